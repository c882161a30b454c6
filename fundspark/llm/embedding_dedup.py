"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are scaled to length one in double precision, so a cosine of c is a distance of
sqrt(2 - 2c). Each of ``TABLES`` tables joins ``PROJECTIONS`` values floor((a.v + b) / WIDTH) with a
normally distributed a and a uniform b into one key. At cosine 0.95 two vectors share at least one
of the default's keys with probability 0.99, at 0.97 with more than 0.999; vectors at a right angle
share a key with probability 0.0004. Candidates are checked by their exact cosine.

Equal vectors are one node. Nodes that share a key are linked through ``graph.bucket_components``.
``n_links`` is exact for each component found: nodes within half the largest angle of the component's
mean direction, its core, are all linked with each other (angles obey the triangle inequality), so they
are counted, not compared. Only the nodes outside the core are compared with all others, in blocks of
bounded size of which counts alone leave a task. A group of near copies is nearly all core, so its
vectors move once; no group produces its pairs.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with
nothing; vectors of different dimension link with nothing; repeated rows link with each other. A
null key takes part but gives no component its id. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import bucket_components
from .shared import materialise
from .words import flat, lengths, mix, signed

TABLES, PROJECTIONS, WIDTH = 40, 16, 2.0
BLOCK = 512
SEED = 20240229


def projections(dim: int, tables: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * count)), rng.uniform(0, 1, tables * count)


def hash_keys(unit: np.ndarray, tables: int, count: int, width: float, seed: int) -> np.ndarray:
    """One key per row and table."""
    a, b = projections(unit.shape[1], tables, count, seed)
    cells = np.floor(unit @ a / width + b).astype(np.int64).view(np.uint64).reshape(len(unit), tables, count)
    key = np.full((len(unit), tables), unit.shape[1], dtype=np.uint64) + np.arange(tables, dtype=np.uint64) * np.uint64(1 << 32)
    for i in range(count):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, i])
    return key


def unit_rows(values: np.ndarray, size: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by dimension: (row numbers, rows scaled to length one)."""
    start = np.cumsum(size) - size
    out = {}
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        if dim:
            x = values[start[rows][:, None] + np.arange(dim)]
            out[int(dim)] = (rows, x / np.linalg.norm(x, axis=1, keepdims=True))
    return out


def length(x) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, y: acc + y * y))


def cosine(x: str, y: str) -> Column:
    dot = F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, a: acc + a)
    return dot / (length(F.col(x)) * length(F.col(y)))


def core_members(groups: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(component, node, v, copies, core): ``core`` says that the node lies within half the angle of
    ``least`` of the component's mean direction, so that it is linked with every other such node."""
    rows = groups.join(nodes.select("node", "v", "copies"), "node")
    unit = rows.withColumn("_l", length(F.col("v"))).select("component", F.posexplode(F.transform("v", lambda x: x / F.col("_l"))).alias("at", "x"))
    mean = unit.groupBy("component", "at").agg(F.avg("x").alias("x"))
    centre = mean.groupBy("component").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s.x).alias("centre"))
    within = F.try_divide(F.lit(1.0), length(F.col("centre"))).isNotNull() & (cosine("v", "centre") >= math.cos(math.acos(least) / 2) + 1e-9)
    return rows.join(centre, "component").select("component", "node", "v", "copies", F.coalesce(within, F.lit(False)).alias("core"))


def link_cells(members: DataFrame) -> DataFrame:
    """The members by cells (block of nodes outside the core, block of all nodes) of their component:
    ``left`` rows are the former, the others the latter."""
    sizes = members.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("wide"), F.ceil(F.count_if(~F.col("core")) / BLOCK).cast("int").alias("high")
    )
    rows = members.join(sizes.where("high > 0"), "component")
    spot = lambda n: F.pmod(F.xxhash64("node", F.lit(1)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where(~F.col("core")).select("component", spot("high").alias("i"), every("wide").alias("j"), "node", "v", "copies", "core", F.lit(True).alias("left"))
    right = rows.select("component", every("high").alias("i"), spot("wide").alias("j"), "node", "v", "copies", "core", F.lit(False).alias("left"))
    return left.unionByName(right)


def count_links(members: DataFrame, least: float) -> DataFrame:
    """(node, n): how many other vectors each member is linked with."""

    def compare(table: pa.Table) -> pa.Table:
        node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
        core, is_left = (table.column(c).to_numpy(zero_copy_only=False) for c in ("core", "left"))
        out = np.zeros(len(node), dtype=np.int64)
        for rows, unit in unit_rows(flat(table.column("v")), lengths(table.column("v"))).values():
            left, right = np.flatnonzero(is_left[rows]), np.flatnonzero(~is_left[rows])
            near = unit[left] @ unit[right].T >= least
            out[rows[left]] += near @ copies[rows[right]]
            # Nodes outside the core are counted where they are on the left.
            out[rows[right]] += np.where(core[rows[right]], near.T @ copies[rows[left]], 0)
        return pa.table({"node": node, "n": out})

    compared = link_cells(members).groupBy("component", "i", "j").applyInArrow(compare, "node long, n long")
    cores = members.where("core").groupBy("component").agg(F.sum("copies").alias("n"))
    whole = members.where("core").select("component", "node").join(cores, "component").select("node", "n")
    # A node is near itself once: in the core's sum, or where it is on both sides of a cell.
    return compared.unionByName(whole).groupBy("node").agg((F.sum("n") - 1).alias("n"))


def embedding_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    percent: int = 95,
    tables: int = TABLES,
    count: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """Key, n_links, component_id, kept of every row."""
    least = percent / 100
    kind = dict(vectors.dtypes)[key]
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))
    # -0.0 + 0.0 is 0.0: equal vectors have equal arrays. Scaled by the largest component against overflow.
    rows = vectors.select(F.col(key).alias("_key"), F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"))
    rows = rows.withColumn("v", F.when(usable, F.transform(v, lambda x: x / F.array_max(F.transform(v, F.abs)))))
    # Equal vectors are grouped by a 64-bit hash of the vector, which names the node.
    rows = materialise(rows.withColumn("node", F.when(v.isNotNull(), F.xxhash64("v", F.lit(seed)))), "vectors")
    nodes = materialise(
        rows.where("v is not null").groupBy("node").agg(F.first("v").alias("v"), F.min("_key").alias("least"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, unit in unit_rows(flat(batch.column(1)), lengths(batch.column(1))).values():
                sig = hash_keys(unit, tables, count, width, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(sig.reshape(-1))), pa.array(np.repeat(node[rows], tables))], ["sig", "node"]
                )

    buckets = materialise(nodes.select("node", "v").mapInArrow(keys, "sig long, node long"), "buckets")

    def verify(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(nodes.select(F.col("node").alias("a"), F.col("v").alias("va")), "a").join(
            nodes.select(F.col("node").alias("b"), F.col("v").alias("vb")), "b"
        )
        return joined.where(F.size("va") == F.size("vb")).select("a", "b", cosine("va", "vb").alias("c")).where(F.col("c") >= least).select("a", "b")

    groups = materialise(bucket_components(buckets, verify), "groups")
    members = materialise(core_members(groups, nodes, least), "members")
    links = count_links(members, least)
    named = groups.join(nodes.select("node", "least"), "node")
    ids = named.groupBy("component").agg(F.min("least").alias("id"))
    linked = named.join(ids, "component").select("node", "id")
    facts = nodes.select("node", "least", "copies").join(links, "node", "left").join(linked, "node", "left").select(
        "node", F.coalesce("n", F.col("copies") - 1).alias("n_links"), F.coalesce("id", "least").alias("component_id")
    )
    out = rows.select("_key", "node").join(facts, "node", "left").select(
        F.col("_key").cast(kind).alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
