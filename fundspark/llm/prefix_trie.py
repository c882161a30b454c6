"""Prefix trie of conversations as a burst trie.

A conversation is the sequence of its turns (role and text); a node is a distinct sequence of first
turns. Equal conversations are first reduced to one sequence with its number of copies. Sequences
then lie in suffix containers under trie heads: at first one container under the root. A container of
more than ``MOST_TURNS`` turns bursts: the turns that all its suffixes share become a chain of heads
(the common prefix is that of its smallest and largest suffix, two aggregates), and the rest is dealt
into containers by the next turn's id. So a long shared prefix costs one round, and a container of any
size is divided by aggregates and joins, never gathered. The remaining containers are dealt to shards
by their head, sorted there (Spark's sort spills) and swept: neighbours in the sorted order share
exactly their common ancestors, so one path of open nodes is enough. Heads take their figures from the
containers and heads below them, from the last round up.

Memory: a conversation is one row of 16 bytes a turn (id and length of the text, no text); a sweep
holds one path and the finished children on it, at most one container; the digest of a node reads the
member ids in order, in strings of ``CHUNK`` ids, so copies of one conversation pass through a task
without being held there. Turn ids are 64-bit hashes, sequences are told apart by two of them.

Defined results: a null role or text counts as empty; turns are ordered by ``turn``, null first, and
equal turns by their ids; repeated rows are repeated turns; rows without a conversation id belong to
no conversation and are left out; an empty table has no nodes. Only the four columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, shuffle_width

MOST_TURNS, CHUNK, SPREAD = 8192, 8192, 16
EMPTY = hashlib.sha256(b"").hexdigest()
TURN = "struct<id:bigint,bytes:bigint>"
#: ``up`` is the head over a container's or chain's first node, null elsewhere and at the root.
NODE = "conv long, depth long, parent long, n long, children long, leaves long, saved long, ends string, up long"
NODE_ARROW = pa.schema([(c.split()[0], pa.string() if c.split()[1] == "string" else pa.int64()) for c in NODE.split(", ")])


def sequences(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv, turns)``: each conversation's turns in order, as ids with the UTF-8 length of the text."""
    said = F.coalesce(F.col(text), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.xxhash64(F.coalesce(F.col(role), F.lit("")), said).alias("id"),
            F.octet_length(said).cast("long").alias("bytes"),
        ).alias("turn"),
    )
    listed = rows.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # null first
    return listed.select("conv", F.transform("turns", lambda t: F.struct(t.id.alias("id"), t.bytes.alias("bytes"))).alias("turns"))


def rebuilt(said: DataFrame) -> DataFrame:
    """The query's conversations: the first h turns are those of conversation ``conv - conv % 5``."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(9)).cast("int")
    first = said.where("pmod(conv, 5) = 0").select(F.col("conv").alias("base"), F.slice("turns", 1, 8).alias("head"))
    joined = said.withColumn("base", F.col("conv") - F.pmod("conv", F.lit(5))).join(first, "base", "left")
    none = F.array().cast(f"array<{TURN}>")
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return joined.withColumn("h", h).select("conv", F.concat(F.coalesce(F.expr("slice(head, 1, h)"), none), own).alias("turns"))


def _member_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive ids of one sequence as comma-joined strings of at most ``CHUNK`` ids."""
    names = ["a", "b", "first", "n", "ids"]
    held, key = [], None

    def rows(out):
        return pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in out], pa.int64()) for i in range(4)], pa.array([r[4] for r in out], pa.string())], names)

    for batch in batches:
        out = []
        for a, b, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held and ((a, b) != key or len(held) == CHUNK):
                out.append((*key, held[0], len(held), ",".join(map(str, held))))
                held = []
            key = (a, b)
            held.append(conv)
        yield rows(out)
    if held:
        yield rows([(*key, held[0], len(held), ",".join(map(str, held)))])


def _member_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence: smallest id, number of ids and the digest of all of them."""
    key = lead = digest = None
    count = 0

    def rows(out):
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["conv", "n", "ends"])

    for batch in batches:
        out = []
        for a, b, first, n, ids in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (a, b) == key:
                digest.update(b"," + ids.encode())
                count += n
                continue
            if key is not None:
                out.append((lead, count, digest.hexdigest()))
            key, lead, count, digest = (a, b), first, n, hashlib.sha256(ids.encode())
        yield rows(out)
    if key is not None:
        yield rows([(lead, count, digest.hexdigest())])


def distinct_sequences(said: DataFrame) -> DataFrame:
    """``(conv, n, ends, turns)``: one row per distinct sequence, with its smallest conversation, the
    number of its copies and the digest of their ids."""
    width = shuffle_width(said.sparkSession)
    keyed = said.select(F.xxhash64("turns").alias("a"), F.xxhash64(F.lit(1), "turns").alias("b"), "conv")
    dealt = keyed.repartitionByRange(width, "a", "b", "conv").sortWithinPartitions("a", "b", "conv")
    strings = dealt.mapInArrow(_member_strings, "a long, b long, first long, n long, ids string")
    grouped = strings.repartition(width, "a", "b").sortWithinPartitions("a", "b", "first")
    digests = grouped.mapInArrow(_member_digests, "conv long, n long, ends string")
    return digests.join(said, "conv")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the containers of a shard, whose suffixes come sorted by container."""
    path: list[list] = []  # open nodes: [turn id, bytes, conv, n, leaves, saved, ends, finished children]
    out: list[tuple] = []
    head, up, base = None, None, 0

    def finish() -> None:
        _, size, conv, n, leaves, saved, ends, kids = path.pop()
        leaves, saved = (leaves or 1), saved + (n - 1) * size
        out.extend((k_conv, base + len(path) + 1, conv, *rest, None) for k_conv, *rest in kids)
        mine = (conv, n, len(kids), leaves, saved, ends or EMPTY)
        if path:
            over = path[-1]
            over[2] = min(over[2], conv)
            over[3] += n
            over[4] += leaves
            over[5] += saved
            over[7].append(mine)
        else:
            out.append((conv, base, None, n, len(kids), leaves, saved, ends or EMPTY, up))

    def table() -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], f.type) for i, f in enumerate(NODE_ARROW)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, schema=NODE_ARROW)

    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(8))
        for this, over, depth, size, conv, n, ends, rest in zip(*columns, strict=True):
            shared = 0
            if this == head:
                while shared < len(rest) and shared + 1 < len(path) and path[shared + 1][0] == rest[shared]["id"]:
                    shared += 1
            while len(path) > (shared + 1 if this == head else 0):
                finish()
            if this != head:
                head, up, base = this, over, depth
                path.append([None, size, conv, 0, 0, 0, None, []])
            for t in rest[shared:]:
                path.append([t["id"], t["bytes"], conv, 0, 0, 0, None, []])
            last = path[-1]
            last[2], last[3], last[6] = min(last[2], conv), last[3] + n, ends
        yield table()
    while path:
        finish()
    yield table()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a burst container's common prefix, from its first node down to where it divides."""
    for batch in batches:
        out = []
        columns = (batch.column(i).to_pylist() for i in range(9))
        for up, depth, sizes, conv, n, children, leaves, saved, ends in zip(*columns, strict=True):
            last = len(sizes) - 1
            for j in range(last, -1, -1):
                saved += (n - 1) * sizes[j]
                bottom = j == last
                out.append((conv, depth + j, conv if j else None, n, children if bottom else 1, leaves, saved, ends if bottom else EMPTY, None if j else up))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(NODE_ARROW)], schema=NODE_ARROW)


def trie_nodes(said: DataFrame, most: int = MOST_TURNS) -> DataFrame:
    """One row per node of the trie of ``said(conv, turns)``: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (bytes of turns that the subtree shares) and ``ends_sha256`` (members that end here).

    ``most`` bounds the turns of a container, not of a conversation: a longer one is a chain of heads.
    """
    spark = said.sparkSession
    said = materialise(said, "sequences")
    rows = distinct_sequences(said).select(
        F.lit(0).cast("long").alias("head"), F.lit(None).cast("long").alias("up"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("bytes"), "conv", "n", "ends", F.col("turns").alias("rest"),
    )
    live = materialise(rows, "suffixes")
    containers, bursts = [], []
    while True:
        sizes = live.groupBy("head").agg(
            F.sum(F.size("rest")).alias("turns"), F.min("rest").alias("low"), F.max("rest").alias("high"),
            *[F.first(c).alias(c) for c in ("up", "depth", "bytes")],
        )
        # Where the smallest and the largest suffix part, counted from 0.
        apart = F.expr("array_position(zip_with(low, high, (x, y) -> coalesce(x.id <> y.id, true)), true)")
        shared = F.when(apart > 0, apart - 1).otherwise(F.size("low")).cast("int")
        burst = sizes.where(F.col("turns") > most).select(
            "head", "up", "depth", shared.alias("shared"),
            F.concat(F.array("bytes"), F.slice("low", F.lit(1), shared).getField("bytes")).alias("sizes"),
        )
        burst = materialise(burst, "bursts")
        if burst.isEmpty():
            containers.append(live)
            break
        # A head may hold a third of all suffixes: it is met in SPREAD places.
        spot = F.pmod("conv", F.lit(SPREAD))
        wide = burst.select("head", "shared", F.explode(F.expr(f"sequence(0L, {SPREAD - 1}L)")).alias("spot"))
        met = live.withColumn("spot", spot).join(wide, ["head", "spot"], "left").drop("spot")
        containers.append(met.where("shared is null").drop("shared"))
        moved = materialise(met.where("shared is not null"), "moved")
        turn = F.get("rest", "shared")
        live = materialise(
            moved.where("size(rest) > shared").select(
                F.xxhash64("head", turn.getField("id")).alias("head"), F.col("head").alias("up"),
                (F.col("depth") + F.col("shared") + 1).alias("depth"), turn.getField("bytes").alias("bytes"),
                "conv", "n", "ends", F.expr("slice(rest, shared + 2, greatest(size(rest) - shared - 1, 0))").alias("rest"),
            ),
            "suffixes",
        )
        bursts.append((burst, moved.where("size(rest) = shared").select("head", "conv", "n", "ends")))
    suffixes = containers[0]
    for other in containers[1:]:
        suffixes = suffixes.unionByName(other)
    shards = suffixes.repartition(shuffle_width(spark), "head").sortWithinPartitions("head", "rest")
    nodes = shards.select("head", "up", "depth", "bytes", "conv", "n", "ends", "rest").mapInArrow(_sweep, NODE)
    if bursts:
        nodes = materialise(nodes, "nodes")
        heads, tops = [], nodes.where("up is not null").select("up", "conv", "n", "leaves", "saved")
        for burst, ended in reversed(bursts):
            below = tops.groupBy("up").agg(
                F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("children"),
                F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
            )
            here = ended.select(F.col("head").alias("_head"), F.col("conv").alias("_conv"), F.col("n").alias("_n"), "ends")
            figures = (
                burst.join(below.withColumnRenamed("up", "_up"), F.col("head") == F.col("_up"), "left")
                .join(here, F.col("head") == F.col("_head"), "left")
                .select(
                    "head", "up", "depth", "sizes", F.least("conv", "_conv").alias("conv"),
                    (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("long").alias("n"),
                    *[F.coalesce(c, F.lit(d)).cast("long").alias(c) for c, d in (("children", 0), ("leaves", 1), ("saved", 0))],
                    F.coalesce("ends", F.lit(EMPTY)).alias("ends"),
                )
            )
            figures = materialise(figures, "heads")
            heads.append(figures)
            chain = F.expr("aggregate(sizes, 0L, (s, x) -> s + x)")
            first = figures.where("up is not null").select("up", "conv", "n", "leaves", (F.col("saved") + (F.col("n") - 1) * chain).alias("saved"))
            # The next round up: its containers' first nodes and these heads.
            tops = tops.unionByName(first)
        figures = heads[0]
        for other in heads[1:]:
            figures = figures.unionByName(other)
        chains = figures.select("up", "depth", "sizes", "conv", "n", "children", "leaves", "saved", "ends").mapInArrow(_chain, NODE)
        every = nodes.unionByName(chains)
        over = figures.select(F.col("head").alias("_over"), F.col("conv").alias("_parent"))
        first = every.where("up is not null").join(over, F.col("up") == F.col("_over")).withColumn("parent", F.col("_parent"))
        nodes = every.where("up is null").unionByName(first.drop("_over", "_parent"))
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def prefix_trie(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    most: int = MOST_TURNS,
) -> DataFrame:
    """The trie of a table of turns, as :func:`trie_nodes`."""
    return trie_nodes(sequences(turns, conv, turn, role, text), most)


def prefix_trie_sql() -> str:
    """DuckDB SQL for the query: every prefix as a list of turns, grouped, and joined with its subtree."""
    return """
    WITH said AS (
      SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    hashed AS (
      -- CRC-32 of the decimal id: reflected, bit by bit
      SELECT *, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
          lambda ch: CAST(ascii(ch) AS UBIGINT))), lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
          lambda a, b: xor(a // 2, 3988292384::UBIGINT * (a % 2)))), 4294967295::UBIGINT) % 9 AS INTEGER) AS h
      FROM said),
    rebuilt AS (
      SELECT x.conv_id, list_concat(coalesce(y.turns[1:x.h], []), x.turns[x.h + 1:]) AS turns
      FROM hashed x LEFT JOIN said y ON y.conv_id = x.conv_id - x.conv_id % 5),
    prefixes AS (
      SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
    cut AS (
      SELECT conv_id, depth, CAST(turns[1:depth] AS VARCHAR) AS node, depth = len(turns) AS ends,
             coalesce(strlen(turns[depth].text), 0) AS bytes,
             CASE WHEN depth > 0 THEN CAST(turns[1:depth - 1] AS VARCHAR) END AS above
      FROM prefixes),
    nodes AS (
      SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(bytes) AS bytes,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM cut GROUP BY depth, node),
    children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    counted AS (
      SELECT n.*, coalesce(c.n_children, 0) AS n_children
      FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node),
    under AS (
      -- the prefixes of a node's smallest member are the node's ancestors and itself
      SELECT c.node, c.depth, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved
      FROM counted d JOIN cut c ON c.conv_id = d.conv_id AND c.depth <= d.depth GROUP BY c.node, c.depth)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, u.n_leaves,
           CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM counted n JOIN under u ON u.node = n.node AND u.depth = n.depth
    LEFT JOIN counted p ON p.node = n.above AND p.depth = n.depth - 1
    """
