"""Connected components and links between the members of buckets, as Spark joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Alternates large-star and small-star steps until the edges are stars, every node having one edge
    to a centre that has none; both are a minimum per node (combined before the shuffle) and a join, so
    a node with very many links is never gathered. Each round is kept in the shared folder. Empty input
    gives an empty table.
    """

    def stars(edges: DataFrame) -> bool:
        out = edges.select(F.col("u").alias("x"), F.lit(1).cast("long").alias("up"), F.lit(0).alias("down"))
        into = edges.select(F.col("v").alias("x"), F.lit(0).cast("long").alias("up"), F.lit(1).alias("down"))
        ends = out.unionByName(into).groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()

    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "edges")
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def bucket_components(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    possible: Callable[[Column, Column], Column] | None = None,
    star_rounds: int = 3,
) -> DataFrame:
    """Components of the links that ``verify`` confirms among nodes sharing a bucket.

    ``buckets(sig, node[, info])`` says which node is in which bucket; ``verify`` takes pairs
    ``(a, b)`` and returns those that are links; ``possible`` may rule a pair out by the two nodes'
    ``info``, which must not depend on the bucket. A node's weight is the number of places it shares buckets with: in
    a group of near copies the text they derive from has the most. Members are first checked
    against the heaviest node of their buckets; then, as long as this joins components, against the
    heaviest node of another component in each bucket; at last every pair of a bucket whose nodes
    are still in different components is checked, so no component is missed. A bucket whose nodes
    are all connected produces no pairs any more, and a large group does not produce all of its
    pairs.
    """
    if possible is None:
        buckets, possible = buckets.withColumn("info", F.lit(0)), lambda a, b: F.lit(True)
    spread = buckets.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    weight = buckets.join(spread, "sig").groupBy("node").agg(F.sum("n").alias("w"))
    member = materialise(buckets.join(weight, "node").select("sig", "node", "w", "info"), "members")

    def heaviest(now: DataFrame) -> DataFrame:
        """Every node outside the component of its bucket's heaviest node, with that node."""
        lead = (
            now.groupBy("sig")
            .agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max(F.struct("w", "node", "c", "info")).alias("top"))
            .where("low != high")
            .select("sig", F.col("top.c").alias("main"), F.col("top.info").alias("other"), F.struct("top.w", "top.node").alias("lead"))
        )
        fits = (F.col("c") != F.col("main")) & possible(F.col("info"), F.col("other"))
        return now.join(lead, "sig").where(fits).select("node", "lead")

    def best(now: DataFrame) -> DataFrame:
        return heaviest(now).groupBy("node").agg(F.max("lead").alias("lead")).select("node", F.col("lead.node").alias("lead"))

    def each(now: DataFrame) -> DataFrame:
        return heaviest(now).select("node", F.col("lead.node").alias("lead"))

    def everything(now: DataFrame) -> DataFrame:
        """Every pair of a bucket that lies in two components: the nodes outside the bucket's
        largest component with all of its nodes."""
        sizes = now.groupBy("sig", "c").agg(F.count(F.lit(1)).alias("n"))
        mixed = (
            sizes.groupBy("sig")
            .agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count(F.lit(1)).alias("k"))
            .where("k > 1")
            .select("sig", "main")
        )
        rest = now.join(mixed, "sig")
        few = rest.where("c != main").select("sig", "node", F.col("c").alias("c1"), F.col("info").alias("other"))
        fits = (F.col("c") != F.col("c1")) & possible(F.col("info"), F.col("other"))
        return few.join(rest.select("sig", F.col("node").alias("lead"), "c", "info"), "sig").where(fits).select("node", "lead")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()

    tried = materialise(ordered(best(member.withColumn("c", F.col("node")))), "pairs")
    links = materialise(verify(tried), "links")
    known, settled = connected_components(links), False
    for step in [each] * star_rounds + [everything]:
        if step is each and settled:
            continue
        now = member.join(known, "node", "left").select("sig", "node", "w", "info", F.coalesce("component", "node").alias("c"))
        new = materialise(ordered(step(now)).join(tried, ["a", "b"], "left_anti"), "pairs")
        found = materialise(verify(new), "links")
        tried = tried.unionByName(new)
        if found.isEmpty():
            settled = True
            continue
        links = links.unionByName(found)
        known = connected_components(links)
    return known
