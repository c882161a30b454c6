"""Interleave sources at target weights by Pfair scheduling.

Each source's documents are laid out in blocks of about ``block_chars`` characters. With integer
shares n_i of a period of N slots (n_i / N is the weight), block j of source i is released at slot
floor(j * N / n_i) and due by slot ceil((j + 1) * N / n_i); in each slot the released block with the
earliest deadline runs. On one unit-speed sequence whose weights sum to one this meets every
deadline, so after any t slots a source has been given its weight times t to within less than one
block. The schedule repeats after N slots, so only one period is worked out (on the driver: its
size depends on the weights, not on the documents) and the blocks are placed by arithmetic.

Nothing is dropped or repeated: when a source runs out, a new phase starts in which the others share
the slots in proportion to their weights.

Defined results: a null source is a source of its own, named ''. Sources without a target weight
get the weight ``1``; weights of absent sources are ignored; a weight must be positive. A null or
empty text counts as one character. Rows are ordered inside a source by a hash of the key, so the
result does not depend on how the table is stored; repeated rows keep a place each. An empty table
gives an empty table.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ranked

PERIOD = 1000
BLOCK_CHARS = 20_000
ADDED = ("mix_source", "mix_phase", "mix_block", "mix_slot", "mix_place")
MOST_SOURCES = 2000  # the schedule is worked out on the driver


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Integer shares of the period, at least one each, by largest remainder."""
    total = sum(weights.values())
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    period = max(period, len(weights))
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (out[s] - exact[s], s))
    k = 0
    while (gap := period - sum(out.values())) != 0:
        s = order[k % len(order)] if gap > 0 else max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -1, s))
        out[s] += 1 if gap > 0 else -1
        k += 1
    return out


def one_period(share: dict[str, int]) -> dict[str, list[int]]:
    """Slots given to each source in one period: earliest deadline first among released blocks."""
    period = sum(share.values())
    waiting = [(0, s, 0) for s in share]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # (deadline, source, block)
    slots: dict[str, list[int]] = {s: [] for s in share}
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // share[s]), s, j))
        due, s, j = heapq.heappop(ready)
        if t >= due:
            raise RuntimeError(f"block {j} of {s} missed slot {due}")
        slots[s].append(t)
        if j + 1 < share[s]:
            heapq.heappush(waiting, ((j + 1) * period // share[s], s, j + 1))
    return slots


def plan(blocks: dict[str, int], weights: dict[str, float], period: int) -> list[dict]:
    """Phases: base slot, period, and per source (first block, end block, its slots in a period)."""
    done, base, phases = dict.fromkeys(blocks, 0), 0, []
    left = {s for s, n in blocks.items() if n}
    while left:
        share = shares({s: weights[s] for s in left}, period)
        size, slots = sum(share.values()), one_period(share)
        slot_of = lambda s, j: j // share[s] * size + slots[s][j % share[s]]  # noqa: E731, B023
        end = min(slot_of(s, blocks[s] - done[s]) for s in left)
        given = {}
        for s in sorted(left):
            whole, part = divmod(end, size)
            n = whole * share[s] + sum(x < part for x in slots[s])
            given[s] = (done[s], done[s] + n, slots[s])
            done[s] += n
        phases.append({"base": base, "size": size, "given": given})
        base += end
        left = {s for s in left if done[s] < blocks[s]}
    return phases


def tags(key: str, text: str, source: str) -> list[Column]:
    """What the mixture reads of a row: ``mix_source``, ``_mix_chars``, ``_mix_hash``."""
    return [
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("mix_source"),
        F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)).cast("long").alias("_mix_chars"),
        F.xxhash64(key, text).alias("_mix_hash"),
    ]


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_chars: int = BLOCK_CHARS,
    period: int = PERIOD,
) -> DataFrame:
    """All columns of ``docs`` plus ``mix_source``, ``mix_phase``, ``mix_block``, ``mix_slot`` and
    ``mix_place`` (order inside the source): sorted by (mix_slot, mix_place) they are the mixture. Input columns of
    these names are replaced.

    Without ``weights`` each source weighs the square root of its characters.
    """
    # The rows travel as one column: no name of theirs can meet one of the schedule's.
    names = [c for c in docs.columns if c not in ADDED]
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in names]).alias("_mix_row")
    mixed = placed(docs.select(row, *tags(key, text, source)), weights, block_chars, period)
    return mixed.select(*[F.col("_mix_row").getField(c).alias(c) for c in names], *ADDED)


def quoted(name: str) -> str:
    """A column name as it stands, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def placed(
    named: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS, period: int = PERIOD
) -> DataFrame:
    """The columns of ``named`` (``tags`` among them), ``mix_phase``, ``mix_block``, ``mix_slot`` and ``mix_place``."""
    spark = named.sparkSession
    sums = named.groupBy("mix_source").agg(F.sum("_mix_chars").alias("chars")).limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    chars = {r["mix_source"]: r["chars"] for r in sums}
    blocks = {s: -(-n // block_chars) for s, n in chars.items()}
    goal = {s: (weights.get(s, 1.0) if weights is not None else chars[s] ** 0.5) for s in blocks}
    phases = plan(blocks, goal, period)
    table = [
        (s, p, low, high, ph["base"], ph["size"], slots)
        for p, ph in enumerate(phases)
        for s, (low, high, slots) in ph["given"].items()
        if high > low
    ]
    schedule = spark.createDataFrame(
        table, "s string, phase int, low long, high long, base long, size long, slots array<int>"
    )
    rows = ranked(named, ["mix_source"], ["_mix_hash"], F.col("_mix_chars")).withColumn(
        "mix_block", F.expr(f"_before div {int(block_chars)}")
    )
    j = F.col("mix_block") - F.col("low")
    share = F.size("slots")
    slot = F.col("base") + F.floor(j / share) * F.col("size") + F.get("slots", F.pmod(j, share).cast("int"))
    on = (F.col("mix_source") == F.col("s")) & (F.col("mix_block") >= F.col("low")) & (F.col("mix_block") < F.col("high"))
    return rows.join(F.broadcast(schedule), on).select(
        *[F.col(quoted(c)) for c in named.columns], F.col("phase").alias("mix_phase"), "mix_block", slot.alias("mix_slot"),
        F.col("_rank").alias("mix_place"),
    )


def interleave(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs`` in the order of the mixture."""
    mixed = mix_sources(docs, **options).orderBy("mix_slot", "mix_source", "mix_place")
    return mixed.select(*[F.col(quoted(c)) for c in docs.columns])
