"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

The rows of a source, in key order, form blocks. A mixture is a sequence of slots of one
block each. Block j (from 0) of a source with weight w of W is released at slot
floor(j W / w) and due before slot ceil((j + 1) W / w); every slot takes the released
block that is due first. Then after every slot each source has got less than one block
more or less than its weight asks for.

Weights are whole numbers, so a schedule repeats after W slots, and the slot of a block
is arithmetic: its period and its place in one table of W rows. When a source has no
block left, a new schedule begins for the others with the weights they have (a phase), so
the bound holds within every phase and no row is dropped or repeated. The schedule is made from
the number of rows per source alone; sources and W are bounded and checked.

Defined cases: NULL is a source of its own; a source without a weight is an error; NULL
keys come first, rows of equal key are ordered by their checksum and repeated rows stand
next to each other; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.files import shared_folder, written
from corpusloom.operators.ordering import Running, with_running

MAX_SOURCES = 1000
MAX_PERIOD = 100_000


def period(weights: list[int]) -> list[int]:
    """Which entry of ``weights`` each slot of one period takes."""
    total = sum(weights)
    released = [(0, -(-total // w), s, 0) for s, w in enumerate(weights)]
    heapq.heapify(released)
    ready: list[tuple[int, int, int]] = []
    slots = []
    for t in range(total):
        while released and released[0][0] <= t:
            _, due, s, j = heapq.heappop(released)
            heapq.heappush(ready, (due, s, j))
        _, s, j = heapq.heappop(ready)
        slots.append(s)
        if j + 1 < weights[s]:
            w = weights[s]
            heapq.heappush(released, ((j + 1) * total // w, -(-(j + 2) * total // w), s, j + 1))
    return slots


@dataclass(frozen=True)
class Phase:
    """Slots first to first + slots - 1; of source s the blocks begin[s] to begin[s] + taken[s] - 1."""

    number: int
    first: int
    slots: int
    weights: dict[str, int]
    begin: dict[str, int]
    taken: dict[str, int]
    order: list[str]


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[Phase]:
    """The whole mixture, from the number of blocks per source."""
    left = {s: n for s, n in sorted(blocks.items()) if n}
    done = dict.fromkeys(left, 0)
    found, first = [], 0
    while left:
        names = list(left)
        divisor = math.gcd(*[weights[s] for s in names])
        own = {s: weights[s] // divisor for s in names}
        order = [names[i] for i in period(list(own.values()))]
        rounds = min(left[s] // own[s] for s in names)
        taken = {s: rounds * own[s] for s in names}
        slots = rounds * len(order)
        if all(taken[s] < left[s] for s in names):
            for s in order:
                taken[s] += 1
                slots += 1
                if taken[s] == left[s]:
                    break
        found.append(Phase(len(found), first, slots, own, dict(done), taken, order))
        first += slots
        for s in names:
            done[s] += taken[s]
            left[s] -= taken[s]
            if not left[s]:
                del left[s]
    return found


def _label(source: Column) -> Column:
    """Text that tells sources apart, NULL included."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("NULL"))


def rows_per_source(docs: DataFrame, source: str) -> dict[str, int]:
    found = docs.groupBy(_label(F.col(source)).alias("s")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1)
    rows = found.collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return {row["s"]: row["n"] for row in rows}


def tempered_weights(rows: Mapping[str, int], power: float, total: int = 1000) -> dict[str, int]:
    """Whole weights in proportion to rows ** power that sum to about ``total``, each 1 at least."""
    raw = {s: n**power for s, n in rows.items() if n}
    scale = total / sum(raw.values()) if raw else 0
    return {s: max(1, round(x * scale)) for s, x in raw.items()}


def _table(spark: SparkSession, rows: list[list], schema: str) -> DataFrame:
    """A small table as a constant of the plan."""
    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = ", ".join(part.replace(" ", ": ") for part in schema.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def mixed_positions(
    docs: DataFrame,
    *,
    weights: Mapping[str | None, int] | None = None,
    power: float = 0.5,
    block_rows: int = 16,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """key, crc, label, block, phase, slot, position of every row; positions run from 0 without gaps.

    ``weights`` gives each source its whole-number weight; without it weights follow the
    number of rows to ``power``. Only the narrow columns are ordered and joined.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "mixing")
    narrow = docs.select(
        F.col(key).alias("key"), F.crc32(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("crc"),
        _label(F.col(source)).alias("label"),
    )
    narrow = written(narrow, f"{folder}/rows")
    rows = {
        row["label"]: row["n"]
        for row in narrow.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    }
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    given = tempered_weights(rows, power) if weights is None else {
        "NULL" if s is None else f"={s}": w for s, w in weights.items()
    }
    if missing := sorted(s for s in rows if given.get(s, 0) < 1):
        raise ValueError(f"sources without a positive weight: {missing}")
    if sum(given[s] for s in rows) > MAX_PERIOD:
        raise ValueError(f"weights sum to more than {MAX_PERIOD}")
    plan = phases({s: -(-n // block_rows) for s, n in rows.items()}, given)

    # Bounded by sources squared, and by sources times the sum of weights.
    spans = [
        [p.number, s, p.begin[s], p.begin[s] + p.taken[s], p.weights[s], p.first, len(p.order)]
        for p in plan for s in p.weights if p.taken[s]
    ]
    turns: list[list] = []
    ends: list[list[int]] = []
    for p in plan:
        seen = dict.fromkeys(p.weights, 0)
        for at, s in enumerate(p.order):
            turns.append([p.number, s, seen[s], at])
            seen[s] += 1
        for s, taken in p.taken.items():
            last = p.begin[s] + taken == -(-rows[s] // block_rows)
            if last and taken and rows[s] % block_rows:
                j = taken - 1
                place = [at for at, name in enumerate(p.order) if name == s][j % p.weights[s]]
                ends.append([p.first + j // p.weights[s] * len(p.order) + place, block_rows - rows[s] % block_rows])
    phase_of = _table(
        spark, spans,
        "phase int, label string, from_block bigint, to_block bigint, weight bigint, first_slot bigint, length bigint",
    )
    turn_of = _table(spark, turns, "phase int, label string, turn bigint, place bigint")

    numbered = with_running(
        narrow, ["label", "key", "crc"], {"row": Running("sum", F.lit(1))}, group_by=["label"]
    )
    numbered = numbered.withColumn("block", F.floor(F.col("row") / block_rows))
    in_phase = (F.col("block") >= F.col("from_block")) & (F.col("block") < F.col("to_block"))
    placed = numbered.join(F.broadcast(phase_of.withColumnRenamed("label", "l")), (F.col("label") == F.col("l")) & in_phase)
    since = F.col("block") - F.col("from_block")
    placed = placed.withColumn("turn", since % F.col("weight")).join(F.broadcast(turn_of), ["phase", "label", "turn"])
    slot = F.col("first_slot") + F.floor(since / F.col("weight")) * F.col("length") + F.col("place")
    short = F.from_json(F.lit(json.dumps(sorted(ends))), "array<array<bigint>>")
    missing_rows = F.aggregate(
        short, F.lit(0).cast("long"), lambda n, end: n + F.when(end[0] < F.col("slot"), end[1]).otherwise(F.lit(0))
    )
    placed = placed.withColumn("slot", slot)
    position = F.col("slot") * block_rows + F.col("row") % block_rows - missing_rows
    return placed.select("key", "crc", "label", "block", "phase", "slot", position.cast("long").alias("position"))


def mixed(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", rows_per_part: int = 50_000, least_rows: int = 1_000,
    **how,
) -> DataFrame:
    """The documents in mixture order: sorted within partitions that follow each other.

    ``key`` must identify a row. Writing the result gives files in that order: of at most
    ``rows_per_part`` rows, and enough of them for two tasks a core wherever files of
    ``least_rows`` rows suffice for that, since a later job reads a small file in one task.
    """
    folder = shared_folder(docs.sparkSession, "mixture")
    found = mixed_positions(docs, key=key, text=text, **how)
    found = written(found.select(F.col("key").alias("_mix_key"), F.col("position").alias("_mix_position")), folder)
    joined = docs.join(found, F.col(key).eqNullSafe(F.col("_mix_key")))
    rows = found.count()
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-rows // rows_per_part), min(tasks, -(-rows // least_rows)))
    ordered = joined.repartitionByRange(parts, "_mix_position").sortWithinPartitions("_mix_position")
    return ordered.select(*docs.columns)
