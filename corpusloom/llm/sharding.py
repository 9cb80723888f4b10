"""Shards of equal size that keep linked documents together: balanced label propagation.

In DataFrame functions only. Links are rows (node, hub): nodes of a hub are linked. Nodes
start in shards by turns. In every round a hub counts its nodes per shard, a node prefers
the shard where most of its neighbours are, and as many nodes move as quotas allow:
movers of two shards may change places, and the free room of a shard is dealt to those
who gain most. Every other round asks only for shards with room, for nodes whose
neighbours sit in a full one. Rounds end when no node moves.

Shards hold counts that differ by one at most. Nodes without links have no preference,
so they are counted only, as room, and fill the shards at the end. A hub that has more
nodes than a shard has room is cut beforehand into as few parts as fit, by a hash of the
node. Quotas are a table of shards x shards; ranking movers and numbering rows happens in
ranges of the key, so neither a hot hub nor a hot shard lands in one task.

Defined cases: NULL text has size 8 and the checksum of the empty text, and is linked
with empty texts; NULL keys are placed like others, and all rows of one key and text
count separately; an empty table gives no rows; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.files import shared_folder, written
from corpusloom.operators.ordering import Running, with_row_index, with_running


def _best(counts: Column, own: Column, turn: Column, free: list[bool]) -> Column:
    """The shard with the highest count among those with room and the node's own.

    Ties go to shards with room, then round from ``turn``, so that hubs differ.
    """
    shards = len(free)
    room = F.array(*[F.lit(f) for f in free])

    def ranked(n: Column, s: Column) -> Column:
        rank = F.pmod(s + turn, F.lit(shards))
        return F.struct(
            F.when(room[s] | (s == own), n).otherwise(F.lit(-1)).alias("n"), room[s].alias("room"), rank.alias("rank"), s.alias("shard")
        )

    return F.array_max(F.transform(counts, ranked))["shard"]


def _preferences(links: DataFrame, shard_of: DataFrame, free: list[bool]) -> DataFrame:
    """Linked nodes with their shard, the one they prefer and what they gain."""
    shards = len(free)
    placed = links.join(shard_of, "node")
    per_hub = placed.groupBy("hub").agg(
        F.array(*[F.count_if(F.col("shard") == s) for s in range(shards)]).alias("counts")
    )
    seen = placed.join(per_hub, "hub").groupBy("node", "shard").agg(
        F.array(*[F.sum(F.col("counts")[s]) for s in range(shards)]).alias("counts"), F.min("hub").alias("hub")
    )
    chosen = seen.withColumn("goal", _best(F.col("counts"), F.col("shard"), F.xxhash64("hub"), free).cast("int"))
    return chosen.select(
        "node", "hub", "shard", "goal", (F.col("counts")[F.col("goal")] - F.col("counts")[F.col("shard")]).alias("gain")
    )


def _quotas(wishes: DataFrame, room: Column, shards: int) -> DataFrame:
    """How many may move from shard to goal: those who change places, then the free room.

    ``wishes`` holds shards x shards rows at most.
    """
    back = wishes.select(F.col("goal").alias("shard"), F.col("shard").alias("goal"), F.col("wish").alias("back"))
    both = wishes.join(F.broadcast(back), ["shard", "goal"], "left").fillna(0, ["back"])
    both = both.withColumn("swap", F.least("wish", "back")).withColumn("rest", F.col("wish") - F.col("swap"))
    earlier = Window.partitionBy("goal").orderBy(F.desc("gain"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    left = F.element_at(room, F.col("goal") + 1) - F.coalesce(F.sum("rest").over(earlier), F.lit(0))
    quota = F.col("swap") + F.greatest(F.lit(0), F.least("rest", left))
    return both.select("shard", "goal", "wish", quota.alias("quota"))


def balanced_shards(
    nodes: DataFrame, links: DataFrame, *, shards: int = 24, max_rounds: int = 12, folder: str | None = None
) -> DataFrame:
    """(node, shard) for every row of ``nodes`` (column node, which identifies a row).

    ``links`` has columns node and hub. Counts per shard differ by one at most. The
    table of ``nodes`` should be a written one.
    """
    folder = folder or shared_folder(nodes.sparkSession, "sharding")
    total = nodes.count()
    target = [total // shards + (s < total % shards) for s in range(shards)]
    cap = max(1, total // shards)
    sizes = links.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    links = links.join(sizes, "hub").select(
        "node", F.struct("hub", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / cap)).alias("part")).alias("hub")
    )
    links = written(links, f"{folder}/links")
    first = with_row_index(links.select("node").distinct(), ["node"])
    shard_of = written(first.select("node", (F.col("row_index") % shards).cast("int").alias("shard")), f"{folder}/round-0")
    still = 0
    for turn in range(1, max_rounds + 1):
        held = {row["shard"]: row["n"] for row in shard_of.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        left = [max(0, target[s] - held.get(s, 0)) for s in range(shards)]
        # In turn: wishes for any shard, so that nodes can change places, and for those with room.
        free = [turn % 2 == 1 or n > 0 for n in left]
        found = written(_preferences(links, shard_of, free), f"{folder}/wishes-{turn}")
        movers = found.where("goal <> shard")
        room = F.array(*[F.lit(n).cast("long") for n in left])
        wishes = movers.groupBy("shard", "goal").agg(F.count(F.lit(1)).alias("wish"), F.sum("gain").alias("gain"))
        quotas = written(_quotas(wishes, room, shards), f"{folder}/quotas-{turn}")
        if quotas.where("quota > 0").isEmpty():
            still += 1
            if still == 2 or (all(free) and all(left)):
                break
            continue
        still = 0
        held_back = movers.join(F.broadcast(quotas.where("quota < wish")), ["shard", "goal"])
        going = movers.join(F.broadcast(quotas.where("quota = wish")), ["shard", "goal"]).select("node", "goal")
        order = ["shard", "goal", "loss", "hub", "node"]
        if not quotas.where("quota < wish AND quota > 0").isEmpty():
            held_back = held_back.withColumn("loss", -F.col("gain"))
            ranked = with_running(held_back, order, {"rank": Running("sum", F.lit(1))}, group_by=["shard", "goal"])
            going = going.unionByName(ranked.where("rank < quota").select("node", "goal"))
        moved = shard_of.join(going, "node", "left").select("node", F.coalesce("goal", "shard").alias("shard"))
        shard_of = written(moved, f"{folder}/round-{turn}")

    held = {row["shard"]: row["n"] for row in shard_of.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    alone = with_row_index(nodes.select("node").join(shard_of.select("node"), "node", "left_anti"), ["node"])
    ends, end = [], 0
    for s in range(shards):
        end += target[s] - held.get(s, 0)
        ends.append(end)
    past = F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("row_index"))
    return shard_of.unionByName(alone.select("node", F.size(past).alias("shard")))


def shard_documents(
    docs: DataFrame, *, shards: int = 24, key: str = "doc_id", text: str = "text", max_rounds: int = 12
) -> DataFrame:
    """key, size, text_crc32, shard and slot of every document; equal texts are linked.

    A node is a row: its key, text digest and a number that tells repeated rows apart.
    """
    folder = shared_folder(docs.sparkSession, "sharding")
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content).cast("long") + 8).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.sha2(content, 256).alias("digest"),
    )
    narrow = written(narrow, f"{folder}/documents")
    repeated = narrow.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"),
                                                   F.first("text_crc32").alias("text_crc32"))
    rows = repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    rows = rows.select(F.struct("key", "digest", "copy").alias("node"), "size", "text_crc32")
    rows = written(rows, f"{folder}/rows")
    links = rows.select("node", F.col("node.digest").alias("hub"))
    placed = balanced_shards(rows.select("node"), links, shards=shards, max_rounds=max_rounds, folder=folder)
    placed = written(rows.join(placed, "node"), f"{folder}/placed")
    slots = with_running(placed, ["shard", "node"], {"slot": Running("sum", F.lit(1))}, group_by=["shard"])
    return slots.select(F.col("node.key").alias("key"), "size", "text_crc32", "shard", "slot")
