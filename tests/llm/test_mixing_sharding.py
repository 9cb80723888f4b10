import random
import zlib
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import mixing, sharding
from corpusloom.llm.queries import op4_mixed_sources, op5_shards

DOCS = "doc_id long, text string, source string, slot string, shard string, label string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], DOCS)


def assert_no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_period_deviates_by_less_than_a_block():
    rng = random.Random(1)
    for _ in range(100):
        weights = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        got = [0] * len(weights)
        for t, s in enumerate(mixing.period(weights), 1):
            got[s] += 1
            assert all(abs(g - w * t / sum(weights)) < 1 for g, w in zip(got, weights, strict=True))
        assert got == weights


def test_every_phase_keeps_the_weights(spark):
    rng = random.Random(2)
    rows = [(i, f"t{i}", rng.choice("aaaaabbc")) for i in range(700)] + [(1000 + i, None, None) for i in range(37)]
    weights = {"a": 3, "b": 5, "c": 1, None: 2}
    found = mixing.mixed_positions(docs(spark, rows), weights=weights, block_rows=4)
    assert_no_python(found)
    got = sorted(found.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert sorted(r["key"] for r in got) == sorted(r[0] for r in rows)
    by_label = defaultdict(list)
    for r in got:
        by_label[r["label"]].append(r["key"])
    assert all(keys == sorted(keys) for keys in by_label.values())
    slots = {r["slot"]: (r["phase"], r["label"]) for r in got}
    assert sorted(slots) == list(range(len(slots)))
    given = {"NULL" if s is None else f"={s}": w for s, w in weights.items()}
    left = Counter(label for _, label in slots.values())
    phase, count, active = None, Counter(), {}
    for slot in sorted(slots):
        if slots[slot][0] != phase:
            phase, count = slots[slot][0], Counter()
            active = {s: given[s] for s, n in left.items() if n}
        label = slots[slot][1]
        count[label] += 1
        left[label] -= 1
        for s, w in active.items():
            assert abs(count[s] - w * sum(count.values()) / sum(active.values())) < 1


def test_files_follow_the_mixture(spark, tmp_path):
    rows = [(i, f"t{i}", "ab"[i % 2]) for i in range(100)]
    df = docs(spark, rows)
    order = [r["key"] for r in mixing.mixed_positions(df, block_rows=3).orderBy("position").collect()]
    mixed = mixing.mixed(df, block_rows=3, rows_per_part=10)
    assert mixed.columns == df.columns
    mixed.write.parquet(f"{tmp_path}/mixed")
    back = spark.read.parquet(f"{tmp_path}/mixed").select("doc_id", "_metadata.file_name", "_metadata.row_index")
    assert [r["doc_id"] for r in back.orderBy("file_name", "row_index").collect()] == order


def test_mixing_edge_cases(spark):
    assert mixing.mixed_positions(docs(spark, [])).count() == 0
    rows = [(None, None, "a"), (1, "x", "a"), (1, "x", "a"), (None, "", None)]
    found = mixing.mixed_positions(docs(spark, rows)).collect()
    assert sorted(r["position"] for r in found) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="weight"):
        mixing.mixed_positions(docs(spark, rows), weights={"a": 1})


def test_mixed_query(spark, small_dir, documents):
    rows = op4_mixed_sources(spark, small_dir).collect()
    assert sorted(r["position"] for r in rows) == list(range(len(documents)))


def check_shards(rows, given, shards):
    """rows of (key, size, crc, shard, slot)"""
    assert Counter((r[0], r[1], r[2]) for r in rows) == Counter(
        (k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in given
    )
    sizes = Counter(r[3] for r in rows)
    assert all(0 <= s < shards for s in sizes)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r[4] for r in rows if r[3] == s) == list(range(sizes.get(s, 0)))


def test_shards_of_the_table(spark, small_dir, documents):
    df = op5_shards(spark, small_dir)
    rows = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect()]
    check_shards(rows, documents, 24)
    texts, held = dict(documents), defaultdict(set)
    for key, *_, shard, _ in rows:
        held[texts[key]].add(shard)
    assert all(len(s) == 1 for s in held.values())


def test_sharding_edge_cases(spark):
    given = [(i, f"own {i}") for i in range(30)] + [(100 + i, "hot") for i in range(40)]
    given += [(200 + i, f"pair {i // 2}") for i in range(20)] + [(None, None), (None, ""), (7, "x"), (7, "x"), (1, "é" * 50_000)]
    df = docs(spark, [(*g, "s") for g in given])
    found = sharding.shard_documents(df, shards=4)
    assert_no_python(found)
    rows = [(r["key"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found.collect()]
    check_shards(rows, given, 4)
    pairs = defaultdict(set)
    for key, _, crc, shard, _ in rows:
        if key is not None and 200 <= key < 300:
            pairs[crc].add(shard)
    assert all(len(s) == 1 for s in pairs.values())
    # 40 equal texts do not fit a shard of 24, but are cut into as few parts as do.
    assert len({r[3] for r in rows if r[0] is not None and 100 <= r[0] < 200}) <= 3
    assert sharding.shard_documents(df.limit(0)).count() == 0
    few = [(r["key"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard_documents(docs(spark, [(1, "a", "s"), (2, "a", "s")])).collect()]
    check_shards(few, [(1, "a"), (2, "a")], 24)


def test_nodes_with_several_hubs_come_together(spark):
    nodes = spark.createDataFrame([(i,) for i in range(400)], "node long")
    links = spark.createDataFrame(
        [(i, i // 10) for i in range(200)] + [(i, 1000 + i // 20) for i in range(200)], "node long, hub long"
    )
    placed = {r["node"]: r["shard"] for r in sharding.balanced_shards(nodes, links, shards=4).collect()}
    counts = Counter(placed.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    whole = sum(len({placed[i] for i in range(g * 10, g * 10 + 10)}) == 1 for g in range(20))
    assert whole >= 16
