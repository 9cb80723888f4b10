import random

import numpy as np
import pytest

from corpusloom.llm import decontaminate
from corpusloom.llm.decontaminate import Latent, contaminated
from corpusloom.llm.queries import op6_contaminated

WORDS = [a + b + c for a in "bdfgklmnprst" for b in ("a", "e", "io", "u") for c in ("ck", "l", "n", "rd", "st")]


def made(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def tables(spark):
    items = [(i, made(f"item{i}", 30 + i)) for i in range(12)] + [(50, None), (51, "too short"), (0, made("item0", 30))]
    docs = [(i, made(f"doc{i}", 150)) for i in range(60)]
    for i in range(6):
        docs[i] = (i, f"{docs[i][1]} {items[i][1]} {made(i, 40)}")
    words = items[6][1].split()
    words[5], words[17] = "changed", "replaced"
    docs[6] = (6, f"{made('x', 80)} {' '.join(words)} {made('y', 80)}")
    docs += [(60, None), (61, ""), (None, items[7][1]), (62, made("long", 30_000) + " " + items[8][1])]
    docs = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item int")
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_planted_items_also_reworded_ones(spark):
    docs, items = tables(spark)
    found = {(r["key"], r["item"]) for r in contaminated(docs, items).collect()}
    assert found == {(i, i) for i in range(7)} | {(None, 7), (62, 8)}


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert contaminated(docs.limit(0), items).collect() == []
    assert contaminated(docs, items.limit(0)).collect() == []


def by_all_regions(docs, items):
    """(document, item) by the common subsequence of each item and every region of each document."""
    found = {}
    for d, text in docs:
        words = text.split()
        for i, item in items:
            own = item.split()
            n = len(own)
            region, step = n + 2 * (n // 2 + 1), max(1, n // 8)
            for at in range(0, max(0, len(words) - region) + step, step):
                row = [0] * (n + 1)
                for word in words[at : at + region]:
                    above = row[:]
                    for j in range(n):
                        row[j + 1] = above[j] + 1 if word == own[j] else max(above[j + 1], row[j])
                found[d, i] = max(found.get((d, i), 0), row[n] / n)
    return found


def reworded(item, share, seed, new):
    rng, words = random.Random(seed), item.split()
    last = len(words) - 4  # the answer stays
    for place in rng.sample(range(last), min(last, round(share * len(words)))):
        words[place] = f"new{seed}{place}" if new else rng.choice(WORDS)
    return " ".join(words)


def test_reworded_items_against_all_regions(spark):
    items = [(i, f"{made(f'item{i}', 16 + 5 * i)}. {made(f'answer{i}', 4)}") for i in range(6)]
    items = [(i, text.replace(".", ". ").replace("  ", " ")) for i, text in items]
    plain = [(i, text.replace(".", "")) for i, text in items]
    docs = []
    for i, item in plain:
        for share in (0.2, 0.25, 0.3, 0.35, 0.4, 0.45):
            for new in (False, True):
                d = len(docs)
                docs.append((d, f"{made(f'a{d}', 40 + d % 9)} {reworded(item, share, d, new)} {made(f'b{d}', 30)}"))
    docs += [(len(docs) + k, made(f"clean{k}", 120)) for k in range(6)]
    docs += [(len(docs) + k, f"{made(f'c{k}', 20)} {plain[0][1]}") for k in range(40)]  # an item in over a third
    exact = by_all_regions(docs, plain)
    rows = contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = {(r["key"], r["item"]): r["common"] for r in rows}
    answers = {i: text.split()[-4:] for i, text in plain}
    told = dict(docs)
    for pair, common in exact.items():
        if common >= 0.8 or (common >= 0.55 and " ".join(answers[pair[1]]) in told[pair[0]]):
            assert found[pair] == common, pair
        elif common < 0.55:
            assert pair not in found
    assert len(found) >= 40 + 60


def test_share_that_the_search_finds_of_all_that_the_check_would_take(spark, small_dir):
    """Items of the benchmark with 20 to 45 % of their words replaced, in texts of the corpus."""
    texts = [r["text"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").where("length(text) > 400").limit(60).collect()]
    words = [word for text in texts for word in text.split()]
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    docs = []
    for row in items.collect():
        body, rng = row["text"].split(), random.Random(row["item_id"])
        for share in (0.2, 0.25, 0.3, 0.35, 0.4, 0.45):
            for new in (False, True):
                changed = list(body)
                for place in rng.sample(range(len(body)), round(share * len(body))):
                    changed[place] = f"new{place}" if new else rng.choice(words)
                at = rng.randrange(len(words) - 200)
                around = words[at : at + 60], words[at + 60 : at + 100]
                docs.append((len(docs), " ".join([*around[0], *changed, *around[1]])))
    docs = spark.createDataFrame(docs, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{small_dir}/documents.parquet").selectExpr("doc_id + 1000000 AS doc_id", "text")
    )
    found = {(r["key"], r["item"]) for r in contaminated(docs, items).collect()}
    every = {(r["key"], r["item"]) for r in contaminated(docs, items, Latent(near=-2.0)).collect()}
    none = contaminated(docs, items, Latent(near=1.1)).collect()
    assert none == []  # what the search does not propose is not found
    assert found <= every and len(every) > 60
    assert len(found) >= 0.95 * len(every)


def test_short_items_word_for_word(spark):
    docs = [(1, "we saw the Red, lazy fox run"), (2, "the lazy red fox"), (3, "red lazy"), (4, "fox"), (5, None), (6, "red lazy fox red lazy fox")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "red lazy fox"), (2, "run"), (3, " . "), (4, "red lazy fox"), (5, "absent")], "item_id long, text string")
    found = sorted((r["key"], r["item"], r["common"], r["answer"], r["first_word"], r["words"]) for r in contaminated(docs, items).collect())
    assert found == [(1, 1, 1.0, True, 3, 3), (1, 2, 1.0, True, 6, 1), (1, 4, 1.0, True, 3, 3), (6, 1, 1.0, True, 0, 3), (6, 4, 1.0, True, 0, 3)]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200])
def test_prefix_sums(n):
    rows = np.random.default_rng(n).integers(0, 9, (n, 3)).astype(np.float32)
    assert (decontaminate._prefix_sums(rows) == np.concatenate([np.zeros((1, 3)), np.cumsum(rows, axis=0)])).all()


def test_query_against_all_regions(spark, small_dir):
    """Whole tables: every pair that the common subsequence takes with 0.8 is found, none below 0.55."""
    clean = [(r[0], "".join(c if c.isalnum() else " " for c in (r[1] or "").lower())) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = {r["item_id"]: "".join(c if c.isalnum() else " " for c in r["text"].lower()) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]): r["common"] for r in op6_contaminated(spark, small_dir).collect()}
    own = {i: set(text.split()) for i, text in items.items()}
    exact = {}
    for d, text in clean:
        held = set(text.split())
        near = [(i, items[i]) for i in items if len(own[i] & held) >= 0.4 * len(own[i])]
        exact |= by_all_regions([(d, text)], near)
    assert {pair for pair, common in exact.items() if common >= 0.8} <= found.keys()
    assert all(exact[pair] == common and common >= 0.55 for pair, common in found.items())
