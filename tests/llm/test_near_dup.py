import random

import numpy as np

from corpusloom.llm import near_dup
from corpusloom.llm.alignment import common_subsequence, ordered_similarity
from corpusloom.llm.components import components
from corpusloom.llm.queries import op3_near_duplicates
from corpusloom.llm.shingles import numbered, shingles_of_words, word_hashes


def plain_common(a, b, band=None):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            near = band is None or abs(i - j) <= band
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] and near else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_common_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(0, 20)), rng.integers(0, 6, rng.integers(0, 20))
        for band in (None, 0, 2, 30):
            assert common_subsequence(a, b, band) == plain_common(a, b, band)
        whole = plain_common(a, b)
        union = len(a) + len(b) - whole
        exact = whole / union if union else 0
        assert np.isclose(ordered_similarity(a, b, 0.8), exact if exact >= 0.8 - 1e-9 else 0)


def test_shingles_are_those_of_words():
    texts = ["A b  c\td e f", "", "one two", "x", "a b c d e f", " lead and trail ", "é É"]
    hashes, first = word_hashes(texts)
    words = [t.lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    names = {}
    for h, w in zip(hashes.tolist(), [x for w in words for x in w], strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    assert len(shingles_of_words(hashes[first[2] : first[3]], 5)) == 1
    repeated = numbered(np.array([7, 7, 8, 7], np.uint64))
    assert len(set(repeated.tolist())) == 4 and repeated[0] == 7


def classes(rows):
    """Smallest key of each row's class, by comparing all pairs."""
    keys, texts = [r[0] for r in rows], [r[1] or "" for r in rows]
    sequences = [shingles_of_words(word_hashes([t])[0], 5) for t in texts]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and (texts[i] == texts[j] or ordered_similarity(sequences[i], sequences[j], 0.8)):
                parent[find(i)] = find(j)
    least = {}
    for i, key in enumerate(keys):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted((str(key), str(least.get(find(i)))) for i, key in enumerate(keys))


def group_of_copies(rng, size, words=150, edits=6):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_classes_with_a_large_group_of_chained_copies(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = group_of_copies(rng, 300)
    texts += [f"{passage} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(90)) for _ in range(60)]
    texts += [t for _ in range(20) for t in group_of_copies(rng, 3, rng.randrange(4, 700), 3)]
    rows = [(i, t) for i, t in enumerate(texts)]
    p = near_dup.OrderMinHash(block=64)
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), p).collect()
    assert sorted((str(r["key"]), str(r["class_id"])) for r in found) == classes(rows)


def test_short_texts_that_differ_by_a_word_at_an_end(spark):
    rng = random.Random(8)
    rows = []
    for n in range(6, 31):
        for turn in range(12):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            other = {0: [*words, "end"], 1: ["begin", *words], 2: [*words[:-1], "other"], 3: words[1:]}[turn % 4]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r["key"]), str(r["class_id"])) for r in near_dup.near_duplicates(df).collect())
    exact = classes_of_neighbours(rows)
    assert sum(key != least for key, least in exact) > 200
    assert found == exact


def classes_of_neighbours(rows):
    """As ``classes`` where only the rows 2k and 2k + 1 can be alike."""
    return sorted(pair for k in range(0, len(rows), 2) for pair in classes(rows[k : k + 2]))


def test_keys_with_one_left_out():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 62, 9).astype(np.uint64)
    for i in range(9):
        b = np.delete(a, i)
        assert near_dup.left_out(b)[-1] in near_dup.left_out(a)
        changed = a.copy()
        changed[i] += np.uint64(1)
        assert len(set(near_dup.left_out(changed)) & set(near_dup.left_out(a))) == 1
    assert not set(near_dup.left_out(a)) & set(near_dup.left_out(a[::-1]))


def test_recall_on_sampled_texts(spark):
    """Texts of more shingles than a sample holds, near the similarity on both sides of it."""
    rng = random.Random(9)
    rows = []
    for n in (1100, 1500, 2600, 5000):
        for turn in range(24):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            other = list(words)
            for place in rng.sample(range(n), round(n * (0.012 + 0.001 * (turn % 14)))):
                other[place] = f"x{place}"
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["key"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()}
    linked = {key for key, least in classes_of_neighbours(rows) if key != least}
    told = {str(key) for key, least in found.items() if key != least}
    assert told <= linked and len(linked) > 40
    assert len(told) >= 0.97 * len(linked)


def test_order_matters(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[100:] + words[:100]))]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["key"]: r["class_id"] for r in found} == {1: 1, 2: 2}


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(5, None), (3, ""), (7, "  "), (None, "only one here"), (2, "same words"), (2, "same words"), (1, "same words"), (None, "same words")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, class_id int, node string")
    found = near_dup.near_duplicates(df).collect()
    assert sorted((str(r["key"]), str(r["class_id"])) for r in found) == classes(rows)
    assert {r["key"]: (r["class_size"], r["kept"]) for r in found if r["class_id"] == 1} == {1: (4, True), 2: (4, False), None: (4, False)}
    assert near_dup.keep_first(df).columns == df.columns
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_whole_table(spark, small_dir, documents):
    found = op3_near_duplicates(spark, small_dir).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in found) == classes(documents)
    assert sum(r["kept"] for r in found) == len({r["class_id"] for r in found})


def test_recall_of_the_keys():
    assert near_dup.expected_recall(near_dup.OrderMinHash(), 0.8) > 0.999


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (200, 200), (None, 3), (101, 100)]
    links += [(500, i) for i in range(501, 800)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(1, 61), 1), 100: 100, 101: 100, 200: 200, **dict.fromkeys(range(500, 800), 500)}
