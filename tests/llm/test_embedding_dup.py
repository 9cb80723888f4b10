import numpy as np

from corpusloom.llm import embedding_dup
from corpusloom.llm.queries import op9_embedding_duplicates


def plain(rows):
    """(links, component) by comparing all pairs of a label."""
    keys = [r[0] for r in rows]
    group = list(range(len(rows)))
    links = [0] * len(rows)

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    units = []
    for _, vector, label in rows:
        ok = label is not None and vector is not None and len(vector) and None not in vector
        v = np.array(vector if ok else [0.0], np.float64)
        units.append(v / np.linalg.norm(v) if np.isfinite(v).all() and v.any() else None)
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][2] == rows[j][2] and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    a, b = sorted((root(i), root(j)))
                    group[b] = a
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), keys[i]), keys[i])
    return {k: (links[i], least[root(i)], least[root(i)] == k) for i, k in enumerate(keys)}


def test_lattice_points_are_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    near = embedding_dup.nearest_e8(x)
    gap = ((x - near) ** 2).sum(axis=1)
    for step in embedding_dup.ROOTS:
        assert (((x - near - step) ** 2).sum(axis=1) >= gap - 1e-9).all()
    assert (gap <= 1 + 1e-9).all()


def test_query(spark, small_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op9_embedding_duplicates(spark, small_dir).collect()}
    assert found == plain(rows)


def test_near_copies_are_found(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(150):
        base = rng.normal(size=64)
        for _ in range(2):
            noisy = base / np.linalg.norm(base) + rng.normal(size=64) * 0.016
            rows.append((len(rows), noisy.tolist(), g % 3))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r[0]: tuple(r)[1:] for r in embedding_dup.near_duplicate_vectors(df).collect()}
    expected = plain(rows)
    links = sum(v[0] for v in expected.values())
    assert links > 200
    assert sum(v[0] for v in found.values()) >= 0.99 * links
    assert all(found[k][0] <= expected[k][0] for k in found)


def test_invalid_vectors_and_empty_tables(spark):
    one, inf, nan = [1.0, 2.0, 3.0], [float("inf"), 1.0, 1.0], [float("nan"), 1.0, 1.0]
    vectors = [one, one, [2.0, 4.0, 6.0], [0.0, 0.0, 0.0], None, [], [1.0, None, 1.0], inf, inf, nan, nan, [1.0, 2.0]]
    rows = [(i, v, "a") for i, v in enumerate(vectors)] + [(20, one, None), (21, one, None), (22, one, "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label string, node int")
    found = {r[0]: tuple(r)[1:] for r in embedding_dup.near_duplicate_vectors(df).collect()}
    assert found == plain(rows)
    assert embedding_dup.near_duplicate_vectors(df.limit(0)).collect() == []
