"""Near-duplicate embeddings by lattice hashing.

Each table projects the unit vectors to a few random orthogonal directions, eight per
block, and decodes each block to the nearest point of the E8 lattice; the points of all
blocks are the cell. Besides its own cell a vector is entered in the neighbouring cells
it is closest to (one lattice step by a shortest vector in one block). Vectors of one
label that share a cell in some table are compared by cosine in double precision.

Equal vectors of a label are one node with a number of copies. Cells that hold one node
are dropped before vectors are moved. A cell is compared block by block inside the
tasks: a pair is counted in the first cell it shares only, and a task returns sums per
node and a spanning star per connected group, never the pairs. A cell with very many
vectors is so spread over many tasks, and no partner is dropped.

Defined cases: vectors that are NULL, empty, zero, or hold a NULL or non-finite component,
and rows with a NULL label, link with nothing. Vectors of different length do not link.
Rows with a NULL key are linked and counted like others, but never name a component.
Repeated rows are copies that link with each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.files import shared_folder, written
from corpusloom.llm.groups import map_groups
from corpusloom.llm.shingles import mix


@dataclass(frozen=True)
class LatticeHash:
    """Parameters. At cosine 0.98 in 64 dimensions a table without probes finds 37 % of the
    pairs and one with two probes over half, ten tables find all but a few in ten thousand."""

    cosine: float = 0.98
    tables: int = 10
    blocks: int = 2
    #: Length of a lattice step, as a share of the length of the vectors.
    scale: float = 0.5
    probes: int = 2
    seed: int = 7
    #: Vectors of a block that one task compares with another.
    block: int = 512


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i in range(8):
        for j in range(i):
            for a in (-1.0, 1.0):
                for b in (-1.0, 1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    whole.append(v)
    signs = 1.0 - 2.0 * (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.vstack([whole, signs[signs.prod(axis=1) > 0] / 2])


ROOTS = _roots()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points of rows of eight numbers: E8 is the even points and those moved by 1/2."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def cells(unit: np.ndarray, p: LatticeHash) -> np.ndarray:
    """Cell numbers of unit vectors: rows x tables x (1 + probes)."""
    n, dim = unit.shape
    width = 8 * p.blocks
    rng = np.random.default_rng([p.seed, dim])
    out = np.zeros((n, p.tables, 1 + p.probes), np.int64)
    names = mix(rng.integers(0, 1 << 63, width, np.uint64)) | np.uint64(1)
    for t in range(p.tables):
        directions = rng.normal(size=(dim, width))
        if dim >= width:
            directions = np.linalg.qr(directions)[0] * np.sqrt(dim)
        x = (unit @ directions / (np.sqrt(width) * p.scale)).reshape(n * p.blocks, 8)
        point = nearest_e8(x)
        gain = ((x - point) @ ROOTS.T).reshape(n, p.blocks * len(ROOTS))
        steps = np.argpartition(-gain, p.probes - 1, axis=1)[:, : p.probes] if p.probes else gain[:, :0]
        twice = np.rint(2 * point).astype(np.int64).reshape(n, width)
        for k in range(1 + p.probes):
            there = twice.copy()
            if k:
                block, root = np.divmod(steps[:, k - 1], len(ROOTS))
                moved = there.reshape(n, p.blocks, 8)
                moved[np.arange(n), block] += np.rint(2 * ROOTS[root]).astype(np.int64)
            key = (there.view(np.uint64) * names[None, :]).sum(axis=1, dtype=np.uint64)
            out[:, t, k] = mix(key + np.uint64(t)).view(np.int64)
    return out


def _hashed(vectors: DataFrame, p: LatticeHash) -> DataFrame:
    """key, label, and for valid vectors: node, vector as bytes of doubles, cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            nodes, raw, found = [None] * n, [None] * n, [None] * n
            by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, (label, value) in enumerate(zip(batch["label"], batch["vector"], strict=True)):
                if not label.is_valid or not value.is_valid or value.values.null_count or not len(value.values):
                    continue
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all() and v.any():
                    by_length.setdefault(len(v), []).append((i, v))
            for length, rows in by_length.items():
                matrix = np.array([v for _, v in rows])
                matrix /= np.abs(matrix).max(axis=1)[:, None]
                unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
                cell = cells(unit, p).reshape(len(rows), -1)
                for (i, v), own in zip(rows, cell, strict=True):
                    raw[i] = v.tobytes()
                    name = hashlib.blake2b(raw[i], digest_size=16, key=struct.pack("<I", length))
                    name.update(str(batch["label"][i].as_py()).encode())
                    nodes[i], found[i] = name.digest(), own
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["label"],
                    pa.array(nodes, pa.binary()),
                    pa.array(raw, pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["key", "label", "node", "vector", "cells"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return vectors.mapInArrow(
        run, f"key {kinds['key']}, label {kinds['label']}, node binary, vector binary, cells array<bigint>"
    )


def _units(raw: list[bytes]) -> np.ndarray:
    m = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    m = m / np.abs(m).max(axis=1)[:, None]
    return m / np.linalg.norm(m, axis=1)[:, None]


def _counted(p: LatticeHash):
    """Links between two blocks of a cell: sums per node, and per connected group a star."""

    def run(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        n = rows.num_rows
        nodes, raw = rows["node"].to_pylist(), rows["vector"].to_pylist()
        weight, own, x, y, table, cell = (
            rows[c].to_numpy() for c in ("copies", "block", "x", "y", "table", "cell")
        )
        entries = np.array(rows["cells"].to_pylist(), np.int64).reshape(n, p.tables, 1 + p.probes)
        size = np.array([len(v) for v in raw])
        # Labels whose hashes are equal may meet in a group.
        label = rows["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        links = []
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
            at = np.arange(start, stop)
            left = at[own[at] == x[start]]
            right = at[own[at] == y[start]]
            for length in np.unique(size[left]):
                mine, theirs = left[size[left] == length], right[size[right] == length]
                if len(mine) and len(theirs):
                    cosines = _units([raw[i] for i in mine]) @ _units([raw[j] for j in theirs]).T
                    i, j = np.nonzero(cosines >= p.cosine)
                    found = np.column_stack([mine[i], theirs[j]])
                    links.append(found[found[:, 0] < found[:, 1]] if x[start] == y[start] else found)
        found = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
        # Only in the first table they share, and there in the smallest shared cell.
        first = label[found[:, 0]] == label[found[:, 1]]
        for t in range(p.tables):
            same = entries[found[:, 0], t, :, None] == entries[found[:, 1], t, None, :]
            here = table[found[:, 0]]
            same &= ((t < here)[:, None] | ((t == here)[:, None] & (entries[found[:, 0], t] < cell[found[:, 0], None])))[:, :, None]
            first &= ~same.any(axis=(1, 2))
        found = found[first]
        total = np.zeros(n, np.int64)
        np.add.at(total, found[:, 0], weight[found[:, 1]])
        np.add.at(total, found[:, 1], weight[found[:, 0]])
        group = np.arange(n)
        while True:
            lower = group.copy()
            np.minimum.at(lower, found[:, 0], group[found[:, 1]])
            np.minimum.at(lower, found[:, 1], group[found[:, 0]])
            lower = lower[lower]
            if (lower == group).all():
                break
            group = lower
        used = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([nodes[i] for i in used], pa.binary()),
                pa.array([nodes[i] for i in group[used]], pa.binary()),
                pa.array(total[used]),
            ],
            ["node", "hub", "links"],
        )

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    p: LatticeHash = LatticeHash(),
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """key, n_links, component_id, kept for every row."""
    folder = shared_folder(vectors.sparkSession, "embedding-dup")
    narrow = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    hashed = written(_hashed(narrow, p), f"{folder}/hashed")
    valid = hashed.where("node IS NOT NULL")
    copies = valid.groupBy("label", "node").agg(F.count(F.lit(1)).alias("copies"))
    nodes = valid.select("label", "node", "cells").dropDuplicates(["label", "node"]).join(copies, ["label", "node"])
    entries = nodes.select("label", "node", "copies", F.posexplode("cells").alias("at", "cell"))
    entries = entries.withColumn("table", F.floor(F.col("at") / (1 + p.probes)).cast("int"))
    entries = written(entries.select("label", "table", "cell", "node", "copies"), f"{folder}/entries")
    cell = ["label", "table", "cell"]
    sizes = entries.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(entries.join(sizes, cell), f"{folder}/shared")

    once = valid.select("node", "vector", "cells").dropDuplicates(["node"])
    rows = shared.join(once.join(shared.select("node").distinct(), "node", "left_semi"), "node")
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / p.block).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("x"), F.greatest("block", other).alias("y")),
    )
    spread = rows.withColumn("of", F.xxhash64("label"))
    spread = spread.select("of", "label", "table", "cell", "node", "copies", "vector", "cells", "block", F.inline(pairs))
    found = map_groups(
        spread, ["of", "table", "cell", "x", "y"], _counted(p), "node binary, hub binary, links bigint"
    )
    found = written(found, f"{folder}/found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    named = links.join(joined, "node", "left")
    rows = hashed.select("key", "label", "node").join(copies, ["label", "node"], "left").join(named, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("least"))
    out = rows.join(least, "component", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("least", "key"))
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return out.select(
        "key",
        n_links.cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )
