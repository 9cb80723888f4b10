"""URL rules and block lists as a sorted array of digests.

An entry is a host and a beginning of a path with a verdict. Entries become files of
sorted 64-bit xxhash keys, the full strings behind them and their verdicts, one file per
range of keys. Executors map the files into memory and look up all candidate strings of
a batch of URLs at once by binary search; a hit counts only if the stored string is equal,
so that two strings with one digest are told apart. Nothing but the first key of each
file goes through the driver.

The candidates of a URL are its host and every parent domain, each with every beginning
of the path whose length occurs among the entries. The longest entry wins: the longer
host, then the longer path.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case. Path: what follows up to ``?``, ``#`` or the end. A NULL URL or one without ``://``
has both empty and fits no entry. Entries with a NULL host or path are ignored; of equal
entries with different verdicts the first verdict in alphabetical order counts. Repeated
URLs get equal rows; empty tables of URLs or entries are fine; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.files import open_file, shared_folder, write_file, written

#: Entries and bytes of their strings.
HEAD = "<QQ"
#: Entries in a file, about.
FILE_ENTRIES = 4_000_000
#: Different lengths of entry paths that an index may have.
MAX_PATH_LENGTHS = 256


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return _lower(host), path


_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lower(host: str) -> str:
    return host.translate(_UPPER)


def _entry(host: str, path: str) -> bytes:
    """Host and path in one string from which both can be told."""
    return f"{host}\0{path}".encode()


def build_index(entries: DataFrame, folder: str, *, file_entries: int = FILE_ENTRIES) -> list[dict]:
    """Write ``entries`` (host, path, verdict, listed) as digest files; returns the list of files.

    ``listed`` is false for rules, which are reported by name, and true for list entries.
    """
    kept = entries.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path")
    kept = kept.agg(F.min(F.struct("listed", "verdict")).alias("v")).select("host", "path", "v.verdict", "v.listed")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_entry(_lower(h), p) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
            sign = keys ^ np.uint64(1 << 63)  # signed order of what Spark sees is the order of the digests
            yield pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array(sign.view(np.int64)),
                    "entry": pa.array(texts, pa.binary()),
                    "length": pa.array([len(p) for p in batch["path"].to_pylist()], pa.int32()),
                    "block": pa.array([v == "block" for v in batch["verdict"].to_pylist()]),
                    "listed": batch["listed"],
                }
            )

    made = kept.mapInArrow(digests, "digest long, entry binary, length int, block boolean, listed boolean")
    made = written(made, f"{folder}/entries")
    parts = max(1, -(-made.count() // file_entries))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        keys = table["digest"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        texts = table["entry"].to_pylist()
        flags = table["block"].to_numpy().astype(np.uint8) + 2 * table["listed"].to_numpy().astype(np.uint8)
        ends = np.cumsum([0] + [len(t) for t in texts]).astype("<u8")
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.digests"
        write_file(name, [struct.pack(HEAD, len(keys), int(ends[-1])), keys.tobytes(), ends.tobytes(), flags.tobytes(), *texts])
        lengths = sorted(set(table["length"].to_pylist()))
        yield pa.RecordBatch.from_pydict(
            {"file": [name], "first": pa.array([int(table["digest"][0].as_py())]), "lengths": pa.array([lengths], pa.list_(pa.int32()))}
        )

    files = made.repartitionByRange(parts, "digest", "entry").sortWithinPartitions("digest", "entry")
    files = written(files.mapInArrow(write, "file string, first long, lengths array<int>"), f"{folder}/files")
    return [row.asDict() for row in files.orderBy("first", "file").collect()]


class _Mapped:
    """One digest file in memory-mapped arrays."""

    def __init__(self, name: str):
        system, path = fs.FileSystem.from_uri(name)
        if not isinstance(system, fs.LocalFileSystem):
            with open_file(name) as f, tempfile.NamedTemporaryFile(delete=False) as copy:
                copy.write(f.read())
            path = copy.name
        data = np.memmap(path, np.uint8, "r")
        if path != fs.FileSystem.from_uri(name)[1]:
            os.unlink(path)  # the mapping keeps the bytes
        n, size = struct.unpack(HEAD, data[: struct.calcsize(HEAD)].tobytes())
        at = struct.calcsize(HEAD)
        self.keys = data[at : at + 8 * n].view("<u8")
        self.ends = data[at + 8 * n : at + 16 * n + 8].view("<u8")
        self.flags = data[at + 16 * n + 8 : at + 17 * n + 8]
        self.blob = data[at + 17 * n + 8 : at + 17 * n + 8 + size]

    def find(self, keys: np.ndarray, texts: list[bytes]) -> list[int]:
        """Flags of each text, or -1."""
        low = np.searchsorted(self.keys, keys)
        found = [-1] * len(texts)
        hits = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == keys)
        for i in hits.tolist():
            at = int(low[i])
            while at < len(self.keys) and self.keys[at] == keys[i]:
                if self.blob[int(self.ends[at]) : int(self.ends[at + 1])].tobytes() == texts[i]:
                    found[i] = int(self.flags[at])
                    break
                at += 1
        return found


_mapped: dict[str, _Mapped] = {}


def _lookup(files: list[dict], firsts: np.ndarray, texts: list[bytes]) -> dict[bytes, int]:
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
    signed = (keys ^ np.uint64(1 << 63)).view(np.int64)
    # Equal digests may reach over the edge of two files, so the file before an equal first key is asked too.
    last = np.searchsorted(firsts, signed, "right") - 1
    first = np.maximum(np.searchsorted(firsts, signed, "left") - 1, 0)
    found: dict[bytes, int] = {}
    for back in range(int((last - first).max(initial=0)) + 1):
        part_of = last - back
        for part in np.unique(part_of[(part_of >= first) & (part_of >= 0)]):
            name = files[part]["file"]
            if name not in _mapped:
                _mapped[name] = _Mapped(name)
            chosen = np.flatnonzero(part_of == part)
            own = [texts[i] for i in chosen]
            for text, flags in zip(own, _mapped[name].find(keys[chosen], own), strict=True):
                if flags >= 0:
                    found[text] = flags
    return found


def _candidates(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """From the longest host and path to the shortest."""
    if not host:
        return []
    parts = host.split(".")
    hosts = [".".join(parts[i:]) for i in range(len(parts))]
    return [(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]


def judge(urls: DataFrame, entries: DataFrame, *, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict and the listed entry, for every row of ``urls``."""
    folder = shared_folder(urls.sparkSession, "url-index")
    files = build_index(entries, folder)
    firsts = np.array([f["first"] for f in files], np.int64)
    lengths = sorted({n for f in files for n in f["lengths"]}, reverse=True)
    if len(lengths) > MAX_PATH_LENGTHS:
        raise ValueError(f"paths of more than {MAX_PATH_LENGTHS} different lengths")
    narrow = urls.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [host_and_path(u) for u in batch["url"].to_pylist()]
            tried = {pair: [_entry(*c) for c in _candidates(*pair, lengths)] for pair in set(parsed)}
            texts = list({t for own in tried.values() for t in own})
            found = _lookup(files, firsts, texts) if files and texts else {}
            judged = {}
            for pair, own in tried.items():
                hits = [(t, found[t]) for t in own if t in found]
                rule = next(((t, f) for t, f in hits if not f & 2), None)
                listed = next(((t, f) for t, f in hits if f & 2), None)
                decides = rule or listed
                judged[pair] = (
                    rule and rule[0].decode().replace("\0", ""),
                    "block" if decides and decides[1] & 1 else "allow",
                    listed and listed[0].decode().replace("\0", ""),
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array([h for h, _ in parsed], pa.string()),
                    pa.array([p for _, p in parsed], pa.string()),
                    *[pa.array([judged[pair][i] for pair in parsed], pa.string()) for i in range(3)],
                ],
                ["key", "host", "path", "rule", "verdict", "listed"],
            )

    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"key {kind}, host string, path string, rule string, verdict string, listed string"
    )
