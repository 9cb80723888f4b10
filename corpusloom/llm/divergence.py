"""How the words of each source differ from those of the other sources of its language.

Inside ``mapInArrow`` texts are lowered (``ascii_lower``), split (``split_pattern_regex``),
dictionary-encoded and counted by Arrow's hash ``group_by``, so that a task sends one
partial count per language, source and term. Counts meet by language and term; a language
keeps the terms of at least ``min_docs`` of its documents. The kept counts are written as
columnar shards, and each shard of terms adds its part to the divergences.

With V kept terms in a language and N occurrences of them in a group, a count c becomes
``p = 1 + floor(10^9 (c + 2) / (N + 2 V))``, and two numbers p and q differ by
``floor((p - q)^2 / (p + q))``. Part ``pair`` sums that over all kept terms, for a source
and each other source of its language; part ``term`` has the terms of a source that are
more frequent there than in the language as a whole, by what they differ, the ``top``
largest. Everything is exact in integers.

A shard holds the counts of about ``SHARD_ROWS`` rows for two blocks of sources, so its
size depends neither on the corpus nor on the number of sources. The sources of a language
are compared in pairs, since that is the result.

Defined cases: NULL text, language and source count as ''. A group without kept terms
still has its rows of part ``pair``; with V = 0 their value is 0. Equal values rank by
item in the order of UTF-8. Repeated rows count each time; an empty table gives no row.
Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.files import shared_folder, written

#: What stands between terms: everything in ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE_STEPS = (1000, 1000, 1000)
#: Bytes of text that are split at a time, about; a text is never cut.
BATCH_BYTES = 4 << 20
#: Distinct partial counts that a task holds before it sends them on.
HELD_COUNTS = 500_000
#: Counts in a shard, about, and sources in a block.
SHARD_ROWS = 100_000
BLOCK_SOURCES = 64
#: Terms whose counts are spread over all sources of a shard at a time.
SPREAD_TERMS = 4096

_GROUP = ["lang", "source"]
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_PARTS = "lang string, source string, part string, item string, value bigint, seen bigint, own bigint, other bigint"


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents per language, source and term of a batch."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch["text"]), BETWEEN)
    rows, terms = pc.list_parent_indices(words), pc.list_flatten(words)
    kept = pc.not_equal(terms, "")
    terms = terms.filter(kept).dictionary_encode()
    table = pa.table({"row": rows.filter(kept), "term": terms.indices})
    table = table.group_by(["row", "term"]).aggregate([([], "count_all")])
    langs, sources = (batch[name].dictionary_encode() for name in _GROUP)
    table = pa.table(
        {
            "lang": langs.indices.take(table["row"]),
            "source": sources.indices.take(table["row"]),
            "term": table["term"],
            "n": table["count_all"],
        }
    )
    table = table.group_by([*_GROUP, "term"]).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table(
        {
            "lang": langs.dictionary.take(table["lang"]),
            "source": sources.dictionary.take(table["source"]),
            "term": terms.dictionary.take(table["term"]),
            "n": table["n_sum"],
            "docs": table["count_all"],
        }
    )


def _merged(held: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(held).group_by([*_GROUP, "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return table.select([*_GROUP, "term", "n_sum", "docs_sum"]).rename_columns([*_GROUP, "term", "n", "docs"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in batches:
        for some in _slices(batch, BATCH_BYTES):
            held.append(_counted(some))
            if sum(t.num_rows for t in held) > 2 * HELD_COUNTS:
                held = [_merged(held)]
                if held[0].num_rows > HELD_COUNTS:
                    yield from held.pop().to_batches()
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` of ``(text, lang, source)`` without NULL.

    All counts of a term of a language meet in one task: one row per task and source at most.
    """
    partial = docs.select("text", *_GROUP).mapInArrow(_partial_counts, _COUNTS)
    met = partial.repartition("lang", "term")
    return met.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, min_docs: int) -> DataFrame:
    """The counts of terms in at least ``min_docs`` documents of a language.

    ``n_lang`` is the sum over its sources; ``once`` is 1 in the row of the first of them.
    """
    term = Window.partitionBy("lang", "term")
    found = counts.select(
        "*",
        F.sum("docs").over(term).alias("_docs"),
        F.sum("n").over(term).alias("n_lang"),
        (F.col("source") == F.min("source").over(term)).cast("bigint").alias("once"),
    )
    return found.where(F.col("_docs") >= min_docs).select(*_GROUP, "term", "n", "n_lang", "once")


def smoothed(count: np.ndarray, total: np.ndarray | int, terms: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), by long division three digits at a time."""
    divisor = np.asarray(total + 2 * terms, np.int64)
    rest = np.asarray(count, np.int64) + 2
    quotient = np.zeros(np.broadcast(rest, divisor).shape, np.int64)
    for step in SCALE_STEPS:
        digit, rest = np.divmod(rest * step, divisor)
        quotient = quotient * step + digit
    return quotient + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _place_in(values: pa.Array, value_set: pa.Array) -> np.ndarray:
    return pc.index_in(values, value_set=value_set).to_numpy(zero_copy_only=False)


def _spread(term: np.ndarray, source: np.ndarray, n: np.ndarray, n_terms: int, n_sources: int) -> Iterator[np.ndarray]:
    """The counts as matrices of some terms by all sources, 0 where there is none."""
    order = np.argsort(term, kind="stable")
    term, source, n = term[order], source[order], n[order]
    for first in range(0, n_terms, SPREAD_TERMS):
        i, j = np.searchsorted(term, [first, first + SPREAD_TERMS])
        matrix = np.zeros((min(SPREAD_TERMS, n_terms - first), n_sources), np.int64)
        matrix[term[i:j] - first, source[i:j]] = n[i:j]
        yield matrix


def _pair_sums(matrices: Iterator[np.ndarray], rows: int, columns: int, total: np.ndarray, terms: int) -> np.ndarray:
    """What the first ``rows`` sources differ from the last ``columns`` ones, summed over terms."""
    sums = np.zeros((rows, columns), np.int64)
    for matrix in matrices:
        p = smoothed(matrix, total, terms)
        for i in range(rows):
            sums[i] += difference(p[:, i : i + 1], p[:, len(total) - columns :]).sum(axis=0)
    return sums


def _shard(top: int):
    """The parts of one shard: rows of groups (term NULL, n their sum, n_lang the terms) and of counts."""
    schema = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (c.split() for c in _PARTS.split(", "))])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, _, first, second = (k.as_py() for k in key)
        groups = table.filter(pc.is_null(table["term"])).sort_by([("block", "ascending"), ("source", "ascending")])
        counts = table.filter(pc.is_valid(table["term"]))
        names, total = groups["source"].combine_chunks(), groups["n"].to_numpy()
        n_terms, n_lang = int(groups["n_lang"][0].as_py()), int(groups["lang_n"][0].as_py())
        rows = int((groups["block"].to_numpy() == first).sum())
        columns = len(groups) - rows if first != second else rows
        vocabulary = pc.unique(counts["term"])
        source = _place_in(counts["source"], names)
        matrices = _spread(_place_in(counts["term"], vocabulary), source, counts["n"].to_numpy(), len(vocabulary), len(names))
        sums = _pair_sums(matrices, rows, columns, total, n_terms)
        absent = smoothed(np.zeros(len(names), np.int64), total, n_terms) if n_terms else np.zeros(len(names), np.int64)
        left, right = np.repeat(np.arange(rows), columns), np.tile(np.arange(len(names) - columns, len(names)), rows)
        sides = [(left, right), (right, left)] if first != second else [(left[left != right], right[left != right])]
        values = sums.ravel() if first != second else sums.ravel()[left != right]
        made = [
            {
                "source": names.take(pa.array(own)),
                "part": pa.array(["pair"] * len(own), pa.string()),
                "item": names.take(pa.array(other)),
                "value": values,
                "seen": np.full(len(own), len(vocabulary)),
                "own": absent[own],
                "other": absent[other],
            }
            for own, other in sides
        ]
        if first == second and len(counts):
            p = smoothed(counts["n"].to_numpy(), total[source], n_terms)
            q = smoothed(counts["n_lang"].to_numpy(), n_lang, n_terms)
            made.append(_terms(counts, p, q, top))
        return pa.concat_tables(
            pa.table({"lang": pa.array([lang] * len(rows["item"]), pa.string())} | rows).cast(schema) for rows in made
        )

    return run


def _terms(counts: pa.Table, p: np.ndarray, q: np.ndarray, top: int) -> dict:
    """The terms of each source that are more frequent than in the language: the ``top`` of this shard."""
    found = pa.table({"source": counts["source"], "item": counts["term"], "value": difference(p, q)})
    found = found.filter(pa.array(p > q))
    found = found.sort_by([("source", "ascending"), ("value", "descending"), ("item", "ascending")])
    found = found.filter(pa.array(np.arange(len(found)) - _place_in(found["source"], found["source"]) < top))
    zero = np.zeros(len(found), np.int64)
    part = pa.array(["term"] * len(found), pa.string())
    return {"source": found["source"], "part": part, "item": found["item"], "value": found["value"]} | {
        name: zero for name in ("seen", "own", "other")
    }


def _bucket(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def source_divergence(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 10,
    top: int = 10,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the head of this module.

    Three numbers come to the driver: how many counts and groups the largest language has.
    """
    folder = shared_folder(docs.sparkSession, "divergence")
    filled = {"text": text, "lang": lang, "source": source}
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in filled.items()])
    kept = written(kept_counts(term_counts(docs), min_docs), f"{folder}/kept")
    sums = kept.groupBy(*_GROUP).agg(
        F.sum("n").alias("n"), F.sum("once").alias("_terms"), F.count(F.lit(1)).alias("_rows")
    )
    sums = written(sums, f"{folder}/sums")
    of_lang = Window.partitionBy("lang")
    groups = docs.select(*_GROUP).distinct().join(sums, _GROUP, "left").na.fill(0)
    groups = groups.select(
        *_GROUP,
        "n",
        F.sum("_terms").over(of_lang).alias("n_lang"),
        F.sum("n").over(of_lang).alias("lang_n"),
        F.sum("_rows").over(of_lang).alias("_rows"),
        F.count(F.lit(1)).over(of_lang).alias("_groups"),
    )
    groups = written(groups, f"{folder}/groups")
    sizes = groups.agg(F.max("_rows").alias("rows"), F.max("_groups").alias("groups")).first()
    shards = max(1, -(-(sizes["rows"] or 0) // SHARD_ROWS))
    blocks = max(1, -(-(sizes["groups"] or 0) // BLOCK_SOURCES))
    block = _bucket("source", blocks).alias("block")
    # A source's block meets every block, the smaller one first.
    others = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda b: F.struct(F.least("block", b).alias("first"), F.greatest("block", b).alias("second")),
    )
    columns = ["lang", "shard", "block", "source", "term", "n", "n_lang", "lang_n"]
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    heads = groups.select("*", block, F.lit(None).cast("string").alias("term"), every).select(*columns)
    rows = kept.select("*", block, _bucket("term", shards).alias("shard"), F.lit(0).cast("bigint").alias("lang_n"))
    met = heads.unionByName(rows.select(*columns)).select("*", F.inline(others))
    parts = met.groupBy("lang", "shard", "first", "second").applyInArrow(_shard(top), _PARTS)
    parts = written(parts, f"{folder}/parts")
    pairs = parts.where("part = 'pair'").groupBy(*_GROUP, "part", "item")
    pairs = pairs.agg(*[f(c).alias(c) for f, c in ((F.sum, "value"), (F.sum, "seen"), (F.max, "own"), (F.max, "other"))])
    terms = groups.select(*_GROUP, "n_lang")
    each = F.when(F.col("own") > 0, F.expr("((own - other) * (own - other)) div (own + other)")).otherwise(0)
    pairs = pairs.join(terms, _GROUP).withColumn("value", F.col("value") + (F.col("n_lang") - F.col("seen")) * each)
    best = Window.partitionBy(*_GROUP, "part").orderBy(F.desc("value"), "item")
    result = [*_GROUP, "part", "item", "value", F.row_number().over(best).alias("rank")]
    ranked = parts.where("part = 'term'").select(*result).where(F.col("rank") <= top)
    return pairs.select(*result).unionByName(ranked)
