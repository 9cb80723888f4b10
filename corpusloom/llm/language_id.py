"""Language of texts by Bayesian fusion of several kinds of evidence.

For language l of a row the log posterior adds up

* the likelihood of the text: byte trigrams of its letters under a model per language,
  damped, because neighbouring trigrams overlap;
* how likely the declared language of the markup is where the language is l, and the
  same for the suffix of the address: tables counted over all rows, with the text's own
  probabilities as weights, so that labels which say little weigh little;
* the prior of the host: its share of l, smoothed towards the share in its domain, which
  is smoothed towards the share in the corpus. A row is left out of its own prior.

Counts are grouped aggregations, combined before the shuffle; priors come back to the
rows by joins on the host that can be split where one host holds very many rows. Declared
languages and suffixes are short codes, so their tables are bounded and broadcast.

The trigram model is fitted on a sample of labelled rows of about ``per_language`` rows
for each label (a parameter; by a hash of the key, so it does not depend on row order).
Everything else covers all rows.

Defined cases: a NULL, empty or letterless text has equal likelihoods and is decided by the
other evidence, with ``letters`` 0 and ``accepted`` false; missing evidence (NULL) adds
nothing; ties go to the language first in the alphabet; repeated rows count and appear
each; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.files import releasing, shared_folder, written

BUCKETS = 1 << 16
MAX_LANGUAGES = 200
#: Damping of trigram evidence, weight of the coarser prior in rows, and of a uniform table.
DAMPING = 1 / 3
PRIOR_ROWS = 10.0
TABLE_ROWS = 5.0
#: Mean log likelihood of a trigram below which a text is not in any known language:
#: that of a uniform choice among all buckets.
LEAST_FIT = -float(np.log(BUCKETS))

_LETTER = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def _trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams, and the first and last-but-one place of each text among them."""
    blobs = [f" {text.lower()} ".encode() for text in texts]
    data = _LETTER[np.frombuffer(b"".join(blobs), np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    edges = np.cumsum([0] + [len(b) for b in blobs])
    keep[edges[:-1]] = True
    place = np.concatenate([[0], np.cumsum(keep)])[edges]
    data = data[keep].astype(np.uint32)
    value = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    bucket = (value * np.uint32(2654435761)) >> np.uint32(16)
    return bucket, place[:-1], np.maximum(place[1:] - 2, place[:-1])


@dataclass(frozen=True)
class TrigramModel:
    languages: tuple[str, ...]
    #: buckets x languages, natural logarithms
    log_likelihood: np.ndarray

    def score(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log likelihoods (texts x languages) and numbers of trigrams that hold a letter."""
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts), np.int64)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < 4_000_000 // len(self.languages)):
                size += len(texts[end])
                end += 1
            bucket, first, last = _trigrams(texts[at:end])
            if len(bucket):
                total = np.zeros((len(bucket) + 1, len(self.languages)))
                np.cumsum(self.log_likelihood[bucket], axis=0, dtype=np.float64, out=total[1:])
                sums[at:end] = total[last] - total[first]
                counts[at:end] = last - first
            at = end
        return sums, counts


def fit(labelled: DataFrame, *, key: str, text: str, label: str, per_language: int = 2000) -> TrigramModel:
    """Fit on about ``per_language`` rows of each label; at most 200 labels.

    Rows are drawn by a hash of key and text, rows that share both count once. Without labelled
    rows the only language is "und", all trigrams are alike in it and no text is accepted.
    """
    rows = labelled.select(
        F.xxhash64(F.col(key), F.col(text).cast("string")).alias("hash"), F.col(label).cast("string").alias("label"),
        F.col(text).cast("string").alias("text"),
    ).where("label IS NOT NULL")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if not counts:
        # Clearly below what the same trigrams would have at random.
        return TrigramModel(("und",), np.full((BUCKETS, 1), LEAST_FIT - 1, np.float32))
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"there are more than {MAX_LANGUAGES} labels")
    names = tuple(sorted(row["label"] for row in counts))
    share = F.create_map(*[x for row in counts for x in (F.lit(row["label"]), F.lit(per_language / row["n"]))])
    sample = rows.where(F.pmod("hash", F.lit(1 << 32)) < F.element_at(share, F.col("label")) * (1 << 32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(names), BUCKETS), np.float64)
        for batch in batches:
            for name, body in zip(batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if body:
                    bucket, first, last = _trigrams([body])
                    totals[names.index(name)] += np.bincount(bucket[first[0] : last[0]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(names)), pa.int32()), pa.array([t.tobytes() for t in totals], pa.binary())],
            ["language", "counts"],
        )

    # The sample is bounded, and so is what eight tasks return of it.
    sample = sample.dropDuplicates(["hash", "label"])
    parts = sample.select("label", "text").repartition(8).mapInArrow(releasing(count), "language int, counts binary").collect()
    totals = np.zeros((len(names), BUCKETS))
    for part in parts:
        totals[part["language"]] += np.frombuffer(part["counts"], np.float64)
    smoothed = totals + 0.5
    return TrigramModel(names, np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def short_code(value: Column) -> Column:
    """A language or address code of two or three letters, '?' for anything else, NULL for NULL."""
    code = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]{2,3})(?:[^a-z].*)?$", 1)
    return F.when(value.isNotNull(), F.when(code == "", "?").otherwise(code))


def _probabilities(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def scored(rows: DataFrame, model: TrigramModel, *, html: bool = False) -> DataFrame:
    """Add the text's evidence to rows of key, text, declared, suffix, host, domain.

    With ``html`` the text is markup: its visible text counts, and its ``lang`` is declared.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    others = ["key", "declared", "suffix", "host", "domain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from corpusloom.llm.html_text import parse, render

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t.as_py() or "" for t in part["text"]]
                declared = part["declared"].to_pylist()
                if html:
                    trees = [parse(t) for t in texts]
                    texts = [render(t) for t in trees]
                    declared = [t.attributes.get("lang") or d for t, d in zip(trees, declared, strict=True)]
                sums, counts = shared.value.score(texts)
                fit = np.where(counts > 0, sums.max(axis=1) / np.maximum(counts, 1), 0.0)
                made = {n: part[n] for n in others} | {
                    "declared": pa.array(declared, pa.string()),
                    "evidence": pa.array(list(sums * DAMPING), pa.list_(pa.float64())),
                    "weights": pa.array(list(_probabilities(sums * DAMPING)), pa.list_(pa.float64())),
                    "letters": pa.array(counts),
                    "fit": pa.array(fit),
                }
                yield pa.RecordBatch.from_pydict(made)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("text", *others).mapInArrow(
        releasing(run),
        f"key {kind}, declared string, suffix string, host string, domain string, "
        "evidence array<double>, weights array<double>, letters bigint, fit double",
    )


def _totals(df: DataFrame, by: Sequence[str], name: str, languages: int) -> DataFrame:
    sums = F.array(*[F.sum(F.col("weights")[i]) for i in range(languages)])
    return df.groupBy(*by).agg(sums.alias(name)) if by else df.agg(sums.alias(name))


def fuse(rows: DataFrame, languages: Sequence[str], *, least_fit: float = LEAST_FIT, least_probability: float = 0.5) -> DataFrame:
    """key, language, probability, fit, letters, accepted of written :func:`scored` rows."""
    n = len(languages)
    coded = rows.withColumn("declared", short_code(F.col("declared"))).withColumn("suffix", short_code(F.col("suffix")))
    # Text without letters tells nothing, so it does not count.
    counted = coded.where("letters > 0")
    whole = _totals(counted, [], "whole", n).first()["whole"]
    whole = np.array([x or 0.0 for x in whole])
    joined = coded
    for name in ("declared", "suffix"):
        # Codes have at most three letters: 18,279 rows at most.
        table = _totals(counted.where(F.col(name).isNotNull()), [name], f"{name}_sum", n)
        joined = joined.join(F.broadcast(table), name, "left")
    hosts = _totals(counted.where("host IS NOT NULL"), ["host", "domain"], "host_sum", n)
    domains = hosts.groupBy("domain").agg(
        F.array(*[F.sum(F.col("host_sum")[i]) for i in range(n)]).alias("domain_sum")
    )
    hosts = hosts.join(domains.where("domain IS NOT NULL"), "domain", "left").select("host", "host_sum", "domain_sum")
    joined = joined.join(hosts, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue

            def sums(name: str) -> tuple[np.ndarray, np.ndarray]:
                found = batch[name].to_pylist()
                return np.array([f if f is not None else [0.0] * n for f in found]), np.array([f is not None for f in found])

            letters = batch["letters"].to_numpy()
            own = sums("weights")[0] * (letters > 0)[:, None]
            rest = np.maximum(whole - own, 0)
            prior = (rest + 1) / (rest.sum(axis=1, keepdims=True) + n)
            for name in ("domain_sum", "host_sum"):
                found, known = sums(name)
                found = np.maximum(found - own, 0) * known[:, None]
                prior = (found + PRIOR_ROWS * prior) / (found.sum(axis=1, keepdims=True) + PRIOR_ROWS)
            score = sums("evidence")[0] + np.log(prior)
            for name in ("declared", "suffix"):
                found, known = sums(f"{name}_sum")
                found = np.maximum(found - own, 0)
                share = (found.sum(axis=1, keepdims=True) + 1) / (rest.sum(axis=1, keepdims=True) + 1)
                table = (found + TABLE_ROWS * share) / (rest + TABLE_ROWS)
                score += np.where(known[:, None], np.log(table), 0)
            posterior = _probabilities(score)
            best = posterior.argmax(axis=1)
            probability = posterior[np.arange(len(best)), best]
            fit = batch["fit"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array([languages[i] for i in best], pa.string()),
                    pa.array(probability),
                    batch["fit"],
                    batch["letters"],
                    pa.array((letters > 0) & (fit >= least_fit) & (probability >= least_probability)),
                ],
                ["key", "language", "probability", "fit", "letters", "accepted"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    columns = ["key", "evidence", "weights", "letters", "fit", "declared_sum", "suffix_sum", "host_sum", "domain_sum"]
    return joined.select(*columns).mapInArrow(
        releasing(run), f"key {kind}, language string, probability double, fit double, letters bigint, accepted boolean"
    )


def identify(rows: DataFrame, model: TrigramModel, *, html: bool = False) -> DataFrame:
    """Language of rows with columns key, text, declared, suffix, host and domain."""
    folder = shared_folder(rows.sparkSession, "language-id")
    return fuse(written(scored(rows, model, html=html), folder), model.languages)


def page_rows(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Evidence columns of web pages. The suffix is a first path part of two letters, else the last part of the host."""
    address = F.col(url).cast("string")
    host = F.lower(F.regexp_extract(address, r"://([^/?#]+)", 1))
    part = F.regexp_extract(address, r"://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1)
    known = F.when(host != "", host)
    suffix = F.when(part != "", part).otherwise(F.regexp_extract(host, r"([^.]+)$", 1))
    return pages.select(
        F.col(key).alias("key"),
        F.col(html).cast("string").alias("text"),
        F.lit(None).cast("string").alias("declared"),
        F.when(host != "", suffix).alias("suffix"),
        known.alias("host"),
        F.when(host != "", F.substring_index(host, ".", -2)).alias("domain"),
    )


def document_rows(docs: DataFrame, *, key: str = "doc_id", text: str = "text", declared: str = "lang", source: str = "source") -> DataFrame:
    """Evidence columns of documents: the stated language, and the source in place of the host."""
    return docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        F.col(declared).cast("string").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col(source).cast("string").alias("host"),
        F.lit(None).cast("string").alias("domain"),
    )
