import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from oracle import differences
from pyspark.sql import functions as F

from corpusloom.llm import divergence
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.queries import op11_source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs, top):
    """All terms of all groups in Python integers."""
    count, langs, docs = defaultdict(Counter), defaultdict(set), defaultdict(Counter)
    for text, lang, source in ((t or "", g or "", s or "") for t, g, s in rows):
        terms = TERM.findall(text.translate(LOWER))
        count[lang, source].update(terms)
        langs[lang].add(source)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        own = {s: shares(count[lang, s]) for s in sources}
        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(sum(f(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(own[s][t], whole[t]), t) for t in kept if count[lang, s][t] and own[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, math.inf), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1) if i <= limit]
    return sorted(out)


SCHEMA = "text string, lang string, source string"


def _docs(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    names = ("term", "n", "docs", "n_lang", "shard", "block", "first", "second", "part", "item", "value", "rank", "once")
    return docs.select("*", *[F.lit("x").alias(c) for c in names])


def _found(spark, rows, **settings):
    return sorted(map(tuple, divergence.source_divergence(_docs(spark, rows), **settings).collect()))


ROWS = (
    [("Foo bar, foo! ÉTÉ\x00été x1y" + " tie" * i, "en", f"s{i % 7}") for i in range(40)]
    + [("foo " * 4000 + "baz", "en", "hot")] * 30
    + [(None, "en", "s1"), ("", "en", "silent"), ("foo baz bar", None, None), ("foo baz bar", "", "s1"), (None, None, None)]
    + [("été naïve ß 漢字 kK", "fr", f"é{i}") for i in range(3)]
    + [("nothing twice", "xx", "one"), ("ever here", "xx", "two")]
)


@pytest.mark.parametrize("settings", [{"min_docs": 3, "top": 2}, {"min_docs": 1, "top": 10}, {"min_docs": 10, "top": 10}])
def test_equals_plain_integers(spark, settings):
    assert _found(spark, ROWS, **settings) == plain(ROWS, **settings)


def test_many_shards_and_blocks_of_sources(spark, monkeypatch):
    rows = ROWS + [(f"foo w{i % 9}x bar{'o' * (i % 5)}", "en", f"z{i % 23}") for i in range(200)]
    for name, value in (("SHARD_ROWS", 20), ("BLOCK_SOURCES", 5), ("SPREAD_TERMS", 3)):
        monkeypatch.setattr(divergence, name, value)
    assert _found(spark, rows, min_docs=2, top=3) == plain(rows, 2, 3)


def test_partial_counts_do_not_depend_on_their_size(monkeypatch):
    batch = pa.RecordBatch.from_pylist([{"text": t or "", "lang": g or "", "source": s or ""} for t, g, s in ROWS])

    def counts():
        summed = Counter()
        for part in divergence._partial_counts(iter([batch, batch])):
            for r in part.to_pylist():
                summed[r["lang"], r["source"], r["term"]] += r["n"]
                summed[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return summed

    whole = counts()
    monkeypatch.setattr(divergence, "HELD_COUNTS", 3)
    monkeypatch.setattr(divergence, "BATCH_BYTES", 50)
    assert counts() == whole
    assert whole["en", "hot", "foo"] == 2 * 30 * 4000


def test_long_division_is_exact():
    cases = [(0, 0, 1), (7, 10, 3), (10**14, 10**14 + 5, 10**6), (3 * 10**12, 9 * 10**14, 1)]
    for count, total, terms in cases:
        assert divergence.smoothed(count, total, terms) == 1 + 10**9 * (count + 2) // (total + 2 * terms)


def test_empty_table(spark):
    assert _found(spark, [], min_docs=1) == []


def test_query_equals_sql(spark, small_dir):
    sql = ORACLES["op11_source_divergence"]
    assert differences(op11_source_divergence(spark, small_dir), sql, small_dir) == []
