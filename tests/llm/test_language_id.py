from pyspark.sql import functions as F

from corpusloom.llm import language_id
from corpusloom.llm.queries import op8_page_languages


def test_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").where("lang IS NOT NULL AND length(text) > 40")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = language_id.fit(docs.where(~held), key="doc_id", text="text", label="lang")
    unseen = docs.where(held)
    rows = language_id.document_rows(unseen.withColumn("lang", F.lit(None).cast("string")))
    found = {r["key"]: r["language"] for r in language_id.identify(rows, model).collect()}
    stated = {r["doc_id"]: r["lang"] for r in unseen.collect()}
    assert found.keys() == stated.keys()
    assert sum(found[k] == stated[k] for k in stated) >= 0.9 * len(stated)


def test_nulls_repeats_and_empty_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    model = language_id.fit(docs, key="doc_id", text="text", label="lang")
    text = docs.where("lang IS NOT NULL AND length(text) > 100").orderBy("doc_id").first()
    rows = [(1, text["text"], None), (1, text["text"], None), (None, text["text"], None), (2, None, None), (3, "", "xx"), (4, "12 34", None)]
    df = spark.createDataFrame([(*r, None, 1) for r in rows], "doc_id long, text string, lang string, source string, host int")
    found = language_id.identify(language_id.document_rows(df), model).collect()
    assert len(found) == len(rows)
    by_key = {r["key"]: r for r in found}
    assert by_key[1]["language"] == by_key[None]["language"] == text["lang"]
    assert [by_key[k]["accepted"] for k in (2, 3, 4)] == [False] * 3
    assert [by_key[k]["letters"] for k in (2, 3, 4)] == [0] * 3
    assert language_id.identify(language_id.document_rows(df.limit(0)), model).collect() == []


def test_without_labelled_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    unlabelled = spark.createDataFrame([(1, "some words here", None, "s")], empty.schema)
    for docs in (empty, unlabelled):
        model = language_id.fit(docs, key="doc_id", text="text", label="lang")
        found = language_id.identify(language_id.document_rows(unlabelled), model).collect()
        assert [(r["key"], r["language"], r["accepted"]) for r in found] == [(1, "und", False)]
        assert language_id.identify(language_id.document_rows(empty), model).collect() == []


def test_rows_without_a_key_are_drawn_one_by_one(spark):
    rows = [(None, f"{w} " * 30, "aa") for w in ("lorem", "ipsum")] * 50 + [(None, f"word{i} text", "aa") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = language_id.fit(docs, key="doc_id", text="text", label="lang", per_language=50)
    every = language_id.fit(docs, key="doc_id", text="text", label="lang", per_language=500)
    assert (few.log_likelihood != every.log_likelihood).any()


def test_query_has_every_page(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet").count()
    found = op8_page_languages(spark, small_dir)
    assert found.count() == pages
    assert found.where("probability < 0 OR probability > 1 OR language IS NULL").count() == 0
