import corpus_pipeline as pipeline
from corpusloom.llm import near_dup


def test_stages_keep_what_they_should(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, small_dir).write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = {r["doc_id"] for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == columns
        if name == "near_duplicates":
            classes = near_dup.near_duplicates(before)
            assert kept[name] == {r["key"] for r in classes.where("kept").collect()}
    assert kept["language"] > kept["near_duplicates"] >= kept["decontaminate"]
    assert kept["decontaminate"] == kept["mix"] == kept["tokens"]
    rows = docs.orderBy("start").collect()
    assert rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


def test_empty_tables_and_nulls(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    nothing = docs.selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in docs.dtypes]).limit(2)
    for name, rows in (("empty", docs.limit(0)), ("nulls", nothing)):
        for i, (_, stage) in enumerate(pipeline.STAGES):
            stage(spark, rows, small_dir).write.parquet(f"{tmp_path}/{name}-{i}")
            rows = spark.read.parquet(f"{tmp_path}/{name}-{i}")
        assert rows.count() <= 1


def test_rows_that_share_an_id_are_judged_by_themselves(spark, small_dir, tmp_path):
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet").where("text IS NOT NULL").orderBy("item_id").take(1)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    texts = [r["text"] for r in docs.where("length(text) > 300").orderBy("doc_id").take(40)]
    rows = [(k, f"{k} {texts[k]}", "en", f"s{k % 2}", 1) for k in range(8)]
    for i in (None, 900, 901):
        rows += [(i, f"{text[:200]} {i} {n}", "en", "s0", 1) for n, text in enumerate(texts[10:14])]
        rows.append((i, f"{texts[20][:150]} {items[0]['text']} {texts[21][:150]} {i}", "en", "s1", 1))
        rows.append((i, "12 34 !! 56", "en", "s1", 1))
    given = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)

    def after(stage, given, name):
        given.write.parquet(f"{tmp_path}/{name}")
        stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), small_dir).write.parquet(f"{tmp_path}/{name}-out")
        out = spark.read.parquet(f"{tmp_path}/{name}-out")
        assert out.columns == given.columns
        return sorted((str(r["doc_id"]), r["text"]) for r in out.collect())

    every = [(str(r[0]), r[1]) for r in rows]
    assert after(pipeline.mix, given, "mix") == sorted(every)
    clean = sorted(x for x in every if items[0]["text"] not in x[1])
    assert after(pipeline.decontaminated, given, "clean") == clean
    assert not {x for x in after(pipeline.language, given, "language") if x[1] == "12 34 !! 56"}
    copies = spark.createDataFrame(
        [(None, texts[0], "en", "s", 1), (None, texts[1], "en", "s", 1), (None, texts[0] + " more", "en", "s", 1),
         (7, texts[2], "en", "s", 1), (7, texts[2], "en", "s", 1), (7, texts[3], "en", "s", 1), (None, texts[3], "en", "s", 1)],
        given.schema,
    )
    kept = after(pipeline.near_duplicates, copies, "copies")
    assert len(kept) == 4
    assert {x[1] for x in kept if x[0] == "7"} == {texts[2], texts[3]}
