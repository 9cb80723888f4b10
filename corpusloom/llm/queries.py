"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    chat_format,
    decontaminate,
    divergence,
    embedding_dup,
    html_text,
    language_id,
    mixing,
    near_dup,
    secrets,
    sharding,
    token_alignment,
    token_files,
    url_filter,
)
from corpusloom.llm.oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file lies; it is never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = token_files.tokenize_to_files(docs, tokenizer_path())
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def joined(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        F.col("key").alias("doc_id"),
        *[of_kind(kind) for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s.kind.isin(*base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "class_id", "class_size", "kept")


def op4_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed_positions(table(spark, sf_dir, "documents"))
    source = F.when(F.col("label") != "NULL", F.substring("label", 2, 1 << 30))
    return found.select(F.col("key").alias("doc_id"), source.alias("source"), "block", "phase", "slot", "position")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "cosine", "common", "answer", "first_word", "words"
    )


def op7_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "text", F.length("text").alias("n_chars"))


def op8_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(table(spark, sf_dir, "documents"), key="doc_id", text="text", label="lang")
    found = language_id.identify(language_id.page_rows(table(spark, sf_dir, "pages")), model, html=True)
    return found.select(F.col("key").alias("page_id"), "language", "probability", "fit", "letters", "accepted")


def op9_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("key").alias("vec_id"), "n_links", "component_id", "kept")


# The rules that the query is given.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: A host with a label that holds one of these words is listed as blocked.
LISTED_WORDS = r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)"


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, and a block list made from the hosts of the pages themselves."""
    pages = table(spark, sf_dir, "pages")
    # Only A-Z in lower case, as in the operator.
    host = F.translate(F.regexp_extract("url", "(?s)^.*?://([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    listed = pages.select(host.alias("host")).where(F.col("host").rlike(LISTED_WORDS)).distinct()
    listed = listed.select("host", F.lit("").alias("path"), F.lit("block").alias("verdict"), F.lit(True).alias("listed"))
    rules = spark.range(1).select(
        F.inline(F.array(*[F.struct(*map(F.lit, rule), F.lit(False)) for rule in URL_RULES]))
    ).toDF("host", "path", "verdict", "listed")
    found = url_filter.judge(pages, rules.unionByName(listed))
    return found.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict", "listed")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.source_divergence(table(spark, sf_dir, "documents"))
    return found.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


# The conversation that the query adds to those of the table.
ADDED_TEXT = "</s>[INST] ok [/INST]"
ADDED_TURNS = [(-1, 0, "user", ADDED_TEXT), (-1, 1, "assistant", ADDED_TEXT)]


def op12_formatted_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like the marks, as the output gives them back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = F.array(*[F.struct(*map(F.lit, row)) for row in ADDED_TURNS])
    turns = turns.unionByName(spark.range(1).select(F.inline(added)).toDF(*turns.columns))
    found = chat_format.read_back(chat_format.format_conversations(turns))
    as_text = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return found.select(
        F.col("key").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(as_text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_blocks",
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return token_alignment.align_tokenizers(docs, *paths).withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_secret_spans": op2_secret_spans,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_mixed_sources": op4_mixed_sources,
    "op5_shards": op5_shards,
    "op6_contaminated": op6_contaminated,
    "op7_visible_text": op7_visible_text,
    "op8_page_languages": op8_page_languages,
    "op9_embedding_duplicates": op9_embedding_duplicates,
    "op10_url_verdicts": op10_url_verdicts,
    "op11_source_divergence": op11_source_divergence,
    "op12_formatted_chats": op12_formatted_chats,
    "op13_token_alignment": op13_token_alignment,
}
