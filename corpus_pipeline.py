"""The training-data pipeline over ``documents``, and the queries of its operators.

Each stage takes (spark, docs, sf_dir) and works on every document that the stage before
it kept; what it returns is written as Parquet and read again for the next one. A stage
decides row by row: a row is known by its file and its place there, so that rows with a
NULL or repeated id are told apart.

1. language: documents without letters or in no known language go.
2. near_duplicates: of each class of near copies the one with the smallest id stays
   (one row, also of those that share it; a NULL id only where there is no other).
3. decontaminate: documents that hold a benchmark item go.
4. mix: all documents, in files that follow each other in mixture order.
5. tokens: token ids in that order, written in their file format and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, language_id, mixing, near_dup, token_files
from corpusloom.llm import queries as llm
from corpusloom.llm.files import deleted_folders, shared_folder, written

KEY = "doc_id"


ROW = "_row"


def _identified(docs: DataFrame) -> DataFrame:
    """The documents of a written table, with a column that identifies a row of it."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = written(docs, shared_folder(docs.sparkSession, "documents"))
    return docs.withColumn(ROW, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index")))


def _without(docs: DataFrame, dropped: Callable[[], DataFrame]) -> DataFrame:
    """The identified documents whose row is not in ``dropped()`` (column key).

    The rows to drop are written, then what the operator has left in shared folders goes.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "dropped")
    with deleted_folders(spark):
        gone = written(dropped().select(F.col("key").alias(ROW)).distinct(), folder)
    return docs.join(gone, ROW, "left_anti").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on a sample of the documents and their stated languages."""
    if docs.where("lang IS NOT NULL").isEmpty():
        return docs
    model = language_id.fit(docs, key=KEY, text="text", label="lang")
    docs = _identified(docs)

    def rejected() -> DataFrame:
        return language_id.identify(language_id.document_rows(docs, key=ROW), model).where("NOT accepted")

    return _without(docs, rejected)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _identified(docs)
    order = F.struct(F.col(KEY).isNull().alias("none"), F.col(KEY).alias("id"), F.col(ROW).alias("row"))

    def copies() -> DataFrame:
        found = near_dup.near_duplicates(docs.withColumn("_order", order), key="_order")
        return found.where("NOT kept").select(F.col("key.row").alias("key"))

    return _without(docs, copies)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = _identified(docs)
    return _without(docs, lambda: decontaminate.contaminated(docs, benchmark, key=ROW))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Within a source by id and checksum."""
    columns = docs.columns
    crc = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    docs = _identified(docs)
    docs = docs.withColumn("_order", F.struct(F.col(KEY).alias("id"), crc.alias("crc"), F.col(ROW).alias("row")))
    return mixing.mixed(docs, key="_order").select(*columns)


def _file_order(docs: DataFrame) -> list[Column]:
    """Order of the rows in the files they were read from; none if they are not from files."""
    order = [
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"),
        F.col("_metadata.file_path"),
        F.col("_metadata.row_index"),
    ]
    try:
        docs.select(*order)
    except AnalysisException:
        return []
    return order


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors still hold what the stages before have loaded, so this one takes little.
    found = token_files.tokenize_to_files(
        docs, llm.tokenizer_path(), place=_file_order(docs), batch_chars=1_000_000, remembered_words=100_000
    )
    return found.select(F.col("key").alias(KEY), "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("mix", mix),
    ("tokens", tokens),
]

#: Training, alignment and tokenization are not expressible in SQL; tests compare the
#: stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = llm.QUERIES | {"pipeline": run}
ORACLES = llm.ORACLES | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
