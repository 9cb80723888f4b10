"""Reading corpora: Parquet scans, split catalogue and named corpora."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_text_parquet(
    spark: SparkSession,
    path: str,
    *,
    label: str = "input",
    text: str = "text",
    schema: StructType | str | None = None,
    partitions: int | None = None,
    file_order: bool = False,
) -> DataFrame:
    """Scan a Parquet table that must hold a text column.

    A missing path raises ``FileNotFoundError`` naming which input is missing, before
    any job starts. With ``schema`` the table must hold those columns in those types, as
    one footer tells; Spark would read a missing one as NULL. ``partitions`` deals the
    rows out anew, which a table in one row group may need; by default nothing is
    shuffled. ``file_order`` adds ``file_path`` and ``row_index``, the order of the rows
    in the files, as a key for tables that have none.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{label} parquet not found: {path}") from error
        raise
    if text not in df.columns:
        raise ValueError(f"{label} parquet has no column {text!r}; it has {', '.join(df.columns)}")
    if schema is not None:
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        found = {field.name: field.dataType for field in df.schema.fields}
        wrong = [f"{f.name} {f.dataType.simpleString()}" for f in wanted.fields if found.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"{label} parquet lacks {', '.join(wrong)}; it has {df.schema.simpleString()}")
        df = spark.read.schema(wanted).parquet(path)
    if file_order:
        df = df.select("*", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df if partitions is None else df.repartition(partitions)


def read_splits(
    spark: SparkSession,
    train: str,
    validation: str,
    test: str | None = None,
    *,
    text: str = "text",
    schema: StructType | str | None = None,
) -> DataFrame:
    """The splits of a corpus as one table with a ``split`` column.

    All paths are checked first. Without a test table, ``test`` holds the validation rows.
    """
    paths = {"train": train, "validation": validation} | ({"test": test} if test else {})
    tables = {
        name: read_text_parquet(spark, path, label=name, text=text, schema=schema)
        for name, path in paths.items()
    }
    whole: DataFrame | None = None
    for name, table in tables.items():
        part = table.withColumn("split", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    return whole if test else alias_split(whole)


def alias_split(df: DataFrame, source: str = "validation", alias: str = "test", split: str = "split") -> DataFrame:
    """Make ``alias`` hold the rows of ``source``; rows already under ``alias`` are dropped.

    Each source row is emitted twice by one pass over the input.
    """
    names = F.when(F.col(split) == source, F.array(F.lit(source), F.lit(alias))).otherwise(F.array(split))
    kept = df.where(F.col(split) != alias)
    return kept.withColumn(split, F.explode(names))


def write_corpus(df: DataFrame, path: str, split: str = "split") -> None:
    """Write the splits that ``df`` holds as partitions of a corpus; other splits stay as they are."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(split).parquet(path)


def read_named_split(
    spark: SparkSession,
    registry: Mapping[str, str],
    name: str,
    split: str,
    *,
    split_by: Column | None = None,
    text: str = "text",
    schema: StructType | str | None = None,
) -> DataFrame:
    """One split of a registered corpus.

    The table is expected to be partitioned by ``split``, so only that folder is read.
    ``split_by`` assigns the split of a table that has no such column.
    """
    if name not in registry:
        raise KeyError(f"unknown corpus {name!r}; registered: {', '.join(sorted(registry))}")
    df = read_text_parquet(spark, registry[name], label=name, text=text, schema=schema)
    if split_by is not None:
        df = df.withColumn("split", split_by)
    rows = df.where(F.col("split") == split)
    if rows.isEmpty():
        raise ValueError(f"corpus {name!r} has no rows of split {split!r}")
    return rows
