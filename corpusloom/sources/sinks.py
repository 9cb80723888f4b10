"""Writing: subsets, run logs, metric files and reusable preprocessed tables."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The columns of a run log, after the run they belong to.
RUN_LOG_SCHEMA = (
    "run_id STRING, step BIGINT, epoch DOUBLE, train_loss DOUBLE, learning_rate DOUBLE, "
    "eval_loss DOUBLE, eval_perplexity DOUBLE, timestamp TIMESTAMP"
)
_LOG_OPTIONS = {"header": "true", "nullValue": "", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


class WrittenSubset(NamedTuple):
    rows: int
    bytes: int
    measures: dict[str, object]


def filesystem_of(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def write_subset(df: DataFrame, path: str, measures: Mapping[str, Column] | None = None) -> WrittenSubset:
    """Write ``df`` as Parquet and report the rows and bytes written, and other aggregates if asked.

    Rows and aggregates are observed while they are written; nothing is read again.
    """
    seen = Observation()
    asked = [column.alias(name) for name, column in (measures or {}).items()]
    df.observe(seen, F.count(F.lit(1)).alias("_rows"), *asked).write.mode("overwrite").parquet(path)
    found = dict(seen.get)
    filesystem, target = filesystem_of(df.sparkSession, path)
    return WrittenSubset(
        rows=found.pop("_rows"), bytes=filesystem.getContentSummary(target).getLength(), measures=found
    )


def append_run_log(df: DataFrame, path: str) -> None:
    """Append run-log rows as CSV with a header in each file; NULL becomes an empty cell.

    Earlier rows are kept: a resumed run continues its log under the same ``run_id``.
    """
    columns = [field.split()[0] for field in RUN_LOG_SCHEMA.split(", ")]
    df.select(*columns).write.mode("append").options(**_LOG_OPTIONS).csv(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).options(**_LOG_OPTIONS).csv(path)


def write_metric_json(metrics: DataFrame, path: str, prefix: str | None = None) -> None:
    """Write ``(metric, value)`` rows as one JSON object.

    ``prefix`` keeps the metrics of one stage (``train``, ``eval``, ``test``); without it
    all of them are written. The metrics of a job are a handful of rows.
    """
    if prefix is not None:
        metrics = metrics.where(F.col("metric").startswith(f"{prefix}_"))
    row = metrics.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("m"))
    row.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def _fingerprint(df: DataFrame, parameters: Mapping[str, object]) -> str:
    """What a result depends on: schema, plan without its numbering, input files, parameters."""
    spark = df.sparkSession
    files = []
    for name in sorted(df.inputFiles()):
        filesystem, path = filesystem_of(spark, name)
        status = filesystem.getFileStatus(path)
        files.append([name, status.getLen(), status.getModificationTime()])
    plan = re.sub(r"#\d+L?|plan_id=\d+", "", df._jdf.queryExecution().optimizedPlan().canonicalized().toString())
    parts = [df.schema.json(), plan, files, sorted((k, repr(v)) for k, v in parameters.items())]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def reuse_or_write(
    df: DataFrame, path: str, overwrite: bool = False, parameters: Mapping[str, object] | None = None
) -> DataFrame:
    """Read a finished earlier output of the same job at ``path``, or compute ``df``, write it and read that.

    An output is used again only with its success marker and a fingerprint equal to this
    job's: schema, plan, input files with their sizes and times, and ``parameters`` (what
    the plan does not show, such as the version of user code). Anything else is replaced.
    """
    spark = df.sparkSession
    fingerprint = _fingerprint(df, parameters or {})
    filesystem, done = filesystem_of(spark, path + "/_SUCCESS")
    _, mark = filesystem_of(spark, path + "/_fingerprint")
    same = False
    if not overwrite and filesystem.exists(done) and filesystem.exists(mark):
        stream = filesystem.open(mark)
        same = bytes(stream.readAllBytes()).decode() == fingerprint
        stream.close()
    if not same:
        df.write.mode("overwrite").parquet(path)
        stream = filesystem.create(mark, True)
        stream.write(bytearray(fingerprint.encode()))
        stream.close()
    return spark.read.schema(df.schema).parquet(path)
