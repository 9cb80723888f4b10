"""Connected components of a link table by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.files import shared_folder, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a and b): the smallest node it reaches.

    Each round a node takes the smallest label of its neighbours and then the label of
    that label, so labels travel twice as far every round. Sums and minima are combined
    before the shuffle, joins are plain and can be split where one node has very many
    links, and every round is a written table. Nothing but a count of changes comes to
    the driver. Links with a NULL end are ignored.
    """
    spark = links.sparkSession
    folder = shared_folder(spark, "components")
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), f"{folder}/links")
    alone = links.where("a = b").select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = labels.select("node", F.least("node", "near").alias("component"))
    labels = written(labels, f"{folder}/round-0")
    turn = 0
    while True:
        turn += 1
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        heard = heard.agg(F.min("component").alias("near"))
        better = labels.join(heard, "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        of_label = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        better = better.join(of_label, "component", "left").select(
            "node", "old", F.least("component", "further").alias("component")
        )
        better = written(better, f"{folder}/round-{turn}")
        labels = better.select("node", "component")
        if better.where("old <> component").isEmpty():
            return labels.unionByName(alone.join(labels, "node", "left_anti"))
