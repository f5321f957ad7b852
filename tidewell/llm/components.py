"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.scratch import written


def _weight(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (columns ``a``, ``b``): the least id it reaches.

    Each round takes the least label among neighbours, then the label of the label. Rounds
    end when the sum of labels, which can only fall, stays. Every round is written to the
    shared folder, so a lost executor costs one round at most, and every join is between
    written tables, which lets Spark split the key of a large star.
    """
    sides = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(sides.where("a != b").distinct(), "component-edges")
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "component-labels"
    )
    weight = _weight(labels)
    while weight is not None:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        nearer = written(
            labels.join(near, "id").select("id", F.least("component", "near").alias("component")), "component-near"
        )
        jump = nearer.select(F.col("id").alias("component"), F.col("component").alias("further"))
        labels = written(
            nearer.join(jump, "component").select("id", F.col("further").alias("component")), "component-labels"
        )
        before, weight = weight, _weight(labels)
        if weight == before:
            break
    return labels
