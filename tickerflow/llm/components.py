"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame, written=written) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label, until
    nothing changes. Labels are written after each round, by ``written``. Sums per id combine before the
    shuffle, so an id with very many links isn't gathered in one task.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        step = written(step.join(jump, "component", "left").select("id", "old", F.least("component", "far").alias("component")), "labels")
        labels = step.select("id", "component")
        if not step.where("component <> old").limit(1).count():
            return labels
