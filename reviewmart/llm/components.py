"""Connected components of a table of links, by smallest reachable id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.tasks import stage



def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """(id, component) of every id in the links (a, b); others are their own component.

    Each round every id takes the least label among its own and its neighbours', and
    then that label's label, so that chains halve.  Labels are written once a round to
    the shared folder; nothing is collected.  Sums of labels stop falling at the end.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    both = stage(both, "links", folder)
    labels = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.col("a"), F.min("b")).alias("component")
    )
    labels = stage(labels, "labels-0", folder)
    total, number = _sum(labels), 0
    while True:
        number += 1
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        next_ = labels.join(near, "id").select(
            "id", F.least("component", "near").alias("component")
        )
        parents = labels.select(
            F.col("id").alias("component"), F.col("component").alias("up")
        )
        next_ = next_.join(parents, "component", "left").select(
            "id", F.least("component", "up").alias("component")
        )
        labels = stage(next_, f"labels-{number}", folder)
        now = _sum(labels)
        if now == total:
            return labels
        total = now


def _sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
