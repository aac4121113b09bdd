"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); the component is the smallest id that can be reached.

    Each round takes the smallest label among a node's neighbours (merged before the shuffle) and then the label of that
    label, so chains halve in every round. Rounds are written to the shared folder; only a count comes to the driver.
    """
    edges = stored(links.filter("a <> b").select("a", "b").union(links.filter("a <> b").select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["a"] == labels["id"]).groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near"))
        moved = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        above = labels.select(F.col("id").alias("component"), F.col("component").alias("above"))
        after = stored(moved.join(above, "component", "left").select(
            "id", "old", F.least("component", F.coalesce("above", "component")).alias("component")), "labels")
        settled = after.filter("component <> old").isEmpty()
        labels = after.select("id", "component")
        if settled:
            return labels
