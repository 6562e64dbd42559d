"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links(a, b): component is the smallest id reachable.

    Every round a node takes the least label among its neighbours' and then the label of that label, so
    labels travel in doubling steps. Joins are by id, a hub's rows are summed before they are shuffled,
    and nothing but the number of changed labels reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("least"))
        hooked = labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", F.col("component").alias("old"), F.least("component", F.coalesce("least", "component")).alias("component"))
        roots = labels.select(F.col("id").alias("root"), F.col("component").alias("above"))
        step = stored(hooked.join(roots, F.col("component") == F.col("root"), "left").select(
            "id", "old", F.least("component", F.coalesce("above", "component")).alias("component")), "labels")
        labels = step.select("id", "component")
        if step.where("old <> component").isEmpty():
            return labels
