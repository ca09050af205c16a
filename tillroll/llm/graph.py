"""Connected components of links, as joins and minima over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.workspace import Workspace


def components(edges: DataFrame, workspace: Workspace, name: str) -> DataFrame:
    """vertex, component (its smallest vertex) for all ends of edges (columns a, b: long).

    Each round takes the smallest label around a vertex, then the label of that label, which
    halves long paths; every table of a round is stored, so lineage stays short, a hub's rows can
    be split in joins, and nothing but one sum reaches the driver.
    """
    both = edges.select(F.col("a").alias("near"), F.col("b").alias("vertex")).unionByName(
        edges.select(F.col("b").alias("near"), F.col("a").alias("vertex"))
    )
    loops = both.select(F.col("vertex").alias("near"), "vertex")
    around = workspace.store(both.unionByName(loops).distinct(), f"{name}_around")
    labels = workspace.store(
        around.groupBy("vertex").agg(F.min("near").alias("component")), f"{name}_0"
    )
    total, turn = None, 0
    while True:
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total, turn = now, turn + 1
        known = labels.select(F.col("vertex").alias("near"), "component")
        low = workspace.store(
            around.join(known, "near").groupBy("vertex").agg(F.min("component").alias("component")),
            f"{name}_{turn}_low",
        )
        beyond = low.select(F.col("vertex").alias("component"), F.col("component").alias("lower"))
        labels = workspace.store(
            low.join(beyond, "component").select("vertex", F.col("lower").alias("component")),
            f"{name}_{turn}",
        )
