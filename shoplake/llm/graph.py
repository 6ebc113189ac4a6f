"""Connected components of a distributed graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut

ROWS = 20_000  # of a task, about: links are few next to what they were found in
TASKS = 4  # at least


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that can be reached, for every node of ``a, b``.

    Each round a node takes the smallest label among its neighbours', and then the label of
    the node that its label names, so what a label spans about doubles. Only minima are
    gathered per node, never its neighbours. There are as many tasks as the links need.
    """
    tasks = max(TASKS, 2 * edges.count() // ROWS)

    def kept(df: DataFrame) -> DataFrame:
        return cut(df.coalesce(tasks))

    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = kept(edges.select("a", "b").unionByName(turned).where("a <> b"))
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    label = kept(label.select("node", F.least("node", "least").alias("component")))
    while True:
        near = label.select(F.col("node").alias("b"), F.col("component").alias("found"))
        offered = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("found").alias("found"))
        taken = label.join(offered, "node")
        taken = kept(taken.select("node", "component", F.least("component", "found").alias("next")))
        named = taken.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = kept(taken.join(named, "next").select("node", "component", "far"))
        label = moved.select("node", F.col("far").alias("component"))
        if moved.where("far <> component").isEmpty():
            return label
