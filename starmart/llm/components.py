"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame, path: str) -> DataFrame:
    """(node, label) of every node of the links (a, b); the label is the least node that it is connected with.

    In each round every node points to the least of its neighbours and itself, the pointers are followed to
    their ends, and links within what has become one node fall away. At least half of the nodes that still have
    links go in each round. All steps are joins and groupings, written below ``path``, so a lost executor costs
    the step it was at and nothing is collected.
    """
    edges = _written(links.select("a", "b").filter("a <> b").distinct(), f"{path}/edges-0")
    labels, number = None, 0
    while labels is None or not edges.isEmpty():
        number += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        to = _written(to.select("node", F.least("node", "least").alias("to")), f"{path}/to-{number}-0")
        jump = 0
        while True:
            jump += 1
            beyond = to.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            moved = to.join(beyond, "to").select("node", F.col("beyond").alias("to"), (F.col("beyond") < F.col("to")).alias("moved"))
            moved = _written(moved, f"{path}/to-{number}-{jump}")
            to = moved.select("node", "to")
            if moved.filter("moved").isEmpty():
                break
        a = to.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        b = to.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        left = edges.join(a, "a").join(b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges = _written(left.filter("a <> b").distinct(), f"{path}/edges-{number}")
        if labels is None:
            labels = to.withColumnRenamed("to", "label")
        else:
            labels = labels.join(to.select(F.col("node").alias("label"), "to"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            )
    return _written(labels, f"{path}/labels")
