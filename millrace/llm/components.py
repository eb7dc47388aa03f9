"""Connected components by iterated minimum labels, for edge lists that never leave the executors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Steps


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """edges (a, b) of any orderable type -> (node, label): the least node that each node can reach.

    Every round each node takes the least label among its neighbours, then the label of its label;
    both halve distances, so rounds grow with the logarithm of the longest path. Joins are on plain
    equality with a partial aggregation after them, so a node with very many neighbours is split by
    the skew join and costs one row per task in the shuffle. Nodes without an edge don't appear.
    Only the result stays in the shared folder.
    """
    both = steps.put(edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).distinct(), "cc-edges")
    labels = steps.put(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "cc-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = steps.put(lower.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")), f"cc-{turn}")
        moved = new.where("label != old").limit(1).count()
        steps.drop(labels)
        labels = new
        if not moved:
            steps.drop(both)
            return labels
