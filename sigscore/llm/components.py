"""Connected components of a graph given by its edges, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); a component is named by its
    smallest node. Self loops and repeated edges do no harm; nodes are never null.

    Each round sends the smallest label among a node's neighbours' and its own to the node and to
    the node that is its label now, and then takes the label of the label, so that trees of labels
    join and halve whatever the order of the ids. Labels only get smaller; rounds go on until none
    does. Rounds are written to the shared folder; the labels are pre-aggregated per task, so a hub
    with many neighbours is no large group.
    """
    both = materialise(edges.select("a", "b").unionAll(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc_edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")), "cc_labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(
            F.min("component").alias("near"))
        sent = labels.join(near, labels.node == near.a).select(F.explode(F.array(
            F.struct("node", F.col("component").alias("old"), "near"),
            F.struct(F.col("component").alias("node"), F.lit(None).cast("long").alias("old"),
                     "near"))).alias("to")).select("to.*")
        new = sent.groupBy("node").agg(F.max("old").alias("old"), F.min("near").alias("near")).select(
            "node", "old", F.least("old", "near").alias("new"))
        of = labels.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        new = new.join(of, F.col("new") == F.col("n2"), "left").select(
            "node", "old", F.least("new", "c2").alias("component"))
        step = materialise(new, "cc_labels")
        labels = step.select("node", "component")
        if step.where(F.col("old") != F.col("component")).isEmpty():
            return labels
