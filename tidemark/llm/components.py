"""Connected components by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise

#: Parts of the nodes that have one label.
SALTS = 16


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for edges (a, b): label is the smallest node that can be reached.

    Each round gives every node the smallest label of its neighbours, then the label of its label, and is
    written to the shared folder; it ends when nothing changes. All members of a large component have one
    label: only labels that have a smaller one take part in the jump, and those meet their nodes in SALTS
    parts. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = edges.filter("a <> b").distinct()
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        moved = materialise(moved, "moved")
        salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
        pointed = moved.groupBy("mid", salt.alias("salt")).count().select("mid").distinct()
        lower = moved.select(F.col("node").alias("mid"), F.col("mid").alias("up")).filter("up < mid").join(pointed, "mid", "left_semi")
        lower = lower.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        jumped = moved.withColumn("salt", salt.cast("int")).join(lower, ["mid", "salt"], "left").select("node", "old", F.coalesce("up", "mid").alias("label"))
        stepped = materialise(jumped, "labels")
        labels = stepped.select("node", "label")
        if stepped.filter("old <> label").isEmpty():
            return labels
