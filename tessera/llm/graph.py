"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import BROADCAST_ROWS, materialize


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges a, b in order, and the least node of the component of each."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        # Every root that has a lesser one among its edges goes under the least of them; then all nodes point to roots.
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, up := root[root]):
            root = up
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[root]


def components(edges: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """edges: a, b (long), materialized. One row per node with an edge: node, label (least node of its component).
    As many edges as a slim join side may have rows come to the driver, which needs no round of small jobs; of more, each round
    takes the least label of a node's neighbours, then that label's own
    label; minima are combined before they are shuffled, so hubs are no bottleneck."""
    if edges.limit(most + 1).count() <= most:
        few = edges.select("a", "b").filter("a <> b").toArrow()
        nodes, labels = least_labels(few["a"].to_numpy(), few["b"].to_numpy())
        found = pa.table([pa.array(nodes, pa.int64()), pa.array(labels, pa.int64())], names=["node", "label"])
        return materialize(edges.sparkSession.createDataFrame(found), "labels")
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        step = materialize(step, "step")
        jump = step.join(step.select(F.col("node").alias("low"), F.col("low").alias("lower")), "low")
        new = materialize(jump.select("node", F.col("lower").alias("label"), (F.col("lower") != F.col("label")).alias("moved")), "labels")
        if new.filter("moved").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
