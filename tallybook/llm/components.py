"""Connected components of edges between integer nodes: inside a task, and over a whole table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.sinks import settle

SALTS = 16


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the same nodes: every node but the smallest of its component, with that smallest one."""
    nodes, places = np.unique(np.concatenate((left, right)), return_inverse=True)
    a, b = places[: len(left)], places[len(left) :]
    labels = np.arange(len(nodes))
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        open_edges = low != high
        if not open_edges.any():
            break
        a, b = a[open_edges], b[open_edges]
        np.minimum.at(labels, high[open_edges], low[open_edges])
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels = further
    child = labels != np.arange(len(nodes))
    return nodes[child], nodes[labels[child]]


def connected(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (node, other); the label is the smallest node it is connected to.

    Edges lead from a node to a smaller one. Each round hangs a node, and its other smaller neighbours, under the
    smallest of them, and then moves every edge on to the smallest neighbour of its end, until all trees are stars.
    Path lengths about halve with each round. Every round is written to the shared folder, so a lost executor costs
    one round. A node has few smaller neighbours; a great many nodes may share one, so they look it up by salt.
    """
    low, high = F.least("node", "other").alias("other"), F.greatest("node", "other").alias("node")
    edges = settle(edges.where("node != other").select(high, low).distinct(), "edges")
    while True:
        own = Window.partitionBy("node")
        hung = edges.select("node", "other", F.min("other").over(own).alias("low"), F.count("other").over(own).alias("ways"))
        under = F.struct("node", F.col("low").alias("other"), (F.col("ways") > 1).alias("moved"))
        beside = F.struct(F.col("other").alias("node"), F.col("low").alias("other"), F.lit(True).alias("moved"))
        hung = hung.select(F.inline(F.array(under, beside))).where("node != other")
        hung = hung.groupBy("node", "other").agg(F.bool_or("moved").alias("moved"))

        ends = hung.groupBy("node").agg(F.min("other").alias("end"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        ends = ends.select(F.col("node").alias("other"), "end", salts)
        salted = hung.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        on = salted.join(ends, ["other", "salt"], "left")
        moved = F.col("moved") | F.col("end").isNotNull()
        on = on.select("node", F.coalesce("end", "other").alias("other"), moved.alias("moved"))
        edges = settle(on.groupBy("node", "other").agg(F.bool_or("moved").alias("moved")), "edges")
        if not edges.agg(F.bool_or("moved")).first()[0]:
            break
        edges = edges.drop("moved")
    children = edges.select("node", F.col("other").alias("label"))
    return children.unionByName(children.select(F.col("label").alias("node"), "label").distinct())
