"""Connected components of links between documents, without gathering them anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, ship_package

#: So many links at most are contracted in one task (16 MB).
LINKS_PER_TASK = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, sorted, and the least node that each can reach."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        lower = label.copy()
        for side in (x, y):
            np.minimum.at(lower, label[side], low)
        while not np.array_equal(lower, lower[lower]):
            lower = lower[lower]
        if np.array_equal(lower, label):
            return nodes, nodes[label]
        label = lower


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """(node, component): each task's own links as stars around their least nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        for batch in batches:
            for side in (0, 1):
                ends[side].append(batch.column(side).to_numpy(zero_copy_only=False))
        nodes, least = least_reachable(np.concatenate(ends[0]), np.concatenate(ends[1]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)],
                                         names=["node", "component"])

    ship_package(links.sparkSession)
    return cut_lineage(links.coalesce(tasks).mapInArrow(run, "node long, component long"))


def connected_components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component), the least node that can be reached.

    Each task first contracts its own links, a bounded number. If one task holds them
    all, that is the answer. Else the stars that are left are joined in rounds: each
    takes the least label among neighbours and then the label of that label, so that
    long chains shorten quickly. Labels are written to the shared folder after each
    round. Nodes without a link have no row.
    """
    saved = cut_lineage(links.where("a <> b").select("a", "b"))
    tasks = -(-saved.count() // LINKS_PER_TASK)
    stars = _contracted(saved, max(1, tasks))
    return stars if tasks <= 1 else _joined(stars.select(F.col("component").alias("a"),
                                                         F.col("node").alias("b")))


def _joined(links: DataFrame) -> DataFrame:
    """Components by rounds of joins."""
    both = cut_lineage(
        links.where("a <> b").select("a", "b")
        .unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct()
    )
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a").agg(F.min("label").alias("seen"))
        )
        lower = labels.join(near, labels.node == near.a, "left").select(
            "node", F.least("label", F.coalesce("seen", "label")).alias("next"), "label"
        )
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        stepped = cut_lineage(
            lower.join(up, "next", "left").select(
                "node",
                F.least("next", F.coalesce("far", "next")).alias("now"),
                (F.least("next", F.coalesce("far", "next")) < F.col("label")).alias("moved"),
            )
        )
        labels = stepped.select("node", F.col("now").alias("label"))
        if stepped.where("moved").limit(1).count() == 0:
            return labels.withColumnRenamed("label", "component")
