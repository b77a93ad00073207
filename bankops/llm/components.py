"""Connected components of an edge table, by union in tasks and a shuffle by node, until nothing changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankops.session import stored


def union_min(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the smallest node that each is connected with."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[x] != label[y]
        x, y = x[open_], y[open_]
    return nodes, nodes[label]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        nodes, low = union_min(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(low)], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the two-column long edge table is connected with.

    A task holds its share of the edges. Rows (node, smallest known) go to the task of the node, so that a node of very many
    edges, once its edges are contracted, has at most one row from each task. Then each node that is the smallest known of others,
    but knows a smaller one itself, gives way to that on all their rows, wherever these are. Each round is written to the shared
    folder; when nothing changes, a node has one row, and its component only itself. An empty table gives no rows; self-edges and
    repeated edges are allowed; rows with a null end are left out.
    """
    a, b = edges.columns
    rows = edges.select(F.col(a).alias("node"), F.col(b).alias("component")).dropna()
    rows = rows.mapInArrow(_contract, "node long, component long")
    seen = None
    while True:
        rows = stored(rows.repartition("node").mapInArrow(_contract, "node long, component long"))
        digest = rows.distinct().agg(F.count("*"), F.sum(F.xxhash64("node", "component") % 1_000_003)).first()
        if digest == seen:
            return rows.distinct()
        seen = digest
        smaller = rows.where("component < node").groupBy(F.col("node").alias("component")).agg(F.min("component").alias("smaller"))
        rows = rows.join(smaller, "component", "left").select("node", F.coalesce("smaller", "component").alias("component"))


def id_edges(rows: DataFrame, id_col: str, node_col: str) -> DataFrame:
    """Edges (a, b) between the nodes of rows that share an id: each to the smallest of its id. Null ids share nothing.

    Ids of one node, as a rule all of them, end in the first count, which holds two numbers for an id.
    """
    known = rows.where(F.col(id_col).isNotNull() & F.col(node_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(node_col).alias("a"))
    ends = known.groupBy("id").agg(F.min("a").alias("b"), F.max("a").alias("high")).where("b < high").select("id", "b")
    return known.distinct().join(ends, "id").where("a != b").select("a", "b")
