"""Compaction of the de Bruijn graph of repeated token k-mers.

Nodes are (k-1)-word sequences, edges the repeated k-word windows between them. The graph comes as
walks, stretches of consecutive edges that documents take through it. A walk is broken wherever it
meets a branching node or a node at which any walk starts or stops; equal pieces become one. Pieces
that follow each other at a node with one way in and one way out then join to maximal nonbranching
paths, by pointer-doubling joins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import materialise

WALKS_AT_ONCE = 512
STEPS = "walk bigint, at int, node bigint, before bigint, after bigint"


def _slices(batch: pa.RecordBatch):
    for lo in range(0, batch.num_rows, WALKS_AT_ONCE):
        yield batch.slice(lo, WALKS_AT_ONCE)


def _unpacked(column: pa.Array):
    """(values, lengths) of a column of lists without nulls."""
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def steps(walks: DataFrame) -> DataFrame:
    """One row per node that a walk (walk, nodes) passes: its place, and the nodes before and after
    it in the walk (null at the ends)."""
    def unfold(batches):
        for batch in batches:
            for part in _slices(batch):
                nodes, n = _unpacked(part.column(1))
                if not len(nodes):
                    continue
                last = np.cumsum(n) - 1
                first = last - n + 1
                starts, stops = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
                starts[first], stops[last] = True, True
                walk = np.repeat(part.column(0).to_numpy(), n)
                at = np.arange(len(nodes)) - np.repeat(first, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(walk), pa.array(at.astype(np.int32)), pa.array(nodes),
                     pa.array(np.roll(nodes, 1), mask=starts), pa.array(np.roll(nodes, -1), mask=stops)],
                    names=["walk", "at", "node", "before", "after"])

    return walks.select("walk", "nodes").mapInArrow(unfold, STEPS)


def _breaks(step: DataFrame) -> DataFrame:
    """Nodes with several ways in or out, and nodes where a walk starts or stops. Least and greatest
    neighbours tell whether there are several, so tasks reduce a node to one row before the shuffle."""
    ways = step.groupBy("node").agg(
        F.min("before").alias("b1"), F.max("before").alias("b2"), F.min("after").alias("a1"),
        F.max("after").alias("a2"), F.count("before").alias("nb"), F.count("after").alias("na"),
        F.count("*").alias("n"))
    plain = (F.col("b1") == F.col("b2")) & (F.col("a1") == F.col("a2")) & (
        F.col("nb") == F.col("n")) & (F.col("na") == F.col("n"))
    return ways.where(~F.coalesce(plain, F.lit(False))).select(F.col("node").alias("broken"))


def _pieces(walks: DataFrame) -> DataFrame:
    """(piece, source, nodes): the distinct parts of walks between breaks, with their least source."""
    step = steps(walks)
    cuts = step.select("walk", "at", "node").join(_breaks(step), F.col("node") == F.col("broken")).groupBy(
        F.col("walk").alias("w")).agg(F.sort_array(F.collect_list("at")).alias("cuts"))
    rows = walks.join(cuts, F.col("walk") == F.col("w")).select("source", "nodes", "cuts")

    def split(batches):
        for batch in batches:
            for part in _slices(batch):
                out = []
                for source, nodes, at in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                    nodes = nodes.values.to_numpy()
                    at = at.values.to_numpy()
                    for lo, hi in zip(at[:-1], at[1:]):
                        x = nodes[lo:hi + 1]
                        out.append((hashlib.blake2b(x.tobytes(), digest_size=16).digest(), source, x))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (
                            pa.binary(), pa.int64(), pa.list_(pa.int64())))],
                        names=["name", "source", "nodes"])

    parts = rows.mapInArrow(split, "name binary, source bigint, nodes array<bigint>")
    distinct = parts.groupBy("name").agg(F.min("source").alias("source"), F.first("nodes").alias("nodes"))
    return materialise(distinct.select(F.monotonically_increasing_id().alias("piece"), "source", "nodes"),
                       "pieces")


def _links(pieces: DataFrame) -> DataFrame:
    """(piece, at, far): for each piece that follows another one at a node with one way in and one
    way out, the piece before it, one step away."""
    ends = pieces.select("piece", F.element_at("nodes", 1).alias("head"), F.element_at("nodes", -1).alias("tail"))
    out = ends.groupBy("head").agg(F.count("*").alias("ways_out"), F.min("piece").alias("piece"))
    into = ends.groupBy("tail").agg(F.count("*").alias("ways_in"), F.min("piece").alias("at"))
    return out.join(into, F.col("head") == F.col("tail")).where(
        (F.col("ways_out") == 1) & (F.col("ways_in") == 1) & (F.col("piece") != F.col("at"))).select(
        "piece", "at", F.lit(1).cast("long").alias("far"))


def _chained(links: DataFrame) -> DataFrame:
    """(piece, at, far) with ``at`` the first piece of the path and ``far`` the steps from it. Every
    round doubles the steps that are known. Pieces on a ring have no first one and are left out."""
    links = materialise(links, "links")
    rounds = links.count().bit_length()  # the longest path is known after so many rounds
    for _ in range(rounds):
        before = links.select(F.col("piece").alias("p"), F.col("at").alias("a"), F.col("far").alias("f"))
        links = materialise(links.join(before, F.col("at") == F.col("p"), "left").select(
            "piece", F.coalesce("a", "at").alias("at"),
            (F.col("far") + F.coalesce("f", F.lit(0))).alias("far"), F.col("p").isNotNull().alias("moved")),
            "links")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    starts = links.select(F.col("piece").alias("p"))
    return links.join(starts, F.col("at") == F.col("p"), "left_anti").select("piece", "at", "far")


def compact(walks: DataFrame) -> DataFrame:
    """(path, place, source, nodes): the pieces of all nonbranching paths of the graph of ``walks``
    (walk: a distinct long; source: long; nodes: array of at least two longs, no nulls). Each edge
    is in one piece. ``path`` names the path, ``place`` orders its pieces, ``source`` is the least
    source of the walks that pass the piece. A ring that nothing enters is as many paths as it has
    pieces. No walks give no rows."""
    pieces = _pieces(walks)
    chained = _chained(_links(pieces)).select(F.col("piece").alias("p"), "at", "far")
    return pieces.join(chained, F.col("piece") == F.col("p"), "left").select(
        F.coalesce("at", "piece").alias("path"), F.coalesce("far", F.lit(0)).alias("place"), "source", "nodes")
