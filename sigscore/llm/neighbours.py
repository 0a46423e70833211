"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table cuts space by k random projections into cells of a given width. A query visits, in
each table, its own cell and then cells next to it in the order of the estimated chance that a
near vector lies there (the squared distances to the crossed cell walls). Vectors and probes meet
by a shuffle on (table, cell); each meeting place keeps a query's nearest by the exact distance,
and the tables' candidates are merged per query.

Equal vectors are one entry with their smallest ids, so a vector copied without end is one entry;
cells with many entries are dealt over several places.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, table
from sigscore.llm.near_dedup import _blocks

NEAREST = 10
QUERY_EVERY = 100
TABLES, PROJECTIONS, PROBES = 12, 8, 96
WIDTH = 1.4             # cell width in units of the sample's median distance
SAMPLE = 512            # vectors that the width is measured on, those with the smallest hashes
ENTRIES_PER_PLACE = 2_048
QUERIES_AT_ONCE = 256
SEED = 71

ROWS = "grp bigint, vec binary, ids array<bigint>, asks boolean"
FOUND = "query binary, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec: doubles) of vectors that are not null, empty, zero, or holding nulls or
    values that are not finite; rows without an id are left out."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad
        & F.exists("v", lambda x: x != 0))


def _entries(vectors: DataFrame, nearest: int) -> DataFrame:
    """One row per distinct vector: vec (packed doubles), its nearest + 1 smallest ids, and
    whether a query has it. Tasks reduce copies before the shuffle."""
    def reduce(batches):
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            seen: dict[bytes, list] = {}
            for i, v in zip(ids, lists):
                seen.setdefault((np.array(v) + 0.0).tobytes(), []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()),
                 pa.array([sorted(set(x))[:nearest + 1] for x in seen.values()], pa.list_(pa.int64())),
                 pa.array([any(i % QUERY_EVERY == 0 for i in x) for x in seen.values()], pa.bool_())],
                names=["vec", "ids", "asks"])

    part = vectors.mapInArrow(reduce, "vec binary, ids array<bigint>, asks boolean")
    return part.groupBy("vec").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, nearest + 1)
        .alias("ids"), F.max("asks").alias("asks"))


def _median_distance(entries: DataFrame) -> float:
    """Median distance within a bounded sample, as a scale."""
    sample = entries.orderBy(F.xxhash64(F.lit(SEED), "vec"), "vec").limit(SAMPLE).select("vec").collect()
    x = [np.frombuffer(r["vec"]) for r in sample]
    x = [v for v in x if len(v) == len(x[0])]
    if len(x) < 2:
        return 1.0
    x = np.array(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))[np.triu_indices(len(x), 1)]
    return float(np.median(d)) or 1.0


def _projections(dimension: int, width: float):
    """(k x tables) directions and offsets of a dimension, the same in every task."""
    rng = np.random.default_rng([SEED, dimension])
    return (rng.standard_normal((dimension, TABLES * PROJECTIONS)) / width,
            rng.uniform(0, 1, TABLES * PROJECTIONS))


def probe_order(inside: np.ndarray, probes: int) -> list[tuple[int, ...]]:
    """Sets of cell walls to cross, the likeliest to lead to near vectors first. ``inside``: the
    query's place between the walls of its cell, 0 to 1 per projection. Wall i < k is the lower
    one of projection i, wall k + i its upper one."""
    k = len(inside)
    far = np.concatenate([inside, 1 - inside]) ** 2
    order = np.argsort(far, kind="stable")
    cost = far[order]
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < probes:
        c, walls = heapq.heappop(heap)
        crossed = [int(order[i]) for i in walls]
        if len({w % k for w in crossed}) == len(crossed):
            out.append(tuple(crossed))
        last = walls[-1]
        if last + 1 < 2 * k:  # the next set: move the farthest wall on, or add one
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], (*walls[:-1], last + 1)))
            heapq.heappush(heap, (c + cost[last + 1], (*walls, last + 1)))
    return out


_MIX = np.random.default_rng(SEED).integers(1, 2**62, PROJECTIONS, dtype=np.int64) | 1


def _cell(t: int, dimension: int, corner: np.ndarray) -> np.ndarray:
    """One number per cell of a table; cells that share a number only share candidates."""
    with np.errstate(over="ignore"):
        return ((corner * _MIX).sum(-1) * 64 + t) * 8191 + dimension


def _placed(entries: DataFrame, width: float) -> DataFrame:
    """Entries in their cell of every table (asks false), and queries in the cells they probe."""
    def place(batches):
        known = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                vecs, ids, asks = (c.to_pylist() for c in part.columns)
                rows = []
                for v, i, a in zip(vecs, ids, asks):
                    x = np.frombuffer(v)
                    if len(x) not in known:
                        known[len(x)] = _projections(len(x), width)
                    directions, offsets = known[len(x)]
                    at = (x @ directions + offsets).reshape(TABLES, PROJECTIONS)
                    corner = np.floor(at).astype(np.int64)
                    for t in range(TABLES):
                        rows.append((int(_cell(t, len(x), corner[t])), v, i, False))
                        if not a:
                            continue
                        sets = probe_order(at[t] - corner[t], PROBES)
                        probed = np.repeat(corner[t][None], len(sets), 0)
                        for n, walls in enumerate(sets):
                            for w in walls:
                                probed[n, w % PROJECTIONS] += 1 if w >= PROJECTIONS else -1
                        rows += [(c, v, None, True) for c in
                                 np.unique(_cell(t, len(x), probed)).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (
                        pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.bool_()))],
                    names=["grp", "vec", "ids", "asks"])

    return entries.mapInArrow(place, ROWS)


def nearest_in_block(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances, in double precision, of a query to a block of vectors."""
    d = x - q
    return np.sqrt((d * d).sum(1))


def _meet(rows: DataFrame, nearest: int) -> DataFrame:
    """The nearest + 1 rows per query of each place; rows: grp, block, vec, ids, asks. Entries
    come before queries in a place, and queries pass in batches."""
    def meet(batches):
        for group in _blocks(batches):
            asks = np.array(group["asks"].to_pylist())
            vecs = group["vec"].to_pylist()
            n = int((~asks).sum())
            if not n or n == len(vecs):
                continue
            ids = group["ids"].slice(0, n).to_pylist()
            of: dict[int, list[int]] = {}
            for i, v in enumerate(vecs[:n]):
                of.setdefault(len(v), []).append(i)
            blocks = {size: (np.frombuffer(b"".join(vecs[i] for i in at)).reshape(len(at), -1), at)
                      for size, at in of.items()}
            out = []
            for v in vecs[n:]:
                if len(v) not in blocks:
                    continue
                x, at = blocks[len(v)]
                d = nearest_in_block(np.frombuffer(v), x)
                some = np.flatnonzero(d <= np.partition(d, nearest)[nearest]) if len(d) > nearest + 1 \
                    else np.arange(len(d))
                best = heapq.nsmallest(nearest + 1, ((d[j], i) for j in some for i in ids[at[j]]))
                out += [(v, i, s) for s, i in best]
                if len(out) > 20_000:
                    yield _found(out)
                    out = []
            if out:
                yield _found(out)

    return rows.select("grp", "block", "vec", "ids", "asks").repartition(
        "grp", "block").sortWithinPartitions("grp", "block", "asks").mapInArrow(meet, FOUND)


def _found(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.float64()))],
        names=["query", "vec_id", "score"])


def _best(found: DataFrame, queries: DataFrame, nearest: int) -> DataFrame:
    """query_id, rank, vec_id, score from what the places found."""
    first = Window.partitionBy("query").orderBy("score", "vec_id")
    top = found.groupBy("query", "vec_id").agg(F.min("score").alias("score")).withColumn(
        "r", F.row_number().over(first)).where(F.col("r") <= nearest + 1)
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return queries.join(top, queries.vec == top.query).where(
        F.col("query_id") != F.col("vec_id")).withColumn(
        "rank", F.row_number().over(mine)).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by 100, the
    ``nearest`` other rows that were found, nearest first, ties to the smaller vec_id.

    Vectors that are null, empty, zero, or hold nulls or values that are not finite take no part,
    nor do rows without an id. Vectors are compared with those of their own length. Repeated rows
    count once per id. Queries for which the probes find fewer than ``nearest`` rows are compared
    with all rows, in blocks, so a small table is answered whole. An empty table gives an empty
    result. Only ``vec_id`` and ``embedding`` are read.
    """
    good = usable(vectors)
    entries = materialise(_entries(good, nearest), "entries")
    packed = F.udf(lambda v: (np.array(v) + 0.0).tobytes(), "binary")
    queries = materialise(good.where(F.col("vec_id") % QUERY_EVERY == 0).select(
        F.col("vec_id").alias("query_id"), packed("v").alias("vec")).distinct(), "ann_queries")
    placed = materialise(_placed(entries, WIDTH * _median_distance(entries)), "placed")
    cells = placed.where(~F.col("asks")).groupBy(F.col("grp").alias("g")).agg(
        F.ceil(F.count("*") / ENTRIES_PER_PLACE).cast("int").alias("places"))
    rows = placed.join(cells, F.col("grp") == F.col("g"))
    found = materialise(_meet(_dealt(rows), nearest), "found")
    best = materialise(_best(found, queries, nearest), "best")
    counts = best.groupBy(F.col("query_id").alias("q")).agg(F.count("*").alias("n"))
    short = materialise(queries.join(counts, F.col("query_id") == F.col("q"), "left").where(
        F.coalesce("n", F.lit(0)) < nearest).select("query_id", "vec"), "short")
    if short.isEmpty():
        return best
    places = F.lit(max(1, -(-entries.count() // ENTRIES_PER_PLACE)))
    asked = short.select("vec").distinct().select(
        F.lit(0).cast("long").alias("grp"), "vec", F.lit(None).cast("array<bigint>").alias("ids"),
        F.lit(True).alias("asks"))
    whole = entries.select(F.lit(0).cast("long").alias("grp"), "vec", "ids",
                           F.lit(False).alias("asks")).unionByName(asked)
    rest = _best(_meet(_dealt(whole.withColumn("places", places)), nearest), short, nearest)
    return best.join(short, "query_id", "left_anti").unionByName(rest)


def _dealt(rows: DataFrame) -> DataFrame:
    """Entries go to one of their cell's places, queries to all of them."""
    at = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("places") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("vec"), F.col("places")).cast("int")))
    return rows.withColumn("block", F.explode(at))


def op7(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
