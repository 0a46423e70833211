"""Trie of conversation prefixes, with count-min screening of prefix digests.

A prefix of a conversation is known by a digest chained over its turns. A count-min sketch of all
prefix digests, whose cells tell none, one, and two or more, proves prefixes that stand alone: where
the estimate is one, a single conversation starts that way, and so does everything that follows.
Such tails are given out where they are read. Only prefixes that may be shared are shuffled and
grouped exactly. The sketch has a bound on its size; beyond it, it proves less and more is grouped,
with the same result.

Sums over subtrees need no walk over the trie: a node's first member is a member of each of the
node's ancestors, so that a node's value travels up along that conversation alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, table

LENT_EVERY, LENT_LENGTHS = 100, 6   # the query's rebuilding: from which conversation, how many turns
SKETCH_ROWS = 4
SKETCH_LEAST, SKETCH_MOST = 1 << 12, 1 << 24  # cells in a row; two bits each, 16 MB in all at most
BLOCK = 1 << 16                               # cells that travel together
TURNS_PER_RUN = 4096                          # of one conversation that a row holds
IDS_PER_CHUNK = 2000                          # of a node's ends that a row holds
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
DIGEST = 16

RUNS = ("conv_id bigint, depth bigint, parent binary, digests binary, points binary, ends boolean")
TURN = ("conv_id bigint, depth bigint, digest binary, parent binary, points bigint, ends boolean, "
        "alone boolean, head boolean")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (from 0), role, text: turns in order of turn (null first), then role and text.
    Null role and text become empty; rows without a conv_id belong to no conversation."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))).where(
        F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("idx"), "role", "text")


def with_lent_beginnings(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 100 in the place of its
    own first h, h = crc32(c) % 6."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(LENT_LENGTHS))
    lenders = turns.where((F.col("conv_id") % LENT_EVERY == 0) & (F.col("idx") < LENT_LENGTHS - 1)
                          ).withColumnRenamed("conv_id", "lender")
    takers = ids.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % LENT_EVERY
                                                  ).alias("from"))
    lent = takers.join(lenders, (F.col("from") == F.col("lender")) & (F.col("idx") < F.col("h")))
    return turns.where(F.col("idx") >= h).unionByName(lent.select("conv_id", "idx", "role", "text"))


def _chained(turns: DataFrame) -> DataFrame:
    """Runs of prefixes: for TURNS_PER_RUN turns of a conversation, the depth before them, the
    digest there, the digests of the prefixes that end with them and their texts' code points;
    ``ends`` says that the conversation's last turn is among them."""
    def chain(batches):
        conv, before, depth, digests, points, last = None, b"", 0, [], [], b""

        def run(ends):
            return (conv, depth - len(digests), before, b"".join(digests),
                    np.array(points, np.int64).tobytes(), ends)

        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != conv or len(digests) == TURNS_PER_RUN:
                    if digests:
                        out.append(run(c != conv))
                    if c != conv:
                        conv, depth, last = c, 0, b""
                    before, digests, points = last, [], []
                r, t = role.encode(), text.encode()
                last = hashlib.blake2b(last + len(r).to_bytes(8, "little") + r + t,
                                       digest_size=DIGEST).digest()
                digests.append(last)
                points.append(len(text))
                depth += 1
            if out:
                yield _batch(out, RUNS)
        if digests:
            yield _batch([run(True)], RUNS)

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "idx").mapInArrow(chain, RUNS)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
          "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _ARROW[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _cells(digests: bytes, width: int) -> np.ndarray:
    """The sketch's cells of each digest, one in every row of the sketch."""
    at = np.frombuffer(digests, np.uint32).reshape(-1, SKETCH_ROWS).astype(np.int64) % width
    return at + np.arange(SKETCH_ROWS) * width


def count_min(runs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bits of the cells that were met, of those met twice or more). Each task counts its own
    digests; the tasks' sketches are merged block by block, and the whole has a bounded size."""
    def local(batches):
        one, two = (np.zeros(SKETCH_ROWS * width, bool) for _ in range(2))
        for batch in batches:
            for digests in batch.column(0).to_pylist():
                cell, n = np.unique(_cells(digests, width), return_counts=True)
                two[cell[(n > 1) | one[cell]]] = True
                one[cell] = True
        rows = [(b, np.packbits(one[b * BLOCK:(b + 1) * BLOCK]).tobytes(),
                 np.packbits(two[b * BLOCK:(b + 1) * BLOCK]).tobytes())
                for b in range(-(-len(one) // BLOCK)) if one[b * BLOCK:(b + 1) * BLOCK].any()]
        if rows:
            yield _batch(rows, "block int, one binary, two binary")

    def merge(batches):
        held: dict[int, tuple] = {}
        for batch in batches:
            for b, one, two in zip(*(batch.column(i).to_pylist() for i in range(3))):
                one, two = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
                if b in held:
                    one0, two0 = held[b]
                    one, two = one | one0, two | two0 | (one & one0)
                held[b] = one, two
        if held:
            yield _batch([(b, x.tobytes(), y.tobytes()) for b, (x, y) in held.items()],
                         "block int, one binary, two binary")

    schema = "block int, one binary, two binary"
    parts = runs.select("digests").mapInArrow(local, schema).repartition("block").mapInArrow(merge, schema)
    size = SKETCH_ROWS * width
    one, two = (np.zeros(-(-size // 8), np.uint8) for _ in range(2))
    for b, x, y in parts.collect():  # at most SKETCH_ROWS * SKETCH_MOST cells of two bits
        lo = b * BLOCK // 8
        one[lo:lo + len(x)], two[lo:lo + len(y)] = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    return one, two


def _screened(runs: DataFrame, two: np.ndarray, width: int) -> DataFrame:
    """A row per prefix. ``alone``: the sketch proves that no other conversation starts so, of this
    prefix or of an earlier one of its run; ``head``: the first such."""
    def screen(batches):
        for batch in batches:
            for conv, depth, before, digests, points, ends in zip(*(
                    batch.column(i).to_pylist() for i in range(6))):
                cell = _cells(digests, width)
                shared = (two[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
                alone = np.flatnonzero(shared.min(axis=1) == 0)
                n = len(cell)
                first = int(alone[0]) if len(alone) else n
                each = [digests[i * DIGEST:(i + 1) * DIGEST] for i in range(n)]
                at = np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, conv)), pa.array(depth + 1 + at), pa.array(each, pa.binary()),
                     pa.array([before, *each[:-1]], pa.binary()), pa.array(np.frombuffer(points, np.int64)),
                     pa.array((at == n - 1) & ends), pa.array(at >= first), pa.array(at == first)],
                    names=["conv_id", "depth", "digest", "parent", "points", "ends", "alone", "head"])

    return runs.mapInArrow(screen, TURN)


def _ends_digests(ends: DataFrame) -> DataFrame:
    """digest, sha of the decimal conv_ids, ascending and joined by commas. Ids are sorted over all
    tasks and joined in chunks; a digest that has to see every id in order gets them chunk by chunk,
    as a stream."""
    def chunks(batches):
        node, first, ids = None, None, []
        for batch in batches:
            out = []
            for d, c in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                if d != node or len(ids) == IDS_PER_CHUNK:
                    if ids:
                        out.append((node, first, ",".join(ids)))
                    node, first, ids = d, c, []
                ids.append(str(c))
            if out:
                yield _batch(out, "digest binary, first bigint, ids string")
        if ids:
            yield _batch([(node, first, ",".join(ids))], "digest binary, first bigint, ids string")

    def joined(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for d, ids in zip(*(batch.column(i).to_pylist() for i in (0, 2))):
                if d != node:
                    if sha is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = d, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield _batch(out, "digest binary, sha string")
        if sha is not None:
            yield _batch([(node, sha.hexdigest())], "digest binary, sha string")

    sorted_ids = ends.select("digest", "conv_id").repartitionByRange("digest", "conv_id"
                                                                     ).sortWithinPartitions("digest", "conv_id")
    packed = sorted_ids.mapInArrow(chunks, "digest binary, first bigint, ids string")
    return packed.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(
        joined, "digest binary, sha string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie's nodes over conversations ``ids`` (conv_id, each once), whose ``turns`` (conv_id, idx,
    role, text) are in the order of idx. Per node: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations without turns are members of the root alone. Conversations with equal turns end
    at one node. Without conversations there is no node, not even the root.
    """
    runs = materialise(_chained(turns), "trie_runs")
    n = runs.agg(F.sum(F.octet_length("digests") / DIGEST)).first()[0] or 0
    width = SKETCH_LEAST
    while width < min(4 * n, SKETCH_MOST):
        width *= 2
    _, two = count_min(runs, width)
    rows = materialise(_screened(runs, two, width), "trie_prefixes")
    maybe, tails = rows.where(~F.col("alone")), rows.where("alone")
    heads = tails.where("head")

    # exact grouping of what may be shared; the smallest member and counts are added up per task
    nodes = materialise(maybe.groupBy("digest").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("first"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("points").alias("points")), "trie_nodes")
    children = materialise(nodes.select("parent", "depth").unionAll(heads.select("parent", "depth")
                           ).where("depth > 1").groupBy(F.col("parent").alias("digest")).agg(
        F.count("*").alias("n_children")), "trie_children")
    known = nodes.join(children, "digest", "left").select(
        "digest", "n_convs", "first", F.coalesce("n_children", F.lit(0)).alias("n_children"))

    # what a conversation carries up to its prefixes: the values of the nodes whose first member it
    # is, and one leaf if it is the first member of the node where it ends
    mine = F.col("conv_id") == F.col("first")
    carried = maybe.join(known, "digest").select(
        "digest", "conv_id", "depth",
        F.when(mine, (F.col("n_convs") - 1) * F.col("points")).otherwise(0).alias("value"),
        (mine & F.col("ends") & (F.col("n_children") == 0)).cast("long").alias("leaf"))
    alone_at_end = tails.where("ends").select(
        F.lit(None).cast("binary").alias("digest"), "conv_id", "depth", F.lit(0).cast("long").alias("value"),
        F.lit(1).cast("long").alias("leaf"))
    conv = Window.partitionBy("conv_id")
    deeper = conv.orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = carried.unionByName(alone_at_end).select(
        "digest", F.sum("value").over(deeper).alias("value"), F.sum("leaf").over(deeper).alias("leaf")
    ).where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.sum("value").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    # the root: every conversation
    root_id = F.unhex(F.lit("00"))
    turnless = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        root_id.alias("digest"), "conv_id")
    ends = materialise(_ends_digests(maybe.where("ends").select("digest", "conv_id").unionByName(turnless)),
                       "trie_ends")
    n_convs, first = ids.agg(F.count("*"), F.min("conv_id")).first()
    saved, n_top = nodes.agg(
        F.sum((F.col("n_convs") - 1) * F.col("points")),
        F.sum((F.col("depth") == 1).cast("long"))).first()
    lone_top, lone_leaves = tails.agg(F.sum((F.col("head") & (F.col("depth") == 1)).cast("long")),
                                      F.sum(F.col("ends").cast("long"))).first()
    leaves = known.where("n_children = 0").count() + (lone_leaves or 0)
    sha = ends.where(F.col("digest") == root_id).agg(F.max("sha")).first()[0]
    long = "cast({} as bigint)".format
    root = turns.sparkSession.range(1 if n_convs else 0).selectExpr(
        long(first if n_convs else "null") + " as conv_id", long(0) + " as depth",
        long("null") + " as parent_conv_id", long(n_convs) + " as n_convs",
        long((n_top or 0) + (lone_top or 0)) + " as n_children", long(max(leaves, 1)) + " as n_leaves",
        long(saved or 0) + " as saved_tokens", f"'{sha or EMPTY_SHA}' as ends_sha256")

    up = nodes.select(F.col("digest").alias("up"), F.col("first").alias("up_first"))

    def parent_of(frame, conv_id):
        found = frame.join(up, F.col("parent") == F.col("up"), "left")
        # a parent that is in no group is one of this conversation's own, alone
        return found.withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(first)).otherwise(
            F.coalesce("up_first", conv_id)))

    shared = parent_of(nodes, "first").join(known.select("digest", "n_children"), "digest").join(
        sums, "digest").join(ends, "digest", "left").select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    lone = parent_of(heads, "conv_id").select(*heads.columns, "parent_conv_id").unionByName(
        tails.where("not head").withColumn("parent_conv_id", F.col("conv_id"))).select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"),
        F.when(F.col("ends"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(
            F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return root.unionByName(shared).unionByName(lone)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (``with_lent_beginnings``).

    Null turns come first, null roles and texts are empty, equal turn numbers are ordered by role and
    text, repeated rows are turns of their own. Rows without a conv_id take no part. An empty table
    gives no nodes. Only conv_id, turn, role and text are read.
    """
    turns = materialise(numbered_turns(conversations), "trie_turns")
    ids = turns.where("idx = 0").select("conv_id")
    rebuilt = materialise(with_lent_beginnings(turns, ids), "trie_rebuilt")
    return prefix_trie(rebuilt, ids)


def op11(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           coalesce(role, ''), coalesce(text, '')) - 1 AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
           string_split(CAST(c AS VARCHAR), ''),
           lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, e: CASE WHEN e >= 0 THEN xor(a, e)
                             ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT t.c, t.i, t.role, t.text FROM turns t JOIN ids USING (c) WHERE t.i >= ids.h
  UNION ALL
  SELECT ids.c, t.i, t.role, t.text FROM ids JOIN turns t ON t.c = ids.c - ids.c % 100 AND t.i < ids.h),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, length(text) AS cp,
         md5(CAST(length(role) AS VARCHAR) || ':' || role || text) AS k
  FROM rebuilt),
prefixes AS (
  SELECT c, d, cp, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS p,
         d = count(*) OVER (PARTITION BY c) AS ends
  FROM placed
  UNION ALL
  SELECT c, 0, 0, '', NOT EXISTS (SELECT 1 FROM placed x WHERE x.c = ids.c) FROM ids),
linked AS (SELECT *, lag(p) OVER (PARTITION BY c ORDER BY d) AS up FROM prefixes),
nodes AS (
  SELECT p, min(up) AS up, min(d) AS d, min(c) AS c, count(*) AS n, max(cp) AS cp,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS sha
  FROM linked GROUP BY p),
kids AS (SELECT up AS p, count(*) AS k FROM nodes WHERE up IS NOT NULL GROUP BY up),
full_nodes AS (SELECT nodes.*, coalesce(kids.k, 0) AS k FROM nodes LEFT JOIN kids USING (p)),
below AS (
  SELECT a.p, sum(CASE WHEN x.k = 0 THEN 1 ELSE 0 END) AS leaves, sum((x.n - 1) * x.cp) AS saved
  FROM full_nodes x JOIN prefixes a ON a.c = x.c AND a.d <= x.d GROUP BY a.p)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, u.c AS parent_conv_id, f.n AS n_convs,
       CAST(f.k AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, f.sha AS ends_sha256
FROM full_nodes f JOIN below b USING (p) LEFT JOIN nodes u ON u.p = f.up
"""
