"""MinHash near-dedup with tensored banding and exact confirmation.

A document's set is its distinct word shingles. Two collections of k sub-keys, each a
combination of a few min-hashes, give k * k tables: the key of table (i, j) combines sub-key i of
the first collection with sub-key j of the second, so that k * k tables of 2 r min-hashes cost
2 k r min-hashes instead of 2 k k r.

Equal sets are first collapsed to their smallest document. Documents that meet in a table are
joined to the table row's smallest document; the components of that candidate graph are the
groups in which links are looked for. Inside a group all pairs are compared on their full sets,
in blocks of bounded size, and a block gives back only a spanning forest of its links. A group
beyond one block is compared with its first chunk; only documents that this leaves outside the
group's largest component are compared with the other chunks. The components of the confirmed
links are the result: equal, for documents that meet, to those of all links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigscore.llm._common import (WordHashes, materialise, mix64, ngram_hashes, table,
                                  text_slices, tidy)
from sigscore.llm.components import connected_components

SHINGLE_WORDS = 3
LINK_PERCENT = 85       # links need 100 * intersection >= LINK_PERCENT * union
SUB_KEYS = 8            # per collection; SUB_KEYS ** 2 tables
HASHES_PER_SUB_KEY = 3
SEED = 20
DOCS_PER_CHUNK = 512
SHINGLES_PER_CHUNK = 1 << 18

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: bytes | None, known: WordHashes, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle."""
    ws = text.translate(_LOWER).split() if text else []
    if not ws:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(known.of(ws), min(size, len(ws))))


def table_keys(shingles: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray,
               sub_keys: int, hashes: int) -> np.ndarray:
    """The keys of all tables for a non-empty set."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1 << 14):
        part = shingles[at:at + (1 << 14)]
        seen = (part[None, :] ^ offsets[:, None]) * multipliers[:, None]
        np.minimum(low, seen.min(axis=1), out=low)
    low = low.reshape(2, sub_keys, hashes)
    key = np.zeros((2, sub_keys), np.uint64)
    for i in range(hashes):
        key = mix64(key + low[:, :, i])
    number = np.arange(sub_keys * sub_keys, dtype=np.uint64)
    return mix64((key[0][:, None] + mix64(key[1])[None, :]).ravel() + number)


def signatures(docs: DataFrame, size: int = SHINGLE_WORDS, sub_keys: int = SUB_KEYS,
               hashes: int = HASHES_PER_SUB_KEY) -> DataFrame:
    """doc_id, n_shingles, same (digest of the full set; null when empty), keys."""
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 2**64, 2 * sub_keys * hashes, dtype=np.uint64)
    multipliers, offsets = draw() | np.uint64(1), draw()

    @tidy
    def sign(batches):
        known = WordHashes()
        for batch in batches:
            ids = batch.column(0)
            for lo, texts in text_slices(batch, "text"):
                n, same, keys = [], [], []
                for t in texts:
                    s = shingle_set(t, known, size)
                    n.append(len(s))
                    same.append(hashlib.blake2b(s, digest_size=16).digest() if len(s) else None)
                    keys.append(table_keys(s, multipliers, offsets, sub_keys, hashes)
                                .view(np.int64) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(texts)), pa.array(n, pa.int64()),
                     pa.array(same, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "same", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, same binary, keys array<bigint>")


class Links:
    """Spanning forest of the links among the documents of a block."""

    def __init__(self, percent: int):
        self.percent = percent

    def of(self, nodes, sets, labels, turn):
        """Pairs that link. ``labels``: known components; a pair of one label is not looked at.
        ``turn``: whether a document is compared with all others, or only serves them."""
        flat = np.concatenate(sets)
        _, flat = np.unique(flat, return_inverse=True)
        n = np.array([len(s) for s in sets])
        starts = np.concatenate(([0], np.cumsum(n)[:-1]))
        label = np.asarray(labels).copy()
        mark = np.zeros(flat.max() + 1, np.int64)
        out = []
        for i in np.flatnonzero(turn):
            if (label == label[i]).all():
                break
            mine = flat[starts[i]:starts[i] + n[i]]
            mark[mine] = 1
            both = np.add.reduceat(mark[flat], starts)
            mark[mine] = 0
            linked = 100 * both >= self.percent * (n + n[i] - both)
            for j in np.flatnonzero(linked & (label != label[i])):
                if label[j] != label[i]:
                    out.append((nodes[i], nodes[j]))
                    label[label == label[j]] = label[i]
        return out


def _blocks(batches):
    """Groups of rows with equal (grp, block) from batches sorted by them; the last group of a
    batch is held until the next key."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(0).to_numpy()
        b = batch.column(1).to_numpy()
        cuts = np.flatnonzero((g[1:] != g[:-1]) | (b[1:] != b[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if held and key != (g[lo], b[lo]):
                yield pa.Table.from_batches(held)
                held = []
            key = (g[lo], b[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each (grp, block); rows: grp, block, node, label, turn, shingles."""
    @tidy
    def compare(batches):
        links = Links(percent)
        for group in _blocks(batches):
            if group.num_rows < 2:
                continue
            cols = {c: group[c].to_pylist() for c in ("node", "label", "turn", "shingles")}
            sets = [np.frombuffer(s, np.uint64) for s in cols["shingles"]]
            found = links.of(cols["node"], sets, cols["label"], cols["turn"])
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 names=["a", "b"])

    keyed = rows.select("grp", "block", "node", "label", "turn", "shingles").repartition(
        "grp", "block").sortWithinPartitions("grp", "block", "node")
    return keyed.mapInArrow(compare, "a bigint, b bigint")


def _sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """Full shingle sets (node, grp, chunk, chunks, shingles) of the documents in ``members``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        members, F.col("doc_id") == F.col("node")).select("node", "grp", "chunk", "chunks", "text")
    schema = T.StructType([*rows.drop("text").schema.fields, T.StructField("shingles", T.BinaryType())])

    @tidy
    def shingle(batches):
        known = WordHashes()
        for batch in batches:
            for lo, texts in text_slices(batch, "text"):
                sets = [shingle_set(t, known, size).tobytes() for t in texts]
                rest = [batch.column(i).slice(lo, len(texts)) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(sets, pa.binary())],
                    names=["node", "grp", "chunk", "chunks", "shingles"])

    return rows.mapInArrow(shingle, schema)


def _candidate_groups(reps: DataFrame) -> DataFrame | None:
    """(node, component) of the candidate graph; None when no two sets meet in a table. The
    smallest document of each table row is found by a pre-aggregated minimum; the join back to
    the row's documents is one that Spark can split when a row is large."""
    rows = reps.select(F.col("rep").alias("node"), F.explode("keys").alias("key"), "n_shingles")
    met = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    met = met.where(F.col("first") < F.col("last")).select("key", "first")
    edges = materialise(rows.join(met, "key").where(F.col("node") > F.col("first")).select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "met")
    return None if edges.isEmpty() else connected_components(edges)


def _confirmed(docs: DataFrame, groups: DataFrame, weights: DataFrame, size: int,
               percent: int) -> DataFrame | None:
    """(node, component) of the links confirmed on full sets; None when there are none."""
    sized = groups.join(weights, F.col("node") == F.col("rep"))
    totals = sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / DOCS_PER_CHUNK),
                        F.ceil(F.col("w") / SHINGLES_PER_CHUNK)).cast("int")
    members = groups.join(totals.withColumn("chunks", chunks), "component").select(
        "node", F.col("component").alias("grp"), "chunks",
        F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("chunks")).cast("int").alias("chunk"))
    members = materialise(members, "members")
    sets = materialise(_sets(docs, members, size), "sets")
    # the first chunk of a group goes to the blocks of all its chunks
    block = F.when(F.col("chunk") == 0, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
        F.array("chunk"))
    first = sets.withColumn("block", F.explode(block)).withColumn(
        "label", F.col("node")).withColumn("turn", F.lit(True))
    links = materialise(_compare(first, percent), "links")
    labels = None if links.isEmpty() else connected_components(links)
    large = sets.where(F.col("chunks") > 1)
    if large.isEmpty():
        return labels
    # documents outside the largest component of their group against all of the group
    known = large.select("node", "grp", "chunk", "chunks")
    if labels is None:
        known = known.withColumn("label", F.col("node"))
    else:
        known = known.join(labels.withColumnRenamed("node", "n"), F.col("node") == F.col("n"),
                           "left").select("node", "grp", "chunk", "chunks",
                                          F.coalesce("component", "node").alias("label"))
    known = materialise(known, "known")
    largest = known.groupBy("grp", "label").agg(F.count("*").alias("n")).groupBy("grp").agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("main"))
    split = known.join(largest, "grp").withColumn("turn", F.col("label") != F.col("main"))
    turns = split.where("turn").groupBy("grp").agg(F.count("*").alias("turns"))
    deals = F.ceil(F.col("turns") / DOCS_PER_CHUNK).cast("int")
    split = split.join(turns.withColumn("deals", deals), "grp").withColumn(
        "deal", F.pmod(F.xxhash64(F.lit(SEED + 1), "node"), F.col("deals")).cast("int"))
    split = split.select(F.col("node").alias("n"), "label", "turn", "deals", "deal")
    # a block is (deal of open documents, chunk of the group); an open document takes its turn
    # in the blocks of its deal and serves in its chunk's blocks for the other deals
    rows = large.join(split, F.col("node") == F.col("n"))
    serving = rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).where(
        ~F.col("turn") | (F.col("d") != F.col("deal"))).withColumn("c", F.col("chunk")).withColumn(
        "turn", F.lit(False))
    taking = rows.where("turn").withColumn("d", F.col("deal")).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    second = serving.unionByName(taking).withColumn(
        "block", F.col("d").cast("long") * F.col("chunks") + F.col("c"))
    more = materialise(_compare(second, percent), "more_links")
    if more.isEmpty():
        return labels
    return connected_components(links.unionByName(more))


def _id_links(known: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between the smallest documents of the sets that stand under one id."""
    several = known.groupBy("doc_id").agg(F.min("same").alias("s"), F.max("same").alias("t")).where(
        "s < t").select(F.col("doc_id").alias("id"))
    of = known.join(several, F.col("doc_id") == F.col("id")).select("doc_id", "same").join(
        reps.select("same", "rep"), "same")
    low = of.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return of.join(low, "doc_id").where("a < rep").select("a", F.col("rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = LINK_PERCENT,
                    sub_keys: int = SUB_KEYS, hashes: int = HASHES_PER_SUB_KEY) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept, one row
    per input row.

    Null, empty and blank texts have an empty set and link with nothing; texts with fewer words
    than a shingle are one shingle. Equal sets link (all ties collapse to the smallest id).
    Rows that share a doc_id are one node of the graph. Rows without an id take no part: their
    component is null and they are kept. An empty table gives an empty result. Only ``doc_id``
    and ``text`` are read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(signatures(docs, size, sub_keys, hashes), "signatures")
    known = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    reps = materialise(known.groupBy("same").agg(
        F.min("doc_id").alias("rep"), F.first("keys").alias("keys"),
        F.first("n_shingles").alias("n_shingles")), "classes")
    groups = _candidate_groups(reps)
    labels = None if groups is None else _confirmed(
        docs.where(F.col("doc_id").isNotNull()), groups, reps.select("rep", "n_shingles"),
        size, percent)
    # several sets under one id: the id's sets are linked through the id itself
    shared = materialise(_id_links(known, reps), "id_links")
    if not shared.isEmpty():
        labels = connected_components(shared if labels is None else shared.unionAll(
            labels.select(F.col("component").alias("a"), F.col("node").alias("b"))))
    out = signed.drop("keys").join(reps.select("same", "rep"), "same", "left")
    if labels is None:
        component = F.coalesce("rep", "doc_id")
    else:
        out = out.join(labels.select(F.col("node"), F.col("component")),
                       F.col("rep") == F.col("node"), "left")
        component = F.coalesce("component", "rep", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


# All pairs that share a shingle, compared on their full sets: the links that hashing looks for.
OP1_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, w.doc_id = l.component_id AS kept
FROM words w JOIN least l ON l.a = w.doc_id LEFT JOIN sizes s ON s.doc_id = w.doc_id
"""
