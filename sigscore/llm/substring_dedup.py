"""Substring dedup by compacted paths of repeated token k-mers.

Every window of 13 words is an edge of the documents' de Bruijn graph (from its first 12 words to
its last 12). Edges that lie in two documents or more are found by a shuffle of edge hashes,
after each task has reduced its equal edges to the smallest document. Brought back to their
documents, consecutive repeated edges are walks through the graph of repeated edges; distinct walks
are compacted to its nonbranching paths (``de_bruijn``), so that a passage that many documents
share in part or whole is one path. A join takes each path to its source documents, where its
nodes, by a second, independent hash, must stand in a row at some coordinate, or else each of its
edges at one of its own; what is not found there is not removed. Words covered by confirmed edges go.

Edges travel packed: one row per task and part of the hash space, eight bytes an edge plus
run-length coded document ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import (BYTES_PER_BATCH, WordHashes, materialise, mix64, table,
                                  text_slices, tidy)
from sigscore.llm.de_bruijn import compact, steps

WINDOW = 13
EDGES_PER_TASK = 1 << 20     # a map task packs its edges whenever it holds so many
BYTES_PER_PART = 12_000_000  # text whose edges one reducer holds, about two million
BYTES_PER_BUCKET = 24_000_000  # text whose marks one task holds while its documents pass
MARKS_PER_ROW = 1 << 15      # at most, so that rows of marks stay small in Spark
CHECK_SEED = 77              # of the second, independent hash

EDGES = "part int, doc_id bigint, hashes binary, docs binary, counts binary"
MARKS = "bucket int, docs binary, hashes binary, sources binary"
_EDGES = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("hashes", pa.binary()),
                    ("docs", pa.binary()), ("counts", pa.binary())])
_MARKS = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("hashes", pa.binary()),
                    ("sources", pa.binary())])
RESULT = ("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
          "paths array<struct<start:int,length:int,source:bigint,nodes:array<bigint>>>")


_ODD = np.uint64(0xA24BAED4963EE407)


def node_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive word hashes, put together from spans of doubling length."""
    m = len(h) - n + 1
    if m < 1:
        return np.empty(0, np.uint64)
    out, done, span, size = None, 0, h, 1
    while size <= n:
        if n & size:
            part = span[done:done + m]
            out = part if out is None else mix64(out + part * _ODD)
            done += size
        if 2 * size <= n:
            span = mix64(span[:-size] + span[size:] * _ODD)
        size *= 2
    return out


def edge_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """Hash of every window: its first node and its last word."""
    nodes = node_hashes(h, window - 1)
    return mix64(nodes[:-1] + h[window - 1:] * _ODD) if len(nodes) > 1 else np.empty(0, np.uint64)


def pair_hashes(nodes: np.ndarray) -> np.ndarray:
    """Hash of every edge between consecutive nodes."""
    x = nodes.view(np.uint64)
    return mix64(x[:-1] + mix64(x[1:]) * _ODD)


def _starts(h: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate((np.ones(min(len(h), 1), bool), h[1:] != h[:-1])))


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list gives them up."""
    whole = np.concatenate(arrays)
    arrays.clear()
    return whole


def _batches(rows, schema: pa.Schema):
    """Batches of rows of packed arrays, each of about BYTES_PER_BATCH: a task never holds all of its
    rows packed."""
    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), schema.types)],
                                          schema=schema)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BYTES_PER_BATCH:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _packed_edges(ids: list[int], held: list[np.ndarray], parts: int):
    """Rows of EDGES from the edges ``held`` of the documents ``ids``; both lists are emptied. Documents
    go by their rank, in four bytes, until they are packed."""
    names, rank = np.unique(np.array(ids, np.int64), return_inverse=True)
    who = np.argsort(rank, kind="stable")
    d = np.repeat(rank[who].astype(np.int32), [len(held[i]) for i in who])
    h = np.concatenate([held[i] for i in who])
    ids.clear()
    held.clear()
    order = np.argsort(h, kind="stable")  # equal edges by document
    h, d = h[order], d[order]
    del order
    starts = _starts(h)
    source = np.repeat(d[starts], np.diff(starts, append=len(h)))
    again = np.flatnonzero(d > source)
    again = again[np.lexsort((h[again], d[again]))]
    ah, ad, source = h[again], d[again], source[again]
    h, d = h[starts], d[starts]
    del starts, again
    if len(ah):
        once = np.concatenate(([True], (ah[1:] != ah[:-1]) | (ad[1:] != ad[:-1])))
        ah, ad, source = ah[once], ad[once], source[once]
        cuts = _starts(ad)
        for lo, hi in zip(cuts, [*cuts[1:], len(ad)]):
            yield (int(ah[lo] % np.uint64(parts)), int(names[ad[lo]]), ah[lo:hi].tobytes(),
                   names[source[lo:hi]].tobytes(), None)
    del ah, ad, source
    part = (h % np.uint64(parts)).astype(np.int32)
    order = np.lexsort((d, part))
    part = part[order]
    cuts = _starts(part)
    for lo, hi in zip(cuts, [*cuts[1:], len(part)]):
        own = order[lo:hi]
        which, n = np.unique(d[own], return_counts=True)
        yield (int(part[lo]), None, h[own].tobytes(), names[which].tobytes(), n.astype(np.int32).tobytes())


def _edges(docs: DataFrame, parts: int, window: int) -> DataFrame:
    """Packed edges. Rows with null ``doc_id`` hold, for one part of the hash space, edges and
    the smallest document of the task that has each. Rows with a ``doc_id`` say that the edges
    ``hashes`` of that document are also in the task's documents ``docs``, which are smaller."""
    @tidy
    def pack(batches):
        known = WordHashes()
        ids: list[int] = []
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            who = batch.column(0).to_pylist()
            for lo, texts in text_slices(batch, "text"):
                for i, t in enumerate(texts):
                    h = edge_hashes(known.of(t.split()), window) if t else ()
                    if len(h):
                        ids.append(who[lo + i])
                        held.append(h)
                        n += len(h)
                if n >= EDGES_PER_TASK:
                    yield from _batches(_packed_edges(ids, held, parts), _EDGES)
                    n = 0
        if held:
            yield from _batches(_packed_edges(ids, held, parts), _EDGES)

    return docs.mapInArrow(pack, EDGES)


def _bucket_of(d: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each document id, the same as ``_bucket`` gives in Spark."""
    x = d.astype(np.uint64)
    return ((x ^ (x >> np.uint64(16))) % np.uint64(buckets)).astype(np.int32)


def _bucket(doc_id, buckets: int):
    mixed = doc_id.bitwiseXOR(F.shiftrightunsigned(doc_id, 16))
    # the remainder of an unsigned division, from halves that stay positive
    high, low = F.shiftrightunsigned(mixed, 32), mixed.bitwiseAND(F.lit(2**32 - 1))
    return F.pmod(F.pmod(high, F.lit(buckets)) * F.lit(2**32 % buckets) + low,
                  F.lit(buckets)).cast("int")


def _repeated(batches, buckets: int):
    """Rows of MARKS from the rows of EDGES of some parts of the hash space."""
    h, d = [], []                # edges to judge
    mh, md, ms = [], [], []      # marks: edge, document, source
    for batch in batches:
        for who, x, docs, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
            x, docs = np.frombuffer(x, np.uint64), np.frombuffer(docs, np.int64)
            if who is None:
                h.append(x)
                d.append(np.repeat(docs, np.frombuffer(n, np.int32)))
            else:
                mh.append(x)
                md.append(np.full(len(x), who, np.int64))
                ms.append(docs)
    batch = x = docs = n = None
    if h:
        h, d = _joined(h), _joined(d)
        order = np.argsort(h)
        h = h[order]
        d = d[order]
        del order
        counts = np.diff(_starts(h), append=len(h))
        several = np.repeat(counts > 1, counts)
        h = h[several]               # most edges are in one document alone
        d = d[several]
        del counts, several
        if len(h):
            starts = _starts(h)
            source = np.repeat(np.minimum.reduceat(d, starts), np.diff(starts, append=len(h)))
            again = d > source
            mh.append(h[again])
            md.append(d[again])
            ms.append(source[again])
            del starts, source, again
        h = d = None
    if not mh:
        return
    h, d, source = _joined(mh), _joined(md), _joined(ms)
    bucket = _bucket_of(d, buckets)
    order = np.lexsort((d, bucket))
    bucket = bucket[order]
    cuts = _starts(bucket)
    for lo, hi in zip(cuts, [*cuts[1:], len(bucket)]):
        for at in range(lo, hi, MARKS_PER_ROW):
            own = order[at:min(hi, at + MARKS_PER_ROW)]
            yield int(bucket[lo]), d[own].tobytes(), h[own].tobytes(), source[own].tobytes()


def _marks(edges: DataFrame, parts: int, buckets: int) -> DataFrame:
    """Repeated edges of documents that are not their first, each with a smaller document that
    has it, packed in rows per part and bucket of documents."""
    @tidy
    def find(batches):
        yield from _batches(_repeated(batches, buckets), _MARKS)

    # one part may share a partition with others; a hash is in one part, so in one partition
    return edges.repartition(parts, "part").mapInArrow(find, MARKS)


def _paths_of(sources: np.ndarray, marked: np.ndarray):
    """(start, length, source) of maximal runs of marked edges with one source."""
    at = np.flatnonzero(marked)
    if not len(at):
        return
    cuts = np.flatnonzero((np.diff(at) != 1) | (sources[at][1:] != sources[at][:-1])) + 1
    for run in np.split(at, cuts):
        yield int(run[0]), len(run), int(sources[run[0]])


class _BucketMarks:
    """The marks of one bucket's documents, found by document."""

    def __init__(self):
        self.packed, self.sorted = ([], [], []), None

    def add(self, docs: bytes, hashes: bytes, sources: bytes) -> None:
        for held, x, kind in zip(self.packed, (docs, hashes, sources), (np.int64, np.uint64, np.int64)):
            held.append(np.frombuffer(x, kind))

    def of(self, doc_id: int):
        """(hashes, sources) of a document, sorted by hash and source."""
        if self.sorted is None:
            self.sorted = [_joined(x) for x in self.packed] if self.packed[0] else [
                np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)]
            order = np.lexsort(self.sorted[::-1])
            for i in range(3):
                self.sorted[i] = self.sorted[i][order]
        d, h, s = self.sorted
        lo, hi = np.searchsorted(d, [doc_id, doc_id + 1])
        return h[lo:hi], s[lo:hi]


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """Strings marks together to walks, cuts the covered words and digests the rest. Rows come sorted by
    bucket with the bucket's marks (kind 0) before its documents (kind 1), which pass one by one.
    ``refused``: packed second hashes of edges whose windows must stay."""
    @tidy
    def cut(batches):
        known, checks = WordHashes(), WordHashes(CHECK_SEED)
        marks, current = _BucketMarks(), None
        for batch in batches:
            for lo, texts in text_slices(batch, "text"):
                part = batch.slice(lo, len(texts))
                cols = zip(*(part[c].to_pylist() for c in (
                    "bucket", "kind", "doc_id", "docs", "hashes", "sources", "refused")))
                out = []
                for t, (bucket, kind, doc_id, docs, hashes, sources, refused) in zip(texts, cols):
                    if bucket != current:
                        marks, current = _BucketMarks(), bucket
                    if kind == 0:
                        marks.add(docs, hashes, sources)
                        continue
                    ws = t.split() if t else []
                    gone, paths = np.zeros(len(ws), bool), []
                    mh, ms = marks.of(doc_id) if doc_id is not None else ((), ())
                    if len(mh):
                        h = edge_hashes(known.of(ws), window)
                        c = node_hashes(checks.of(ws), window - 1).view(np.int64)
                        place = np.minimum(np.searchsorted(mh, h), len(mh) - 1)
                        marked = mh[place] == h
                        if refused is not None:
                            marked &= ~np.isin(pair_hashes(c), np.frombuffer(refused, np.uint64))
                        for start, n, source in _paths_of(ms[place], marked):
                            gone[start:start + n + window - 1] = True
                            paths.append({"start": start, "length": n, "source": source,
                                          "nodes": c[start:start + n + 1]})
                    kept = b" ".join([w for w, g in zip(ws, gone.tolist()) if not g]
                                     if paths else ws)
                    out.append((doc_id, len(ws), int(gone.sum()),
                                hashlib.sha256(kept).hexdigest(), paths))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (
                            pa.int64(), pa.int64(), pa.int64(), pa.string(), _PATHS))],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256", "paths"])

    return rows.mapInArrow(cut, RESULT)


_PATHS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()),
                             ("source", pa.int64()), ("nodes", pa.list_(pa.int64()))]))


def _spans(paths: DataFrame) -> DataFrame:
    """(source, path, pieces): the compacted paths of all documents' walks, brought together per
    source. A source's pieces of a path are no more than its own text."""
    walks = paths.select(F.col("path.source").alias("source"), F.col("path.nodes").alias("nodes")).groupBy(
        "nodes").agg(F.min("source").alias("source"))
    walks = materialise(walks.select(F.monotonically_increasing_id().alias("walk"), "source", "nodes"), "walks")
    return compact(walks).groupBy("source", "path").agg(
        F.sort_array(F.collect_list(F.struct("place", "nodes"))).alias("pieces"))


def stretches(places: list[int], pieces: list[np.ndarray]):
    """Node sequences of pieces that follow each other, joined at their common node."""
    held = []
    for i, nodes in enumerate(pieces):
        if held and places[i] != places[i - 1] + 1:
            yield np.concatenate(held)
            held = []
        held.append(nodes[1:] if held else nodes)
    if held:
        yield np.concatenate(held)


class _Coordinates:
    """Places of a source text's nodes."""

    def __init__(self, text: bytes | None, checks: WordHashes, window: int):
        self.nodes = node_hashes(checks.of((text or b"").split()), window - 1).view(np.int64)
        self.order = np.argsort(self.nodes, kind="stable")
        self.ranked = self.nodes[self.order]
        self.pairs = None

    def missing(self, run: np.ndarray) -> np.ndarray:
        """Places in ``run`` of the edges that the text does not have: none if all of it stands in
        a row somewhere; else each edge is looked up by itself."""
        lo, hi = np.searchsorted(self.ranked, run[0], "left"), np.searchsorted(self.ranked, run[0], "right")
        for at in self.order[lo:min(hi, lo + 8)]:  # more places are left to the look-up by edges
            if np.array_equal(self.nodes[at:at + len(run)], run):
                return np.empty(0, np.int64)
        if self.pairs is None:
            self.pairs = np.unique(pair_hashes(self.nodes))
        return np.flatnonzero(~np.isin(pair_hashes(run), self.pairs))


def _refused(docs: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """(u, v): edges of ``spans``, by their end nodes, that no row of their source has: none, but
    for collisions of the first hash."""
    rows = spans.withColumnRenamed("source", "of").join(docs, F.col("of") == F.col("doc_id")).select(
        "of", "path", "pieces", "text")

    @tidy
    def verify(batches):
        checks = WordHashes(CHECK_SEED)
        last, own = None, None
        for batch in batches:
            for lo, texts in text_slices(batch, "text"):
                part = batch.slice(lo, len(texts))
                out = []
                for s, path, pieces, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                              part.column(2), texts):
                    if last != (s, t):
                        last, own = (s, t), _Coordinates(t, checks, window)
                    found = pieces.values
                    for run in stretches(found.field("place").to_pylist(),
                                         [x.values.to_numpy() for x in found.field("nodes")]):
                        out += [(s, path, int(run[i]), int(run[i + 1])) for i in own.missing(run)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["source", "path", "u", "v"])

    missing = materialise(rows.mapInArrow(verify, "source bigint, path bigint, u bigint, v bigint"), "missing")
    if missing.isEmpty():
        return missing.select("u", "v")
    # a source id may have several rows; an edge is refused if it is missing in each of them
    sources = docs.join(missing.select("source").distinct(), F.col("doc_id") == F.col("source")).groupBy(
        "source").agg(F.count("*").alias("rows"))
    each = missing.groupBy("source", "path", "u", "v").agg(F.count("*").alias("n"))
    return each.join(sources, "source").where("n >= rows").select("u", "v").distinct()


def _refused_by_document(paths: DataFrame, refused: DataFrame) -> DataFrame:
    """(r, refused): documents whose walks pass refused edges, with those edges' packed hashes."""
    passed = steps(paths.select(F.col("doc_id").alias("walk"), F.col("path.nodes").alias("nodes")))
    met = passed.join(refused, (F.col("node") == F.col("u")) & (F.col("after") == F.col("v"))).select(
        "walk", "u", "v").distinct().groupBy("walk").agg(F.collect_list(F.struct("u", "v")).alias("pairs"))

    @F.udf("binary")
    def packed(pairs):
        return b"".join(pair_hashes(np.array([p["u"], p["v"]], np.int64)).tobytes() for p in pairs)

    return met.select(F.col("walk").alias("r"), packed("pairs").alias("refused"))


def _with_marks(docs: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """Documents (doc_id, text, refused) and marks, brought together by bucket. Documents
    without an id, which have no marks, are spread over the buckets."""
    spread = F.coalesce("doc_id", F.xxhash64("text"))
    nothing = F.lit(None).cast("binary")
    rows = docs.select(_bucket(spread, buckets).alias("bucket"), F.lit(1).alias("kind"), "doc_id",
                       "text", "refused", nothing.alias("docs"), nothing.alias("hashes"),
                       nothing.alias("sources"))
    packed = marks.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                          F.lit(None).cast("string").alias("text"), nothing.alias("refused"), "docs",
                          "hashes", "sources")
    return packed.unionByName(rows).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "kind")


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the paths that were cut, one row per input
    row.

    Null, empty and blank texts have no words: nothing is removed and the digest is that of no
    text. A text shorter than a window keeps all its words. Repeats inside one document, and
    between rows that share a doc_id, are no repeats. Rows without an id neither lose words nor
    make others lose any. An empty table gives an empty result. Only ``doc_id`` and ``text`` are
    read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // BYTES_PER_PART))
    edges = _edges(docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), parts, window)
    buckets = max(8, -(-size // BYTES_PER_BUCKET))
    marks = materialise(_marks(edges, parts, buckets), "marks")
    plain = docs.withColumn("refused", F.lit(None).cast("binary"))
    cut = materialise(_cut(_with_marks(plain, marks, buckets), window), "cut")
    paths = cut.select("doc_id", F.explode("paths").alias("path"))
    refused = materialise(_refused(docs.where(F.col("doc_id").isNotNull()), _spans(paths), window), "refused")
    if refused.isEmpty():
        return cut
    # documents with a refused window are cut again without it
    by_doc = materialise(_refused_by_document(paths, refused), "refused_docs")
    again = docs.join(by_doc, F.col("doc_id") == F.col("r")).select("doc_id", "text", "refused")
    rest = cut.join(by_doc, F.col("doc_id") == F.col("r"), "left_anti")
    return rest.unionByName(_cut(_with_marks(again, marks, buckets), window))


def remove_repeats(docs: DataFrame, window: int = WINDOW, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the repeated passages cut from ``text``: its kept words, joined by one space
    where words were removed, and the text as it was where none were. Every other column stays;
    every row stays, with an empty text if all its words were repeats, unless ``drop_emptied``
    says that such rows go. Rows that share an id are cut alike only where their words are:
    spans are looked up by id and number of words, and the digest must agree."""
    cut = find_repeats(docs, window).where(F.col("n_removed") > 0).select(
        F.col("doc_id").alias("c"), F.col("n_words").alias("n"), "kept_sha256",
        F.transform("paths", lambda p: F.struct(p["start"].alias("start"),
                                                p["length"].alias("length"))).alias("spans"))
    row = docs.select(F.struct("*").alias("row"))
    joined = row.join(cut.dropDuplicates(["c", "n", "kept_sha256"]),
                      F.col("row.doc_id") == F.col("c"), "left")

    @F.udf("string")
    def kept(text, spans, n, digest):
        ws = (text or "").encode().split()
        if spans is None or len(ws) != n:
            return None
        gone = np.zeros(n, bool)
        for s in spans:
            gone[s["start"]:s["start"] + s["length"] + window - 1] = True
        left = b" ".join(w for w, g in zip(ws, gone) if not g)
        return left.decode() if hashlib.sha256(left).hexdigest() == digest else None

    joined = joined.withColumn("cut", F.when(F.col("c").isNotNull(), kept(
        "row.text", "spans", "n", "kept_sha256")))
    if drop_emptied:
        joined = joined.where(F.col("cut").isNull() | (F.col("cut") != ""))
    text = F.coalesce("cut", "row.text")
    return joined.select(*[(text if f == "text" else F.col("row").getField(f)).alias(f)
                           for f in docs.columns])


def op5(spark, sf_dir):
    return find_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


OP5_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS k FROM starts),
first AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT x.doc_id, x.p FROM windows x JOIN first f ON x.k = f.k AND x.doc_id > f.d),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM hit),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT e.doc_id, string_agg(e.x, ' ' ORDER BY e.i) AS t, count(*) AS n
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i
  WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
       CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
