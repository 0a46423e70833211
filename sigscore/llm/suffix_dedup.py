"""Exact substring dedup by blockwise suffix sorting with a difference-cover sample.

Suffixes are told apart by their first ``length`` bytes. A difference cover is a set of residues whose
differences meet every residue: whatever the distance of two suffixes, both reach a position of the
cover at the same offset, less than a period away. So a sample of some 6 in 100 positions is ranked
first, by two windows:

* the short one lies in every ``length``-byte string that reaches it, so a suffix without a repeated
  short window ahead stands alone and is never sorted;
* the long one holds the ``length``-byte strings of a whole period, so where it is repeated, the long
  ties of those suffixes are resolved by the sample alone.

The suffixes left open are sorted one bucket at a time: a round for each bucket of suffix keys, in
which Spark partitions hold its parts, so that memory and disk hold one bucket of them. Those that the
sample has resolved are sorted along, as partners, but get no answer.

Windows are compared by fingerprints: 64 bits where an error only costs work (short windows), 96 where
it counts. Texts that are equal as a whole are one text with a count.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, mix64, table

LENGTH = 400
COVER_SHARE = 0.77           # the period's largest share of the length
HELD_PER_TASK = 1 << 20      # fingerprints that a task holds before it packs them
CHUNK = 1 << 20              # positions of a text that are looked at at a time
BYTES_PER_PART = 12_000_000  # text whose sample one task ranks
BYTES_PER_BUCKET = 24_000_000  # text whose answers one task holds while its texts pass
SUFFIXES_PER_PART = 1_000_000  # that one task sorts
BUCKET_SHARE = 0.08          # suffixes in a bucket of the sort, as a share of all bytes
SHORT, LONG, SUFFIX, SETTLED = 0, 1, 2, 3
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

PACKED = "level int, part int, bucket int, hashes binary, more binary, keys binary, counts binary"
ANSWERS = "level int, bucket int, hashes binary, keys binary, counts binary"
SEGMENTS = "key bigint, start bigint, n int, body binary, settled binary"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


@functools.lru_cache(8)
def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(period, residues) of a cover for strings of ``length`` bytes: a perfect difference set of
    q + 1 residues modulo q * q + q + 1 for the largest fitting prime q, from the powers of an
    element of the field with q ** 3 elements that lie in a plane; all positions where none fits."""
    for q in range(int(length ** 0.5) + 1, 1, -1):
        v = q * q + q + 1
        if v > COVER_SHARE * length or any(q % k == 0 for k in range(2, q)):
            continue
        for a, b, c in ((a, b, c) for c in range(1, q) for b in range(q) for a in range(q)):
            x, plane = (1, 0, 0), []   # coefficients of 1, t, t * t; t ** 3 = c + b t + a t * t
            for i in range(v):
                if x[2] == 0:
                    plane.append(i)
                x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
            if len(plane) == q + 1 and len({(i - j) % v for i in plane for j in plane}) == v:
                return v, tuple(plane)
    return 1, (0,)


class Prints:
    """Fingerprints of windows of one piece of text, by prefix sums of powers modulo 2 ** 64."""

    _table = np.random.default_rng(20).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
    _base = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
    _powers: dict[int, tuple] = {}

    @classmethod
    def powers(cls, which: int, n: int):
        if which not in cls._powers or len(cls._powers[which][0]) < n:
            each = np.full((2, max(n, 1 << 16)), cls._base[which], np.uint64)
            each[1] = pow(cls._base[which], -1, 1 << 64)
            each[:, 0] = 1
            cls._powers[which] = tuple(np.cumprod(each, axis=1, dtype=np.uint64))
        return cls._powers[which]

    def __init__(self, body: np.ndarray):
        self.body, self.sums = body, {}

    def of(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Fingerprints of the windows of ``length`` bytes that start ``at``."""
        up, down = self.powers(which, len(self.body) + 1)
        if which not in self.sums:
            total = np.zeros(len(self.body) + 1, np.uint64)
            np.cumsum(self._table[which][self.body] * up[:len(self.body)], out=total[1:])
            self.sums[which] = total
        s = self.sums[which]
        return mix64((s[at + length] - s[at]) * down[at] + np.uint64(length))


def _chunks(n: int, most: int):
    """(first, last + 1) of ranges of start positions."""
    return [(lo, min(n, lo + most)) for lo in range(0, n, most)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)


def _by_key(keys: np.ndarray, hashes: np.ndarray, group: np.ndarray):
    """(group, packed hashes, keys, counts) for each group, its hashes in the order of keys."""
    order = np.lexsort((hashes, keys, group))
    keys, hashes, group = keys[order], hashes[order], group[order]
    cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(group)]) if len(group) else ():
        first = np.flatnonzero(np.concatenate(([True], keys[lo + 1:hi] != keys[lo:hi - 1])))
        n = np.diff(np.append(first, hi - lo)).astype(np.int32)
        yield int(group[lo]), order[lo:hi], hashes[lo:hi].tobytes(), keys[lo:hi][first].tobytes(), n.tobytes()


def _opened(hashes, keys, counts):
    return np.frombuffer(hashes, np.uint64), np.repeat(np.frombuffer(keys, np.int64),
                                                       np.frombuffer(counts, np.int32))


class _Asker:
    """Fingerprints that a task asks about. Those that it meets twice itself are answered here and
    asked once, so that however common a string is, each task sends it on once."""

    def __init__(self, parts: int, buckets: int):
        self.parts, self.buckets = parts, buckets
        self.held: dict[int, list] = {}
        self.n = 0

    def add(self, level: int, key: int, hashes: np.ndarray, more: np.ndarray | None, wanted) -> None:
        """``more``: the second fingerprints; ``wanted``: which of them want an answer."""
        if len(hashes):
            self.held.setdefault(level, []).append((
                hashes, more if more is not None else np.zeros(len(hashes), np.uint32),
                np.full(len(hashes), key, np.int64), np.broadcast_to(wanted, len(hashes))))
            self.n += len(hashes)

    def flush(self):
        rows = []
        for level, held in self.held.items():
            h, m, k, w = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((~w, m, h))   # wanted ones first
            h, m, k, w = h[order], m[order], k[order], w[order]
            first = np.concatenate(([True], (h[1:] != h[:-1]) | (m[1:] != m[:-1])))
            group = np.cumsum(first) - 1
            several = np.bincount(group)[group] > 1
            told = several & w
            for bucket, _, x, who, n in _by_key(k[told], h[told], k[told] % self.buckets):
                rows.append((level, bucket % self.parts, bucket, x, None, who, n))
            alone = first & w & ~several
            for ask, answer in ((alone, True), (first & ~alone, False)):
                key, second = k[ask] if answer else np.zeros(ask.sum(), np.int64), m[ask]
                part = (h[ask] % np.uint64(self.parts)).astype(np.int64)
                for p, at, x, who, n in _by_key(key, h[ask], part):
                    rows.append((level, p, None, x, second[at].tobytes() if level != SHORT else None,
                                 who if answer else None, n if answer else None))
        self.held, self.n = {}, 0
        return [_batch(rows, PACKED)] if rows else []


def _answered(asks: DataFrame, parts: int, buckets: int) -> DataFrame:
    """The answers: fingerprints of texts that occur elsewhere, packed by bucket of texts. Each
    partition sorts its part of the fingerprints."""
    def sort(batches):
        asked: dict[int, list] = {}
        for batch in batches:
            out = []
            for level, bucket, hashes, more, keys, counts in zip(*(
                    batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6))):
                if bucket is not None:
                    out.append((level, bucket, hashes, keys, counts))
                    continue
                h = np.frombuffer(hashes, np.uint64)
                m = np.frombuffer(more, np.uint32) if more is not None else np.zeros(len(h), np.uint32)
                k = _opened(hashes, keys, counts)[1] if keys is not None else np.zeros(len(h), np.int64)
                asked.setdefault(level, []).append((h, m, k, np.full(len(h), keys is not None)))
            if out:
                yield _batch(out, ANSWERS)
        for level, held in asked.items():
            h, m, k, w = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((m, h))
            h, m, k, w = h[order], m[order], k[order], w[order]
            same = (h[1:] == h[:-1]) & (m[1:] == m[:-1])
            tied = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            tied &= w
            rows = [(level, b, x, who, n) for b, _, x, who, n in _by_key(k[tied], h[tied], k[tied] % buckets)]
            if rows:
                yield _batch(rows, ANSWERS)

    return asks.repartitionById(parts, "part").mapInArrow(sort, ANSWERS)


def _sample(texts: DataFrame, length: int, parts: int, buckets: int) -> DataFrame:
    """Packed fingerprints of the short and long windows at the cover's positions."""
    period, cover = difference_cover(length)
    short, long = length - period + 1, length + period - 1
    residues = np.array(cover)

    def ask(batches):
        asker = _Asker(parts, buckets)
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                body = np.frombuffer(text.as_py(), np.uint8)
                for lo, hi in _chunks(len(body) - short + 1, CHUNK):
                    at = (np.arange(lo // period, hi // period + 1)[:, None] * period + residues).ravel()
                    at = at[(at >= lo) & (at < hi)] - lo
                    prints = Prints(body[lo:hi + long - 1])
                    asker.add(SHORT, key, prints.of(at, short), None, True)
                    at = at[at + long <= len(prints.body)]
                    asker.add(LONG, key, prints.of(at, long), (prints.of(at, long, 1) >> np.uint64(32)
                                                               ).astype(np.uint32), True)
                    if asker.n >= HELD_PER_TASK:
                        yield from asker.flush()
        yield from asker.flush()

    return texts.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(ask, PACKED)


class _Answers:
    """The answers of one bucket of texts, found by text and level."""

    def __init__(self):
        self.held, self.sorted = {}, {}

    def add(self, level, hashes, keys, counts):
        self.held.setdefault(level, []).append(
            _opened(hashes, keys, counts) if level != SETTLED else (np.frombuffer(hashes, np.uint64),
                                                                    np.frombuffer(keys, np.int64)))

    def of(self, level: int, key: int) -> np.ndarray:
        if level not in self.sorted:
            h, k = (np.concatenate(x) for x in zip(*self.held.pop(level, [(np.empty(0, np.uint64),
                                                                            np.empty(0, np.int64))])))
            order = np.lexsort((h, k))
            self.sorted[level] = h[order], k[order]
        h, k = self.sorted[level]
        lo, hi = np.searchsorted(k, key, "left"), np.searchsorted(k, key, "right")
        return h[lo:hi]


def _among(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of ``h`` are among ``found``, which is sorted."""
    if not len(found):
        return np.zeros(len(h), bool)
    return found[np.minimum(np.searchsorted(found, h), len(found) - 1)] == h


def _with_answers(texts: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """Answers and texts brought together by bucket, a bucket's answers before its texts."""
    rows = texts.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), F.lit(9).alias("level"),
                        "key", F.col("text").cast("binary").alias("text"), "copies", "digest",
                        *(F.lit(None).cast("binary").alias(c) for c in ("hashes", "keys", "counts")))
    packed = answers.select("bucket", "level", F.lit(None).cast("long").alias("key"),
                            F.lit(None).cast("binary").alias("text"), F.lit(None).cast("long").alias("copies"),
                            F.lit(None).cast("string").alias("digest"), "hashes", "keys", "counts")
    return packed.unionByName(rows).repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "level")


def _each(batches):
    """(key, text, copies, digest, answers of its bucket) of the texts in rows of _with_answers."""
    current, answers = None, None
    for batch in batches:
        small = [batch.column(c).to_pylist() for c in ("bucket", "level", "key", "copies", "digest", "hashes",
                                                       "keys", "counts")]
        text = batch.column("text")
        for i, (bucket, level, key, copies, digest, hashes, keys, counts) in enumerate(zip(*small)):
            if bucket != current:
                current, answers = bucket, _Answers()
            if level == 9:
                yield key, text[i].as_py(), copies, digest, answers
            else:
                answers.add(level, hashes, keys, counts)


def _segments(rows: DataFrame, length: int) -> DataFrame:
    """The runs of open suffixes: key, start, number of suffixes, the bytes that they and their
    windows cover, and which of them the sample has resolved (packed runs)."""
    period, cover = difference_cover(length)
    short, long = length - period + 1, length + period - 1
    residues = np.array(cover)

    def find(batches):
        out, size = [], 0
        for key, text, copies, _, answers in _each(batches):
            shorts, longs = answers.of(SHORT, key), answers.of(LONG, key)
            if not len(shorts):
                continue
            body = np.frombuffer(text, np.uint8)
            n = len(body) - length + 1
            opened, settled = (np.zeros(n + 1, np.int32) for _ in range(2))
            for lo, hi in _chunks(len(body) - short + 1, CHUNK):
                at = (np.arange(lo // period, hi // period + 1)[:, None] * period + residues).ravel()
                at = at[(at >= lo) & (at < hi)] - lo
                prints = Prints(body[lo:hi + long - 1])
                a = at[_among(shorts, prints.of(at, short))] + lo
                np.add.at(opened, np.clip(a - period + 1, 0, n), 1)
                np.add.at(opened, np.clip(a + 1, 0, n), -1)
                at = at[at + long <= len(prints.body)]
                a = at[_among(longs, prints.of(at, long))] + lo
                np.add.at(settled, np.clip(a, 0, n), 1)
                np.add.at(settled, np.clip(a + period, 0, n), -1)
            opened = np.cumsum(opened[:n]) > 0
            settled = np.cumsum(settled[:n]) > 0 if copies < 2 else np.ones(n, bool)
            for lo, hi in _runs(opened):
                for a, b in _chunks(int(hi - lo), CHUNK):
                    a, b = int(lo) + a, int(lo) + b
                    out.append((key, a, b - a, text[a:b + length - 1],
                                _runs(settled[a:b]).astype(np.int32).tobytes()))
                    size += b - a + length
            if size >= 8 * CHUNK:
                yield _batch(out, SEGMENTS)
                out, size = [], 0
        if out:
            yield _batch(out, SEGMENTS)

    return rows.mapInArrow(find, SEGMENTS)


def _flags(runs: bytes, n: int) -> np.ndarray:
    flags = np.zeros(n, bool)
    for a, b in np.frombuffer(runs, np.int32).reshape(-1, 2):
        flags[a:b] = True
    return flags


def _bucket_of_suffixes(segments: DataFrame, k: int, rounds: int, length: int, parts: int,
                        buckets: int) -> DataFrame:
    """Packed keys of the open suffixes in bucket ``k`` of the sort."""
    def ask(batches):
        asker = _Asker(parts, buckets)
        for batch in batches:
            for key, n, body, settled in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "n", "body", "settled"))):
                prints = Prints(np.frombuffer(body, np.uint8))
                h = prints.of(np.arange(n), length)
                at = np.flatnonzero((h >> np.uint64(40)) % np.uint64(rounds) == k)
                asker.add(SUFFIX, key, h[at], (prints.of(at, length, 1) >> np.uint64(32)).astype(np.uint32),
                          ~_flags(settled, n)[at])
                if asker.n >= HELD_PER_TASK:
                    yield from asker.flush()
        yield from asker.flush()

    return segments.mapInArrow(ask, PACKED)


def _settled_runs(segments: DataFrame, buckets: int) -> DataFrame:
    """The runs that the sample resolved, as answers: start << 24 | length for each run."""
    def pack(batches):
        for batch in batches:
            rows = []
            for key, start, settled in zip(*(batch.column(c).to_pylist() for c in ("key", "start", "settled"))):
                runs = np.frombuffer(settled, np.int32).reshape(-1, 2).astype(np.uint64)
                if len(runs):
                    packed = (runs[:, 0] + np.uint64(start)) << np.uint64(24) | (runs[:, 1] - runs[:, 0])
                    rows.append((SETTLED, key % buckets, packed.tobytes(),
                                 np.full(len(runs), key, np.int64).tobytes(), None))
            if rows:
                yield _batch(rows, ANSWERS)

    return segments.mapInArrow(pack, ANSWERS)


CUT = "digest string, n_removed bigint, n_spans bigint, kept_sha256 string, spans binary"


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Of the texts with something to remove: how much, the spans and the rest's digest."""
    def cut(batches):
        for key, text, copies, digest, answers in _each(batches):
            hashes, runs = answers.of(SUFFIX, key), answers.of(SETTLED, key)
            if copies > 1 or not len(hashes) and not len(runs):
                continue
            body = np.frombuffer(text, np.uint8)
            n = len(body) - length + 1
            starts = np.zeros(n, bool)
            for r in runs.tolist():
                starts[r >> 24:(r >> 24) + (r & 0xFFFFFF)] = True
            if len(hashes):
                for lo, hi in _chunks(n, CHUNK):
                    starts[lo:hi] |= _among(hashes, Prints(body[lo:hi + length - 1]).of(np.arange(hi - lo), length))
            gone = np.zeros(len(body) + 1, np.int32)
            for a, b in _runs(starts):
                gone[a] += 1
                gone[b + length - 1] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            spans = _runs(gone)
            yield _batch([(digest, int(gone.sum()), len(spans), hashlib.sha256(body[~gone].tobytes()).hexdigest(),
                           spans.astype(np.int64).tobytes())], CUT)

    return rows.mapInArrow(cut, CUT)


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``spans`` (the removed runs: packed pairs
    of 64-bit start and end; null where nothing or everything goes), one row per input row.

    Null and empty texts have no bytes, and texts shorter than ``length`` lose none. Rows without an
    id, or with one id, are documents of their own; of two equal texts of ``length`` bytes or more both
    go whole. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.md5("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = max(8, -(-size // BYTES_PER_PART)), max(8, -(-size // BYTES_PER_BUCKET))
    texts = materialise(docs.where(F.octet_length("text") >= length).groupBy(digest.alias("digest")).agg(
        F.first("text").alias("text"), F.count("*").alias("copies")).withColumn("key", F.xxhash64("text")),
        "suffix_texts")
    answers = materialise(_answered(_sample(texts, length, parts, buckets), parts, buckets), "suffix_sample")
    segments = materialise(_segments(_with_answers(texts, answers, buckets), length), "suffix_open")

    n = segments.agg(F.sum("n")).first()[0] or 0
    rounds = int(max(1, -(-n // max(1, int(BUCKET_SHARE * size)))))
    per_round = max(8, -(-n // rounds // SUFFIXES_PER_PART))
    found = _settled_runs(segments, buckets)
    for k in range(rounds if n else 0):
        suffixes = _bucket_of_suffixes(segments, k, rounds, length, per_round, buckets)
        found = found.unionByName(materialise(_answered(suffixes, per_round, buckets), "suffix_bucket"))
    cut = materialise(_cut(_with_answers(texts, found, buckets), length), "suffix_cut")

    whole = texts.where("copies > 1").select(
        "digest", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(EMPTY_SHA).alias("kept_sha256"), F.lit(None).cast("binary").alias("spans"))
    gone = cut.unionByName(whole).withColumnRenamed("kept_sha256", "left_sha256")
    rows = docs.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("own_sha256"))
    zero = F.lit(0).cast("long")
    return rows.join(gone, "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("left_sha256", "own_sha256").alias("kept_sha256"), "spans")


def op12(spark, sf_dir):
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("spans")
