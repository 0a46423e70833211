"""Phrase collocations, counted in HAT-tries whose subtrees spill as sorted runs.

A task counts phrases in a trie over word ids: shallow nodes, under them hash containers that burst
into a node of containers when they grow. When a trie is full, whole subtrees go out as sorted runs,
each to the partition of its prefix, where the runs of all tasks are merged in order.

Phrases are counted by length: words first, then pairs of frequent words, then longer phrases whose
pairs are all frequent. What is frequent is told by a Bloom filter of bounded size, which may
let too much through, never too little; counts are exact, whatever it lets through.
"""

from __future__ import annotations

import gc
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, mix64, table, text_slices

LEAST, LONGEST = 30, 4       # occurrences of a candidate, words
TOP = 2000                   # of each language
SCALE = 2_000_000            # of the score
COVERED = 80                 # percent of a phrase's occurrences inside a longer one that drop it
BURST = 2048                 # entries of a container before it becomes a node of containers
ENTRIES = 1_000_000          # of a task's trie before subtrees spill
KNOWN = 600_000              # words of a task that have ids at a time
TOKENS = 1 << 20             # that are counted at a time
SLICE = 1 << 22              # bytes of a text whose words are held at a time
FANS = 64                    # partitions that the subtree of one first word is dealt over
BYTES_PER_PART = 8_000_000   # of text per merging partition
FILTER_LEAST, FILTER_MOST = 1 << 16, 1 << 27  # bits; 16 MB at most
FILTER_HASHES = 4

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r",
                        b"abcdefghijklmnopqrstuvwxyz.........")
_BETWEEN = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
RUNS = "part int, lang string, run binary, counts binary"
COUNTS = "lang string, phrase string, words int, f bigint"


def _spaced(text: bytes) -> bytes:
    """A text in lower case (A-Z only), with b" . " between its pieces."""
    return text.translate(_FOLD).replace(b".", b" . ")


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in lower case (A-Z only), with b"." between its pieces."""
    return _spaced(text).split()


class HatTrie:
    """Counts of phrases of word ids, held by the first id; the other ids are one integer for pairs
    and a tuple for longer phrases."""

    def __init__(self):
        self.root: dict[int, tuple] = {}  # first id -> (is a node, its dict)
        self.entries = 0

    def add(self, first: int, rests: list, counts: list) -> None:
        """Adds the counts of phrases that share their first word; ``rests`` are the other ids."""
        node, kept = self.root.get(first) or (False, {})
        before = len(kept) if not node else 0
        if not node:
            get = kept.get
            for r, n in zip(rests, counts):
                kept[r] = get(r, 0) + n
            self.entries += len(kept) - before
            if len(kept) > BURST and type(rests[0]) is tuple:
                node, kept = True, self._burst(kept)
            self.root[first] = (node, kept)
            return
        for r, n in zip(rests, counts):
            child = kept.setdefault(r[0], {})
            self.entries += r[1:] not in child
            child[r[1:]] = child.get(r[1:], 0) + n

    @staticmethod
    def _burst(container: dict) -> dict:
        """A node of containers by the next id."""
        out: dict[int, dict] = {}
        for r, n in container.items():
            out.setdefault(r[0], {})[r[1:]] = n
        return out

    def take(self, share: float = 1.0) -> list[tuple]:
        """Takes whole subtrees out, the largest first, until ``share`` of the entries are gone."""
        def size(item):
            node, kept = item[1]
            return sum(map(len, kept.values())) if node else len(kept)

        gone, wanted, taken = 0, self.entries * share, []
        for first, (node, kept) in sorted(self.root.items(), key=size, reverse=True):
            if gone >= wanted:
                break
            taken.append((first, node, kept))
            gone += size((first, (node, kept)))
            del self.root[first]
        self.entries -= gone
        return taken

    @staticmethod
    def phrases(taken) -> tuple[dict, dict]:
        """By number of words, the phrases of subtrees (arrays of ids) and their counts."""
        firsts, sizes, seconds, pair_counts = [], [], [], []
        longer: dict[int, tuple] = {}
        for first, node, kept in taken:
            if not node and type(next(iter(kept), None)) is int:
                firsts.append(first)
                sizes.append(len(kept))
                seconds += kept
                pair_counts += kept.values()
                continue
            for begin, container in ([((first, second), c) for second, c in kept.items()] if node
                                     else [((first,), kept)]):
                for rest, n in container.items():
                    ids, counts = longer.setdefault(len(begin) + len(rest), ([], []))
                    ids.append(begin + rest)
                    counts.append(n)
        ids = {n: np.array(p, np.int64) for n, (p, _) in longer.items()}
        counts = {n: c for n, (_, c) in longer.items()}
        if seconds:
            ids[2] = np.stack([np.repeat(np.array(firsts, np.int64), sizes), np.array(seconds, np.int64)], axis=1)
            counts[2] = pair_counts
        return ids, counts


class _Ids(dict):
    """Ids of words, given in the order in which they are met."""

    def __init__(self, words: list[bytes]):
        super().__init__({b".": 0})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self.words)
        self.words.append(word)
        return i


class _Language:
    """What a task holds of one language: words and their ids, tokens to count, the trie."""

    def __init__(self, lang: str, words_ok):
        self.lang, self.words_ok = lang, words_ok
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        self.held: list[np.ndarray] = []
        self.fresh = 0   # held tokens before this one have been counted
        self.trie = HatTrie()
        self.clear()

    def clear(self) -> None:
        self.words: list[bytes] = [b""]
        self.ids = _Ids(self.words)
        self.hashes = np.zeros(1, np.uint64)
        self.ok = np.zeros(1, bool)
        self.single = np.zeros(1, np.int64)

    def hold(self, text: bytes) -> int:
        """Holds the ids of a text's tokens, distinct ones looked up once; how many there are."""
        text = pa.array([_spaced(text)], pa.large_binary()).view(pa.large_string())
        ts = pc.ascii_split_whitespace(text).flatten().dictionary_encode()
        distinct = ts.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        ids = np.fromiter((self.ids[t] if t else -1 for t in distinct), np.int64, len(distinct))
        ids = ids[ts.indices.to_numpy()]
        self.held.append(ids[ids >= 0])  # white space at an end leaves an empty one
        return len(self.held[-1])

    def look_up(self) -> None:
        """Hashes of the words that are new, and whether they can be in a candidate."""
        new = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words[len(self.hashes):]), np.uint64)
        ok = np.ones(len(new), bool) if self.words_ok is None else self.words_ok.has(new ^ self.seed)
        self.hashes, self.ok = np.append(self.hashes, new), np.append(self.ok, ok)

    def take(self) -> tuple[np.ndarray, int]:
        """The held ids, 0 for words that no phrase crosses, and from which on they are new. The last
        ones stay, for phrases that go on."""
        self.look_up()
        ids, fresh = np.concatenate([np.empty(0, np.int64), *self.held]), self.fresh
        self.held = [ids[-(LONGEST - 1):].copy()]
        self.fresh = len(self.held[0])
        ids[~self.ok[ids]] = 0
        return ids, fresh


def _parts(hashes: np.ndarray, phrases: np.ndarray, parts: int) -> np.ndarray:
    """The merging partitions of phrases (rows of ids): that of the first word, whose subtree is dealt
    over FANS partitions by the words that follow."""
    fan = np.zeros(len(phrases), np.uint64)
    for k in range(1, phrases.shape[1]):
        fan = fan * np.uint64(31) + hashes[phrases[:, k]]
    fan = (fan >> np.uint64(9)) % np.uint64(FANS) * np.uint64(0x9E3779B1)
    return (((hashes[phrases[:, 0]] >> np.uint64(7)) + fan) % np.uint64(parts)).astype(np.int64)


def _grams(ids: np.ndarray, fresh: int, n: int, pair_ok=None):
    """(phrases as rows of ids, sorted, and counts) of the phrases of ``n`` words that end at
    ``fresh`` or later, hold no 0 and only pairs that are ok."""
    m = len(ids) - n + 1
    none = np.empty((0, n), np.int64), np.empty(0, np.int64)
    if m <= 0:
        return none
    ok = np.ones(m, bool)
    ok[:max(0, fresh - n + 1)] = False
    for k in range(n):
        ok &= ids[k:k + m] > 0
    for k in range(n - 1 if pair_ok is not None else 0):
        ok &= pair_ok[k:k + m]
    at = np.flatnonzero(ok)
    if not len(at):
        return none
    # a phrase is numbered by its beginning's number and its last word
    key = ids[at]
    for k in range(1, n):
        key = key << 31 | ids[at + k]
        if n == 2:  # the number tells both words
            key = np.sort(key)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            return np.stack([key[first] >> 31, key[first] & (1 << 31) - 1], axis=1), np.diff(first, append=len(key))
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        key[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return np.stack([ids[at[order[first]] + k] for k in range(n)], axis=1), np.diff(first, append=len(order))


def _hash_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of each pair of words from the words' hashes."""
    return mix64(mix64(first + np.uint64(2)) + second * np.uint64(0xA24BAED4963EE407))


def _packed(values: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(1).compress(b"\n".join(values))


def _packed_counts(values: list[int]) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.array(values, np.int64).tobytes())


def _unpacked(run: bytes, counts: bytes):
    out = zstandard.ZstdDecompressor()
    return zip(out.decompress(run).split(b"\n"),
               np.frombuffer(out.decompress(counts), np.int64).tolist())


def _slices(text: bytes):
    """Parts of a text, cut before a character that no word has."""
    lo = 0
    while len(text) - lo > SLICE:
        cut = _BETWEEN.search(text, lo + SLICE)
        hi = cut.start() if cut else len(text)
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def count_runs(docs: DataFrame, lengths: tuple[int, ...], parts: int, words_ok=None,
               pairs_ok=None) -> DataFrame:
    """Sorted runs of the phrases of ``lengths`` words of ``docs`` (lang, text): rows (part, lang,
    run, counts). ``words_ok`` and ``pairs_ok`` (Bloom filters) say which words, and which pairs of
    words, a phrase may hold. With lengths (1,) there is also a phrase b"", counted once a word."""
    def count(lang: _Language) -> None:
        ids, fresh = lang.take()
        if lengths == (1,):
            seen = np.bincount(ids[fresh:], minlength=len(lang.words))
            seen[:len(lang.single)] += lang.single
            lang.single = seen
            return
        pair_ok = None
        if pairs_ok is not None and len(ids) > 1:
            h = lang.hashes[ids]
            pair_ok = pairs_ok.has(_hash_pairs(h[:-1], h[1:]) ^ lang.seed)
        for n in lengths:
            rows, counts = _grams(ids, fresh, n, pair_ok)
            if not len(rows):
                continue
            cuts = [0, *(np.flatnonzero(np.diff(rows[:, 0])) + 1).tolist(), len(rows)]
            rests = rows[:, 1].tolist() if n == 2 else list(map(tuple, rows[:, 1:].tolist()))
            counts = counts.tolist()
            for lo, hi in zip(cuts, cuts[1:]):
                lang.trie.add(int(rows[lo, 0]), rests[lo:hi], counts[lo:hi])

    def spill(lang: _Language, share: float):
        """Subtrees as sorted runs, a row for each partition that they go to."""
        runs: dict[int, list] = {}
        words = lang.words
        if lengths == (1,):
            seen = np.flatnonzero(lang.single[1:]) + 1
            ids, counts = {1: seen[:, None]} if len(seen) else {}, {1: lang.single[seen].tolist()}
            if len(seen):
                runs[0] = [(b"", sum(counts[1]))]
            lang.single = np.zeros(1, np.int64)
        else:
            ids, counts = HatTrie.phrases(lang.trie.take(share))
        for n, phrases in ids.items():
            part = _parts(lang.hashes, phrases, parts)
            order = np.argsort(part, kind="stable")
            cuts = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
            pairs = list(zip(map(b" ".join, zip(*(map(words.__getitem__, phrases[order, k].tolist())
                                                  for k in range(n)))),
                             map(counts[n].__getitem__, order.tolist())))
            for lo, hi in zip(cuts, cuts[1:]):
                runs.setdefault(int(part[order[lo]]), []).extend(pairs[lo:hi])
        for part, run in runs.items():
            run.sort()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([lang.lang]),
                 pa.array([_packed([p for p, _ in run])], pa.binary()),
                 pa.array([_packed_counts([n for _, n in run])], pa.binary())],
                names=["part", "lang", "run", "counts"])

    def work(batches):
        gc.disable()  # millions of small objects and no cycles among them
        try:
            yield from counted(batches)
        finally:
            gc.enable()

    def all_counted(langs):
        for x in langs.values():
            count(x)
        while sum(x.trie.entries for x in langs.values()) > ENTRIES:
            yield from spill(max(langs.values(), key=lambda x: x.trie.entries), 0.5)

    def counted(batches):
        langs: dict[str, _Language] = {}
        held = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for lo, texts in text_slices(batch, "text"):
                joined: dict[str, bytearray] = {}
                for name, text in zip(names[lo:], texts):
                    if name not in langs:
                        langs[name] = _Language(name, words_ok)
                    several = joined.setdefault(name, bytearray())
                    for part in _slices(text):
                        several += part
                        if len(several) >= SLICE:  # parts end between words
                            held += langs[name].hold(bytes(several))
                            several.clear()
                            if held >= TOKENS:
                                held = 0
                                yield from all_counted(langs)
                    several += b"."
                for name, several in joined.items():
                    held += langs[name].hold(bytes(several))
                if held >= TOKENS:
                    held = 0
                    yield from all_counted(langs)
                if sum(len(x.ids) for x in langs.values()) > KNOWN:
                    for x in langs.values():  # at the end of a text no phrase goes on
                        count(x)
                        yield from spill(x, 1.0)
                        x.held, x.fresh = [], 0
                        x.clear()
                    held = 0
        for x in langs.values():
            count(x)
            yield from spill(x, 1.0)

    return docs.mapInArrow(work, RUNS)


def merged(runs: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words, f of the phrases that occur ``least`` times or more: the sorted runs
    of a partition, whose size follows BYTES_PER_PART, are merged in order (sorting what consists of
    sorted runs merges them). The phrase "" has words 0."""
    def merge(batches):
        held, key = [], None

        def close():
            out, last, total = [], None, 0
            for phrase, n in sorted(chain.from_iterable(_unpacked(*x) for x in held)):
                if phrase != last:
                    if total >= least or last == b"":
                        out.append((last, total))
                    last, total = phrase, 0
                total += n
            if total >= least or last == b"":
                out.append((last, total))
            return pa.RecordBatch.from_arrays(
                [pa.array([key[1]] * len(out), pa.string()),
                 pa.array([p for p, _ in out], pa.binary()).cast(pa.string()),
                 pa.array([p.count(b" ") + 1 if p else 0 for p, _ in out], pa.int32()),
                 pa.array([n for _, n in out], pa.int64())], names=["lang", "phrase", "words", "f"])

        for batch in batches:
            for part, lang, run, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (part, lang) != key:
                    if held:
                        yield close()
                    held, key = [], (part, lang)
                held.append((run, counts))
        if held:
            yield close()

    return runs.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(merge, COUNTS)


class Bloom:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    @staticmethod
    def places(h: np.ndarray, size: int) -> np.ndarray:
        step = mix64(h + np.uint64(1)) | np.uint64(1)
        return np.stack([(h + np.uint64(k) * step) % np.uint64(size) for k in range(FILTER_HASHES)])

    def has(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h, self.size)
        return ((self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
                ).all(axis=0)


def bloom_of(counts: DataFrame) -> Bloom:
    """The filter of the words or pairs of words in ``counts``. Its size follows their number up to
    FILTER_MOST bits, which also bounds what reaches the driver; tasks mark bits of their own, which
    are joined block by block."""
    size, n = FILTER_LEAST, counts.count()
    while size < min(16 * n, FILTER_MOST):
        size *= 2
    block = FILTER_LEAST // 8
    schema = "block int, bits binary"

    def local(batches):
        bits, any_row = np.zeros(size, bool), False
        for batch in batches:
            for lang, phrase in zip(*(batch.column(i).to_pylist() for i in range(2))):
                h = [np.array([xxhash.xxh3_64_intdigest(w)], np.uint64) for w in phrase.encode().split(b" ")]
                h = h[0] if len(h) == 1 else _hash_pairs(*h)
                bits[Bloom.places(h ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode())), size)] = any_row = True
        if any_row:
            packed = np.packbits(bits, bitorder="little")
            for b in range(size // 8 // block):
                part = packed[b * block:(b + 1) * block]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "bits"])

    def join(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, bits in zip(*(batch.column(i).to_pylist() for i in range(2))):
                bits = np.frombuffer(bits, np.uint8)
                held[b] = held[b] | bits if b in held else bits
        for b, bits in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["block", "bits"])

    parts = counts.select("lang", "phrase").mapInArrow(local, schema).repartition("block").mapInArrow(join, schema)
    bits = np.zeros(size // 8, np.uint8)
    for b, x in parts.collect():  # FILTER_MOST bits at most
        bits[b * block:(b + 1) * block] = np.frombuffer(x, np.uint8)
    return Bloom(bits, size)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to LONGEST words that occur ``least`` times or
    more, and (lang, n) of the languages' words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where(
        F.col("text").isNotNull())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // BYTES_PER_PART))
    words = materialise(merged(count_runs(texts, (1,), parts), least), "colloc_words")
    sizes = words.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    words = words.where("words = 1")
    words_ok = bloom_of(words)
    pairs = materialise(merged(count_runs(texts, (2,), parts, words_ok), least), "colloc_pairs")
    more = materialise(merged(count_runs(texts, tuple(range(3, LONGEST + 1)), parts, words_ok,
                                         bloom_of(pairs)), least), "colloc_longer")
    return words.unionByName(pairs).unionByName(more), sizes


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Null texts count as empty and have no words; a null lang is "und", like that value itself. Ties
    of score and count are ordered by the phrase's bytes. Repeated rows count each. An empty table,
    or one without a phrase that occurs often enough, gives no rows. Only lang and text are read.
    """
    counts, sizes = frequent_phrases(docs, least)
    wide = "decimal(24,0)"
    split = F.split("phrase", " ", -1)

    def span(at, n):
        return F.array_join(F.slice("w", at, n), " ")

    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"),
                                                   split.alias("w"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "k", span(F.lit(1), F.col("k")).alias("left"),
        span(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    part = counts.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")),
                     ["lang", "left"]).join(
        part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # floor by whole division of decimals: the products may pass 64 bits
    cuts = cuts.withColumn("score", F.expr(
        f"cast(a as {wide}) * cast({SCALE} as decimal(7,0)) div cast(cast(l as {wide}) + r as {wide})"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "words")).alias("best")).select("lang", "phrase", "best.*")

    inner = candidates.where("words >= 3").withColumn(
        "m", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1))).groupBy(
        "lang", span(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    best = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | F.expr(f"cast(longer as {wide}) * cast(100 as decimal(3,0)) "
                                          f"< cast(a as {wide}) * cast({COVERED} as decimal(3,0))"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(FANS))
    best = best.withColumn("share", share).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(
        F.col("rank") <= top)  # at most FANS * top rows of a language go on
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))


def op13(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, g.m AS m, unnest(list_transform(range(1, len(w) - g.m + 2),
                                lambda i: array_to_string(w[i:i + g.m - 1], ' '))) AS phrase
  FROM split, (SELECT unnest([1, 2, 3, 4]) AS m) g WHERE len(w) >= g.m),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
         CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT s.lang, s.phrase, s.a FROM (
    SELECT lang, m, a, w, unnest(range(1, m)) AS i FROM cand WHERE m >= 3) t,
    (SELECT unnest([2, 3]) AS z) z, cand s
  WHERE z.z < t.m AND t.i + z.z - 1 <= t.m AND s.lang = t.lang
    AND s.phrase = array_to_string(t.w[t.i:t.i + z.z - 1], ' ') AND 100::HUGEINT * t.a >= 80::HUGEINT * s.a),
kept AS (SELECT b.* FROM best b ANTI JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
