"""Best-fit-decreasing packing of tokenised documents into sequences of 2048 tokens.

Documents are encoded once with a public byte-level BPE file. Texts are cut where no token can
cross (a lone space or line feed between other characters), the pieces' ids are remembered, and
only pieces that were not seen yet go through the tokenizer.

Pieces are dealt at random into groups of bounded size. Inside a group the longest piece comes
first and goes into the tightest open sequence, found in a segment tree over remaining
capacities. Dealing at random keeps the length distribution of every group that of the corpus;
what a group can lose against one global packing is a few sequences at its end.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import held, materialise, table, tidy

CAPACITY = 2048
END_ID = 0
PIECES_PER_GROUP = 16_384
TOKENIZER_FILE = "byte_bpe_50k.json"
CACHE = 400_000  # remembered pieces of text per worker and kind
ROWS_PER_SLICE, BYTES_PER_SLICE = 1024, 1 << 22  # of texts that are encoded at a time

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII signs but the apostrophe, which starts "'s"
JOINED_CHARS = 1 << 16  # of new words that one call of the tokenizer takes
PIECES_SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
PACKED_SCHEMA = PIECES_SCHEMA + ", sequence_id bigint, offset bigint"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Little-endian 32-bit ids of texts, equal to encoding each text as a whole."""

    def __init__(self, path: str, keep: int = CACHE):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keep = keep
        self.known: dict[str, bytes] = {}   # words after a lone space; after a line feed, with it
        self.starts: dict[str, bytes] = {}  # other pieces, as they stand at the start of a text
        self.spaced: dict[str, bytes] = {}  # and after a lone space
        self.tails: dict[str, bytes] = {}   # runs of signs after a letter
        self.newline = self._ids(["\n"])[0]
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that start with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def _spaced_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space, each after a space. They are encoded in joined runs;
        an id that starts with a space starts a word, as no other space is there."""
        out, at = [], 0
        while at < len(words):
            end, chars = at, 0
            while end < len(words) and chars < JOINED_CHARS:
                chars += len(words[end]) + 1
                end += 1
            text = " " + " ".join(words[at:end])
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                             "<u4")
            starts = np.flatnonzero(self.opens[ids]) * 4
            if len(starts) != end - at:  # not expected of this vocabulary
                out += self._ids([" " + w for w in words[at:end]])
            else:
                raw = ids.tobytes()
                cuts = starts.tolist()
                out += [raw[i:j] for i, j in zip(cuts, [*cuts[1:], len(raw)])]
            at = end
        return out

    def _learn(self, words: list[str], ids: list) -> list:
        """``ids`` with those of the words that were not known (None). Words that hold white space of
        another kind, or nothing, stay None. Signs after a letter are tokens of their own, so the word
        before them is encoded once."""
        if len(self.known) > self.keep:
            self.known = {w: x for w, x in zip(words, ids) if x is not None}
        if len(self.tails) > self.keep:
            self.tails.clear()
        known, tails = self.known, self.tails
        cut, whole = {}, set()
        new = [i for i, x in enumerate(ids) if x is None]
        for c in map(words.__getitem__, new):
            stem = c.rstrip(TAIL)
            if len(stem) < len(c) and stem[-1:].isalpha():
                cut[c] = stem
                if stem not in known:
                    whole.add(stem)
            else:
                whole.add(c)
        lines = [w for c in whole if c[:1] == "\n" and (w := c[1:]).split() == [w]]
        after = [c for c in whole if c[:1] != "\n" and c.split() == [c]]
        known.update(zip(after, self._spaced_ids(after)))
        known.update(("\n" + w, self.newline + x) for w, x in zip(lines, self._ids(lines)))
        signs = list({c[len(stem):] for c, stem in cut.items()}.difference(tails))
        tails.update(zip(signs, self._ids(signs)))
        for c, stem in cut.items():
            if stem in known:
                known[c] = known[stem] + tails[c[len(stem):]]
        for i in new:
            ids[i] = known.get(words[i])
        return ids

    def _pieces(self, text: str) -> bytes:
        """Ids of a text with runs of white space, white space at an end, or other kinds of it."""
        start, *rest = _LONE_SPACE.split(text)
        for known, wanted, space in ((self.starts, {start}, ""), (self.spaced, set(rest), " ")):
            if len(known) > self.keep:
                known.clear()
            new = list(wanted.difference(known))
            known.update(zip(new, self._ids([space + c for c in new])))
        return self.starts[start] + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, texts cut only where tokens cannot cross: the pre-tokens of
        this vocabulary take white space only as one leading space or as a run of its own."""
        kind = pa.large_string()
        texts = pa.array(texts, kind) if isinstance(texts, list) else texts.cast(kind)
        # a line feed is put before the text and stays with the word after it, so that words that
        # start a line, and the first one, are told from those after a space
        cut = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(
            pa.scalar("", kind), texts, pa.scalar("\n", kind)), "\n", " \n"), " ")
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._learn(distinct, list(map(self.known.get, distinct)))
        odd = np.concatenate(([0], np.cumsum(np.array([x is None for x in ids], bool)[words.indices.to_numpy()])))
        joined = pa.array(ids, pa.large_binary()).take(words.indices)
        _, ends, data = joined.buffers()
        ends, data = np.frombuffer(ends, np.int64), memoryview(data or b"")
        # what stands before the first line feed is left out, and so are the ids of that line feed
        first, last = cut.offsets.to_numpy()[:-1] + 1, cut.offsets.to_numpy()[1:]
        return [data[a:b].tobytes() if plain else self._pieces(t.as_py()) for t, plain, a, b in zip(
            texts, odd[first] == odd[last], (ends[first] + len(self.newline)).tolist(), ends[last].tolist())]


def encoder_for(path: str) -> Encoder:
    """This worker process's encoder: what it remembers serves all tasks that run there."""
    return held(("encoder", path), lambda: Encoder(path))


def _pieces_of(ids: bytes, capacity: int):
    """(start, length, crc32) of a document's pieces: whole if it fits, else full pieces after
    a first one that takes what is over."""
    n = len(ids) // 4
    first = n if n <= capacity else (n % capacity or capacity)
    start, end = 0, first
    while start < n:
        yield start, end - start, zlib.crc32(ids[4 * start:4 * end])
        start, end = end, end + capacity


def _slices(texts: pa.Array, rows: int):
    """(first, last + 1) of slices of at most ``rows`` rows that end once they have BYTES_PER_SLICE."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = int(np.searchsorted(ends, before + BYTES_PER_SLICE)) + 1
        yield lo, (hi := min(hi, lo + rows, len(ends)))
        lo = hi


def encode_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                  rows: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32. A null or
    empty text is the end id alone."""
    path = path or tokenizer_path()
    end = END_ID.to_bytes(4, "little")

    @tidy
    def encode(batches):
        encoder = encoder_for(path)
        for batch in batches:
            for lo, hi in _slices(batch.column(1), rows):
                ids, texts = (c.slice(lo, hi - lo) for c in batch.columns)
                out = []
                for doc_id, x in zip(ids.to_pylist(), encoder.encode(texts.fill_null(""))):
                    out += [(doc_id, k, *p) for k, p in enumerate(_pieces_of(x + end, capacity))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*out), _PIECE_TYPES)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES_SCHEMA)


_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


class BestFit:
    """Open sequences by remaining capacity, under a segment tree that tells for each range of
    capacities whether a sequence is open there."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used = 0

    def _tightest(self, length: int) -> int:
        """The smallest remaining capacity of an open sequence that is at least ``length``; -1 if
        none is."""
        tree, at = self.tree, self.leaves + length
        if tree[at]:
            return length
        while at > 1:
            if not at & 1 and tree[at + 1]:  # the right sibling holds one: its leftmost leaf
                at += 1
                while at < self.leaves:
                    at = 2 * at if tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1

    def _mark(self, left: int, there: bool) -> None:
        tree, at = self.tree, self.leaves + left
        tree[at] = there
        while at > 1:
            at >>= 1
            tree[at] = tree[2 * at] | tree[2 * at + 1]

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece."""
        left = self._tightest(length)
        if left < 0:
            sequence, left = self.used, self.capacity
            self.used += 1
        else:
            sequence = self.open[left].pop()
            if not self.open[left]:
                self._mark(left, False)
        rest = left - length
        if rest:
            if not self.open[rest]:
                self._mark(rest, True)
            self.open[rest].append(sequence)
        return sequence, self.capacity - left


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY,
                per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Adds sequence_id and offset. Pieces are dealt by a hash of id, piece and checksum, and by
    a random part for rows that repeat, so one document repeated without end still spreads."""
    groups = max(1, -(-pieces.count() // per_group))
    # equal rows are interchangeable, so any deal of them gives the same packed rows
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(
        "doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))

    def pack(key, group):
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("piece", "ascending")])
        bins = BestFit(capacity)
        placed = [bins.place(n) for n in group["length"].to_pylist()]
        base = key[0].as_py() << 32
        out = group.drop_columns(["grp"])
        out = out.append_column("sequence_id", pa.array([base + s for s, _ in placed], pa.int64()))
        return out.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    return dealt.groupBy("grp").applyInArrow(pack, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Packs every row of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Each document is its ids and the end id 0; only longer ones are cut. Null and empty texts are
    a piece of length 1. Repeated rows are packed each, null ids too. An empty table gives an
    empty result. Other columns are not read. Reruns agree up to sequence numbers.
    """
    return pack_pieces(materialise(encode_pieces(docs, path, capacity), "pieces"), capacity,
                       per_group)


def op10(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
