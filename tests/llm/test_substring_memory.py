"""What tasks of substring dedup hold at a time, and their marks against plain sets."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sigscore.llm import substring_dedup as S
from sigscore.llm._common import WordHashes, materialise


class Rows:
    """Stands for a data frame: keeps the function that it is given."""

    def repartition(self, *_):
        return self

    def mapInArrow(self, work, _):
        self.work = work
        return self


def packed(docs, parts=5):
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()),
                                        pa.array([t for _, t in docs])], names=["doc_id", "text"])
    return S._edges(Rows(), parts, S.WINDOW).work(iter([batch]))


def corpus(n, words, seed=3):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(words)) for _ in range(n)]


def test_batches_of_writes_are_bounded_in_bytes(spark):
    def seen(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    names = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = [spark.conf.get(x) for x in names]
    rows = spark.range(0, 24, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    got = materialise(rows.mapInArrow(seen, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in got) == 24 and max(r["size"] for r in got) < 6_000_000
    assert [spark.conf.get(x) for x in names] == before


def test_packing_holds_few_bytes_an_edge():
    texts = corpus(1200, 360)
    docs = list(enumerate(texts + texts[:60]))
    list(packed(docs[:5]))
    edges = sum(len(t.split()) - S.WINDOW + 1 for _, t in docs)
    work = packed(docs)
    tracemalloc.start()
    try:
        sizes = [b.nbytes for b in work]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) > 8 * edges * 0.9
    assert peak < 56 * edges + 4_000_000
    assert max(sizes) < 5_500_000 or len(sizes) > 1


def test_marks_are_those_of_plain_sets(monkeypatch):
    monkeypatch.setattr(S, "EDGES_PER_TASK", 400)   # several packs a task
    monkeypatch.setattr(S, "MARKS_PER_ROW", 16, raising=False)
    rng, texts = random.Random(5), corpus(12, 60)
    docs = []
    for _ in range(80):
        a, b = rng.choice(texts).split(), rng.choice(texts).split()
        lo = rng.randrange(40)
        docs.append((rng.randrange(-20, 40), " ".join(a[lo:lo + rng.randrange(30)] + b[:rng.randrange(60)])))
    docs += [(2**62, texts[0]), (2**62, texts[0]), (-2**62, "too short")]
    known, holders = WordHashes(), {}
    for d, t in docs:
        for h in S.edge_hashes(known.of(t.encode().split()), S.WINDOW).tolist():
            holders.setdefault(h, set()).add(d)
    want = {(d, h) for h, ds in holders.items() for d in ds if d > min(ds)}

    found = S._marks(Rows(), 5, 7).work(b for lo in range(0, len(docs), 30) for b in packed(docs[lo:lo + 30]))
    got, most = set(), 0
    for batch in found:
        for bucket, d, h, s in zip(*(c.to_pylist() for c in batch.columns)):
            d, h, s = np.frombuffer(d, np.int64), np.frombuffer(h, np.uint64), np.frombuffer(s, np.int64)
            assert (S._bucket_of(d, 7) == bucket).all()
            most = max(most, len(d))
            got |= set(zip(d.tolist(), h.tolist(), s.tolist()))
    # a source is some smaller document that has the edge, not always the smallest
    assert all(x < d and {x, d} <= holders[h] for d, h, x in got)
    assert {(d, h) for d, h, _ in got} == want
    assert most <= 16
