"""The whole pipeline: what its stages keep, and that the packed pieces hold just that."""

import collections

from conftest import SF_SMALL

import corpus_pipeline as P
from sigscore.llm import toxicity
from sigscore.llm._common import materialise, table


def test_run_holds_what_the_stages_keep(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF_SMALL), f"test_{name}")
        assert docs.columns == columns
        kept[name] = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    given = {r["doc_id"] for r in table(spark, SF_SMALL, "documents").collect()}
    scores = toxicity.op3(spark, SF_SMALL).collect()
    assert set(kept["toxicity"]) == {r["doc_id"] for r in scores if r["predicted"] == 0} < given
    assert set(kept["near_dedup"]) <= set(kept["toxicity"]) and max(kept["near_dedup"].values()) == 1
    assert set(kept["mixing"]) <= set(kept["substring_dedup"]) <= set(kept["near_dedup"])
    assert max(kept["mixing"].values()) <= 2

    pieces = [r.asDict() for r in P.run(spark, SF_SMALL).collect()]
    assert collections.Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == kept["mixing"]
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    assert sum(p["length"] for p in pieces) > 0.9 * 2048 * len(sequences)
