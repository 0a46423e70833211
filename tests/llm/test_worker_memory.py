"""What worker processes keep between tasks, and how often the tokenizer is asked."""

import numpy as np
import pytest

from sigscore.llm import _common, packing, toxicity

TEXTS = ["", "a", "\n", "a\nb", "a \nb", "a  b", "\na", "a\n", "a\tb c", "x\r\ny", "a\n\nb", "... !!!", "it's, 's",
         "é, è!\n$$$ x", "a, \n", "don't' x'", " lead", "trail ", "<|endoftext|> x", "a\x1cb c", "\x85 a", "　",
         "aa, bb.\nAa, bb! cc", "a b c, d"]


@pytest.fixture(scope="module")
def path():
    return packing.tokenizer_path()


def test_ids_equal_the_tokenizers_own(path):
    encoder = packing.Encoder(path, keep=4)  # its memory is full again and again
    want = [np.asarray(x.ids, "<u4").tobytes()
            for x in encoder.tokenizer.encode_batch_fast(TEXTS, add_special_tokens=False)]
    assert encoder.encode(TEXTS) == want
    assert [encoder.encode([t])[0] for t in TEXTS] == want
    assert encoder.encode([]) == []


def test_words_in_use_outlive_a_full_memory(path):
    encoder, asked = packing.Encoder(path, keep=3), []
    encode = encoder._spaced_ids
    encoder._spaced_ids = lambda words: asked.extend(words) or encode(words)
    encoder.encode(["start aa bb cc dd ee"])
    assert sorted(asked) == ["aa", "bb", "cc", "dd", "ee"]
    asked.clear()
    encoder.encode(["start aa bb ff"])
    assert asked == ["ff"] and len(encoder.known) < 6


def test_a_worker_keeps_one_thing(path):
    first = packing.encoder_for(path)
    assert packing.encoder_for(path) is first
    assert _common.held("another operator's", list) == []
    assert packing.encoder_for(path) is not first


def test_words_without_a_weight_cost_no_set():
    model = toxicity.Model({"bad": 1.0})
    model.score("nothing known here. bad luck")
    assert len({id(found) for word, found in model.seen.items() if word != "bad"}) == 1


def test_slices_are_bounded_in_rows_and_bytes(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(packing, "BYTES_PER_SLICE", 10)
    texts = pa.array(["x" * 30, None, "", "y" * 4, "z" * 4, "w" * 4, "v"])
    assert list(packing._slices(texts, 3)) == [(0, 1), (1, 4), (4, 7)]
    assert list(packing._slices(texts.slice(0, 0), 3)) == []
