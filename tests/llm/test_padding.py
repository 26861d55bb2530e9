"""Padding of tables whose lengths are unlike those of the test data."""

import numpy as np
import public_tokenizers
import pytest

from tests.llm import test_exact
from wayprint.llm import packing


@pytest.mark.parametrize("words, rows", [(2100, 400), (20, 20_000)])
def test_padding_of_one_length(spark, words, rows):
    """Copies of one text just above half a window; a table of tiny texts."""
    text = "a " * words
    docs = spark.range(rows).selectExpr("id as doc_id", f"repeat('a ', {words}) as text")
    found = packing.pack(docs, test_exact.WORDS, 2, 4096).collect()
    assert test_exact.packs(found, {d: text for d in range(rows)}, 4096) < 0.04


@pytest.mark.parametrize("low, high", [(2049, 3500), (2100, 2101), (3000, 3001), (1400, 1401), (1100, 1101)])
def test_share_of_grains(low, high):
    rng = np.random.default_rng(low)
    lengths, counts = np.unique(rng.integers(low, high, 600), return_counts=True)
    parts = packing.cut_parts(lengths, counts, 4096)
    pieces = [p for n in np.repeat(lengths, counts).tolist() for p in (packing.grains(n) if rng.integers(packing.PARTS_OF) < parts else [n])]
    found = packing.divide(np.sort(pieces)[::-1], 4096)
    assert 1 - sum(pieces) / 4096 / (found.max() + 1) < 0.05


def test_known_words_are_looked_up_and_not_gone_through():
    """A batch costs what its own words cost, however many words the worker knows."""
    class Known(dict):
        def keys(self):
            raise AssertionError("all known words")

    encoder = packing.WordEncoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    texts = ["Two\x0bwords, naïve\x85 one\r\n\tand no  more", "", " \n", "日本 語 <|end|> É"]
    first = encoder.encode(texts)
    encoder.known = Known(encoder.known)
    assert encoder.encode(texts) == first
    whole = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert [list(memoryview(ids).cast("I")) for ids in first] == whole
