"""Words that end with marks, as op9's encoder and the tokenizer's library see them."""

import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from candlewick.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def same(coded, text):
    return packing.tokenizer(PATH).encode(text, add_special_tokens=False).ids == list(np.frombuffer(coded.encode(text), "<u4"))


def test_runs_of_marks_match_the_library():
    ascii_marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
    ends = [*ascii_marks, *map("".join, itertools.product(ascii_marks, repeat=2))]
    rnd = random.Random(5)
    ends += ["".join(rnd.choices(ascii_marks, k=rnd.randint(3, 9))) for _ in range(500)]
    for stem in ("and", "Été", "IT", "x1", "İ", "ǆ", ""):
        coded = packing.encoder(PATH)
        text = " ".join(stem + end for end in ends)
        assert same(coded, text) and same(coded, text)  # learnt, then from memory
        assert same(coded, " ".join(f"new{stem}{end} {stem}{end}" for end in ends))  # old and new words mixed


def test_words_with_marks_do_not_take_the_whole_way(monkeypatch):
    coded, asked = packing.encoder(PATH), []
    whole = coded._whole
    monkeypatch.setattr(coded, "_whole", lambda words: asked.extend(words) or whole(words))
    text = " ".join(f"{w}{end}" for w in ("and", "the", "Été", "heed") for end in ("***", ",%%%", "$$$", ".", "!!"))
    assert same(coded, text)
    assert sorted(asked) == sorted(["***", ",%%%", "$$$", ".", "!!"])


@pytest.mark.parametrize("limit", [1, 5])
def test_marks_with_a_full_memory(monkeypatch, limit):
    monkeypatch.setattr(packing, "MEMO_WORDS", limit)
    coded = packing.encoder(PATH)
    for text in ("one*** two,%%% *** one***", "one*** new!!", "***", "two,%%% new!! ,%%%"):
        assert same(coded, text)
