"""Ids of texts with very long runs, against the tokenizers library."""

import random

import numpy as np
import pytest
from clickmill.llm import packing


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(library, body):
    return np.array(library.encode(body, add_special_tokens=False).ids, "<u4").tobytes()


def encoder():
    vocabulary = packing.public_vocabulary()
    return packing.Encoder(vocabulary, packing.added_tokens(vocabulary))


@pytest.mark.parametrize("one", [" ", "\n", "　", "a"])
@pytest.mark.parametrize("n", [1_000_000, 5_000_000])
def test_a_run_of_millions(library, one, n):
    body = "x" + one * n + "y"
    if one == "a" and n > 1_000_000:
        body = ("a" * 999 + " ") * (n // 1000)  # one word of millions takes the library itself very long
    assert encoder().whole(body) == ids(library, body)


def test_runs_are_cut_as_the_pattern_cuts_them(library, monkeypatch):
    monkeypatch.setattr(packing, "LONG", 3)
    own, draw = encoder(), random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t ", "　", "\x1c", "\x85", "é", "1", "'s", "!", "<|endoftext|>", "        ", "​"]
    for _ in range(3000):
        body = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert own.whole(body) == ids(library, body), repr(body)
