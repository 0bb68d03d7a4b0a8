"""The packing of a histogram by the configuration program: valid, no worse than best-fit, near its own lower bound."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeops.llm import packing


def lognormal(pieces, seed):
    random = np.random.default_rng(seed)
    return dict(Counter(np.clip(random.lognormal(6.2, 1.0, pieces).astype(int), 2, 2048).tolist()))


CASES = {
    "pairs": ({700: 50_000, 900: 30_000}, 0.001),
    "triples": ({600: 30_000, 650: 30_000, 780: 30_000, 1000: 9_000}, 0.003),
    "five": ({1100: 10_000, 500: 20_000, 420: 15_000, 300: 10_000, 940: 30_000}, 0.015),
    "dense": (lognormal(60_000, 1), 0.002),
    "few": (lognormal(900, 2), 0.02),
}


def pieces_of(packed):
    held = Counter()
    for config, copies in packed:
        assert copies > 0 and sum(v * k for v, k in config) <= 2048
        for v, k in config:
            held[v] += k * copies
    return held


@pytest.mark.parametrize("name", CASES)
def test_program_against_best_fit_and_its_bound(name):
    counts, gap = CASES[name]
    packed = packing.plan(counts, 2048)
    assert pieces_of(packed) == Counter(counts)
    found, left, bound = packing.program(counts, 2048)
    total, alone = sum(m for _, m in packed), sum(packing.best_fit(counts, 2048).values())
    assert bound <= total <= alone
    assert total <= bound * (1 + gap) + 1
    # most sequences are the program's own, but where each length has a piece or two
    assert sum(found.values()) >= (0.2 if name == "few" else 0.6) * total


def test_program_beats_best_fit_where_lengths_must_be_matched():
    counts = CASES["triples"][0]
    total = sum(m for _, m in packing.plan(counts, 2048))
    assert total == 34_500 and sum(packing.best_fit(counts, 2048).values()) == 39_500


def test_bound_holds_for_a_packing_known_to_be_best():
    # each sequence is exactly 1000 + 700 + 348
    _, bound = packing.solve({1000: 400, 700: 400, 348: 400}, 2048)
    assert 390 < bound <= 400
    assert sum(m for _, m in packing.plan({1000: 400, 700: 400, 348: 400}, 2048)) == 400


@pytest.mark.parametrize("counts", [{}, {2048: 3}, {1: 5000}, {1: 1}, {2047: 2, 1: 3}, {1025: 7}])
def test_small_histograms(counts):
    packed = packing.plan(counts, 2048)
    assert pieces_of(packed) == Counter(counts)


def test_words_learnt_together_have_the_ids_of_the_whole_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, words = Tokenizer.from_file(path), packing.Words(Tokenizer.from_file(path))
    random = np.random.default_rng(6)
    signs = ["a", "Ab", "it's", "'s", "'", "12", "é", "ß", ".", "...", "_", "-", " ", "  ", "\n", "\t", "\n\n", " the", "&&&", "don't", "''s", "x'll"]
    for _ in range(1500):
        text = "".join(random.choice(signs, random.integers(1, 14)))
        ids = np.frombuffer(packing.encode(words, text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_go_to_the_merges_alone():
    """They were written into a text, which the tokenizer split again, at twice the time."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)

    class Merges:
        model = tokenizer.model

    words = packing.Words(Merges())
    signs = [chr(c) for c in range(0x250) if not packing._UNSAFE.search(chr(c))]
    texts = ["", "A few words, and 12 more.\n\n  It's  all\r\n", *(f"a{c} {c}b  {c}{c}" for c in signs)]
    for text in texts:
        assert np.frombuffer(packing.encode(words, text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(words) > len(signs)


def test_forgotten_words_and_unsafe_texts(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = packing.Words(tokenizer)
    for text in ["one two three four five one two", "one <|endoftext|> two", "\u0416 \u0661 x", "two one", "\x1c\xa0a", "five  four"]:
        assert np.frombuffer(packing.encode(words, text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(words) <= 3 and len(words.older) <= 3
