"""Alignment of tokens against a plain walk over both sequences."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeops.llm import token_align

SF = "/root/testdata/sf0.001"
A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        self.a.encode_special_tokens = True
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in kept]
        self.byte = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a, b = [(i, self.a_bytes(i)) for i in a], [(i, self.b_bytes(i)) for i in b]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            return []
        found, x, y, at, bt = [], [], [], 0, 0
        while a or b:
            if at <= bt and a:
                x.append(a[0][0])
                at += len(a.pop(0)[1])
            else:
                y.append(b[0][0])
                bt += len(b.pop(0)[1])
            if at == bt:
                found.append((x, y))
                x, y = [], []
        return found

    def table(self, texts):
        all_groups = [self.groups(t) for t in texts]
        links = [Counter((i, j) for x, y in g for i in x for j in y) for g in all_groups]
        held = Counter(p for k in links for p in k)
        most = Counter()
        for (i, _), n in held.items():
            most[i] = max(most[i], n)
        for g, k in zip(all_groups, links):
            written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            yield (
                sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(k.values()),
                sum(n for p, n in k.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in k.items()),
                hashlib.sha256(written.encode()).hexdigest() if g else "",
            )


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found_in(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


ODD = [
    None, "", " ", "a", "  two  spaces ", "tab\tline\n\n\nend", "▁ low line", "a▁b", "naïve Ünïcödé — 日本語のテキスト 🙂🙃👩‍👩‍👧", "<|endoftext|> <s> </s> <unk>", "\x00\x01",
    "x" * 3000, "ab" * 2000, " " * 500, "1234567890" * 30, "日本語" * 300, "same words here", "same words here", "word " * 50, "  wide", "\r\n", "🙂" * 200,
]


@pytest.mark.parametrize("hot_pairs", [0, 60, token_align.HOT_PAIRS])
def test_odd_texts_against_a_plain_walk(spark, plain, hot_pairs):
    """With few hot pairs, or none, counts come by the join."""
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in enumerate(ODD)], "doc_id long, text string, a int, row int, times int, best string")
    assert found_in(token_align.align(docs, A_FILE, B_FILE, hot_pairs=hot_pairs)) == sorted(plain.table(ODD))


def test_given_documents_against_a_plain_walk(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    assert found_in(token_align.align(docs, A_FILE, B_FILE)) == sorted(plain.table(texts))


def test_groups_themselves(spark, plain):
    docs = spark.createDataFrame([(1, "tokenizers disagree"), (None, "tokenizers disagree"), (1, "")], "doc_id long, text string")
    written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain.groups("tokenizers disagree"))
    found = token_align.align(docs, A_FILE, B_FILE, with_groups=True).collect()
    assert sorted((r["doc_id"] or 0, r["groups"]) for r in found) == [(0, written), (1, ""), (1, written)]


def test_empty_table(spark):
    found = token_align.align(spark.createDataFrame([], "doc_id long, text string"), A_FILE, B_FILE)
    assert found.columns == ["doc_id", *NAMES] and found.collect() == []


def test_parts_give_the_ids_of_the_whole_text():
    """At single spaces between visible characters nothing is joined, whatever stands there."""
    pair = token_align.pair_of(A_FILE, B_FILE)
    random = np.random.default_rng(8)
    signs = ["a", "Ab", "it's", "'s", "12", "é", "\u0301", "Ж", "\u00ad", "\u00a0", " ", "  ", "\t", "\n", ".", "...", "_", "<s>", "日", "🙂", "\u2003", "\u1680", "\x1f", "\x85", "the", " the "]
    for _ in range(2000):
        text = " ".join("".join(random.choice(signs, random.integers(1, 4))) for _ in range(random.integers(1, 9)))
        parts = token_align.parts_of(text)
        assert " ".join(parts) == text
        a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        assert (sum((pair.a.encode(" " + p, add_special_tokens=False).ids for p in parts), []), sum((pair.b.encode(p) for p in parts), [])) == (a, b), repr(text)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64, 4096])
def test_pieces_of_any_size_give_the_same_groups(work):
    random = np.random.default_rng(work)
    for share in (0.02, 0.5, 0.98):
        ends = [np.flatnonzero(random.random(2000) < p) + 1 for p in (share, 0.4)]
        a, b = (np.union1d(e, [2000]) for e in ends)
        common = np.intersect1d(a, b)
        of_a, of_b = token_align.groups_of(a, b, work)
        assert (of_a == np.searchsorted(common, a)).all() and (of_b == np.searchsorted(common, b)).all()


def test_diagonals_deal_out_equal_work():
    a, b = np.arange(1, 4001), np.array([1, 2, 2000, 4000])
    cuts = np.arange(0, 4005, 500)
    before = token_align.before_diagonals(a, b, cuts)
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    assert before.tolist() == [sum(1 for m in merged[:d] if m[1] == 0) for d in cuts]


def test_links_of_a_long_group_and_of_small_slices(monkeypatch):
    random = np.random.default_rng(3)
    a_ids, b_ids = random.integers(0, 9, 900), random.integers(0, 5, 700)
    of_a, of_b = np.sort(random.integers(0, 6, 900)), np.sort(random.integers(0, 6, 700))
    plain = Counter((int(i), int(j)) for i, g in zip(a_ids, of_a) for j, h in zip(b_ids, of_b) if g == h)
    for large, links in ((1 << 16, 1 << 21), (1 << 16, 50), (100, 1000), (15_000, 64)):
        monkeypatch.setattr(token_align, "LINKS", links)
        codes, times = token_align.linked(a_ids, of_a, b_ids, of_b, large)
        assert {(int(c >> token_align.ID_BITS), int(c & token_align._LOW)): int(n) for c, n in zip(codes, times)} == plain
