"""The llm operators against brute force on small tables, and their edge cases."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeops.llm import ann, bpe, html_text, license_scan, lm_score, near_dup, packing, quality, suffix_dedup, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, band int, key string, node long, n int"
PASSAGE = " ".join(f"wörd{i * 7919 % 1000}" for i in range(90))
LONG = " ".join(f"x{i * i % 9973}" for i in range(60_000))


def docs_of(spark, texts):
    """Documents with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None if i == 1 else "en", 1, "k", 2, 3) for i, t in enumerate(texts)], SCHEMA)


TEXTS = [
    "one two three four five six seven eight nine ten eleven twelve",
    "one two three four five six seven eight nine ten eleven twelve",
    None, "", "  \n\t ", "short", "SHORT", LONG, "a b " * 40,
    f"start {PASSAGE} end of one", f"{PASSAGE}", f"other {PASSAGE} finish", "line\nline\nother\n" * 3,
]


@pytest.fixture(scope="module")
def docs(spark):
    return docs_of(spark, TEXTS)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, x) for x in r[:1]))


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute_components(texts, words, percent):
    sets = {i: shingles(t, words) for i, t in texts.items()}
    root = {i: i for i in sets}
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and root[i] != root[j]:
                m = len(sets[i] & sets[j])
                if 100 * m >= percent * (len(sets[i]) + len(sets[j]) - m):
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if v == high else v for k, v in root.items()}
    return [(i, len(sets[i]), root[i], root[i] == i) for i in ids]


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, given, words, percent):
    for df in (docs, given):
        texts = {r.doc_id: r.text for r in df.collect()}
        assert rows(near_dup.near_duplicates(df, words, percent)) == brute_components(texts, words, percent)


def test_near_duplicates_split_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SET_BLOCK", 2)
    monkeypatch.setattr(near_dup, "SIGNATURE_BLOCK", 2)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(w if i != k else f"edit{k}" for i, w in enumerate(base)) for k in range(9)]
    got = rows(near_dup.near_duplicates(docs_of(spark, texts), 3, 80))
    assert got == brute_components(dict(enumerate(texts)), 3, 80)


def test_rows_without_id_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "z y x w v u"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 4, False), (4, 4, True), (4, 4, True), (None, None, True), (None, None, True)], key=str)
    assert suffix_dedup.remove_repeats(df).count() == lm_score.score_documents(df).count() == 5
    assert packing.pack(df, public_tokenizers.path("byte_bpe_50k.json")).count() == 5


def brute_repeats(texts, length):
    starts, out = Counter(), []
    data = [(t or "").encode() for t in texts]
    for d in data:
        starts.update(d[i : i + length] for i in range(len(d) - length + 1))
    for i, d in enumerate(data):
        gone = np.zeros(len(d) + 1, int)
        for k in range(len(d) - length + 1):
            if starts[d[k : k + length]] > 1:
                gone[k] += 1
                gone[min(len(d), k + length)] -= 1
        off = np.cumsum(gone)[: len(d)] > 0
        left = bytes(np.frombuffer(d, np.uint8)[~off])
        out.append((i, len(d), int(off.sum()), len(suffix_dedup.runs(off)), hashlib.sha256(left).hexdigest()))
    return out


def test_suffix_dedup(spark, docs):
    texts = [t if t != LONG else LONG[:3000] for t in TEXTS] + ["ab" * 700, LONG[1000:2200]]
    assert rows(suffix_dedup.remove_repeats(docs_of(spark, texts))) == brute_repeats(texts, 400)


def test_suffix_dedup_splits_large_groups(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup.solve, "__defaults__", (suffix_dedup.WIDTHS, 3))
    texts = [f"{chr(97 + i) * (20 + i)} {PASSAGE} {chr(110 + i) * 30}" for i in range(12)]
    assert rows(suffix_dedup.remove_repeats(docs_of(spark, texts))) == brute_repeats(texts, 400)


def test_suffix_order_and_windows():
    contexts = [b"abcabcabcabd" * 3, b"xxabcabcabcabdyy", b"q"]
    joined = [c[i : i + 9] for c in contexts for i in range(len(c) - 8)]
    got = suffix_dedup.repeated_windows(contexts, 9)
    at, want = 0, np.zeros(len(got), bool)
    for c in contexts:
        for i in range(len(c) - 8):
            want[at + i] = joined.count(c[i : i + 9]) > 1
        at += len(c) + 1
    assert (got == want).all()


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies on this site and hope that you accept them all.</div>
<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;paragraph <b>bold</b><br>goes on.<p>Second &lt;p&gt; &#228;.
<ul><li>item</ul><form><label>Mail</label><input></form><div class="ad">Buy this now</div>
<section class="comments"><p>A reader says that this is a long comment with many words in it.</p></section></article>
<aside><p>Also read this other long paragraph which is no part of the article text.</p></aside><footer>&copy; me</footer><script>x = "<p>no</p>"</script>"""


def test_html(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 0), (2, None, None, 0), (3, "v", "", 0), (4, "w", "<p>" + "long text " * 9 + "<div cla", 0), (1, "u", PAGE, 0)], "page_id long, url string, html string, text int")
    got = rows(html_text.extract_pages(df))
    text = "Title & more\nFirst paragraph bold goes on.\nSecond <p> ä.\nitem"
    prose = " ".join(["long text"] * 9)
    assert got == [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (3, "v", "", 0), (4, "w", prose, len(prose))]
    assert html_text.extract_pages(df.limit(0)).count() == 0


def test_html_tree_is_accurate_on_held_out_blocks():
    table = html_text.training_table()
    held = np.arange(len(table)) % 4 == 0
    tree = html_text.fit_tree(table[~held, 1:], table[~held, 0])
    assert ((html_text.predict(tree, table[held, 1:]) >= 0.5) == (table[held, 0] == 1)).mean() > 0.95


def test_nearest(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", F.lit(1).alias("rank"), F.lit(2).alias("shard"))
    odd = spark.createDataFrame([(1000, None), (1001, [0.0] * 64), (1002, [float("nan")] * 64), (1003, [1.0]), (1004, [None] * 64), (None, [1.0] * 64)], "vec_id long, embedding array<float>")
    table = df.unionByName(odd, allowMissingColumns=True)
    got = ann.nearest(table, table.where("vec_id % 50 = 0")).collect()
    data = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append(r.vec_id)
        x, y = data[r.query_id], data[r.vec_id]
        assert r.score == pytest.approx(x @ y / np.sqrt((x @ x) * (y @ y)), abs=1e-12)
    hits = 0
    for q in found:
        x = data[q] / np.linalg.norm(data[q])
        true = sorted((i for i in data if i != q), key=lambda i: (-(data[i] @ x) / np.linalg.norm(data[i]), i))[:5]
        hits += len(set(true) & set(found[q]))
    assert set(found) == {i for i in data if i % 50 == 0} and hits / (5 * len(found)) >= 0.9
    assert ann.nearest(table.limit(0), table).count() == 0


def test_nearest_recall_in_a_large_shard():
    random = np.random.default_rng(5)
    vectors = random.standard_normal((4000, 32)) + 3 * random.standard_normal((20, 32))[random.integers(0, 20, 4000)]
    forest = ann.Forest(np.arange(4000), vectors, 5)
    hits = 0
    for q in range(0, 4000, 80):
        score = ann.cosines(vectors, forest.norms, vectors[q])
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5]) & {i for _, i, _ in forest.search(q, vectors[q])})
    assert hits / 250 >= 0.9


def brute_ppm(train, text, order):
    """The definition, without tables: counts by scanning the training texts."""
    seen = defaultdict(Counter)
    pad = (256,) * order
    for t in train:
        s = (*pad, *t, 256)
        for p in range(order, len(s)):
            for k in range(order + 1):
                seen[s[p - k : p]][s[p]] += 1
    s, total = (*pad, *text, 256), 0.0
    for p in range(order, len(s)):
        out = set()
        for k in range(order, -1, -1):
            fresh = {x: c for x, c in seen[s[p - k : p]].items() if x not in out}
            n = sum(fresh.values()) + (len(fresh) if len(fresh) + len(out) < 257 else 0)
            if s[p] in fresh:
                total += np.log10(fresh[s[p]] / n)
                break
            if fresh:
                total += np.log10(len(fresh) / n)
                out |= set(fresh)
        else:
            total -= np.log10(257 - len(out))
    return total


def test_lm_score(spark, docs, given):
    small = docs.where("doc_id != 7").unionByName(given.limit(30).selectExpr("doc_id + 100 AS doc_id", "left(text, 300) AS text"), allowMissingColumns=True)
    texts = {r.doc_id: (r.text or "") for r in small.collect()}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    words = Counter(w for t in train for w in [*t.encode().lower().split(), "end"])
    n, v = sum(words.values()), len(words)
    for r in lm_score.score_documents(small).collect():
        tokens = [*texts[r.doc_id].encode().lower().split(), "end"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2, len(tokens), sum(t in words for t in tokens), n)
        assert r.base_score == pytest.approx(sum(np.log10((words[t] + 1) / (n + v + 1)) for t in tokens))
        assert r.score == pytest.approx(brute_ppm([t.encode() for t in train], texts[r.doc_id].encode(), 4))


def test_lm_words_and_nodes_beyond_the_hot_ones(spark, given, monkeypatch):
    part = given.limit(40).select("doc_id", "text")
    want = {r.doc_id: r for r in lm_score.score_documents(part).collect()}
    monkeypatch.setattr(lm_score, "HOT_WORDS", 5)
    monkeypatch.setattr(lm_score, "HOT_NODES", 50)
    monkeypatch.setattr(lm_score, "CHUNK", 97)
    for r in lm_score.score_documents(part).collect():
        assert r.base_score == pytest.approx(want[r.doc_id].base_score) and r.n_known == want[r.doc_id].n_known
        assert r.score == pytest.approx(want[r.doc_id].score)
    assert lm_score.score_documents(part.limit(0)).count() == 0
    assert lm_score.adaptive_score(b"abc" * 30) > 3 * lm_score.adaptive_score(b"abc" * 10) / 2


def test_bpe_round_trip(docs):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    enc = bpe.encoder(path, pattern)
    for (doc, n, ids, decoded), text in zip(rows(bpe.round_trip(docs, path, pattern)), TEXTS):
        want = enc.encode_ordinary(text or "")
        assert (n, ids) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert decoded == hashlib.sha256((text or "").encode()).hexdigest()
    odd = "naïve  word.\n\n next x 12 'tis don't 漢字 " * 50
    assert bpe.encode(enc, odd, 37) == enc.encode_ordinary(odd)
    data = bpe.decode_documents(bpe.encode_documents(docs, path, pattern), path, pattern)
    assert [bytes(d) for _, d in rows(data)] == [(t or "").encode() for t in TEXTS]


def test_license_scan(spark):
    texts = [
        "x " * 50 + "Released under the MIT License." + " y" * 50, "licensed under cc by-nc 4.0", "no license here at all", None, "",
        "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License. Released under the MIT License.",
    ]
    got = sorted((r.doc_id, r.license, r.containment) for r in license_scan.scan(docs_of(spark, texts)).collect())
    assert got == [(0, "MIT", 100), (1, "CC-BY-NC-4.0", 100), (5, "GPL-3.0", 100), (5, "MIT", 100)]


def test_license_scan_finds_all_windows_by_brute_force(given, docs):
    for df in (given, docs):
        got = {(r.doc_id, r.license, r.containment) for r in license_scan.scan(df).collect()}
        want = set()
        for r in df.collect():
            w = license_scan.words_of(r.text or "")
            for name, text in license_scan.TEMPLATES.items():
                t = set(license_scan.shingles_of(license_scan.words_of(text)))
                c = license_scan.size_class(len(license_scan.words_of(text)))
                size, step = next((n, s) for k, n, s in license_scan.window_sizes() if k == c)
                best = max((100 * len(t & set(license_scan.shingles_of(w[i : i + size]))) // len(t) for i in range(0, len(w), step)), default=0)
                if best >= 80:
                    want.add((r.doc_id, name, best))
        assert got == want


def test_warc(spark):
    df = spark.createDataFrame([(1, "u\r\nX: y", "same\r\n\r\nWARC/1.1"), (2, None, "same\r\n\r\nWARC/1.1"), (3, "v", None), (5, "w", ""), (6, "x", "é" * 1000), (6, "x", "é" * 1000)], "page_id long, url string, html string")
    got = rows(warc.archive_round_trip(df))
    digest = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    same, big = "same\r\n\r\nWARC/1.1", "é" * 1000
    assert got == [
        (1, len(same), digest(same), "revisit", 2), (2, len(same), digest(same), "response", None),
        (3, 0, digest(""), "revisit", 5), (5, 0, digest(""), "response", None),
        (6, 2000, digest(big), "response", None), (6, 2000, digest(big), "response", None),
    ]
    assert [r[3] for r in rows(warc.archive_round_trip(df, min_bytes=100))] == ["response"] * 6
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_packing(docs):
    path, capacity = public_tokenizers.path("byte_bpe_50k.json"), 256
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path, capacity).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces, at = sorted(by[i], key=lambda r: r.piece), 0
        assert len(pieces) == -(-len(ids) // capacity)
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and all(r.length == capacity for r in pieces[1:])
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packing_plan_is_exact_and_near_the_bound():
    random = np.random.default_rng(2)
    lengths = np.clip(random.lognormal(6, 1.1, 50_000), 1, 2048).astype(int)
    counts = Counter(lengths.tolist())
    plan = packing.plan(counts, 2048)
    held = Counter()
    for config, copies in plan:
        assert sum(v * k for v, k in config) <= 2048
        for v, k in config:
            held[v] += k * copies
    assert held == counts and sum(c for _, c in plan) <= 1.002 * -(-int(lengths.sum()) // 2048)


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_counts(spark, docs, given):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (0, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (docs, given):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in quality.quality_rules(df, labels).collect():
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert got == brute_quality(texts[r.doc_id]) and r.kept == (not r.base_failed)
    assert quality.quality_rules(docs.limit(0), labels.limit(0)).count() == 0


def test_quality_thresholds_are_certified(spark):
    text = "concat_ws(' ', transform(sequence(1, 30), i -> concat('w', pmod(hash(id, i), 5000))))"
    df = spark.range(4000).selectExpr("id AS doc_id", f"CASE WHEN id % 10 = 0 THEN replace({text}, 'w', '#*') ELSE {text} END AS text", "'en' AS lang")
    labels = df.selectExpr("doc_id", "cast(doc_id % 10 != 0 AS int) AS quality", "0 AS toxic").where("doc_id < 3000")
    verdicts = {r.doc_id: r.kept for r in quality.quality_rules(df, labels).collect()}
    assert all(kept == (i % 10 != 0) for i, kept in verdicts.items())
    few = quality.quality_rules(df, labels.limit(50)).where("NOT kept").count()
    assert few == 0  # too few labels certify nothing


@pytest.mark.parametrize("n, k, a", [(100, 0, 0.02), (500, 3, 0.02), (2000, 25, 0.02), (10, 9, 0.02)])
def test_binomial_tail(spark, n, k, a):
    from math import comb

    got = spark.sql(f"SELECT {quality.binomial_tail(f'{n}L', f'{k}L', f'{a}D')}").first()[0]
    want = sum(comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(1.0 if k >= n * a else want, rel=1e-9)


def test_pipeline(spark, given):
    docs, sizes = given, [given.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, SF)
        assert after.columns == given.columns
        kept = {r.doc_id: r.text for r in after.collect()}
        texts = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_duplicates":
            assert set(kept) == {i for i, _, _, first in brute_components(texts, 5, 80) if first}
        if name == "repeated_passages":
            ids = sorted(texts)
            want = brute_repeats([texts[i] for i in ids], 400)
            assert set(kept) == set(texts) and all(len(kept[ids[i]].encode()) >= n - gone - 3 * (spans + 1) for i, n, gone, spans, _ in want)
        docs = spark.createDataFrame(after.collect(), after.schema)
        sizes.append(docs.count())
    last = corpus_pipeline.run(spark, SF)
    assert last.select("doc_id").distinct().count() == sizes[-1]
