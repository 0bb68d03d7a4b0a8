"""The bound of the bands for every notice, and sibling licenses told apart."""

import pytest

from lakeops.llm import license_scan as scan


def test_bands_find_the_least_similar_match_of_every_notice():
    bands = scan.bands_needed(scan.NOTICES)
    sizes = {c: n for c, n, _ in scan.window_sizes()}
    for text in scan.NOTICES.values():
        words = scan.words_of(text)
        n, size = len(scan.shingles_of(words)), sizes[scan.size_class(len(words))]
        least = min(m / (n + size - scan.SHINGLE + 1 - m) for m in range(-(-scan.PERCENT * n // 100), n + 1))
        assert (1 - least**scan.ROWS) ** bands <= scan.MISS


def test_every_notice_can_be_told_from_its_siblings():
    for name in scan.NOTICES:
        assert all(scan.apart(name, scan.NOTICES)), name
    assert scan.apart("GPL-3.0", scan.NOTICES) and scan.apart("GPL-3.0-header", scan.NOTICES)


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: set() for i in range(len(texts))}
    for r in scan.scan(df).collect():
        got[r.doc_id].add(r.license)
    return got


@pytest.mark.parametrize("before, after", [("", ""), ("some words stand here before " * 7, " and others come after it" * 9)])
def test_a_notice_is_reported_under_its_own_license_alone(spark, before, after):
    names = list(scan.NOTICES)
    got = found(spark, [before + scan.NOTICES[n] + after for n in names])
    for i, name in enumerate(names):
        assert name in got[i] and {scan.license_of(x) for x in got[i]} == {scan.license_of(name)}, (name, got[i])


def test_siblings_side_by_side_and_unclear_notices(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}"
    cc = "This work is licensed under a Creative Commons {} 4.0 International License"
    got = found(spark, [gpl.format(3) + ". " + gpl.format(2), gpl.format("three"), gpl.format(1), cc.format("Attribution-NonCommercial"), cc.format("Attribution-ShareAlike") + " " + cc.format("Attribution")])
    assert got == {0: {"GPL-3.0", "GPL-2.0"}, 1: {"GPL-unclear"}, 2: {"GPL-unclear"}, 3: {"CC-BY-NC-4.0-sentence"}, 4: {"CC-BY-SA-4.0-sentence", "CC-BY-4.0"}}
