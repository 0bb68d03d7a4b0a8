"""Blocks of a large key are dealt out without a task that holds the whole key."""

from itertools import combinations

from lakeops.llm import near_dup


def test_blocks_of_a_large_key_meet_without_a_window(spark):
    rows = spark.range(210).selectExpr("IF(id < 200, 1L, id) AS band", "id AS node")
    placed = near_dup.blocked(rows, "band", "node", 16)
    assert "Window" not in placed._jdf.queryExecution().executedPlan().toString()
    assert placed.columns == ["band", "node", "i", "j"]
    groups = {}
    for r in placed.collect():
        groups.setdefault((r.band, r.i, r.j), []).append(r.node)
    met = {p for held in groups.values() for p in combinations(sorted(held), 2)}
    assert met == set(combinations(range(200), 2))
    assert max(map(len, groups.values())) < 4 * 16 and {k for k in groups if k[0] >= 200} == {(i, 0, 0) for i in range(200, 210)}
