"""Suffix problems of bounded size, however many rows a batch holds."""

import numpy as np
import pandas as pd

from lakeops.llm import suffix_dedup


def test_problems_hold_whole_keys_and_are_bounded():
    chance = np.random.default_rng(3)
    sizes = chance.integers(2, suffix_dedup.GROUP + 1, 60)
    keys = np.repeat(np.arange(60) * 3 - 90, sizes)
    frame = pd.DataFrame({"key": keys, "at": np.arange(len(keys))})
    parts = list(suffix_dedup.problems(frame))
    assert np.concatenate([p["at"] for p in parts]).tolist() == frame["at"].tolist()
    assert max(map(len, parts)) < suffix_dedup.PROBLEM + suffix_dedup.GROUP
    owners = [set(p["key"]) for p in parts]
    assert sum(map(len, owners)) == 60


def test_a_batch_of_many_keys_is_not_one_problem(spark, monkeypatch):
    seen = []
    whole = suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda contexts, length: seen.append(len(contexts)) or whole(contexts, length))
    held = {}
    monkeypatch.setattr(suffix_dedup, "stage", lambda df, name: df)

    class Rows:  # takes the function that the tasks run
        def __getattr__(self, name):
            return lambda *a, **k: held.update(expand=a[0]) or self if name == "mapInPandas" else self

        def isEmpty(self):
            return True

    suffix_dedup.solve(Rows(), 400)
    rows = [(k, c, bytes([97 + c]) * 420) for k in range(1500) for c in range(2)]
    list(held["expand"](iter([pd.DataFrame(rows, columns=["key", "ctx", "data"])])))
    assert sum(seen) == 3000 and max(seen) < suffix_dedup.PROBLEM + suffix_dedup.GROUP
