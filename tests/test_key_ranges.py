"""The plan of a partitioned database read: ranges from counts, predicates, and what is asked of the source."""

import random
from collections import Counter
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from govlens.sources import jdbc
from govlens.sources.key_ranges import balanced_ranges, predicates


def counter(keys, asked=None):
    def counts(low, high, step):
        if asked is not None:
            asked.append((low, high, step))
        return dict(Counter((k - low) // step for k in keys if low <= k < high))
    return counts


def met(predicate, k):
    if predicate.endswith("IS NULL"):
        return k is None
    return k is not None and (predicate.endswith("IS NOT NULL") or all(
        k >= int(c.split(">= ")[1]) if ">=" in c else k < int(c.split("< ")[1]) for c in predicate.split(" AND ")))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-10 ** 12, 10 ** 12) | st.integers(0, 50), min_size=1, max_size=80), st.integers(1, 12), st.integers(2, 9))
def test_every_row_is_read_once_and_ranges_are_even(keys, parts, steps):
    ranges = balanced_ranges(min(keys), max(keys), len(keys), counter(keys), parts, steps)
    share = -(-len(keys) // parts)
    held = Counter(keys)
    sizes = [sum(n for k, n in held.items() if a <= k < b) for a, b in ranges]
    assert ranges[0][0] == min(keys) and ranges[-1][1] == max(keys) + 1
    assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:])) and sum(sizes) == len(keys)
    assert all(n <= share or b - a == 1 for (a, b), n in zip(ranges, sizes))
    assert all(x + y > share for x, y in zip(sizes, sizes[1:]))           # neighbours are joined
    plan = predicates("k", ranges, True)
    assert all(sum(met(p, k) for p in plan) == 1 for k in [*keys, None, min(keys) - 5, max(keys) + 5])


def test_skewed_keys():
    rng = random.Random(1)
    keys = [rng.randrange(1000) for _ in range(6000)] + [10 ** 15 + rng.randrange(100) for _ in range(3000)] + [77] * 4500
    asked = []
    ranges = balanced_ranges(min(keys), max(keys), len(keys), counter(keys, asked), 9)
    held = [sum(a <= k < b for k in keys) for a, b in ranges]
    share = -(-len(keys) // 9)
    assert [h for h in held if h > share] == [sum(k == 77 for k in keys)]       # only the hot key, alone
    assert len(ranges) <= 2 * 9 + 1 and len(asked) < 20


def test_predicates_without_keys():
    assert predicates("k", [], True) == ["k IS NULL"] and predicates("k", [], False) == ["1 = 1"]
    assert predicates("k", [(3, 4)], False) == ["k IS NOT NULL"]


def test_read_plans_its_own_ranges(spark):
    keys = [1, 2, 3, 4, 100, 200, 300, 400]
    seen = {"queries": []}

    class Reader:
        def format(self, f):
            return self

        def options(self, **kw):
            assert kw["url"] == "jdbc:x" and kw["user"] == "u" and "dbtable" not in kw
            seen["queries"].append(kw["query"])
            return self

        def load(self):
            q = seen["queries"][-1]
            if "MIN(" in q:
                rows = [(min(keys), max(keys), len(keys), len(keys) + 1)]
            else:
                low, high = (int(q.split(x)[1].split()[0]) for x in ("k >= ", "k < "))
                step = int(q.split("/ ")[1].split(")")[0])
                rows = list(counter(keys)(low, high, step).items())
            return SimpleNamespace(collect=lambda: rows)

        def jdbc(self, url, table, predicates, properties):
            seen.update(url=url, table=table, predicates=predicates, properties=properties)
            return spark.createDataFrame([(1, 2, 3)], "k int, b int, c int")

    out = jdbc.read_jdbc(SimpleNamespace(read=Reader()), ["k", "b"], url="jdbc:x", table="t", user="u", partition_column="k", num_partitions=2)
    assert out.columns == ["k", "b"]
    assert seen["table"] == "t" and seen["properties"] == {"fetchsize": "10000", "user": "u"}
    plan = seen["predicates"]
    assert len(plan) == 3 and plan[-1] == "k IS NULL"
    assert [sum(met(p, k) for k in keys) for p in plan] == [4, 4, 0]
    assert seen["queries"][0] == "SELECT MIN(k) AS low, MAX(k) AS high, COUNT(k) AS n, COUNT(*) AS total FROM t"
    with pytest.raises(ValueError):
        jdbc.read_jdbc(SimpleNamespace(read=Reader()), url="jdbc:x", table="t", user="u", partition_column="k")
