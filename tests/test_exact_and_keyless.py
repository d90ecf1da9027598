"""Exact-n over repeated ids, ids of keyless rows, records in blocks."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.sampling import Selection, sample_exact_n
from corpusmill.sources import records
from corpusmill.sources.scan import content_key

IDS = "source string, sample_id string, text string"


@pytest.mark.parametrize("texts", [1, 7, 100])
def test_exact_n_of_one_repeated_id(spark, texts):
    df = spark.createDataFrame([("a", "a/1", f"t{i % texts}") for i in range(100)], IDS)
    got, report = sample_exact_n(df.repartition(7), {"a": 50})
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == 50 and report == {"a": (100, 50)}
    assert all(n <= 100 // texts + 1 for n in Counter(rows).values())  # no row more often than it stands there
    again, _ = sample_exact_n(df.repartition(3), {"a": 50})
    assert sorted(rows) == sorted(tuple(r) for r in again.collect())


def test_exact_n_with_all_some_and_no_equal_ids_at_the_threshold(spark):
    rows = [("a", f"a/{i // 3}", f"t{i}") for i in range(60)] + [("b", f"b/{i}", "t") for i in range(40)]
    df = spark.createDataFrame(rows, IDS)
    everything = Counter(map(tuple, rows))
    for n in (2, 3, 29):
        got, _ = sample_exact_n(df, {"a": n, "b": 10})
        found = Counter(tuple(r) for r in got.collect())
        assert sum(k for r, k in found.items() if r[0] == "a") == n and sum(k for r, k in found.items() if r[0] == "b") == 10
        assert not found - everything
        ids = Counter(r[1] for r in found.elements() if r[0] == "a")
        assert sorted(ids.values())[1:] == [3] * (len(ids) - 1)  # only the threshold's id is cut


def test_no_text_moves_where_ids_are_unique(spark):
    df = spark.createDataFrame([("a", f"a/{i}", "t" * 50) for i in range(100)], IDS)
    picked = Selection(df, {"a": 50}, 42, "sample").rows(df)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and picked.count() == 50


def test_null_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("a", "a/1", None)] * 4 + [("a", "a/1", "x")] * 2, IDS)
    assert sample_exact_n(df, {"a": 3})[0].count() == 3
    assert sample_exact_n(spark.createDataFrame([], IDS), {"a": 3})[0].count() == 0


def keys(df):
    return sorted((r["_row_key"], r["v"], r["w"]) for r in content_key(df).collect())


def test_keyless_ids_do_not_depend_on_partitions(spark, monkeypatch):
    rows = [("hot", None)] * 500 + [(f"v{i % 40}", i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "v string, w int")
    plain = keys(df)
    assert len(plain) == len({k for k, _, _ in plain}) == 800
    assert Counter((v, w) for _, v, w in plain) == Counter(rows)
    # behind shuffles that AQE coalesces, read by partitions in another order
    behind = df.repartition(13).unionByName(df.limit(0)).sort(F.rand(5)).repartition(5, "w")
    assert keys(behind) == plain
    monkeypatch.setattr("corpusmill.sources.scan.COPIES_PER_TASK", 64)
    assert keys(df) == plain  # a hot row is put out by several tasks
    assert keys(df.limit(0)) == []


def brute_exchanges(rows):
    out, by = [], {}
    for k, *rest in rows:
        by.setdefault(k, []).append(rest)
    for k, turns in by.items():
        system = None if k is None else min(((t, x) for t, r, x in turns if r == "system" and t is not None), default=None)
        head = system and system[1]
        for t, role, x in turns:
            at = lambda n, want: [y for u, r, y in turns if k is not None and t is not None and u == t + n and r == want]
            if role == "user":
                out += [(k, t, head, x, y) for y in at(1, "assistant") or [None]]
            elif role == "assistant":
                out += [] if at(-1, "user") else [(k, t, head, None, x)]
            elif role != "system":
                out.append((k, t, head, x, None))
            elif not (system and t == system[0] and len(turns) > 1):
                out.append((k, t, head if x is None else x, None, None))
    return Counter(out)


@pytest.mark.parametrize("block", [2, 64])
def test_exchanges_equal_pair_by_pair(spark, monkeypatch, block):
    monkeypatch.setattr(records, "EXCHANGE_BLOCK", block)
    rng = random.Random(block)
    rows = []
    for k in [*range(12), None]:
        turns = list(range(rng.choice([1, 2, 5, 9, 150])))
        rng.shuffle(turns)
        rows += [(k, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), f"{k}-{t}") for t in turns]
    rows += [(1, 0, "user", "again"), (1, 1, "assistant", "again"), (2, None, "user", "no turn"), (3, 10 ** 9, "user", "far"), (4, -1, "user", "before"),
             (5, 7000, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = records.exchanges(df.repartition(5))
    assert Counter((r.conv_id, r.turn, r.system, r.question, r.reply) for r in got.collect()) == brute_exchanges(rows)
    assert records.exchanges(df.limit(0)).collect() == []


def test_exchanges_move_each_text_once(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn int, role string, text string")
    plan = records.exchanges(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan") <= 2
    # the other exchange holds system texts alone, one for each conversation
    assert plan.count("Exchange hashpartitioning") == 2
