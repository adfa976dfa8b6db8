import datetime as dt
import random

import pytest

from ledgerlens.operators.sequence import hot_keys, next_event, thin_recent

SCHEMA = "k string, t timestamp_ntz, id long, price double"
BASE = dt.datetime(2020, 1, 1)


def brute_thin(rows, days):
    kept, by_key = set(), {}
    for k, t, i, _ in rows:
        if k is None:
            continue
        if t is None:
            kept.add(i)
        else:
            by_key.setdefault(k, []).append((t, i))
    for items in by_key.values():
        items.sort()
        while items:
            run = [x for x in items if (x[0] - items[0][0]).days <= days]
            kept.add(run[-1][1])
            items = items[len(run):]
    return kept


def random_rows(seed, n, step_hours):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["hot"] * 6 + ["a", "b", "c", "d", None])
        t = BASE + dt.timedelta(hours=step_hours * rng.randrange(700))
        if rng.random() < 0.03:
            t = None
        rows.append((key, t, i, float(i)))
    return rows


def test_thinning_edges(spark):
    def at(d, h=0):
        return BASE + dt.timedelta(days=d, hours=h)

    rows = [
        ("gap0", at(0), 1, 1.0), ("gap0", at(0), 2, 1.0),
        ("gap30", at(0), 3, 1.0), ("gap30", at(30), 4, 1.0),
        ("gap31", at(0), 5, 1.0), ("gap31", at(31), 6, 1.0),
        ("chain", at(0), 7, 1.0), ("chain", at(20), 8, 1.0), ("chain", at(40), 9, 1.0),
        ("hours", at(0), 10, 1.0), ("hours", at(30, 23), 11, 1.0),
        ("nodate", None, 12, 1.0), ("nodate", None, 13, 1.0), (None, at(0), 14, 1.0),
    ]
    out = thin_recent(spark.createDataFrame(rows, SCHEMA), "k", "t", "id")
    assert {r.id for r in out.collect()} == {2, 4, 5, 6, 8, 9, 11, 12, 13}


@pytest.mark.parametrize("hot_rows", [10**9, 50])
@pytest.mark.parametrize("step_hours,days", [(24, 30), (7, 30), (24, 0)])
def test_thinning_matches_loop(spark, hot_rows, step_hours, days):
    rows = random_rows(step_hours * 100 + days, 500, step_hours)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = thin_recent(df, "k", "t", "id", days=days, hot_rows=hot_rows)
    assert out.columns == df.columns
    got = [r.id for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_thin(rows, days)


@pytest.mark.parametrize("hot_rows", [10**9, 50])
def test_next_event_matches_loop(spark, hot_rows):
    rows = random_rows(5, 600, 24)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = next_event(df, "k", "t", "id", {"next_id": "id", "next_price": "price"}, hot_rows)
    got = {r.id: (r.purchase_no, r.purchase_count, r.has_next, r.next_id) for r in out.collect()}
    want, by_key = {}, {}
    for k, t, i, _ in rows:
        if k is not None:
            by_key.setdefault(k, []).append((t is None, t or BASE, i))
    for items in by_key.values():
        items.sort()
        for n, (_, _, i) in enumerate(items):
            nxt = items[n + 1][2] if n + 1 < len(items) else None
            want[i] = (n + 1, len(items), nxt is not None, nxt)
    assert got == want


def test_usual_path_has_one_exchange_and_no_python(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = thin_recent(o, "o_custkey", "o_orderdate", "o_orderkey")._jdf.queryExecution().toString()
    assert "Python" not in plan
    nxt = next_event(o, "o_custkey", "o_orderdate", "o_orderkey", {"n": "o_orderkey"})
    physical = nxt._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1


def test_sampled_count_finds_the_hot_key(spark):
    rows = spark.range(40_000).selectExpr("if(id % 3 = 0, -1, id) as k", "id")
    hot = hot_keys(rows, "k", hot_rows=5_000)
    assert [r.k for r in hot.collect()] == [-1]
    assert hot_keys(rows.where("k <> -1"), "k", hot_rows=5_000) is None
    assert hot_keys(rows, "k", hot_rows=None) is None


@pytest.mark.parametrize("step_hours,days", [(24, 30), (7, 2)])
def test_thinning_keeps_the_same_rows_of_repeated_ids(spark, step_hours, days):
    rng = random.Random(days)
    rows = [(k, t, i % 150, rng.choice([None, 1.0, 2.0])) for k, t, i, _ in random_rows(9, 900, step_hours)]
    rows += rows[:100]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    ways = [sorted(map(str, thin_recent(df, "k", "t", ids, days, hot_rows=n).collect())) for n in (10**9, 20) for ids in ("id", ["id", "price"])]
    assert all(w == ways[0] for w in ways)
    runs = 0
    for key in {r[0] for r in rows} - {None}:
        times = sorted(r[1] for r in rows if r[0] == key and r[1] is not None)
        while times:
            times = [t for t in times if (t - times[0]).days > days]
            runs += 1
    assert len(ways[0]) == runs + sum(r[0] is not None and r[1] is None for r in rows)


def test_rounds_of_hot_keys_grow_with_the_logarithm(spark, monkeypatch):
    from ledgerlens.operators import sequence

    seen = []
    real = sequence.stage
    monkeypatch.setattr(sequence, "stage", lambda df, label="stage": seen.append(label) or real(df, label))
    rows = [("hot", BASE + dt.timedelta(days=40 * i), i, 1.0) for i in range(300)]
    out = thin_recent(spark.createDataFrame(rows, SCHEMA), "k", "t", "id", hot_rows=10)
    assert out.count() == 300
    assert seen.count("jumps") <= 10 and seen.count("to-thin") == 1
