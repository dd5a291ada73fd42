"""Joins without pairs against brute force: dominance, the bitemporal join, trailing sums and best identities."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitlens.operators import filings, joins
from pitlens.operators.dominance import dominance

D = dt.date
day = lambda i: D(2020, 1, 1) + dt.timedelta(i)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("n,span", [(0, 5), (1, 5), (40, 4), (333, 60), (700, 100_000)])
def test_dominance_equals_brute_force(spark, n, span):
    draw = random.Random(n)
    some = lambda: None if draw.random() < 0.05 else draw.randrange(span)
    points = [(draw.choice(["a", "a", "b", None]), some(), some(), draw.choice([None, *range(-9, 9)])) for _ in range(n)]
    asks = [(draw.choice(["a", "b", "c", None]), some(), some(), i % 7) for i in range(200)]
    asks += asks[:20]
    p, q = spark.createDataFrame(points, "k string, x long, y long, v long"), spark.createDataFrame(asks, "k string, x long, y long, w long")
    got = rows(dominance(p, q, ["k"], {"s": (F.sum, "v"), "hi": (F.max, "v"), "lo": (F.min, "v"), "w2": (F.max, "y")}))
    want = []
    for k, x, y, w in asks:
        fits = [f for f in points if None not in (k, x, y, *f[:3]) and f[0] == k and f[1] <= x and f[2] <= y]
        v = [f[3] for f in fits if f[3] is not None]
        want.append((k, x, y, w, sum(v) if v else None, max(v, default=None), min(v, default=None), max((f[2] for f in fits), default=None)))
    assert got == sorted(want, key=str)


def test_dominance_rows_are_linear_log(spark):
    """20,000 facts of one key, known early and dated late, and as many questions: no stage makes more than n log n rows."""
    n = 20_000
    right = spark.range(n).selectExpr("'K' as k", "date_add(date'2000-01-01', cast(id as int)) as at", "timestamp(date_add(date'1990-01-01', cast(id * 7919 % 20000 as int))) as known", "id as v")
    left = spark.range(n).selectExpr("'K' as k", "date_add(date'2000-01-01', cast(id * 31 % 20000 as int)) as day", "timestamp(date_add(date'1990-01-01', cast(id as int))) as seen")
    out = joins.asof_bitemporal(left, right, "k", "day", "seen", "at", "known")
    got = {(r["day"], r["seen"]): r["v"] for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(got) == n
    facts = sorted((i * 7919 % n, i) for i in range(n))
    known, at = [k for k, _ in facts], [v for _, v in facts]
    for j in range(0, n, 997):
        fits = [v for k, v in zip(known, at) if k <= j and v <= j * 31 % n]
        assert got[day_of(2000, j * 31 % n), dt.datetime.combine(day_of(1990, j), dt.time())] == max(fits, default=None)


def day_of(year, i):
    return D(year, 1, 1) + dt.timedelta(i)


@pytest.mark.parametrize("days", [370, 10])
def test_trailing_sums_equal_pairs(spark, days):
    draw = random.Random(days)
    data = [(draw.choice(["A", "B", None]), None if draw.random() < 0.05 else day(draw.randrange(1500) - 700), None if draw.random() < 0.05 else dt.datetime(2020, 1, 1) + dt.timedelta(draw.randrange(40)), draw.choice([None, 1.0, 2.5, 1e12]), draw.choice([None, 4])) for _ in range(300)]
    data += data[:25]
    df = spark.createDataFrame(data, "k string, p date, t timestamp, v double, w long")
    got = rows(joins.trailing_sums(df, "k", "p", "t", ["v", "w"], days))
    want = []
    for k, p, t, v, w in data:
        if None not in (k, p, t):
            fits = [r for r in data if None not in r[:3] and r[0] == k and r[2] <= t and p - dt.timedelta(days) < r[1] <= p]
            total = lambda i: sum(r[i] for r in fits if r[i] is not None) if any(r[i] is not None for r in fits) else None  # noqa: E731, B023
            want.append((k, p, t, v, w, total(3), total(4)))
    assert got == sorted(want, key=str)
    pairs = joins.trailing_self(df, "k", "p", "t", days).groupBy("a.k", "a.p", "a.t").agg(F.count("*").alias("n"))
    count = {}
    for k, p, t, *_ in data:
        if None not in (k, p, t):
            count[k, p, t] = count.get((k, p, t), 0) + sum(None not in r[:3] and r[0] == k and r[2] <= t and p - dt.timedelta(days) < r[1] <= p for r in data)
    assert {tuple(r)[:3]: r["n"] for r in pairs.collect()} == count


def test_ttm_of_restatements(spark):
    t = lambda i: dt.datetime(2024, 1, i)
    data = [("A", "1", D(2023, 3, 31), t(1), 10.0, 5.0), ("A", "1", D(2023, 6, 30), t(2), 20.0, 6.0), ("A", "1", D(2023, 3, 31), t(3), 11.0, 7.0), ("A", "1", D(2022, 3, 26), t(1), 99.0, 8.0), ("A", "1", D(2024, 3, 30), t(4), 1.0, None)]
    df = spark.createDataFrame([(*r, None, None, None, None, None) for r in data], "company_id string, cik string, period_end_date date, available_at timestamp, revenue double, assets double, net_income double, operating_cash_flow double, liabilities double, equity double, shares_outstanding double")
    got = {(r.period_end_date, r.available_at): (r.revenue, r.assets, r.net_income) for r in filings.fundamental_ttm(df).collect()}
    assert got == {(D(2023, 3, 31), t(1)): (10.0, 5.0, None), (D(2023, 6, 30), t(2)): (30.0, 6.0, None), (D(2023, 3, 31), t(3)): (21.0, 7.0, None), (D(2022, 3, 26), t(1)): (99.0, 8.0, None), (D(2024, 3, 30), t(4)): (42.0, None, None)}
    newest = {(r.period_end_date, r.available_at): r.revenue for r in filings.fundamental_ttm(df, latest_only=True).collect()}
    assert newest[D(2024, 3, 30), t(4)] == 32.0 and len(newest) == 4


def test_best_identity_keeps_repeated_rows(spark):
    draw = random.Random(3)
    some = lambda: None if draw.random() < 0.1 else day(draw.randrange(60))
    left = [(draw.choice(["A", "B", None]), some(), i % 3) for i in range(150)]
    left += left[:30] + [left[0]] * 3
    hist = [(draw.choice(["A", "B", None]), some(), some(), draw.randrange(4)) for _ in range(80)]
    df, h = spark.createDataFrame(left, "s string, d date, v long"), spark.createDataFrame(hist, "s string, effective_from date, effective_to date, q long")
    got = rows(joins.best_identity(df, h, "s", "d", [F.col("h_q").desc(), F.col("h_effective_from").asc()]))
    want = []
    last = D(9999, 12, 31)
    for s, d, v in left:
        fits = [r for r in hist if None not in (s, d, r[0], r[1]) and r[0] == s and r[1] <= d <= (r[2] or last)]
        best = min(fits, key=lambda r: (-r[3], r[1], r[2] or last), default=(None,) * 4)
        want.append((s, d, v, *best))
    assert got == sorted(want, key=str) and len(got) == len(left)
