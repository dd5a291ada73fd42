"""Single rules on rows made by hand, and invariants."""

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from pitlens.operators import aggregates, backtest, clean, features, filings, joins, labels, news, prices, shorts, universe
from pitlens.sources import readers, sinks
from pitlens.streaming import incremental

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def bars(spark, closes, symbol="A"):
    start = D(2024, 1, 1)
    return spark.createDataFrame([(symbol, start + dt.timedelta(i), float(c), float(c) + 1, float(c) - 1, float(c), 100) for i, c in enumerate(closes)], "symbol string, bar_date date, adj_open double, adj_high double, adj_low double, adj_close double, volume long")


@pytest.fixture(scope="module")
def instruments(spark):
    return spark.createDataFrame([("A", "I1", "C1")], "symbol string, instrument_id string, company_id string")


def test_classification(spark):
    names = [("Apple Inc.", "Common Stock"), ("SPDR S&P 500 ETF Trust", "ETF"), ("Alibaba ADR", None), ("X Preferred", None), ("Y Warrant", None), ("Z Rights", None), ("W Units", None), (None, None)]
    df = spark.createDataFrame(names, "n string, t string").withColumns(clean.classify_security(F.col("n"), F.col("t")))
    assert [r.security_type for r in df.collect()] == ["COMMON_STOCK", "ETF", "ADR", "PREFERRED", "WARRANT", "RIGHT", "UNIT", "COMMON_STOCK"]
    df = df.withColumn("x", clean.inclusion_reason(F.lit("NASDAQ"), allow_adr=False))
    assert [r.x for r in df.collect()] == [None, "etf_excluded", "adr_excluded", "preferred_excluded", "warrant_excluded", "right_excluded", "unit_excluded", None]


def test_exchange_and_names(spark):
    df = spark.createDataFrame([("nasdaqgs", "Apple, Inc."), ("NYSE-American", "Alibaba Group Holding Ltd ADR"), (" ", "Microsoft Corporation"), ("foo", "X HOLDINGS INC CORP")], "e string, n string")
    got = df.select(clean.normalize_exchange(F.col("e")).alias("e"), clean.generate_aliases(F.col("n")).alias("a")).collect()
    assert [r.e for r in got] == ["NASDAQ", "NYSE_AMERICAN", None, "foo".upper()]
    assert got[0].a == ["APPLE INC", "APPLE"] and "ALIBABA" in got[1].a and "MICROSOFT" in got[2].a and got[3].a[1] == "X"


def test_bars_are_normalized(spark):
    schema = "symbol string, open double, high double, low double, close double, volume long"
    df = spark.createDataFrame([("AAPL", 210.0, 213.0, 209.0, 212.0, 100), ("OTCM", 1.0, 1.0, 1.0, 1.0, 1), ("AAPL", 10.0, 9.0, 11.0, 10.5, 1), ("MSFT", None, None, None, None, None), ("AAPL", None, None, None, 212.4, None)], schema)
    got = clean.normalize_bars(df, spark.createDataFrame([("AAPL",), ("MSFT",)], "symbol string")).where("accepted")
    assert rows(got.select("open", "high", "low", "close", "volume"), "close") == [(210.0, 213.0, 209.0, 212.0, 100), (212.4, 212.4, 212.4, 212.4, 0)]


def test_rsi_edges(spark, instruments):
    flat = features.momentum(bars(spark, [5] * 20), instruments)
    rising = features.momentum(bars(spark, range(1, 21)), instruments)
    assert {r.rsi_14 for r in flat.collect()} == {None, 50.0}
    assert {r.rsi_14 for r in rising.collect()} == {None, 100.0}
    assert flat.where("rsi_14 is not null").count() == 6


def test_zero_close_and_single_bar(spark, instruments):
    got = features.momentum(bars(spark, [0, 5]), instruments).orderBy("as_of_date").collect()
    assert [r.returns_1d for r in got] == [None, None] and [r.returns_log_1d for r in got] == [None, None]
    one = features.research_features(*(f(bars(spark, [3]), instruments) for f in (features.momentum, features.trend, features.volatility))).collect()
    assert len(one) == 1 and one[0].sma_20 is None and one[0].short_volume_ratio is None


def test_features_never_look_ahead(spark, instruments):
    closes = [100 + 10 * math.sin(i) + i % 7 for i in range(80)]
    for make in (features.momentum, features.trend, features.volatility):
        whole = make(bars(spark, closes), instruments).where("as_of_date <= date'2024-02-20'")
        cut = make(bars(spark, closes).where("bar_date <= date'2024-02-20'"), instruments)
        assert rows(whole, "as_of_date") == rows(cut, "as_of_date")


def test_labels(spark):
    got = rows(labels.research_labels(bars(spark, [100, 110, 121]), (1,)).select("as_of_date", F.round("return_fwd_1d", 6), "target_up_1d"), "as_of_date")
    assert [g[1:] for g in got] == [(0.1, 1), (0.1, 1), (None, None)]


def test_asof_ignores_the_future(spark):
    left = spark.createDataFrame([("A", D(2024, 1, 1)), ("A", D(2025, 2, 1)), ("B", D(2025, 2, 1)), ("A", None)], "k string, d date")
    right = spark.createDataFrame([("A", D(2025, 1, 1), 1.0), ("A", D(2025, 1, 1), 2.0), ("A", D(2026, 1, 1), 3.0), ("A", None, 9.0)], "k string, t date, v double")
    got = joins.asof(left, right, ["k"], "d", "t", ["v"])
    assert sorted((r.k, str(r.d), r.v) for r in got.collect()) == [("A", "2024-01-01", None), ("A", "2025-02-01", 2.0), ("A", "None", None), ("B", "2025-02-01", None)]


def test_interval_ends(spark):
    left = spark.createDataFrame([("A", D(2024, 1, i)) for i in (1, 2, 3)], "symbol string, d date")
    half = spark.createDataFrame([("A", D(2024, 1, 1), D(2024, 1, 3))], "symbol string, effective_from date, effective_to date")
    assert joins.interval_membership(left, half, "symbol", "d").count() == 2
    point = spark.createDataFrame([("A", D(2024, 1, 1), D(2024, 1, 1))], "symbol string, effective_from date, effective_to date")
    assert joins.interval_membership(left, point, "symbol", "d").count() == 0
    closed = joins.best_identity(left, half, "symbol", "d", [F.col("h_effective_from").desc()])
    assert closed.where("h_effective_from is not null").count() == 3


def test_news_opens_at_half_past_nine(spark):
    times = ["2024-01-05 09:29:59", "2024-01-05 09:30:00", "2024-01-06 08:00:00", "2024-01-09 10:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "raw_id long, t string").withColumn("published_at", F.to_timestamp("t"))
    calendar = spark.createDataFrame([(D(2024, 1, d),) for d in (4, 5, 8, 9)], "bar_date date")
    got = rows(joins.next_trading_day(df, calendar, "published_at").select("raw_id", "effective_date"), "raw_id")
    assert [g[1] for g in got] == [D(2024, 1, 5), D(2024, 1, 8), D(2024, 1, 8), None]


def test_news_candidates(spark):
    articles = spark.createDataFrame([(1001, "Apple launches new enterprise AI tooling for developers"), (1002, "MSFT and Microsoft expand cloud agreements"), (1004, "ETF flows accelerate as broad market rally continues")], "raw_id long, title string")
    refs = spark.createDataFrame([("AAPL", ["APPLE"]), ("MSFT", ["MICROSOFT"]), ("F", ["CLOUD"])], "symbol string, aliases array<string>")
    got = rows(news.news_candidates(articles, refs), "raw_id", "symbol")
    assert got == [(1001, "AAPL", "alias", 0.75, "APPLE"), (1002, "F", "alias", 0.75, "CLOUD"), (1002, "MSFT", "symbol", 1.0, "MSFT")]


def test_short_interest(spark):
    schema = "symbol string, settlement_date date, short_interest long, previous_short_interest long, avg_daily_volume double, shares_float long, source_market string, source_file string, ingested_at timestamp"
    df = spark.createDataFrame([("aapl ", D(2026, 2, 28), 12000000, 11000000, 48000000.0, 15000000000, "regular", "reg.csv", dt.datetime(2026, 3, 1)), ("AAPL", D(2026, 2, 28), 1, 1, 0.0, 0, "regular", "reg.csv", dt.datetime(2026, 2, 1)), (" ", D(2026, 2, 28), 1, 1, 1.0, 1, "otc", "x", None)], schema)
    got = shorts.short_interest_history(df).collect()
    assert len(got) == 1 and got[0].days_to_cover == 0.25 and got[0].short_interest_pct_float == 0.0008
    assert clean.market_selection(df, "BOTH").count() == 3 and clean.market_selection(df, "no").count() == 0


def test_refreshed_short_features_equal_a_full_build(spark):
    n = 140
    daily = spark.range(n).select(F.lit("A").alias("symbol"), F.expr("date_add(date'2024-01-01', cast(id as int))").alias("as_of_date"), (F.col("id") % 13 * 1.0).alias("short_volume"), F.lit(0.0).alias("short_exempt_volume"), F.lit(20.0).alias("total_volume"), F.expr("timestamp(date_add(date'2024-01-02', cast(id as int)))").alias("max_source_available_at"))
    history = spark.range(8).select(F.lit("A").alias("symbol"), F.expr("date_add(date'2024-01-01', cast(id as int) * 15)").alias("settlement_date"), F.expr("timestamp(date_add(date'2024-01-03', cast(id as int) * 15))").alias("ingested_at"), (F.col("id") * 7 + 3).alias("short_interest"), (F.col("id") + 1).alias("previous_short_interest"), F.lit(2.0).alias("avg_daily_volume"), (F.col("id") * 1.5).alias("days_to_cover"), F.lit(9).cast("long").alias("shares_float"), F.lit(0.1).alias("short_interest_pct_float"))
    whole = shorts.short_features(shorts.short_rolling(daily), history).where("as_of_date >= date'2024-04-10'")
    part = shorts.refresh_features(daily, history, "2024-04-10")
    assert rows(whole.select(part.columns), "as_of_date") == rows(part, "as_of_date")


def observed(spark, data):
    return spark.createDataFrame([(s, c, n, e, t, D(2024, m, 1)) for s, c, n, e, t, m in data], "symbol string, cik string, company_name string, exchange string, security_type string, as_of_date date")


def test_listing_history(spark):
    base = [("Z", "0", "Z", "NYSE", "C", m) for m in range(1, 9)]
    moves = [("A", "1", "A", "NYSE", "C", 1), ("B", "1", "A", "NYSE", "C", 2), ("B", "1", "A", "NASDAQ", "C", 3), ("B", "1", "A", "NASDAQ", "C", 5), ("B", "1", "A", "NASDAQ", "C", 8)]
    got = universe.listing_history(observed(spark, base + moves)).where("identity = 'CIK:1'").orderBy("version").select("symbol", "exchange", "effective_from", "effective_to").collect()
    # one missed snapshot (April) closes nothing, two (June and July) close in July, and August opens anew
    assert [tuple(g) for g in got] == [("A", "NYSE", D(2024, 1, 1), D(2024, 2, 1)), ("B", "NYSE", D(2024, 2, 1), D(2024, 3, 1)), ("B", "NASDAQ", D(2024, 3, 1), D(2024, 7, 1)), ("B", "NASDAQ", D(2024, 8, 1), None)]


def test_universe_fixture(spark):
    data = [("AAPL", "Apple Inc.", "320193", "NASDAQGS", "Common Stock", "sec_tickers"), ("AAPL", "Apple Inc. duplicate worse row", None, "OTCQX", "Common Stock", "otc"), ("SPY", "SPDR S&P 500 ETF Trust", None, "NYSEARCA", "ETF", "etf")]
    df = spark.createDataFrame(data, "symbol string, company_name string, cik string, exchange_raw string, security_type_raw string, source_name string")
    got = {r.symbol: r for r in universe.market_universe(df).collect()}
    assert got["AAPL"].include_in_universe and got["AAPL"].cik == "0000320193" and got["SPY"].exclusion_reason == "etf_excluded"
    assert universe.market_universe_conflicts(universe.market_universe(df)).count() == 1
    assert universe.resolve_candidates(df).where("candidate_rank = 2").count() == 1


def test_signal_backtest_by_hand(spark):
    df = spark.createDataFrame([("A", D(2026, 3, 10), "train", 0.6, 0.01), ("A", D(2026, 3, 11), "valid", 0.4, -0.02), ("A", D(2026, 3, 12), "test", 0.7, 0.03)], "symbol string, as_of_date date, partition_name string, v double, fwd_return_1d double")
    got = backtest.signal_backtest(df.withColumn("signal_value", backtest.signal_short_ratio(F.col("v"), 0.5)))
    assert {r.partition_name: (round(r.net_return, 6), r.turnover) for r in got.collect()} == {"train": (0.009, 1.0), "valid": (-0.001, 1.0), "test": (0.029, 1.0)}


def test_dates_with_few_names_are_skipped(spark):
    df = spark.range(99).select(F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("symbol"), F.when(F.col("id") < 49, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date").alias("as_of_date"), F.col("id").cast("double").alias("score"), (F.col("id") / 100).alias("target_return"))
    got = backtest.decile_long_short(df).collect()
    assert len(got) == 1 and got[0].as_of_date == D(2024, 1, 2) and got[0].long == pytest.approx(0.96) and got[0].short == pytest.approx(0.51)


def test_portfolio_turnover_counts_exits(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "A", 1.0), (D(2024, 1, 2), "B", 1.0)], "as_of_date date, symbol string, weight double")
    assert [r.turnover for r in backtest._turnover(df).orderBy("as_of_date").collect()] == [1.0, 2.0]


def test_sinks_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = sinks.upsert_by_key(old, new, ["k"])
    assert rows(once, "k") == rows(sinks.upsert_by_key(once, new, ["k"]), "k") == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(sinks.append_dedup(old, new, ["k"]), "k") == [(3, "d")]


def test_watermark_never_moves_back(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5))], "id int, t timestamp")
    state = spark.createDataFrame([(dt.datetime(2024, 2, 1),)], "watermark timestamp")
    assert incremental.incremental_rows(df, state, "t").count() == 0
    assert incremental.advance_watermark(df, state, "t").first().watermark == dt.datetime(2024, 2, 1)
    empty = spark.createDataFrame([(None,)], "watermark timestamp")
    assert incremental.incremental_rows(df, empty, "t").count() == 2
    assert incremental.advance_watermark(df, empty, "t").first().watermark == dt.datetime(2024, 1, 5)


def test_short_volume_layouts(spark, tmp_path):
    files = {"CNMSshvol20240105.txt": "Date|Symbol|ShortVolume|TotalVolume|Market\n20240104|A|1|9|q\n", "b20240106.txt": "Date|Symbol|ShortVolume|ShortExemptVolume|TotalVolume|Market\n20240105|A|1|2|9|q\n", "c20240107.txt": "Date|Symbol|ShortExemptVolume|ShortVolume|TotalVolume|Market\n20240106|A|2|1|9|q\n", "d20240108.txt": "20240107|a|2|1|9|q\nbad|x|1|2|3|q\n", "e20240109.txt": "0\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = readers.read_daily_short_volume(spark, str(tmp_path)).select("trade_date", "symbol", "short_volume", "short_exempt_volume", "total_volume", "publication_date")
    assert rows(got, "trade_date") == [(D(2024, 1, 4), "A", 1.0, None, 9.0, D(2024, 1, 5)), (D(2024, 1, 5), "A", 1.0, 2.0, 9.0, D(2024, 1, 6)), (D(2024, 1, 6), "A", 1.0, 2.0, 9.0, D(2024, 1, 7)), (D(2024, 1, 7), "A", 1.0, 2.0, 9.0, D(2024, 1, 8))]


def test_signature(spark):
    df = spark.createDataFrame([("A", D(2026, 3, 17)), ("A", D(2026, 3, 18))], "symbol string, date date")
    got = aggregates.table_signature(df, "t").first()
    assert (got.row_count, got.min_date, got.max_date) == (2, D(2026, 3, 17), D(2026, 3, 18))
    assert aggregates.changed_sources(aggregates.table_signature(df, "t"), aggregates.table_signature(df, "t")).count() == 0
    assert {r.error for r in aggregates.snapshot_manifest({"t": df}, ["t", "u"]).collect()} == {None, "missing_table"}


def test_ratios_of_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0, 2.0, 0.0)], "net_income double, revenue double, liabilities double, equity double, assets double")
    got = filings.fundamental_ratios(df).first()
    assert (got.net_margin, got.debt_to_equity, got.return_on_assets) == (None, 0.5, None)


def test_price_flags(spark):
    rows = [("A", D(2024, 1, 1), 1.0, 2.0, 10.0, 5), ("A", D(2024, 1, 2), 3.0, 2.0, 20.0, -1), ("A", D(2024, 1, 3), 1.0, 2.0, -1.0, 5), ("A", D(2024, 1, 4), 1.0, 2.0, 9.0, 5)]
    df = spark.createDataFrame(rows, "symbol string, price_date date, low double, high double, close double, volume long").withColumn("source_name", F.lit("x"))
    got = [(r.price_date.day, r.flag_type, r.flag_value) for r in prices.price_quality_flags(df).collect()]
    # the return on the fourth day has no positive close before it
    assert sorted(got) == [(2, "raw_return_abs_gt_80pct", 1.0), (2, "volume_negative", -1.0), (3, "close_nonpositive", -1.0), (3, "raw_return_abs_gt_80pct", 1.05)]
    assert sorted((r.price_date.day, r.flag_type) for r in prices.bar_flags(df).collect()) == [(2, "high_below_low"), (2, "negative_volume")]


def test_counter_counts_every_failure(spark):
    time = dt.datetime
    old = spark.createDataFrame([("A", 2, time(2024, 1, 1), time(2024, 1, 2)), ("C", 1, time(2024, 1, 1), time(2024, 1, 1))], "k string, failure_count long, first_seen_at timestamp, last_seen_at timestamp")
    seen = spark.createDataFrame([("A", time(2024, 1, d)) for d in (5, 6, 7)] + [("B", time(2024, 1, 4))], "k string, seen_at timestamp")
    got = {r.k: (r.failure_count, r.first_seen_at.day, r.last_seen_at.day) for r in sinks.merge_counter(old, seen, ["k"]).collect()}
    assert got == {"A": (5, 1, 7), "B": (1, 4, 4), "C": (1, 1, 1)}


def test_a_batch_handed_over_again_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    rows = lambda *x: spark.createDataFrame(list(x), "id long, v string")
    for batch in (rows((1, "a"), (2, "a")), rows((2, "b"), (3, "b"), (3, "b")), rows((2, "b"), (3, "b"), (3, "b"))):
        sinks.upsert_batch(batch, path, ["id"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "b")]


def test_aliases_of_many_words_match(spark):
    articles = spark.createDataFrame([(1, "The Very Long Company Name of America rises"), (2, None), (3, "  ")], "raw_id long, title string")
    refs = spark.createDataFrame([("VLC", ["very long company name of america", "long company"])], "symbol string, aliases array<string>")
    assert [(r.raw_id, r.symbol, r.matched_text, r.match_score) for r in news.news_candidates(articles, refs).collect()] == [(1, "VLC", "VERY LONG COMPANY NAME OF AMERICA", 0.9)]
    assert news.news_candidates(articles, refs.limit(0)).count() == 0


def test_instruments_keep_what_is_known(spark):
    df = spark.createDataFrame([(" a", D(2024, 1, 1)), ("A", D(2024, 3, 1)), ("B", D(2024, 1, 5)), ("C", D(2024, 1, 6))], "symbol string, price_date date")
    known = spark.createDataFrame([("b", "INST:9", "NYSE", True), ("C", "INST:8", None, None)], "symbol string, instrument_id string, exchange string, is_active boolean")
    master = universe.instrument_master(df, known)
    got = {r.symbol: (r.instrument_id, r.exchange, r.is_active) for r in master.collect()}
    assert got == {"A": ("INST:" + hashlib.md5(b"A").hexdigest()[:16], "UNKNOWN", True), "B": ("INST:9", "NYSE", True), "C": ("INST:8", "UNKNOWN", False)}
    assert {(r.symbol, r.valid_from.day, r.valid_to) for r in universe.ticker_history(master).collect()} == {("A", 1, None), ("B", 5, None), ("C", 6, None)}
    assert {(r.identifier_type, r.identifier_value) for r in universe.identifier_map(master).collect()} == {("ticker", x) for x in "ABC"}


def test_daily_features_in_one_pass_equal_the_joined_groups(spark):
    rows = [("A", D(2024, 1, 1) + dt.timedelta(i), 10.0 + i % 7, 12.0 + i % 5, None if i % 4 == 0 else 9.0, 11.0 + i % 3, 5) for i in range(90)]
    df = spark.createDataFrame(rows, "symbol string, bar_date date, adj_open double, adj_high double, adj_low double, adj_close double, volume long")
    names = spark.createDataFrame([("A", "I", "C")], "symbol string, instrument_id string, company_id string")
    one = features.research_features_daily(df, names).orderBy("as_of_date").collect()
    joined = features.research_features(*(f(df, names) for f in (features.momentum, features.trend, features.volatility))).orderBy("as_of_date").collect()
    assert [r.asDict() for r in one] == [r.asDict() for r in joined] and one[80].volatility_20d is None and one[81].volatility_20d is not None


def test_bitemporal_join_equals_pairing(spark):
    left = spark.range(400).selectExpr("case when id % 17 = 0 then null else concat('K', id % 3) end as k", "case when id % 19 = 0 then null else date_add(date'2024-01-01', cast(id * 7 % 60 as int)) end as day", "case when id % 23 = 0 then null else timestamp(date_add(date'2024-01-05', cast(id * 11 % 50 as int))) end as seen", "id % 5 as v")
    left = left.union(left.limit(30))
    right = spark.range(90).selectExpr("case when id % 13 = 0 then null else concat('K', id % 4) end as k", "case when id % 29 = 0 then null else date_add(date'2024-01-01', cast(id * 5 % 60 as int)) end as at", "case when id % 31 = 0 then null else timestamp(date_add(date'2024-01-01', cast(id * 13 % 60 as int))) end as known", "id % 7 as v")
    got = sorted(map(tuple, joins.asof_bitemporal(left, right, "k", "day", "seen", "at", "known").collect()), key=str)
    facts, want = [tuple(r) for r in right.collect()], []
    for k, day, seen, v in map(tuple, left.collect()):
        fits = [f for f in facts if None not in (k, day, seen, *f[:3]) and f[0] == k and f[1] <= day and f[2] <= seen]
        best = max(fits, key=lambda f: f[1:], default=(None,) * 4)
        want.append((k, day, seen, v, *best[1:]))
    assert got == sorted(want, key=str) and sum(w[4] is not None for w in want) > 100


def test_aliases_change_with_the_name(spark):
    schema = "symbol string, cik string, company_name string, exchange string, security_type string, as_of_date date"
    data = [("A", "1", "Acme Corp.", "NYSE", "C", D(2024, 1, 1)), ("A", "1", "ACME CORP", "NYSE", "C", D(2024, 2, 1)), ("A", "1", "Acme Tools Ltd", "NYSE", "C", D(2024, 3, 1)), ("B", None, None, "NYSE", "C", D(2024, 1, 1))]
    got = universe.reference_history(spark.createDataFrame(data, schema)).orderBy("identity", "version").select("symbol", "aliases_json", "effective_from", "effective_to", "is_active").collect()
    assert [tuple(g) for g in got] == [
        ("A", '["ACME CORP","ACME"]', D(2024, 1, 1), D(2024, 3, 1), False),
        ("A", '["ACME TOOLS LTD","ACME TOOLS"]', D(2024, 3, 1), None, True),
        ("B", "[]", D(2024, 1, 1), None, True),
    ]


def test_memberships_take_the_first_identifier(spark):
    base = "symbol string, effective_from date, effective_to date, "
    d = D(2024, 2, 1)
    mu = spark.createDataFrame([(x, d, d, x != "C", "ok" if x == "A" else None) for x in (" a", "A", "B", "C", "D", "E")] + [("", d, d, True, None), ("F", None, d, True, None)], base + "eligible_flag boolean, eligible_reason string")
    refs = spark.createDataFrame([("B", None, None, "c2", " "), ("B", D(2024, 1, 1), None, None, "co2"), ("C", D(2024, 3, 1), None, "c3", "late"), ("D", D(2024, 1, 1), d, "c4", None)], base + "cik string, company_id string")
    ls = spark.createDataFrame([("D", D(2024, 1, 1), None, "co4", "l4"), ("E", None, None, "", "l5")], base + "company_id string, listing_id string")
    got = universe.membership_history(mu, refs, ls).orderBy("symbol", "reason").select("symbol", "instrument_id", "company_id", "membership_status", "reason").collect()
    seen = "OBSERVED_IN_MARKET_UNIVERSE_HISTORY"
    assert [tuple(g) for g in got] == [("A", "A", None, "ACTIVE", seen), ("A", "A", None, "ACTIVE", "ok"), ("B", "co2", "co2", "ACTIVE", seen), ("C", "C", None, "INACTIVE", "NOT_ELIGIBLE_IN_MARKET_UNIVERSE_HISTORY"), ("D", "co4", "co4", "ACTIVE", seen), ("E", "l5", None, "ACTIVE", seen)]


def test_events_and_audit_rows_are_appended_once(spark):
    schema = "symbol string, event_type string, event_date date, old_value string, new_value string, source_name string"
    e = spark.createDataFrame([("A", "RENAMED", D(2024, 1, 1), "x", "y", "list"), ("A", "RENAMED", D(2024, 1, 1), "x", None, "list"), ("A", "RENAMED", None, "x", "y", "list")], schema)
    first = universe.event_history_append(None, e.limit(1))
    assert universe.event_history_append(first, e.union(e)).count() == 2
    audit = universe.audit_append(universe.audit_append(None, universe.event_audit(e)), universe.event_audit(e.union(e)))
    assert audit.count() == 2 and {r.entity_key for r in audit.collect()} == {"A|RENAMED|2024-01-01"}


def test_counts_of_loaded_files_are_refreshed(spark):
    schema = "source_file string, publication_date date, market_code string"
    counts = spark.createDataFrame([("a", D(2024, 1, 1), "Q", 5), ("b", D(2024, 1, 2), "Q", 9)], schema + ", row_count long")
    rows = spark.createDataFrame([("b", D(2024, 1, 2), "Q")] * 2 + [("c", None, None)], schema)
    assert sorted((r[0], r[3]) for r in readers.refresh_file_counts(counts, rows).collect()) == [("a", 5), ("b", 2), ("c", 1)]


def test_titles_meet_phrases_of_any_length(spark):
    """Phrases that are prefixes of others, one of 50 words, and titles that break off, against a scan of every title for every phrase."""
    import random

    draw = random.Random(7)
    long = [f"W{i % 9}" for i in range(50)]
    phrases = {" ".join(draw.choice("ABC") for _ in range(draw.randrange(1, 7))) for _ in range(60)} | {" ".join(long), " ".join(long[:17]), "W0 W1", "zz top"}
    titles = [" ".join(draw.choice("ABCD") for _ in range(draw.randrange(0, 15))) for _ in range(120)] + ["x " + " ".join(long).lower() + "!", " ".join(long[:49]), " ".join(long[3:] + long), "ZZ-Top", None, "", "..."]
    articles = spark.createDataFrame(list(enumerate(titles)), "raw_id long, title string")
    refs = spark.createDataFrame([(f"S{i % 40}", p) for i, p in enumerate(sorted(phrases))], "symbol string, phrase string")
    plain = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.upper()).split())} "
    want = {(i, f"S{j % 40}", plain(p).strip()) for i, t in enumerate(titles) for j, p in enumerate(sorted(phrases)) if t and plain(p) in plain(t)}
    got = [tuple(r) for r in joins.alias_text_match(articles, refs).collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(len(m.split()) == 50 for *_, m in want)
    assert joins.alias_text_match(articles, refs.limit(0)).count() == 0


def test_longer_phrases_make_no_more_rows(spark):
    """One phrase of 64 words beside 50 short ones: positions are tried a logarithm of times, not once a length."""
    from pitlens.operators.joins import phrase_hits

    articles = spark.range(50).select(F.col("id").alias("raw_id"), F.concat_ws(" ", *(F.lit(f"t{i}") for i in range(200))).alias("title"))
    short = [(f"T{i}",) for i in range(50)]
    long = " ".join(f"T{i}" for i in range(100, 164))
    hits = phrase_hits(articles, spark.createDataFrame([*short, (long,)], "gram string"))
    assert hits.count() == 50 * 51
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 20


def test_first_of_equal_scores_and_flags_of_matches(spark):
    articles = spark.createDataFrame([(1001, "Apple launches new enterprise AI tooling for developers"), (1002, "Microsoft Corporation expands: MSFT cloud"), (1003, "BRK.B and ab rise"), (1004, "ETF flows accelerate as broad market rally continues")], "raw_id long, title string")
    data = [("AAPL", ["APPLE", "APPLE LAUNCHES", "APPLE LAUNCHES NEW"], True, True), ("MSFT", ["MICROSOFT", "MICROSOFT CORPORATION"], False, True), ("BRK.B", ["RISE"], True, False), ("AB", ["AND", "rise!"], True, True), ("B", ["b--"], True, None), ("ETF", None, None, True)]
    refs = spark.createDataFrame(data, "symbol string, aliases array<string>, symbol_match_enabled boolean, name_match_enabled boolean")
    got = {tuple(r) for r in news.news_candidates(articles, refs).collect()}
    assert got == {(1001, "AAPL", "alias", 0.9, "APPLE LAUNCHES"), (1002, "MSFT", "alias", 0.9, "MICROSOFT"), (1003, "AB", "symbol", 1.0, "AB")}
    everything = {tuple(r)[:3] for r in news.news_candidates(articles, refs.drop("symbol_match_enabled", "name_match_enabled")).collect()}
    assert everything == {(1001, "AAPL", "alias"), (1002, "MSFT", "symbol"), (1003, "AB", "symbol"), (1003, "BRK.B", "alias"), (1004, "ETF", "symbol")}
