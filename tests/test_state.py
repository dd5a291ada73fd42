"""Tables that are kept up: listing history from single snapshots, upserts, and writers that die midway."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitlens.functions import shared
from pitlens.operators import listing_state as ls
from pitlens.operators import shorts, universe
from pitlens.sources import readers, sinks

D = dt.date
SCHEMA = "symbol string, cik string, company_name string, exchange string, security_type string, as_of_date date"


def rows(df):
    return sorted(map(str, df.collect()))


def versions(df):
    return rows(df.select("identity", "version", "symbol", "exchange", "security_type", "company_name", "cik", "effective_from", "last_seen", "effective_to", "is_active"))


def snapshots(seed, n_dates, n_names):
    """Random sightings with gaps, changes, several listings of one company, and names without a CIK."""
    draw, out = random.Random(seed), []
    for i in range(n_names):
        cik = None if i % 5 == 0 else str(i - i % 3)
        for t in range(n_dates):
            if draw.random() < (0.4 if i % 5 == 0 else 0.7):
                out.append((f"S{i}", cik, f"Name {i}{'!' if draw.random() < 0.3 else ''}", draw.choice(["NYSE", "NYSE", "NYSE", "OTC", None]), "COMMON", D(2024, 1, 1) + dt.timedelta(7 * t)))
    return out


@pytest.mark.parametrize("seed,grace", [(1, 2), (2, 1), (3, 2)])
def test_snapshots_one_by_one_in_any_order_equal_the_whole(spark, seed, grace):
    data = snapshots(seed, 7, 9)
    seen = spark.createDataFrame(data, SCHEMA)
    dates = sorted({r[-1] for r in data})
    random.Random(seed).shuffle(dates)
    first = seen.where(F.col("as_of_date") == dates[0])
    stretches, days = ls.listing_stretches(first, grace), first.select("as_of_date").distinct()
    for date in dates[1:]:
        new, touched, days = ls.apply_snapshot(stretches, days, seen, date, grace)
        stretches = shared.stored(stretches.join(touched, "identity", "left_anti").unionByName(new), "state")
        days = shared.stored(days, "days")
    assert rows(stretches) == rows(ls.listing_stretches(seen, grace).select(*stretches.columns))
    assert versions(ls.listing_versions(stretches, grace)) == versions(universe.listing_history(seen, grace))
    columns = ["identity", "version", "symbol", "cik", "company_name_clean", "exchange", "effective_from", "effective_to", "symbol_reference_id", "aliases_json"]
    assert rows(universe.reference_history(ls.sightings_of(stretches)).select(*columns)) == rows(universe.reference_history(seen).select(*columns))


def test_late_snapshot_splits_and_closes(spark):
    day = lambda i: D(2024, 1, i)
    seen = spark.createDataFrame([("A", "1", "A", "NYSE", "C", day(i)) for i in (1, 3, 9)] + [("B", "2", "B", "NYSE", "C", day(i)) for i in (1, 2, 3, 5, 9)] + [("C", "3", "C", "NYSE", "C", day(1))], SCHEMA)
    base = seen.where("as_of_date != date'2024-01-02' and as_of_date != date'2024-01-05'")
    state, days = ls.listing_stretches(base), base.select("as_of_date").distinct()
    got = {r.identity: (r.first_date.day, r.last_date.day, r.missing, r.gone_date and r.gone_date.day) for r in state.collect()}
    assert got == {"CIK:1": (1, 9, 0, None), "CIK:2": (1, 9, 0, None), "CIK:3": (1, 1, 2, 9)}
    new, touched, days = ls.apply_snapshot(state, days, seen, "2024-01-02")
    assert [r.identity for r in touched.orderBy("identity").collect()] == ["CIK:1", "CIK:2", "CIK:3"]
    got = sorted((r.identity, r.first_date.day, r.last_date.day, r.missing, r.gone_date and r.gone_date.day) for r in new.collect())
    assert got == [("CIK:1", 1, 1, 1, None), ("CIK:1", 3, 9, 0, None), ("CIK:2", 1, 9, 0, None), ("CIK:3", 1, 1, 2, 3)]
    # C is closed by now, so a date after that doesn't concern it
    assert {r.identity for r in ls.apply_snapshot(new, days, seen, "2024-01-05")[1].collect()} == {"CIK:1", "CIK:2"}


def test_stored_state_rewrites_touched_buckets_only(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    data = [("A", "1", "A", "NYSE", "C", D(2024, 1, 1)), ("B", "2", "B", "NYSE", "C", D(2024, 1, 1))] + [("B", "2", "B", "NYSE", "C", D(2024, 1, i)) for i in (2, 3, 4)]
    seen = spark.createDataFrame(data, SCHEMA)
    for i in (1, 2, 3):
        ls.update_state(seen, D(2024, 1, i), path)
    before = set(shared.names(spark, f"{path}/stretches"))
    # A was closed on the third, so the fourth leaves its bucket alone; merged twice, as by a writer that died before it stored the date
    for _ in range(2):
        ls.update_state(seen, D(2024, 1, 4), path)
    after = set(shared.names(spark, f"{path}/stretches"))
    assert len(before & after) >= 1 and len(after - before) == 1
    state, dates = ls.read_state(spark, path)
    assert dates.count() == 4 and versions(ls.listing_versions(state)) == versions(universe.listing_history(seen))
    # a corrected snapshot replaces the one of its date
    fixed = spark.createDataFrame([("A", "1", "A", "NYSE", "C", D(2024, 1, 2))], SCHEMA)
    ls.update_state(fixed, D(2024, 1, 2), path)
    whole = seen.where("as_of_date != date'2024-01-02'").union(fixed)
    assert versions(ls.listing_versions(ls.read_state(spark, path)[0])) == versions(universe.listing_history(whole))
    # an empty snapshot lacks them all
    ls.update_state(seen.limit(0), D(2024, 1, 5), path)
    assert {r.missing for r in ls.read_state(spark, path)[0].where("next_date is null and identity = 'CIK:2'").collect()} == {1}


def test_a_writer_that_dies_midway_keeps_the_table(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/table"
    old, new = spark.range(5), spark.range(7)
    sinks.replace_table(old, path)
    with pytest.raises(Exception):
        sinks.replace_table(new.select(F.when(F.col("id") > 3, F.raise_error(F.lit("died"))).otherwise(F.col("id")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    # dies between the two renames: the new rows were whole, so they are the table
    rename = sinks.rename
    monkeypatch.setattr(sinks, "rename", lambda s, a, b: (_ for _ in ()).throw(OSError("died")) if a.endswith("._new") else rename(s, a, b))
    with pytest.raises(OSError):
        sinks.replace_table(new, path)
    monkeypatch.setattr(sinks, "rename", rename)
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 7
    # a table that reads itself
    sinks.replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert spark.read.parquet(path).count() == 4 and not shared.exists(spark, f"{path}._old")


def table(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=str)


def test_upserts_write_what_they_touch_and_survive_a_death(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/keyed"
    batch = lambda *x: spark.createDataFrame(list(x), "k long, v string")
    sinks.upsert_batch(batch(*((i, "a") for i in range(300))), path, ["k"], stream="s", epoch=0)
    before = set(shared.names(spark, path))
    sinks.upsert_batch(batch((7, "b"), (None, "n")), path, ["k"], stream="s", epoch=1)
    after = set(shared.names(spark, path))
    assert len([n for n in after - before if n.endswith(".parquet")]) <= 2 and sinks.last_epoch(spark, path, "s") == 1
    want = sorted([(i, "b" if i == 7 else "a") for i in range(300)] + [(None, "n")], key=str)
    assert table(spark, path) == want
    # the same epoch again, an older one, and null keys
    sinks.upsert_batch(batch((7, "x")), path, ["k"], stream="s", epoch=1)
    sinks.upsert_batch(batch((7, "x")), path, ["k"], stream="s", epoch=0)
    sinks.upsert_batch(batch((None, "m")), path, ["k"], stream="other", epoch=0)
    assert table(spark, path) == sorted([*want[:-1], (None, "m")], key=str) if want[-1][0] is None else True
    assert (7, "b") in table(spark, path) and (None, "m") in table(spark, path) and (None, "n") not in table(spark, path)
    # dies after some buckets are in place: the next writer finishes the change
    rename, calls = sinks.rename, []

    def dying(s, a, b):
        calls.append(b)
        if len(calls) == 3:
            raise OSError("died")
        rename(s, a, b)

    monkeypatch.setattr(sinks, "rename", dying)
    with pytest.raises(OSError):
        sinks.upsert_batch(batch(*((i, "c") for i in range(100))), path, ["k"], stream="s", epoch=2)
    monkeypatch.setattr(sinks, "rename", rename)
    assert sinks.last_epoch(spark, path, "s") == 1
    sinks.upsert_batch(batch((0, "d")), path, ["k"], stream="s", epoch=3)
    got = dict(table(spark, path))
    assert len(got) == 301 and got[0] == "d" and {got[i] for i in range(1, 100)} == {"c"} and got[150] == "a" and sinks.last_epoch(spark, path, "s") == 3
    # dies while writing: nothing of the batch counts
    with pytest.raises(Exception):
        sinks.upsert_batch(batch((1, "e"), (2, "e")).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("died"))).otherwise(F.col("v"))), path, ["k"])
    sinks.recover_keyed(spark, path)
    assert dict(table(spark, path)) == got
    # keys of another type meet their rows
    sinks.upsert_batch(spark.createDataFrame([(3, "i")], "k int, v string"), path, ["k"])
    got[3] = "i"
    assert dict(table(spark, path)) == got and len(table(spark, path)) == 301
    # groups that go altogether
    sinks.replace_groups(batch().limit(0), path, ["k"], spark.createDataFrame([(5,), (None,)], "k long"))
    assert len(table(spark, path)) == 299


def test_late_rows_refresh_what_they_change(spark):
    draw = random.Random(11)
    start = D(2024, 1, 1)
    volume = [(f"S{i}", start + dt.timedelta(t), draw.choice([None, 5.0, 9.0]), 1.0, draw.choice([0.0, 10.0, 20.0]), dt.datetime(2024, 1, 2) + dt.timedelta(t)) for i in range(6) for t in range(120) if draw.random() < 0.8]
    daily = shared.stored(spark.createDataFrame(volume, "symbol string, as_of_date date, short_volume double, short_exempt_volume double, total_volume double, max_source_available_at timestamp"), "daily")
    facts = [(f"S{i}", start + dt.timedelta(15 * t), dt.datetime(2024, 1, 1) + dt.timedelta(15 * t + draw.randrange(40)), draw.randrange(50), 20, 3.0, float(draw.randrange(9)), 100, 0.5) for i in range(6) for t in range(8)]
    history = shared.stored(spark.createDataFrame(facts, "symbol string, settlement_date date, ingested_at timestamp, short_interest int, previous_short_interest int, avg_daily_volume double, days_to_cover double, shares_float int, short_interest_pct_float double"), "history")
    late = F.col("symbol").isin("S1", "S2") & F.col("as_of_date").isin(*(start + dt.timedelta(t) for t in (3, 4, 40, 41, 118)))
    fact = (F.col("symbol") == "S3") & (F.col("settlement_date") == start + dt.timedelta(60))
    full = lambda a, b: shorts.short_features(shorts.short_rolling(a), b)
    old = shared.stored(full(daily.where(~late), history.where(~fact)), "old")
    new, symbols = shorts.refresh_late(old, daily, history, daily.where(late), history.where(fact))
    assert {r.symbol for r in symbols.collect()} == {"S1", "S2", "S3"} and {r.symbol for r in new.select("symbol").distinct().collect()} == {"S1", "S2", "S3"}
    want = full(daily, history)
    assert rows(old.join(symbols, "symbol", "left_anti").unionByName(new).select(*want.columns)) == rows(want)
    assert rows(old.select(*want.columns)) != rows(want)
    ranges = {(r.symbol, (r.range_from - start).days) for r in shorts.late_ranges(daily, daily.where(late), history.where(fact)).collect()}
    assert len([s for s, _ in ranges if s == "S1"]) <= 3 and ("S3", 60) in ranges
    nothing, none = shorts.refresh_late(old, daily, history, daily.limit(0), history.limit(0))
    assert nothing.count() == 0 and none.count() == 0


def test_one_bad_fact_costs_itself(spark):
    good = '{"end":"2024-01-01","val":1.5,"accn":"a"}'
    text = '{"cik":1,"facts":{"us-gaap":{"Rev":{"units":{"USD":[%s,{"val":true},{"val":"x"},7,{"end":"no","val":null}],"EUR":{"a":1},"JPY":5}},"Bad":7,"B2":{"units":[1]}},"dei":null}}' % good
    df = spark.createDataFrame([(text,), ("{broken",), (None,), ("[]",), ("",), ('{"cik":2,"facts":{"t":{"C":{"units":{"U":[%s]}}}}}' % good,)], "value string")
    got = sorted(map(tuple, readers.explode_company_facts(df).collect()), key=str)
    one = ("0000000001", "us-gaap", "Rev", "USD")
    assert got == sorted([(*one, "a", D(2024, 1, 1), "1.5", 1.5), (*one, None, None, "true", None), (*one, None, None, "x", None), (*one, None, None, None, None), (*one, None, None, None, None), ("0000000002", "t", "C", "U", "a", D(2024, 1, 1), "1.5", 1.5)], key=str)
    filings = '{"cik":"5","name":"n","filings":{"recent":{"accessionNumber":["0-1","","0-2"],"form":["10-K"],"filingDate":"oops","primaryDocument":["d","d","d"]}}}'
    rows_ = readers.explode_submissions(spark.createDataFrame([(filings,), ("{",), (None,), ('{"cik":"6"}',)], "value string")).collect()
    assert {(r.cik, r.form_type, r.filing_date, r.accession_number) for r in rows_} == {("0000000005", "10-K", None, "0-1"), ("0000000005", None, None, "0-2")}
