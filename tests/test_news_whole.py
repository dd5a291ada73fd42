"""News over every symbol and alias, shared ones included, against a scan of each title for each phrase."""

from collections import Counter, defaultdict

import pytest

from pitlens.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def matches(spark):
    """(raw_id, symbol): best score."""
    suppliers = [r[0] for r in spark.read.parquet(f"{SF}/supplier.parquet").select("s_suppkey").collect()]
    shared = {0: "value click", 1: "view", 2: "and"}
    best = {}
    for raw_id, user, kind in spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "event_type").collect():
        title = f" STORY ABOUT S{user} AND VALUE {kind.upper()} "
        for k in suppliers:
            aliases = [a for a in (shared[k % 3], f"s{k} and", f"Story about S{k} and value") if len(a) >= 4]
            scores = [1.0] * (f" S{k} " in title) + [0.9 if len(a) >= 8 else 0.75 for a in aliases if f" {a.upper()} " in title]
            if scores:
                best[raw_id, f"S{k}"] = max(scores)
    return best


def test_candidates_of_every_symbol_and_alias(spark, matches):
    got = {(r.raw_id, r.symbol): r.match_score for r in catalog.QUERIES["N1_news_candidates"](spark, SF).collect()}
    assert got == matches and len(got) > spark.read.parquet(f"{SF}/events.parquet").count()


@pytest.fixture(scope="module")
def linked(spark, matches):
    """(raw_id, instrument_id, effective_date, window_end, score, title) of each match with an instrument."""
    days = sorted({r[0] for r in spark.read.parquet(f"{SF}/events.parquet").selectExpr("date(ts)").collect() if r[0].day % 7 not in (6, 0)})
    events = {r[0]: (r[1], (r[2], r[3])) for r in spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "date_add(date(ts), if(date_format(ts, 'HH:mm:ss') < '09:30:00', 0, 1))", "user_id", "event_type").collect()}
    out = []
    for (raw_id, symbol), score in matches.items():
        if int(symbol[1:]) % 11:
            day, title = events[raw_id]
            later = [d for d in days if d >= day][:2] + [None, None]
            out.append((raw_id, f"INST:{symbol[1:]}", later[0], later[1], score, title))
    return out


def test_links_of_every_effective_date(spark, linked):
    got = {r.effective_date: r.n for r in catalog.QUERIES["N4_news_effective_date"](spark, SF).collect()}
    assert got == Counter(x[2] for x in linked)


def test_links_of_every_window(spark, linked):
    got = {(r.effective_date, r.window_end): r.n for r in catalog.QUERIES["N5_news_event_windows"](spark, SF).collect()}
    assert got == Counter(x[2:4] for x in linked)


def test_features_of_every_instrument_and_date(spark, linked):
    want = defaultdict(list)
    for x in linked:
        if x[2]:
            want[x[1], x[2]].append(x)
    got = {(r.instrument_id, r.effective_date): (r.article_count, r.cluster_count, r.avg_confidence) for r in catalog.QUERIES["N6_news_features_daily"](spark, SF).collect()}
    assert got.keys() == want.keys()
    for k, rows in want.items():
        assert got[k] == (len(rows), len({x[5] for x in rows}), pytest.approx(sum(x[4] for x in rows) / len(rows), abs=1e-6))


def test_articles_and_clusters_of_every_date(spark, linked):
    articles, clusters = Counter(x[2] for x in linked if x[2]), defaultdict(set)
    for x in linked:
        clusters[x[2], x[1]].add(x[5])
    got = {r.effective_date: (r.articles, r.clusters) for r in catalog.QUERIES["A6_news_daily"](spark, SF).collect()}
    assert got == {d: (n, max(len(c) for (e, _), c in clusters.items() if e == d)) for d, n in articles.items()}
