"""News of aliases that many symbols share: matches as by a scan of each title, without a shuffle of links."""

import datetime
import random

import pytest

from pitlens.operators import news
from pitlens.plans import catalog

SF = "/root/testdata/sf0.001"


def test_candidates_of_shared_and_own_phrases(spark):
    rnd = random.Random(5)
    words = ["ALFA", "BETA", "GAMMA", "DELTA", "S1", "S2", "S3", "S4", "LONGER WORDS", "ALFA BETA"]
    refs = [(f"S{i}", rnd.sample(words, rnd.randint(0, 5)), rnd.random() < 0.7, rnd.random() < 0.8) for i in range(12)]
    titles = [(i, " - ".join(rnd.choice(words).lower() for _ in range(rnd.randint(0, 5)))) for i in range(150)] + [(3, "alfa beta and s5"), (3, "Delta"), (200, None), (201, "")]
    want = {}
    for raw_id, title in titles:
        text = f" {(title or '').upper().replace(' - ', ' ')} "
        for symbol, aliases, by_symbol, by_name in refs:
            found = [(-1.0, -1, symbol, "symbol")] * by_symbol + [(-0.9 if len(a) >= 8 else -0.75, i, a, "alias") for i, a in enumerate(aliases) if by_name and len(a) >= 4]
            for f in found:
                if f" {f[2]} " in text:
                    want[raw_id, symbol] = min(want.get((raw_id, symbol), f), f)
    articles = spark.createDataFrame(titles, "raw_id long, title string")
    references = spark.createDataFrame(refs, "symbol string, aliases array<string>, symbol_match_enabled boolean, name_match_enabled boolean")
    got = news.news_candidates(articles, references).collect()
    assert {(r.raw_id, r.symbol): (-r.match_score, r.matched_text, r.match_type) for r in got} == {k: (v[0], v[2], v[3]) for k, v in want.items()}
    assert len(got) == len(want) > 100


@pytest.fixture(scope="module")
def shared_aliases(spark, tmp_path_factory):
    """(folder, links): 5,000 articles, of which each names 200 of 600 symbols."""
    path, start = tmp_path_factory.mktemp("shared-aliases"), datetime.datetime(2024, 1, 1)
    of = lambda name: spark.read.parquet(f"{SF}/{name}.parquet").schema
    spark.createDataFrame([(k, f"Supplier#{k}", 0, 1.0) for k in range(600)], of("supplier")).write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(i, start + datetime.timedelta(minutes=8 * i), 1000 + i % 10, "view", 1.0, "") for i in range(5000)], of("events")).write.parquet(f"{path}/events.parquet")
    return str(path), 5000 * 200


@pytest.mark.parametrize("name", ["N1_news_candidates", "N6_news_features_daily"])
def test_links_are_not_shuffled(spark, shared_aliases, name):
    path, links = shared_aliases
    context = spark.sparkContext._jsc.sc()

    def stages():
        """Rows shuffled by each stage."""
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = max(stages(), default=-1)
    # the tables are large ones' stand-ins, which aren't sent whole
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES[name](spark, path)
        df.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(n for stage, n in stages().items() if stage > before) < links / 2
    counted = df.count() if name.startswith("N1") else df.selectExpr("sum(article_count)").first()[0]
    assert links / 2 < counted <= links and (counted == links or name.startswith("N6"))
