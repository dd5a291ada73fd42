"""Point-in-time joins: as-of, interval, next trading day, anti and merge joins.

The as-of joins run on one time axis: both sides are united, sorted by key and time, and the last right row
is carried along a window. That costs one shuffle and is linear, where a range join would pair each left row with all of its past.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import stored
from .dominance import dominance


def asof(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, order: list[str] = [], prefix: str = "") -> DataFrame:
    """Each left row with the latest right row of its key whose `right_time` is not later (J3). Ties go to the highest `order`, nulls lowest.
    Left rows without a match keep nulls; right rows without time or key never match."""
    payload = [c for c in right.columns if c not in keys]
    tie = F.struct(*(F.col(c) for c in order)) if order else F.lit(0)
    best = right.where(F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max_by(F.struct(*payload), tie).alias("_right"))
    rows = left.withColumns({"_t": F.col(left_time), "_left": F.struct(*left.columns)}).select(*keys, "_t", "_left").unionByName(best, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col("_t").asc_nulls_first(), F.col("_left").isNotNull().asc()).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_right", F.last("_right", ignorenulls=True).over(w)).where(F.col("_left").isNotNull())
    matched = F.col("_t").isNotNull()
    return found.select("_left.*", *(F.when(matched, F.col("_right").getField(c)).alias(prefix + c) for c in payload))


def asof_bitemporal(left: DataFrame, right: DataFrame, key: str, left_time: str, left_known: str, right_time: str, right_known: str, placed: bool = False) -> DataFrame:
    """The latest right row by (`right_time`, `right_known`), then its other columns in their order, with both times not later than the left
    row's. Left rows without a match stay.

    Along the axis of knowledge the latest right row known by then is carried. It is the answer unless its own time is still to come; for such left
    rows the latest is found in blocks of right rows (`dominance`), so no left row meets all of its key's past.

    `placed`: left rows lie by `key` already, as after a window over it. Then right rows are brought to them, left rows aren't shuffled, and the result lies by `key` too.
    """
    payload = [c for c in right.columns if c != key]
    rank = F.struct(F.col(right_time).alias("_time"), F.col(right_known).alias("_since"), *(F.col(c).alias(f"_o{i}") for i, c in enumerate(payload)))
    facts = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull() & F.col(right_known).isNotNull()).select(F.col(key).alias("_key"), F.col(right_known).cast("timestamp").alias("_known"), rank.alias("_right"))
    facts = facts.repartition("_key") if placed else facts
    others = [c for c in left.columns if c != key]
    rows = left.select(F.col(key).alias("_key"), F.col(left_known).cast("timestamp").alias("_known"), F.col(left_time).alias("_at"), F.struct(*others).alias("_left"))
    w = Window.partitionBy("_key").orderBy(F.col("_known").asc_nulls_first(), F.col("_left").isNotNull().asc())
    carried = rows.unionByName(facts, allowMissingColumns=True).withColumns({"_best": F.max("_right").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_n": F.row_number().over(w)}).where("_left is not null")
    ahead = F.coalesce(F.col("_best._time") > F.col("_at"), F.lit(False))
    ready = carried.where(~ahead).select("_key", "_left", F.when(F.col("_at").isNotNull() & F.col("_key").isNotNull(), F.col("_best")).alias("_best"))
    points = facts.select("_key", F.col("_known").alias("x"), F.col("_right._time").alias("y"), "_right")
    late = carried.where(ahead).select("_key", F.col("_known").alias("x"), F.col("_at").alias("y"), "_left")
    paired = dominance(points, late, ["_key"], {"_best": (F.max, "_right")}).select("_key", "_left", "_best")
    found = ready.union(paired.repartition("_key") if placed else paired)
    return found.select(*(F.col("_key").alias(c) if c == key else F.col("_left").getField(c).alias(c) for c in left.columns), *(F.col(f"_best._o{i}").alias(f"r_{c}" if c in left.columns else c) for i, c in enumerate(payload)))


def interval_membership(left: DataFrame, intervals: DataFrame, key: str, date: str) -> DataFrame:
    """Left rows of which a half-open interval [effective_from, effective_to) of the key covers the date; a null end is open. One row each."""
    r = intervals.select(F.col(key).alias("_k"), F.col("effective_from").alias("_a"), F.coalesce("effective_to", F.lit("9999-12-31").cast("date")).alias("_b"))
    return left.join(r, (F.col(key) == F.col("_k")) & (F.col("_a") <= F.col(date)) & (F.col(date) < F.col("_b")), "left_semi")


def trailing_self(rows: DataFrame, key: str, period: str, known: str, days: int = 370) -> DataFrame:
    """Each row with the rows of its key known by then and of a period in the `days` days up to its own. Columns of the two are a.* and b.*.

    Periods fall into spans of `days` days, and a row can only meet those of its own span and of the one before, so rows are joined by key and span. The pairs are the result; sums over
    them need none (`trailing_sums`)."""
    span = F.floor(F.unix_date(F.col(period).cast("date")) / days)
    a = rows.withColumn("_span", span).alias("a")
    b = rows.withColumn("_span", F.explode(F.array(span, span + 1))).alias("b")
    near = (F.col("b._span") == F.col("a._span")) & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    cond = near & (F.col(f"b.{known}") <= F.col(f"a.{known}")) & (F.col(f"b.{period}") <= F.col(f"a.{period}")) & (F.col(f"b.{period}") > F.date_sub(F.col(f"a.{period}"), days))
    return a.join(b, cond)


def trailing_sums(rows: DataFrame, key: str, period: str, known: str, measures: list[str], days: int = 370) -> DataFrame:
    """The rows that have key, period and knowledge, with the sum_ of each measure over the rows that `trailing_self` pairs them with; null if all of them are.

    The `days` days up to a row's period are the start of its own span of `days` days and the end of the one before. Each is a sum of what was known by then and lies on one side of
    a period, which `dominance` finds without pairs; nothing is subtracted, so no large old value costs digits of a small new one.
    """
    day = F.unix_date(F.col(period).cast("date"))
    span = F.floor(day / days)
    named = rows.where(F.col(key).isNotNull() & F.col(period).isNotNull() & F.col(known).isNotNull()).withColumns({"_day": day, "_span": span})
    # part 0 asks for periods up to the row's, part 1 for those from its first day on, counted backwards
    first = F.col("_day") - (days - 1)
    sides = lambda *parts: F.explode(F.array(*(F.struct(F.lit(i).alias("_part"), s.alias("_of"), y.alias("_y")) for i, (s, y) in enumerate(parts)))).alias("_side")
    spread = lambda df, side, *more: df.select(*more, side).select(*more, "_side.*").withColumn("_x", F.col("_since"))
    data = named.select(F.col(key).alias("_key"), F.col(known).alias("_since"), "_day", "_span", *measures)
    points = spread(data, sides((F.col("_span"), F.col("_day")), (F.col("_span"), -F.col("_day"))), "_key", "_since", *measures)
    # repeated rows ask once
    asks = named.groupBy(*rows.columns, "_day", "_span").agg(F.count("*").alias("_times"))
    asks = asks.select(F.col(key).alias("_key"), F.col(known).alias("_since"), "_day", "_span", F.struct(*rows.columns).alias("_whole"), "_times")
    asks = spread(asks, sides((F.col("_span"), F.col("_day")), (F.col("_span") - 1, -first)), "_key", "_since", "_whole", "_times")
    found = dominance(points, asks, ["_key", "_part", "_of"], {f"sum_{m}": (F.sum, m) for m in measures}, "_x", "_y")
    summed = found.groupBy("_whole", "_times").agg(*(F.sum(f"sum_{m}").alias(f"sum_{m}") for m in measures))
    return summed.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select("_whole.*", *(f"sum_{m}" for m in measures))


def next_trading_day(rows: DataFrame, calendar: DataFrame, time: str, open_at: str = "09:30:00", out: str = "effective_date") -> DataFrame:
    """The first calendar day (bar_date) on or after the date if the time of day is before `open_at`, else after it; null beyond the calendar.

    Only the distinct dates are matched, by a window over them and the calendar, and joined back.
    """
    day = F.to_date(time)
    first = F.when(F.date_format(time, "HH:mm:ss") < open_at, day).otherwise(F.date_add(day, 1))
    rows = rows.withColumn("_from", first)
    marks = rows.select(F.col("_from").alias("d"), F.lit(None).cast("date").alias("bar")).distinct().union(calendar.select(F.col("bar_date"), F.col("bar_date")).distinct())
    w = Window.orderBy(F.col("d").desc_nulls_last(), F.col("bar").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    dates = marks.withColumn(out, F.last("bar", ignorenulls=True).over(w)).where("bar is null").select(F.col("d").alias("_d"), out)
    return rows.join(dates, F.col("_from") == F.col("_d"), "left").drop("_from", "_d")


def best_identity(rows: DataFrame, history: DataFrame, key: str, date: str, preference: list[Column]) -> DataFrame:
    """Per row the preferred history row of the key whose closed interval holds the date; rows without one stay, and so do repeated rows. `preference` orders history
    columns (prefixed h_); ties beyond it are broken by all of them. A null start holds nothing, a null end is open.

    Within its key the history is ranked once. An interval holds a date if it starts no later and, counted backwards, ends no later either, so the least rank is found
    by `dominance`, however many intervals of the key overlap.
    """
    h = history.select(*(F.col(c).alias(f"h_{c}") for c in history.columns))
    ties = [F.col(c).asc_nulls_last() for c in h.columns]
    rank = F.row_number().over(Window.partitionBy(f"h_{key}").orderBy(*preference, *ties))
    # days before the end of time, so that they fall as dates rise
    left = lambda c: F.datediff(F.lit("9999-12-31").cast("date"), c)
    points = h.withColumn("_rank", rank).select(F.col(f"h_{key}").alias("_key"), F.col("h_effective_from").cast("date").alias("x"), left(F.coalesce("h_effective_to", F.lit("9999-12-31").cast("date"))).alias("y"), F.struct("_rank", *h.columns).alias("_best"))
    asked = rows.select(F.col(key).alias("_key"), F.col(date).cast("date").alias("x"), left(F.col(date)).alias("y"), F.struct(*rows.columns).alias("_whole"))
    found = dominance(points, asked, ["_key"], {"_best": (F.min, "_best")})
    return found.select("_whole.*", *(F.col(f"_best.{c}").alias(c) for c in h.columns))


def anti_missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows whose key the right side lacks."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def not_exists_insert(existing: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """Stage rows whose key, nulls equal, isn't there yet."""
    e = existing.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return stage.join(e, cond, "left_anti")


def semi_allowed(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows of symbols that the universe includes."""
    return rows.join(universe.where("include_in_universe").select("symbol").distinct(), "symbol", "left_semi")


def label_join(features: DataFrame, labels: DataFrame, keys: list[str], optional: bool = False) -> DataFrame:
    """Features with their labels; without labels the row goes, or stays with nulls if they are optional."""
    return features.join(labels, keys, "left" if optional else "inner")


def overlap_floor(rows: DataFrame, watermark: DataFrame, time: str, days: int) -> DataFrame:
    """Rows not older than `days` before the one-row frame's watermark; all, if that is null."""
    floor = F.date_sub(F.to_date("watermark"), days)
    return rows.crossJoin(F.broadcast(watermark.limit(1))).where(F.col("watermark").isNull() | (F.to_date(time) >= floor)).drop("watermark")


def plain_words(text: Column) -> Column:
    """Upper case, with one space for everything but letters and digits."""
    return F.trim(F.regexp_replace(F.upper(text), "[^A-Z0-9]+", " "))


def phrase_trie(phrases: DataFrame) -> DataFrame:
    """The nodes of the trie of `phrases` (gram: words parted by one space): prefix, depth (its words), ends (numbers of its first words that are a phrase, rising)."""
    whole = phrases.select("gram").distinct()
    words = whole.select("gram", F.split("gram", " ").alias("_w"))
    chains = words.select("gram", F.explode(F.transform(F.sequence(F.lit(1), F.size("_w")), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice("_w", F.lit(1), n), " ").alias("prefix")))).alias("_p")).select("gram", "_p.*")
    marked = chains.join(whole.select(F.col("gram").alias("prefix"), F.lit(True).alias("_end")), "prefix", "left")
    w = Window.partitionBy("gram").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("ends", F.collect_list(F.when(F.col("_end"), F.col("depth"))).over(w))
    return marked.dropDuplicates(["prefix"]).select("prefix", "depth", "ends")


def phrase_hits(articles: DataFrame, phrases: DataFrame) -> DataFrame:
    """raw_id, gram: the `phrases` (gram) that stand as whole words in the title of each of `articles` (raw_id, title); distinct.

    A phrase has all its prefixes in the trie, so the longest one that starts at a word is found by bisection over its length: each step is a join by equality, as
    many as the logarithm of the longest phrase. Only words that start some phrase take part, and the node found knows the phrases on its way. Rows grow with
    titles' words and with matches, not with the length of the longest phrase. Titles of the same words are searched once.
    """
    grams = phrases.select("gram").where("gram != ''")
    # one row
    longest = grams.agg(F.max(F.size(F.split("gram", " ")))).first()[0]
    titles = articles.select("raw_id", plain_words(F.col("title")).alias("_text")).where("_text != ''")
    if longest is None:
        return titles.select("raw_id", F.col("_text").alias("gram")).limit(0)
    nodes = stored(phrase_trie(grams), "trie")
    first = nodes.where("depth = 1").select(F.col("prefix").alias("_word"))
    spots = titles.select("_text").distinct().select("_text", F.posexplode(F.split("_text", " ")).alias("_i", "_word")).join(first, "_word")
    rest = spots.select("_text", F.slice(F.split("_text", " "), F.col("_i") + 1, longest).alias("_rest"), F.lit(1).alias("_n"))
    at = lambda n: F.array_join(F.slice("_rest", F.lit(1), n), " ")
    step = 1 << max((longest - 1).bit_length() - 1, 0)
    while step and longest > 1:
        further = F.col("_n") + step
        # a title too short for the step looks for what no prefix is
        rest = rest.withColumn("_try", F.when(further <= F.size("_rest"), at(further)).otherwise(F.concat(F.lit("-"), F.col("_text"))))
        rest = rest.join(nodes.select(F.col("prefix").alias("_try"), F.col("depth").alias("_d")), "_try", "left").select("_text", "_rest", F.coalesce("_d", "_n").alias("_n"))
        step //= 2
    found = rest.withColumn("prefix", at(F.col("_n"))).join(nodes.select("prefix", "ends"), "prefix").where(F.size("ends") > 0)
    return titles.join(found.select("_text", F.explode(F.transform("ends", at)).alias("gram")).distinct(), "_text").select("raw_id", "gram").distinct()


def alias_text_match(articles: DataFrame, references: DataFrame) -> DataFrame:
    """Articles (raw_id, title) with references (symbol, phrase) whose phrase stands in the title as whole words, however many (`phrase_hits`)."""
    phrases = references.select("symbol", plain_words(F.col("phrase")).alias("gram")).where("gram != ''").distinct()
    return phrase_hits(articles, phrases).join(phrases, "gram").select("raw_id", "symbol", F.col("gram").alias("matched_text"))


def merge_features_outer(technical: DataFrame, shorts: DataFrame, news: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """All (instrument_id, as_of_date) of technical, short and news rows, the first non-empty symbol and company winning;
    fundamentals only add to rows that are there, by (company_id, as_of_date)."""
    key = ["instrument_id", "as_of_date"]
    out = None
    for i, df in enumerate((technical, shorts, news)):
        part = df.withColumnsRenamed({c: f"{c}_{i}" for c in ("symbol", "company_id")})
        out = part if out is None else out.join(part, key, "full_outer")
    first = lambda c: F.coalesce(*(F.nullif(F.col(f"{c}_{i}"), F.lit("")) for i in range(3))).alias(c)
    rest = [c for c in out.columns if not c.startswith(("symbol_", "company_id_")) and c not in key]
    return out.select(*key, first("symbol"), first("company_id"), *rest).join(fundamentals, ["company_id", "as_of_date"], "left")
