"""Universe, identity and listing history: set-based, from all snapshots at once instead of row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import latest
from .clean import ALLOWED_VENUES, classify_security, generate_aliases, inclusion_reason, liquidity_filter, normalize_company_name, normalize_exchange, strip_company_suffixes
from .filings import pad_cik
from .joins import best_identity, interval_membership, not_exists_insert

#: Sources in the order in which their values are preferred.
SOURCES = ("sec_tickers", "nasdaq_listed")


def classify(rows: DataFrame, allow_adr: bool = True) -> DataFrame:
    """Candidates (symbol, company_name, cik, exchange_raw, security_type_raw, source_name) with P1, P3, P4 and P5."""
    rows = rows.withColumns({"symbol": F.nullif(F.upper(F.trim("symbol")), F.lit("")), "cik": pad_cik(F.col("cik")), "exchange_normalized": normalize_exchange(F.col("exchange_raw"))}).where("symbol is not null")
    rows = rows.withColumns(classify_security(F.col("company_name"), F.col("security_type_raw")))
    rows = rows.withColumn("exclusion_reason", inclusion_reason(F.col("exchange_normalized"), allow_adr))
    return rows.withColumn("include_in_universe", F.col("exclusion_reason").isNull())


def _preferred(column: str) -> Column:
    """The highest value of the first source, in order, that has one."""
    return F.coalesce(*(F.max(F.when(F.col("source_name") == s, F.col(column))) for s in SOURCES), F.max(column))


def market_universe(candidates: DataFrame, allow_adr: bool = True) -> DataFrame:
    """One row per symbol: values by source preference, flags from any row, then type and decision."""
    flags = ("is_etf", "is_adr", "is_preferred", "is_warrant", "is_right", "is_unit")
    rows = classify(candidates, allow_adr).groupBy("symbol").agg(*(_preferred(c).alias(c) for c in ("company_name", "cik", "exchange_normalized")), *(F.bool_or(f).alias(f) for f in flags), F.countDistinct("source_name").alias("source_count"))
    other = F.col("is_etf") | F.col("is_preferred") | F.col("is_warrant") | F.col("is_right") | F.col("is_unit")
    rows = rows.withColumn("is_common_stock", ~other).withColumn("exclusion_reason", inclusion_reason(F.col("exchange_normalized"), allow_adr))
    return rows.withColumn("include_in_universe", F.col("exclusion_reason").isNull())


def market_universe_conflicts(universe: DataFrame) -> DataFrame:
    """Symbols of more than one source, with a JSON payload."""
    return universe.where("source_count > 1").select("symbol", F.to_json(F.struct("symbol", "cik", "source_count")).alias("payload_json"))


def resolve_candidates(candidates: DataFrame) -> DataFrame:
    """Rows ranked within their symbol (included, has a CIK, venue rank, source, name): rank 1 is the entry, rank 2 a conflict."""
    rows = classify(candidates)
    venue = F.when(F.col("exchange_normalized") == "NASDAQ", 0).when(F.col("exchange_normalized") == "NYSE", 1).otherwise(2)
    order = Window.partitionBy("symbol").orderBy(F.col("include_in_universe").desc(), F.col("cik").isNotNull().desc(), venue.asc(), F.col("source_name").asc(), F.col("company_name").asc_nulls_last(), F.col("cik").asc_nulls_last())
    return rows.withColumn("candidate_rank", F.row_number().over(order)).where("candidate_rank <= 2")


def symbol_reference(universe: DataFrame) -> DataFrame:
    """U4: included symbols with clean name, aliases as JSON and match flags."""
    rows = universe.where("include_in_universe and trim(company_name) != ''")
    clean = normalize_company_name(F.col("company_name"))
    return rows.select("symbol", "cik", clean.alias("company_name_clean"), F.to_json(generate_aliases(F.col("company_name"))).alias("aliases_json"), (F.length("symbol") >= 2).alias("symbol_match_enabled"), (F.length(strip_company_suffixes(clean)) >= 4).alias("name_match_enabled"))


def listing_observations(raw: DataFrame) -> DataFrame:
    """Best row per (symbol, exchange, security_type, as_of_date): with a CIK, with a name, newest."""
    rows = raw.withColumns({"symbol": F.upper(F.trim("symbol")), "cik": pad_cik(F.col("cik"))}).where("symbol != '' and as_of_date is not null")
    return latest(rows, ["symbol", "exchange", "security_type", "as_of_date"], F.col("cik").isNotNull().desc(), F.col("company_name").isNotNull().desc(), F.col("ingested_at").desc_nulls_last())


def _snapshots(rows: DataFrame) -> DataFrame:
    """Snapshot dates with their number; one row per date."""
    return rows.select("as_of_date").distinct().withColumn("snapshot", F.row_number().over(Window.orderBy("as_of_date")))


def listing_identity() -> Column:
    """The CIK, else symbol and clean name."""
    return F.coalesce(F.concat(F.lit("CIK:"), "cik"), F.concat(F.lit("SYM:"), "symbol", F.lit("|"), F.coalesce(normalize_company_name(F.col("company_name")), F.lit(""))))


def listing_history(observations: DataFrame, grace: int = 2) -> DataFrame:
    """Listing versions [effective_from, effective_to). The identity is the CIK, else symbol and name. A version ends where ticker, venue or type
    changes, or at the `grace`-th snapshot in a row without the identity; a later sighting opens a new one. Observations of one identity and date
    follow each other in symbol, exchange, type order."""
    days = _snapshots(observations)
    rows = observations.withColumn("identity", listing_identity())
    rows = rows.join(days, "as_of_date")
    order = ["as_of_date", "symbol", "exchange", "security_type"]
    w = Window.partitionBy("identity").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    moved = F.lit(False)
    for c in ("symbol", "exchange", "security_type"):
        moved = moved | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    gap = F.col("snapshot") - F.lag("snapshot").over(w) > grace
    first = F.lag("snapshot").over(w).isNull()
    rows = rows.withColumns({"_first": first, "_gap": F.coalesce(gap, F.lit(False)), "_moved": moved & ~first})
    rows = rows.withColumn("version", F.sum((F.col("_first") | F.col("_gap") | F.col("_moved")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy("identity", "version").agg(*(F.min_by(c, F.struct(*order)).alias(c) for c in ("symbol", "exchange", "security_type", "company_name", "cik")), F.min("as_of_date").alias("effective_from"), F.max("as_of_date").alias("last_seen"), F.max("snapshot").alias("_last"), F.min_by("_gap", F.struct(*order)).alias("_after_gap"))
    v = Window.partitionBy("identity").orderBy("version")
    end = F.when(F.lead("_after_gap").over(v), F.lit(None).cast("date")).otherwise(F.lead("effective_from").over(v))
    spans = spans.withColumns({"_next": end, "_missing": F.col("_last") + grace})
    closing = days.select(F.col("snapshot").alias("_missing"), F.col("as_of_date").alias("_gone"))
    out = spans.join(closing, "_missing", "left").withColumn("effective_to", F.coalesce("_next", "_gone"))
    return out.withColumn("is_active", F.col("effective_to").isNull()).drop("_last", "_after_gap", "_next", "_missing", "_gone")


def consecutive_missing(observations: DataFrame) -> DataFrame:
    """Latest snapshots in a row without the (symbol, exchange, security_type)."""
    days = _snapshots(observations)
    last = observations.join(days, "as_of_date").groupBy("symbol", "exchange", "security_type").agg(F.max("snapshot").alias("_last"))
    return last.crossJoin(F.broadcast(days.agg(F.max("snapshot").alias("_all")))).select("symbol", "exchange", "security_type", (F.col("_all") - F.col("_last")).alias("missing_snapshots"))


def eligibility(include_adr: bool = False) -> Column:
    """The first rule that a listing's exchange and security_type meet (U8)."""
    kind = F.upper(F.trim(F.coalesce("security_type", F.lit(""))))
    reason = F.when(~F.upper(F.trim(F.coalesce("exchange", F.lit("")))).isin(*ALLOWED_VENUES), "EXCLUDED_EXCHANGE").when(kind.isin("ETF", "ETN", "FUND"), "EXCLUDED_FUND_LIKE").when(kind.isin("PREFERRED", "PREFERRED_STOCK"), "EXCLUDED_PREFERRED").when(kind.isin("WARRANT", "RIGHT", "UNIT"), "EXCLUDED_DERIVATIVE_LIKE")
    if not include_adr:
        reason = reason.when(kind.isin("ADR", "ADS"), "EXCLUDED_ADR")
    return reason.when(kind.isin("COMMON", "COMMON_STOCK", ""), "INCLUDED_COMMON_STOCK").otherwise("EXCLUDED_UNKNOWN_SECURITY_TYPE")


def universe_history(listings: DataFrame, include_adr: bool = False, rule_version: str = "v1") -> DataFrame:
    """U8: eligibility of listing versions, consecutive ones of equal decision joined."""
    rows = listings.withColumns({"eligible_reason": eligibility(include_adr), "rule_version": F.lit(rule_version)}).withColumn("eligible_flag", F.col("eligible_reason").startswith("INCLUDED"))
    w = Window.partitionBy("identity").orderBy("version")
    fresh = ~F.col("eligible_reason").eqNullSafe(F.lag("eligible_reason").over(w)) | ~F.col("effective_from").eqNullSafe(F.lag("effective_to").over(w))
    rows = rows.withColumn("_run", F.sum(fresh.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("identity", "_run", "eligible_flag", "eligible_reason", "rule_version").agg(F.min("effective_from").alias("effective_from"), F.max_by("effective_to", "version").alias("effective_to")).drop("_run")


#: Legal forms that aliases go without.
ALIAS_FORMS = ("INC", "CORPORATION", "CORP", "LTD", "PLC", "SA", "ADR", "ADS")


def reference_history(observations: DataFrame) -> DataFrame:
    """Symbol references of each listing identity (U6) with their aliases as JSON, the clean name and, if it differs, the name without legal forms. A new version
    opens where symbol, CIK, clean name or venue change, and ends the one before. Observations of one identity and date follow each other in symbol, exchange order."""
    order = ["as_of_date", "symbol", "exchange", "security_type"]
    rows = observations.withColumns({"identity": listing_identity(), "company_name_clean": normalize_company_name(F.col("company_name"))})
    w = Window.partitionBy("identity").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    fresh = F.row_number().over(w) == 1
    for c in ("symbol", "cik", "company_name_clean", "exchange"):
        fresh = fresh | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    rows = rows.withColumn("_fresh", fresh.cast("int")).withColumn("version", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy("identity", "version", "symbol", "cik", "company_name_clean", "exchange").agg(F.min("as_of_date").alias("effective_from"))
    name = F.col("company_name_clean")
    aliases = F.array_distinct(F.filter(F.array(name, strip_company_suffixes(name, suffixes=ALIAS_FORMS)), lambda a: a != ""))
    made = F.concat(F.lit("SYMREF:"), F.sha1(F.concat_ws("|", "identity", "symbol", F.col("effective_from").cast("string")).cast("binary")))
    spans = spans.withColumns({"symbol_reference_id": made, "aliases_json": F.to_json(aliases), "effective_to": F.lead("effective_from").over(Window.partitionBy("identity").orderBy("version"))})
    return spans.withColumn("is_active", F.col("effective_to").isNull())


#: Kinds of identifiers, the best first.
IDENTIFIERS = ("company_id", "cik", "listing_id")


def membership_history(eligible: DataFrame, references: DataFrame, listings: DataFrame) -> DataFrame:
    """One membership row per row of `eligible` (symbol, effective_from, effective_to, eligible_flag, eligible_reason). Its instrument is the first there is of the
    company, then the CIK, then the listing, each its own, that of the best reference, that of the best listing; else the symbol. The best holds the
    start in its closed interval, has a company, a CIK, a listing, and is the newest. All three frames may lack any of IDENTIFIERS; rows without symbol or start go.
    Of rows that differ only in identifiers, one with a company stays, the first by instrument."""

    def tidy(df: DataFrame, *more: str) -> DataFrame:
        text = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in df.columns else F.lit(None).cast("string")
        return df.select(F.upper(F.trim("symbol")).alias("symbol"), *(text(c).alias(c) for c in IDENTIFIERS), "effective_from", "effective_to", *more)

    rows = tidy(eligible, "eligible_flag", "eligible_reason").where("symbol != '' and effective_from is not null")
    prefer = [*(F.col(f"h_{c}").isNotNull().desc() for c in IDENTIFIERS), *(F.col(f"h_effective_{e}").desc_nulls_last() for e in ("from", "to")), *(F.col(f"h_{c}").asc_nulls_last() for c in IDENTIFIERS)]
    for source, history in (("reference", references), ("listing", listings)):
        h = tidy(history).withColumn("effective_from", F.coalesce("effective_from", F.lit("0001-01-01").cast("date")))
        rows = best_identity(rows, h, "symbol", "effective_from", prefer).select(*rows.columns, *(F.col(f"h_{c}").alias(f"_{source}_{c}") for c in IDENTIFIERS))
    chain = {c: [c, f"_reference_{c}", f"_listing_{c}"] for c in IDENTIFIERS}
    active = F.coalesce("eligible_flag", F.lit(False))
    rows = rows.select(
        F.coalesce(*(x for c in IDENTIFIERS for x in chain[c]), "symbol").alias("instrument_id"), F.coalesce(*chain["company_id"]).alias("company_id"), "symbol", "effective_from", "effective_to",
        F.when(active, "ACTIVE").otherwise("INACTIVE").alias("membership_status"), F.coalesce("eligible_reason", F.when(active, "OBSERVED_IN_MARKET_UNIVERSE_HISTORY").otherwise("NOT_ELIGIBLE_IN_MARKET_UNIVERSE_HISTORY")).alias("reason"),
    )
    return latest(rows, ["symbol", "effective_from", "effective_to", "membership_status", "reason"], F.col("company_id").isNotNull().desc(), F.col("instrument_id").asc())


def snapshot_diff_events(observations: DataFrame) -> DataFrame:
    """Changes of a symbol from a snapshot to the next: disappearance (no CIK there any more), then name, exchange, type; the first that fits."""
    dates = observations.select("as_of_date").distinct().withColumn("next_date", F.lead("as_of_date").over(Window.orderBy("as_of_date"))).where("next_date is not null")
    after = observations.select("symbol", F.col("as_of_date").alias("next_date"), *(F.col(c).alias(f"next_{c}") for c in ("cik", "company_name", "exchange", "security_type")))
    rows = observations.join(dates, "as_of_date").join(after, ["symbol", "next_date"], "left")
    differs = lambda c: F.coalesce(F.upper(F.trim(c)), F.lit("")) != F.coalesce(F.upper(F.trim(f"next_{c}")), F.lit(""))
    event = F.when(F.col("next_cik").isNull(), "POSSIBLE_DISAPPEARANCE").when(differs("company_name"), "POSSIBLE_COMPANY_NAME_CHANGE").when(differs("exchange"), "POSSIBLE_EXCHANGE_CHANGE").when(differs("security_type"), "POSSIBLE_SECURITY_TYPE_CHANGE")
    return rows.withColumn("event_type", event).where("event_type is not null").select("symbol", "cik", F.col("as_of_date").alias("current_date"), "next_date", "event_type").distinct()


EVENT_PARTS = ("symbol", "event_type", "event_date", "old_value", "new_value", "source_name")


def _text(*columns: str) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def event_history_append(existing: DataFrame | None, events: DataFrame, prefix: str = "NASDAQ_DAILY_LIST:") -> DataFrame:
    """Existing events and new ones (EVENT_PARTS) of a date whose md5 id isn't there."""
    new = events.where("event_date is not null").withColumn("event_id", F.concat(F.lit(prefix), F.md5(_text(*EVENT_PARTS).cast("binary")))).dropDuplicates(["event_id"])
    return existing.unionByName(not_exists_insert(existing, new, ["event_id"]).select(*existing.columns)) if existing is not None else new


AUDIT_KEY = ["entity_type", "entity_key", "action_type", "source_name", "old_value", "new_value"]


def audit_append(existing: DataFrame | None, audit: DataFrame) -> DataFrame:
    """Existing audit rows and the new ones whose AUDIT_KEY, nulls equal, isn't there."""
    new = audit.dropDuplicates(AUDIT_KEY)
    return existing.unionByName(not_exists_insert(existing, new, AUDIT_KEY).select(*existing.columns)) if existing is not None else new


def _audit(rows: DataFrame, entity: str, key: Column, parts: Column, source: Column, old: Column, new: Column, evidence: str, confidence: str) -> DataFrame:
    made = F.concat(F.lit("AUDIT:"), F.md5(parts.cast("binary")))
    return rows.select(made.alias("audit_id"), F.lit(entity).alias("entity_type"), key.alias("entity_key"), F.lit("INSERT").alias("action_type"), source.alias("source_name"), F.lit(evidence).alias("evidence_type"), F.lit(confidence).alias("confidence_level"), old.alias("old_value"), new.alias("new_value"))


def event_audit(events: DataFrame, evidence: str = "DAILY_LIST", confidence: str = "MEDIUM") -> DataFrame:
    """An audit row of each event of a date."""
    key = _text("symbol", "event_type", "event_date")
    return _audit(events.where("event_date is not null"), "listing_event_history", key, _text(*EVENT_PARTS), F.col("source_name"), F.col("old_value"), F.col("new_value"), evidence, confidence)


def observation_audit(observations: DataFrame) -> DataFrame:
    """An audit row of each observation (listing_id, symbol, exchange_raw, effective_from)."""
    parts = _text("listing_id", "symbol", "exchange_raw", "effective_from")
    return _audit(observations, "market_universe_history", F.col("listing_id"), parts, F.lit("nasdaq_symbol_directory_snapshot"), F.lit(None).cast("string"), F.col("symbol"), "DIRECT_SOURCE_FILE", "HIGH")


def enrich_from_filings(listings: DataFrame, filings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listings with a missing CIK filled from filings (symbol, cik, company_name) of the symbol, and events where the names differ."""
    best = latest(filings.where("symbol is not null"), ["symbol"], F.col("cik").asc_nulls_last(), F.col("company_name").asc_nulls_last()).select("symbol", F.col("cik").alias("_cik"), F.col("company_name").alias("_name"))
    rows = listings.join(best, "symbol", "left")
    events = rows.where(normalize_company_name(F.col("company_name")) != normalize_company_name(F.col("_name"))).select("symbol", F.lit("NAME_DIFFERENCE").alias("event_type"), F.col("company_name").alias("old_value"), F.col("_name").alias("new_value")).distinct()
    return rows.withColumn("cik", F.coalesce("cik", "_cik")).drop("_cik", "_name"), events


def instrument_master(prices: DataFrame, known: DataFrame, active_days: int = 30) -> DataFrame:
    """One instrument per symbol, with its old ids or new ones from the symbol's md5, old venue, type and share class or the usual ones. Active if traded in
    the last days of the data, else as it was, or not. `known` may lack any column but symbol."""
    spans = prices.groupBy(F.upper(F.trim("symbol")).alias("symbol")).agg(F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date"))
    newest = spans.agg(F.max("last_date").alias("_max"))
    kinds = {"instrument_id": "string", "company_id": "string", "exchange": "string", "security_type": "string", "share_class": "string", "is_active": "boolean"}
    have = [(F.col(c) if c in known.columns else F.lit(None).cast(t)).alias(f"_{c}") for c, t in kinds.items()]
    old = latest(known.select(F.upper(F.trim("symbol")).alias("symbol"), *have), ["symbol"], F.col("_instrument_id").asc_nulls_last())
    rows = spans.join(old, "symbol", "left").crossJoin(F.broadcast(newest))
    made = F.substring(F.md5(F.col("symbol").cast("binary")), 1, 16)
    usual = {"instrument_id": F.concat(F.lit("INST:"), made), "company_id": F.concat(F.lit("COMP:"), made), "exchange": F.lit("UNKNOWN"), "security_type": F.lit("COMMON_STOCK"), "share_class": F.lit("ORDINARY")}
    active = (F.col("last_date") >= F.date_sub("_max", active_days)) | F.coalesce("_is_active", F.lit(False))
    return rows.select("symbol", *(F.coalesce(f"_{c}", value).alias(c) for c, value in usual.items()), "first_date", "last_date", active.alias("is_active"))


def ticker_history(master: DataFrame) -> DataFrame:
    """The open ticker of each instrument, valid from its first price."""
    return master.select("instrument_id", "symbol", "exchange", F.col("first_date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))


def identifier_map(master: DataFrame) -> DataFrame:
    """The ticker as primary identifier of each instrument."""
    return master.select("instrument_id", F.lit("ticker").alias("identifier_type"), F.col("symbol").alias("identifier_value"), F.lit(True).alias("is_primary"))


def membership_bootstrap(prices: DataFrame, min_close: float, min_volume: float) -> DataFrame:
    """An open membership of each symbol from its first date over the floors."""
    return prices.where((F.col("close") >= min_close) & (F.col("volume") >= min_volume)).groupBy("symbol").agg(F.min("price_date").alias("effective_from")).withColumn("effective_to", F.lit(None).cast("date"))


def quality_universe(features: DataFrame, **floors) -> DataFrame:
    """(symbol, as_of_date) over the floors of P11."""
    return liquidity_filter(features, **floors).select("symbol", "as_of_date").distinct()


def whitelist_pit(quality: DataFrame, memberships: DataFrame) -> DataFrame:
    """U17 rows of members on their date."""
    return interval_membership(quality, memberships, "symbol", "as_of_date").distinct()


def history_readiness(observations: DataFrame, prices: DataFrame) -> DataFrame:
    """Snapshot dates, symbols in both tables, and a level: 0 under two dates or without common symbols, 1 under six dates, else 2."""
    dates = observations.agg(F.countDistinct("as_of_date").alias("snapshot_dates"))
    both = observations.select("symbol").distinct().join(prices.select("symbol").distinct(), "symbol").agg(F.count("*").alias("overlap_symbols"))
    return dates.crossJoin(both).withColumn("level", F.when((F.col("snapshot_dates") < 2) | (F.col("overlap_symbols") == 0), 0).when(F.col("snapshot_dates") < 6, 1).otherwise(2))
