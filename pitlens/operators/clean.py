"""Cleaning, classification and selection rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Venue names, tokens, suffixes, venue sets and symbol corrections that the rules are defined by.
VENUES = {
    "NASDAQ": "NASDAQ", "NASDAQGS": "NASDAQ", "NASDAQGM": "NASDAQ", "NASDAQCM": "NASDAQ", "XNAS": "NASDAQ", "NYSE": "NYSE", "XNYS": "NYSE", "NYSEARCA": "NYSE_ARCA", "ARCA": "NYSE_ARCA",
    "NYSE AMERICAN": "NYSE_AMERICAN", "NYSEAMERICAN": "NYSE_AMERICAN", "AMEX": "NYSE_AMERICAN", "BATS": "BATS", "CBOE": "BATS", "IEX": "IEX", "OTC": "OTC", "OTCMKTS": "OTC", "OTCQX": "OTC", "OTCQB": "OTC", "PINK": "OTC",
}
ALLOWED_VENUES = ("NASDAQ", "NYSE", "NYSE_ARCA", "NYSEAMERICAN", "NYSE_AMERICAN")
OTC_VENUES = ("OTC", "OTCQX", "OTCQB", "OTCPINK", "PINK", "GREY", "GREY_MARKET")
SUFFIXES = ("INCORPORATED", "INC", "CORPORATION", "CORP", "COMPANY", "CO", "LIMITED", "LTD", "HOLDINGS", "HOLDING", "GROUP", "PLC", "SA", "NV", "AG", "LP", "LLC", "ADR", "ADS", "TRUST")
SYMBOL_CORRECTIONS = {"BRK/B": "BRK.B", "BF/B": "BF.B", "PBR/A": "PBR.A"}


def clean_key(c: Column) -> Column:
    """Upper case, trimmed, blank as null."""
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def clean_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all there, cleaned."""
    df = df.withColumns({k: clean_key(F.col(k)) for k in keys})
    return df.dropna(subset=list(keys))


def normalize_bars(bars: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Bars with `accepted`. Missing open, high, low come from the close, a missing close from open, then high, then low, a missing volume is 0;
    bars out of order (high under low, open or close, low over them) or negative are not accepted, nor symbols outside `allowed`."""
    close = F.coalesce("close", "open", "high", "low")
    out = clean_keys(bars, "symbol").withColumn("close", close)
    out = out.withColumns({c: F.coalesce(c, "close") for c in ("open", "high", "low")} | {"volume": F.coalesce("volume", F.lit(0).cast("long"))})
    good = F.col("close").isNotNull() & (F.least("open", "high", "low", "close", "volume") >= 0) & (F.col("high") >= F.greatest("open", "close", "low")) & (F.col("low") <= F.least("open", "close"))
    if allowed is not None:
        out = out.join(allowed.select("symbol", F.lit(True).alias("_in")).distinct(), "symbol", "left")
        good = good & F.col("_in").isNotNull()
    return out.withColumn("accepted", F.coalesce(good, F.lit(False))).drop("_in")


def normalize_exchange(c: Column) -> Column:
    """The venue of a raw name after cleaning white space and hyphens; an unknown name stays, blank is null."""
    name = F.nullif(F.trim(F.regexp_replace(F.upper(c), r"[\s-]+", " ")), F.lit(""))
    known = F.create_map(*(F.lit(x) for pair in VENUES.items() for x in pair))
    return F.coalesce(known[name], name)


def classify_security(name: Column, raw_type: Column) -> dict[str, Column]:
    """Flags and the type, the first of ETF, ADR, PREFERRED, WARRANT, RIGHT, UNIT that fits, else COMMON_STOCK."""
    raw = F.upper(F.coalesce(raw_type, F.lit("")))
    blob = F.trim(F.concat_ws(" ", F.upper(F.coalesce(name, F.lit(""))), raw))
    padded = F.concat(F.lit(" "), blob, F.lit(" "))
    has = lambda text, *tokens: F.lit(False) if not tokens else text.contains(tokens[0]) | has(text, *tokens[1:])
    flags = {
        "is_etf": has(padded, " ETF") | has(blob, "EXCHANGE TRADED FUND"),
        "is_adr": has(padded, " ADR", " ADS") | has(blob, "DEPOSITARY"),
        "is_preferred": has(blob, "PREFERRED", "PREF ") | raw.isin("PREFERRED", "PREF"),
        "is_warrant": has(blob, "WARRANT"),
        "is_right": has(padded, " RIGHT"),
        "is_unit": has(padded, " UNIT"),
    }
    kind = F.lit("COMMON_STOCK")
    for flag, label in reversed(list(zip(flags, ("ETF", "ADR", "PREFERRED", "WARRANT", "RIGHT", "UNIT")))):
        kind = F.when(flags[flag], label).otherwise(kind)
    common = ~(flags["is_etf"] | flags["is_preferred"] | flags["is_warrant"] | flags["is_right"] | flags["is_unit"])
    return flags | {"is_common_stock": common, "security_type": kind}


def inclusion_reason(exchange: Column, allow_adr: bool = True) -> Column:
    """P5: why a row with the flags of `classify_security` is excluded, null if it is included; the first reason wins."""
    venue = F.upper(F.trim(F.coalesce(exchange, F.lit(""))))
    otc, col = venue.isin(*OTC_VENUES), F.col
    reason = F.when(otc, "otc_security")
    for kind in ("etf", "preferred", "warrant", "right", "unit"):
        reason = reason.when(col(f"is_{kind}"), f"{kind}_excluded")
    if not allow_adr:
        reason = reason.when(col("is_adr"), "adr_excluded")
    passes = col("is_adr") & (venue != "")
    return reason.when(~passes & ~venue.isin(*ALLOWED_VENUES), "exchange_not_allowed").when(~passes & ~col("is_common_stock"), "not_common_stock")


def map_provider_symbol(symbol: Column) -> dict[str, Column]:
    """exclusion_reason (null if it can be fetched) and provider_symbol, with a simple share class written with a hyphen."""
    raw = F.upper(F.trim(F.coalesce(symbol, F.lit(""))))
    reason = F.when(raw == "", "empty_symbol").when(raw.contains("$"), "contains_dollar_syntax")
    reason = reason.when(raw.rlike(r"(^|[-.])(R|RI|RT)$"), "rights_not_supported").when(raw.rlike(r"(^|[-.])(W|WT)$"), "warrants_not_supported")
    reason = reason.when(raw.rlike(r"(^|[-.])UN$"), "units_not_supported").when(raw.rlike(r"(^|[-.])P[A-Z]?$"), "preferred_not_supported_by_default")
    mapped = F.when(raw.rlike(r"^[A-Z0-9]+\.[A-Z]$"), F.replace(raw, F.lit("."), F.lit("-"))).otherwise(raw)
    return {"exclusion_reason": reason, "provider_symbol": F.when(reason.isNull(), mapped)}


def normalize_company_name(name: Column) -> Column:
    """Upper case, anything but letters, digits and space as space, squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(name), "[^A-Z0-9 ]+", " "), " +", " "))


def strip_company_suffixes(name: Column, one_pass: bool = False, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """A normalized name without its trailing legal forms: all of them, or, `one_pass`, each in the given order once."""
    if not one_pass:
        return F.trim(F.regexp_replace(name, f"( ({'|'.join(suffixes)}))+$", ""))
    for suffix in suffixes:
        name = F.regexp_replace(name, f" {suffix}$", "")
    return F.trim(name)


def generate_aliases(name: Column) -> Column:
    """Normalized, stripped and compact name, distinct and in that order, none empty."""
    normal = normalize_company_name(name)
    stripped = strip_company_suffixes(normal)
    return F.array_distinct(F.filter(F.array(normal, stripped, F.replace(stripped, F.lit(" "), F.lit(""))), lambda a: a != ""))


def correct_symbols(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """P10: symbols by the lookup rows (raw_symbol, normalized_symbol), others as they are."""
    return rows.join(corrections.select(F.col("raw_symbol").alias("symbol"), "normalized_symbol").dropDuplicates(["symbol"]), "symbol", "left").withColumn("symbol", F.coalesce("normalized_symbol", "symbol")).drop("normalized_symbol")


def liquidity_filter(rows: DataFrame, min_price: float, min_dollar_volume: float, min_volume: float, max_volatility: float, deny: tuple[str, ...] = ()) -> DataFrame:
    """Rows over the floors, under the volatility cap and not denied."""
    keep = (F.col("adj_close") >= min_price) & (F.col("adj_close") * F.col("volume") >= min_dollar_volume) & (F.col("volume") >= min_volume) & (F.col("volatility_20d") <= max_volatility)
    return rows.where(keep & ~F.col("symbol").isin(*deny) if deny else keep)


def market_selection(rows: DataFrame, market: str) -> DataFrame:
    """Rows of the market: regular, otc, or both; nothing for any other word."""
    row = F.lower(F.trim("source_market"))
    chosen = {"both": ("regular", "otc"), "regular": ("regular",), "otc": ("otc",)}.get(market.strip().lower(), ())
    return rows.where(row.isin(*chosen) if chosen else F.lit(False))


def news_raw_filter(rows: DataFrame) -> DataFrame:
    """Rows with `accepted`: raw_id and time are there, title and url not blank."""
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return rows.withColumn("accepted", F.col("raw_id").isNotNull() & F.col("published_at").isNotNull() & filled("title") & filled("url"))


def apply_overrides(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """include_in_universe, the manual decision winning where there is one, with its reason."""
    o = overrides.select("symbol", F.col("include").alias("_include"), F.col("reason").alias("override_reason")).dropDuplicates(["symbol"])
    return rows.join(o, "symbol", "left").withColumn("include_in_universe", F.coalesce("_include", "include_in_universe")).drop("_include")
