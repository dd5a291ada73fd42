"""Raw files as Spark jobs: every reader is lazy, gets a path that Spark opens, and returns clean rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import latest
from ..operators.clean import classify_security
from ..operators.filings import pad_cik
from ..operators.joins import not_exists_insert

#: Eight digits in a file's name.
FILE_DATE = r"(\d{8})[^/]*$"
# Venue codes of the directory files, event words in their order, and column names by their letters and digits.
EXCHANGE_CODES = {"A": "NYSE AMERICAN", "N": "NYSE", "P": "NYSE ARCA", "Z": "BATS", "V": "IEX"}
EVENT_WORDS = {
    "LISTING_ADDED": r"\b(new listing|listed|addition|added)\b",
    "LISTING_REMOVED": r"\b(removal|removed|deleted)\b",
    "DELISTED": r"\b(delist|delisting)\b",
    "RENAMED": r"\b(name change|rename|renamed)\b",
    "TICKER_CHANGED": r"\b(symbol change|ticker change|change symbol)\b",
    "REACTIVATED": r"\b(reactivat|reinstated)\b",
    "SUSPENDED": r"\b(suspend|halted)\b",
}
SHORT_INTEREST_NAMES = {
    "symbol": ("symbol", "symbolcode"),
    "settlement_date": ("settlementdate",),
    "short_interest": ("shortinterest", "currentshort", "currentshortpositionquantity"),
    "previous_short_interest": ("previousshortinterest", "previousshort", "previousshortpositionquantity"),
    "avg_daily_volume": ("avgdailyvolume", "averagedailyvolumequantity"),
    "days_to_cover": ("daystocover", "daystocoverquantity"),
    "shares_float": ("sharesfloat", "sharesfloatquantity"),
    "revision_flag": ("revisionflag",),
    "source_market": ("market", "marketclasscode", "sourcemarket"),
}
PRICE_NAMES = {"symbol": ("ticker", "symbol"), "price_date": ("date",), "open": ("open",), "high": ("high",), "low": ("low",), "close": ("close", "adjclose"), "volume": ("vol", "volume"), "period": ("per",)}


def file_path() -> Column:
    return F.col("_metadata.file_path")


def _plain(name: str) -> str:
    return "".join(c for c in name.lower() if c.isalnum())


def harmonize(df: DataFrame, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns renamed by their letters and digits alone; the first match of each wins, those without one come as null strings."""
    have = {_plain(c): c for c in reversed(df.columns)}
    pick = lambda options: next((F.col(f"`{have[o]}`") for o in options if o in have), F.lit(None).cast("string"))
    return df.select(*(pick(options).alias(c) for c, options in names.items()), *([c for c in df.columns if c.startswith("_")]))


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Strings with header, and _path."""
    return spark.read.csv(path, header=True, sep=sep, recursiveFileLookup=True).withColumn("_path", file_path())


def read_stooq_bars(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows of a tree of files with <TICKER>,<PER>,<DATE>,... headers; asset class and venue group from the path."""
    rows = harmonize(read_csv(spark, path), PRICE_NAMES).where("period = 'D' and symbol is not null and price_date is not null")
    where = F.lower(F.replace(F.col("_path"), F.lit("%20"), F.lit(" ")))
    venue = F.lit("UNKNOWN")
    for kind in ("etfs", "stocks"):
        for v in ("nysemkt", "nyse", "nasdaq"):
            venue = F.when(where.contains(f"{v} {kind}"), f"{v} {kind}".upper()).otherwise(venue)
    number = {c: F.expr(f"try_cast({c} as double)") for c in ("open", "high", "low", "close")}
    return rows.select(
        F.regexp_replace(F.upper("symbol"), r"\.US", "").alias("symbol"), F.expr("try_to_date(price_date, 'yyyyMMdd')").alias("price_date"), *(v.alias(c) for c, v in number.items()), F.expr("try_cast(try_cast(volume as double) as bigint)").alias("volume"),
        F.regexp_extract("_path", "[^/]+$", 0).alias("source_path"), F.when(where.contains("etfs"), "ETF").when(where.contains("stocks"), "STOCK").otherwise("UNKNOWN").alias("asset_class"), venue.alias("venue_group"),
    )


PRICE_SCHEMA = "symbol string, price_date date, open double, high double, low double, close double, volume long, source_name string"


def read_normalized_price_csv(spark: SparkSession, path: str) -> DataFrame:
    """An already normalized price file."""
    return spark.read.csv(path, header=True, schema=PRICE_SCHEMA)


def read_price_any(spark: SparkSession, path: str) -> DataFrame:
    """S3: prices under any usual column names: daily rows (a missing period counts as daily), numbers or null, volume 0 if missing; rows without a price or with high under low go."""
    rows = harmonize(read_csv(spark, path), PRICE_NAMES).where("coalesce(period, 'D') = 'D'")
    rows = rows.select(F.upper(F.trim("symbol")).alias("symbol"), F.expr("coalesce(try_to_date(price_date, 'yyyyMMdd'), try_to_date(price_date, 'yyyy-MM-dd'))").alias("price_date"), *(F.expr(f"try_cast({c} as double)").alias(c) for c in ("open", "high", "low", "close")), F.expr("coalesce(try_cast(try_cast(volume as double) as bigint), 0)").alias("volume"))
    return rows.dropna(subset=["symbol", "price_date", "open", "high", "low", "close"]).where("high >= low")


def _yahoo_rows(spark: SparkSession, path: str) -> DataFrame:
    schema = "symbol string, price_date string, open double, high double, low double, close double, volume double, source_name string, fetched_at timestamp"
    rows = spark.read.json(path, schema=schema, recursiveFileLookup=True).withColumn("_path", file_path())
    rows = rows.select(F.upper(F.trim("symbol")).alias("symbol"), F.expr("try_to_date(price_date)").alias("price_date"), "open", "high", "low", "close", F.col("volume").cast("long").alias("volume"), "source_name", "fetched_at", F.regexp_extract("_path", "run_id=([^/]+)", 1).alias("run_id"), F.regexp_extract("_path", "run_date=([^/]+)", 1).alias("run_date"), F.col("_path").alias("source_file"))
    return rows.where("symbol != '' and price_date is not null")


def read_yahoo_jsonl(spark: SparkSession, path: str, existing: DataFrame) -> DataFrame:
    """JSON lines of bars that `existing` lacks by (symbol, price_date, source_name), with run_id and run_date of the path; newest per key."""
    key = ["symbol", "price_date", "source_name"]
    return latest(not_exists_insert(existing, _yahoo_rows(spark, path).drop("source_file"), key), key, F.col("fetched_at").desc_nulls_last())


def yahoo_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Each file of bars with its run_id, run_date and number of usable rows."""
    return _yahoo_rows(spark, path).groupBy("source_file", "run_id", "run_date").agg(F.count("*").alias("rows_loaded"))


def read_daily_short_volume(spark: SparkSession, path: str, date_pattern: str = FILE_DATE) -> DataFrame:
    """Pipe-separated files of 5 or 6 columns, with a header or not. A file's own header tells the order of the two short columns; without
    one, 6 columns hold the exempt volume first. Rows without an 8-digit date or a symbol go, and so do files of a lone 0."""
    lines = spark.read.text(path, recursiveFileLookup=True).select(F.split("value", r"\|").alias("f"), file_path().alias("_path"))
    heads = lines.where(F.lower(F.trim(F.col("f")[0])) == "date").groupBy("_path").agg(F.min(F.transform("f", lambda x: F.lower(F.trim(x)))).alias("head"))
    rows = lines.where(F.trim(F.col("f")[0]).rlike("^[0-9]{8}$") & (F.size("f") >= 5) & (F.trim(F.col("f")[1]) != "")).join(heads, "_path", "left")
    six = F.size("f") >= 6
    plain_first = F.coalesce(F.col("head")[2] == "shortvolume", F.lit(False))
    number = lambda c: F.trim(c).try_cast("double")
    at = lambda i: F.col("f")[i]
    return rows.select(
        F.expr("try_to_date(trim(f[0]), 'yyyyMMdd')").alias("trade_date"), F.upper(F.trim(at(1))).alias("symbol"), number(F.when(six & ~plain_first, at(3)).otherwise(at(2))).alias("short_volume"),
        number(F.when(six & plain_first, at(3)).when(six, at(2))).alias("short_exempt_volume"), number(F.when(six, F.get("f", F.lit(4))).otherwise(at(3))).alias("total_volume"), F.upper(F.trim(F.when(six, F.get("f", F.lit(5))).otherwise(at(4)))).alias("market_code"),
        F.col("_path").alias("source_file"), F.to_date(F.nullif(F.regexp_extract("_path", date_pattern, 1), F.lit("")), "yyyyMMdd").alias("publication_date"),
    ).where("trade_date is not null")


def load_only_new_files(rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows of files whose path isn't loaded yet."""
    return rows.join(loaded.select("source_file").distinct(), "source_file", "left_anti")


def refresh_file_counts(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """Row counts by (source_file, publication_date, market_code), those of the files of `rows` counted anew."""
    new = rows.groupBy("source_file", "publication_date", "market_code").agg(F.count("*").alias("row_count"))
    return load_only_new_files(counts, rows).select(*new.columns).union(new)


def read_short_interest(spark: SparkSession, path: str, sep: str = "|", date_pattern: str = FILE_DATE) -> DataFrame:
    """Short interest under any of the known column names; numbers or null; a missing market comes from the file's token."""
    rows = harmonize(read_csv(spark, path, sep), SHORT_INTEREST_NAMES)
    where = F.lower("_path")
    guess = F.when(where.rlike("fnsq|fnqc|fnyx|fnra|cnms"), "regular").when(where.rlike("shrt|otc"), "otc")
    day = F.expr("coalesce(try_to_date(settlement_date, 'yyyy-MM-dd'), try_to_date(settlement_date, 'yyyyMMdd'))")
    numbers = {c: F.expr(f"try_cast({c} as double)") for c in ("short_interest", "previous_short_interest", "avg_daily_volume", "days_to_cover", "shares_float")}
    rows = rows.withColumns(numbers | {"symbol": F.upper(F.trim("symbol")), "settlement_date": day, "source_market": F.coalesce(F.lower(F.trim("source_market")), guess), "source_date": F.to_date(F.nullif(F.regexp_extract("_path", date_pattern, 1), F.lit("")), "yyyyMMdd")})
    return rows.withColumnRenamed("_path", "source_file").where("symbol != '' and settlement_date is not null")


def read_symbol_directory(spark: SparkSession, path: str, kind: str, date_pattern: str = FILE_DATE) -> DataFrame:
    """A snapshot of one of three kinds (sec, nasdaqlisted, otherlisted) in one schema; the closing row of the directory files goes."""
    df = read_csv(spark, path, "," if kind == "sec" else "|")
    names = {"symbol": ("symbol", "actsymbol"), "company_name": ("companyname", "securityname", "title"), "cik": ("cik", "cikstr"), "exchange_raw": ("exchangeraw", "exchange"), "etf": ("etf",)}
    rows = harmonize(df, names).withColumn("symbol", F.upper(F.trim("symbol"))).where("symbol != '' and not symbol like 'FILE CREATION TIME%'")
    venue = F.col("exchange_raw")
    if kind == "nasdaqlisted":
        venue = F.lit("NASDAQ")
    elif kind == "otherlisted":
        venue = F.coalesce(F.create_map(*(F.lit(x) for pair in EXCHANGE_CODES.items() for x in pair))[F.upper(F.trim("exchange_raw"))], "exchange_raw")
    security = None if kind == "sec" else F.when(F.upper("etf") == "Y", "ETF").otherwise(classify_security(F.col("company_name"), F.lit(None).cast("string"))["security_type"])
    return rows.select("symbol", F.trim("company_name").alias("company_name"), pad_cik(F.col("cik")).alias("cik"), venue.alias("exchange_raw"), (F.lit(None).cast("string") if security is None else security).alias("security_type_raw"), F.lit(kind).alias("source_name"), F.to_date(F.nullif(F.regexp_extract("_path", date_pattern, 1), F.lit("")), "yyyyMMdd").alias("as_of_date"))


SNAPSHOT_KEY = ["symbol", "company_name", "cik", "exchange_raw", "security_type_raw", "source_name", "as_of_date"]


def stage_symbol_snapshots(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct snapshot rows with a date that `existing` lacks, nulls equal."""
    return not_exists_insert(existing, rows.where("as_of_date is not null").dropDuplicates(SNAPSHOT_KEY), SNAPSHOT_KEY)


def _field(v: str, path: str, kind: str = "string") -> Column:
    """A field of a variant column as `kind`; null where there is none or it doesn't fit."""
    return F.try_variant_get(F.col(v), f"$.{path}", kind)


FILING = ("accessionNumber", "form", "filingDate", "acceptanceDateTime", "primaryDocument")


def explode_submissions(raw: DataFrame) -> DataFrame:
    """Rows of JSON text (value) to one row per filing, parallel arrays zipped, empty ones dropped, with the archive URL. An array that is none counts as empty; a line that isn't JSON gives no row."""
    parsed = raw.select(F.try_parse_json("value").alias("j"))
    arrays = [F.coalesce(_field("j", f"filings.recent.{c}", "array<string>"), F.array().cast("array<string>")).alias(c) for c in FILING]
    rows = parsed.select(pad_cik(_field("j", "cik")).alias("cik"), _field("j", "name").alias("company_name"), *arrays).select("cik", "company_name", F.explode(F.arrays_zip(*FILING)).alias("f"))
    bare = F.replace(F.col("f.accessionNumber"), F.lit("-"), F.lit(""))
    url = F.concat_ws("/", F.lit("https://www.sec.gov/Archives/edgar/data"), F.regexp_replace("cik", "^0+", ""), bare, F.col("f.primaryDocument"))
    return rows.where("cik is not null and f.accessionNumber != ''").select("cik", "company_name", F.col("f.form").alias("form_type"), F.expr("try_to_date(f.filingDate)").alias("filing_date"), F.expr("try_to_timestamp(f.acceptanceDateTime)").alias("accepted_at"), F.col("f.accessionNumber").alias("accession_number"), url.alias("filing_url"))


def explode_company_facts(raw: DataFrame) -> DataFrame:
    """Rows of JSON text (value) with facts -> taxonomy -> concept -> units -> unit -> list, one row per fact. A number fills value_numeric, and every value value_text; a boolean is text only.

    The document stays a variant that is opened level by level, so no maps of all its facts are built. What isn't an object or list where one belongs has no
    facts, a fact that isn't an object has nulls, and the rest of the document counts; a line that isn't JSON gives no row."""
    each = lambda df, v: df.lateralJoin(raw.sparkSession.tvf.variant_explode(F.col(v).outer()))
    rows = raw.select(F.try_parse_json("value").alias("j")).select(pad_cik(_field("j", "cik")).alias("cik"), _field("j", "facts", "variant").alias("v"))
    rows = each(rows, "v").where("key is not null").select("cik", F.col("key").alias("taxonomy"), F.col("value").alias("v"))
    rows = each(rows, "v").where("key is not null").select("cik", "taxonomy", F.col("key").alias("concept"), _field("value", "units", "variant").alias("v"))
    rows = each(rows, "v").where("key is not null").select("cik", "taxonomy", "concept", F.col("key").alias("unit"), F.col("value").alias("v"))
    rows = each(rows, "v").where("key is null").select("cik", "taxonomy", "concept", "unit", F.col("value").alias("f"))
    rows = rows.select("cik", "taxonomy", "concept", "unit", _field("f", "accn").alias("accession_number"), _field("f", "end").alias("_end"), _field("f", "val").alias("value_text"))
    return rows.select("cik", "taxonomy", "concept", "unit", "accession_number", F.expr("try_to_date(_end)").alias("period_end_date"), "value_text", F.expr("try_cast(value_text as double)").alias("value_numeric"))


def select_target_files(files: DataFrame, references: DataFrame) -> DataFrame:
    """Files (path, cik) with `selected`: those of referenced CIKs, or all if none is referenced."""
    wanted = references.select(pad_cik(F.col("cik")).alias("cik"), F.lit(True).alias("_in")).where("cik is not null").distinct()
    rows = files.withColumn("cik", pad_cik(F.col("cik"))).join(wanted, "cik", "left")
    any_in = F.broadcast(wanted.agg((F.count("*") > 0).alias("_any")))
    return rows.crossJoin(any_in).withColumn("selected", F.col("_in").isNotNull() | ~F.col("_any")).drop("_in", "_any")


def read_filing_index(spark: SparkSession, path: str) -> DataFrame:
    """A filing index file."""
    names = {"cik": ("cik",), "company_name": ("companyname", "company"), "form_type": ("formtype", "form"), "filing_date": ("filingdate", "datefiled"), "accession_number": ("accessionnumber", "accession")}
    rows = harmonize(read_csv(spark, path), names)
    return rows.select(pad_cik(F.col("cik")).alias("cik"), "company_name", "form_type", F.expr("try_to_date(filing_date)").alias("filing_date"), "accession_number").where("cik is not null")


def read_news_source(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, limit: int | None = None) -> DataFrame:
    """News with an id and a time in the closed date range; the earliest `limit` rows if one is given."""
    rows = read_csv(spark, path).select(F.expr("try_cast(raw_id as bigint)").alias("raw_id"), F.expr("try_to_timestamp(published_at)").alias("published_at"), "source_name", "title", "url").where("raw_id is not null and published_at is not null")
    if start:
        rows = rows.where(F.to_date("published_at") >= start)
    if end:
        rows = rows.where(F.to_date("published_at") <= end)
    return rows.orderBy("published_at", "raw_id").limit(limit) if limit else rows


def parse_daily_list_events(lines: DataFrame, kind: str = "text") -> DataFrame:
    """Lines (value) to typed events: the first matching words, the first plausible symbol, the first date; confidence MEDIUM for csv, LOW for text."""
    text = F.trim("value")
    event = reduce(lambda acc, item: acc.when(text.rlike(f"(?i){item[1]}"), item[0]), list(EVENT_WORDS.items())[1:], F.when(text.rlike(f"(?i){EVENT_WORDS['LISTING_ADDED']}"), "LISTING_ADDED"))
    rows = lines.select(text.alias("notes"), event.alias("event_type"), F.nullif(F.regexp_extract(text, r"\b([A-Z][A-Z0-9.\-]{0,9})\b", 1), F.lit("")).alias("symbol"), F.expr(r"try_to_date(regexp_extract(trim(value), '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1))").alias("event_date"))
    return rows.where("event_type is not null and symbol is not null").withColumn("confidence_level", F.lit("MEDIUM" if kind == "csv" else "LOW"))


def snapshot_listing_observations(snapshots: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """One-day membership observations with a deterministic id, without those that are there."""
    rows = snapshots.where("symbol != '' and as_of_date is not null").withColumn("listing_id", F.concat(F.lit("LST:"), F.md5(F.concat_ws("|", "symbol", F.coalesce("exchange_raw", F.lit("")), F.col("as_of_date").cast("string")).cast("binary"))))
    return rows.dropDuplicates(["listing_id"]).join(existing_ids.select("listing_id").distinct(), "listing_id", "left_anti").select("listing_id", "symbol", "exchange_raw", F.col("as_of_date").alias("effective_from"), F.col("as_of_date").alias("effective_to"))


def read_manual_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Symbol, include, reason; 1, true, yes, y, include count as true, 0, false, no, n, exclude as false, other words drop the row."""
    rows = harmonize(read_csv(spark, path), {"symbol": ("symbol",), "include": ("include", "isincluded", "override"), "reason": ("reason", "notes")})
    word = F.lower(F.trim("include"))
    flag = F.when(word.isin("1", "true", "yes", "y", "include"), True).when(word.isin("0", "false", "no", "n", "exclude"), False)
    return rows.select(F.upper(F.trim("symbol")).alias("symbol"), flag.alias("include"), "reason").where("symbol != '' and include is not null")
