"""Filings, facts and fundamentals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import latest, ratio
from .joins import trailing_sums

#: Concepts of each measure.
CONCEPTS = {
    "revenue": ("revenues", "revenuefromcontractwithcustomerexcludingassessedtax", "salesrevenuenet"),
    "net_income": ("netincomeloss", "profitloss"),
    "assets": ("assets",),
    "liabilities": ("liabilities",),
    "equity": ("stockholdersequity",),
    "operating_cash_flow": ("netcashprovidedbyusedinoperatingactivities",),
    "shares_outstanding": ("entitycommonstocksharesoutstanding",),
}
FLOWS, STOCKS = ("revenue", "net_income", "operating_cash_flow"), ("assets", "liabilities", "equity", "shares_outstanding")
FACT_KEY = ["accession_number", "cik", "taxonomy", "concept", "unit", "period_end_date", "period_start_date", "frame"]


def pad_cik(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.lpad(F.trim(c), 10, "0"))


def sec_filings(index: DataFrame, companies: DataFrame, now: str) -> DataFrame:
    """Filings with a stable id, company and available_at (acceptance, else `now`); newest row per id."""
    rows = index.withColumn("cik", pad_cik(F.col("cik"))).where("cik is not null and trim(accession_number) != ''")
    rows = rows.withColumns({"filing_id": F.concat(F.lit("FILING:"), F.substring(F.sha1(F.concat_ws("|", "cik", "accession_number").cast("binary")), 1, 20)), "available_at": F.coalesce("accepted_at", F.lit(now).cast("timestamp"))})
    return latest(rows.join(companies, "cik", "left"), ["filing_id"], F.col("available_at").desc_nulls_last())


def cik_company_map(*references: DataFrame) -> DataFrame:
    """One company per padded CIK, the smallest id of the first reference that has one."""
    rows = None
    for i, df in enumerate(references):
        part = df.select(pad_cik(F.col("cik")).alias("cik"), "company_id", F.lit(i).alias("_i"))
        rows = part if rows is None else rows.union(part)
    return latest(rows.where("cik is not null and company_id is not null"), ["cik"], F.col("_i").asc(), F.col("company_id").asc()).drop("_i")


def best_filing_per_accession(filings: DataFrame) -> DataFrame:
    """Newest filing of each accession number."""
    return latest(filings, ["accession_number"], *(F.col(c).desc_nulls_last() for c in ("available_at", "accepted_at", "filing_date")))


def sec_fact_dedup(facts: DataFrame) -> DataFrame:
    """Facts with cleaned keys (lower case, trimmed, blank null), concept and period known; newest per fact key."""
    lower = {c: F.nullif(F.lower(F.trim(c)), F.lit("")) for c in ("taxonomy", "concept", "unit", "frame")}
    rows = facts.withColumns(lower | {"cik": pad_cik(F.col("cik"))}).where("cik is not null and concept is not null and period_end_date is not null")
    return latest(rows, FACT_KEY, F.col("ingested_at").desc_nulls_last())


def sec_fact_normalized(facts: DataFrame, companies: DataFrame, filings: DataFrame) -> DataFrame:
    """E5: E4 with company (mapped, else the filing's, else from the CIK) and available_at (the filing's, else ingestion)."""
    best = best_filing_per_accession(filings).select("accession_number", F.col("filing_id"), F.col("company_id").alias("_fc"), F.col("available_at").alias("_fa"))
    rows = sec_fact_dedup(facts).join(companies, "cik", "left").join(best, "accession_number", "left")
    return rows.withColumns({"company_id": F.coalesce("company_id", "_fc", F.concat(F.lit("CIK:"), "cik")), "available_at": F.coalesce("_fa", "ingested_at")}).drop("_fc", "_fa")


def impacted_months(rows: DataFrame, watermark: DataFrame, time: str, month_of: str, overlap: int) -> DataFrame:
    """Months (month_start) of rows past the one-row watermark, and the `overlap` months up to the newest row."""
    month = F.trunc(month_of, "month").alias("month_start")
    new = rows.crossJoin(F.broadcast(watermark.limit(1))).where(F.col("watermark").isNull() | (F.col(time) > F.col("watermark"))).select(month)
    last = F.broadcast(rows.agg(F.trunc(F.max(month_of), "month").alias("_last")))
    near = rows.crossJoin(last).where(F.col(month_of) >= F.add_months("_last", -(overlap - 1))).select(month)
    return new.union(near).distinct()


def pivot_concepts(facts: DataFrame, keys: list[str] = ["company_id", "cik", "period_end_date", "available_at"]) -> DataFrame:
    """A4: per key the highest value of the concepts of each measure."""
    return facts.groupBy(*keys).agg(*(F.max(F.when(F.lower("concept").isin(*names), F.col("value_numeric"))).alias(m) for m, names in CONCEPTS.items()))


def fundamental_base(facts: DataFrame) -> DataFrame:
    """A4 of the known concepts, liabilities filled as assets less equity; newest per (company, period)."""
    every = [c for names in CONCEPTS.values() for c in names]
    rows = pivot_concepts(facts.where(F.lower("concept").isin(*every) & F.col("value_numeric").isNotNull()))
    rows = rows.withColumn("liabilities", F.coalesce("liabilities", F.col("assets") - F.col("equity")))
    return latest(rows, ["company_id", "period_end_date"], F.col("available_at").desc_nulls_last())


def fundamental_ttm(base: DataFrame, latest_only: bool = False) -> DataFrame:
    """Each row with the sums of flows and the last stocks of rows known by then in the 370 days up to its period. Restated periods
    count again, unless `latest_only` takes the newest row of each period first.

    Sums need no pairs (`trailing_sums`). The last row known by then is the row itself, or one of the same period and time of knowledge."""
    rows = latest(base, ["company_id", "period_end_date"], F.col("available_at").desc_nulls_last()) if latest_only else base
    summed = trailing_sums(rows, "company_id", "period_end_date", "available_at", list(FLOWS))
    newest = F.struct("period_end_date", "available_at")
    return summed.groupBy("company_id", "cik", "period_end_date", "available_at").agg(*(F.sum(f"sum_{m}").alias(m) for m in FLOWS), *(F.max_by(m, newest).alias(m) for m in STOCKS))


def missing_fundamentals(symbols: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """CIKs without fundamentals, each with its best symbol: included, without punctuation, shortest, first."""
    rows = symbols.withColumn("cik", pad_cik(F.col("cik"))).where("cik is not null").join(fundamentals.select(pad_cik(F.col("cik")).alias("cik")).distinct(), "cik", "left_anti")
    return latest(rows, ["cik"], F.col("include_in_universe").desc_nulls_last(), F.col("symbol").rlike("[^A-Z0-9]").asc(), F.length("symbol").asc(), F.col("symbol").asc()).select("cik", "symbol")


def statement_mapping(wide: DataFrame, labels: dict[str, list[str]]) -> DataFrame:
    """Measures from the first non-null of their labels' columns; labels without a column are skipped."""
    pick = lambda names: F.coalesce(*(F.col(f"`{n}`").cast("double") for n in names if n in wide.columns), F.lit(None).cast("double"))
    return wide.withColumns({f"_{m}": pick(names) for m, names in labels.items()}).select("company_id", "period_end_date", *(F.col(f"_{m}").alias(m) for m in labels))


def latest_filing_asof(requests: DataFrame, filings: DataFrame) -> DataFrame:
    """For each request (company_id, form_type, as_of) the newest filing available by then; null without one."""
    from .joins import asof

    rows = filings.select("company_id", "form_type", "available_at", "filing_id").where("available_at is not null")
    return asof(requests, rows, ["company_id", "form_type"], "as_of", "available_at", ["filing_id"])


def fundamental_ratios(ttm: DataFrame) -> DataFrame:
    """Net margin, debt to equity and return on assets, null on a zero divisor."""
    out = {"net_margin": ratio(F.col("net_income"), F.col("revenue")), "debt_to_equity": ratio(F.col("liabilities"), F.col("equity")), "return_on_assets": ratio(F.col("net_income"), F.col("assets"))}
    return ttm.withColumns(out)
