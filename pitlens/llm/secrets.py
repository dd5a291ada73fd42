"""Secrets in texts by patterns and multipart credential linking, with DataFrame functions only.

Strong patterns report on their own. Weak candidates are parts of a credential: an identifier
(account, client id), a secret (random-looking string, short key) and an endpoint (URL, address).
Alone they are noise, so each is reported only if complementary parts lie in the same scope: a weak secret
with an identifier, a weak identifier with a secret, an endpoint with both. A scope is the interval of
text between two blank lines, however long.

Texts are scanned once, into a table of spans. The interval join of parts with scopes runs on the text's own axis:
blank lines and parts are sorted by position, so that each part knows the number of its scope, and what a scope
holds is gathered by (document, scope). No pairs of parts are made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, read

#: Fixed patterns of the strong kinds, in their order; of the first, group 2 has 6 characters or more.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
STRONG = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
ASSIGN_LEAST = 6
WEAK = {
    "weak_id": r"""(?i:access_?key(?:_?id)?|client_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}""",
    "weak_secret": r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}=*|(?i:pwd|pass|auth|private_?key)["']?\x20*[:=]\x20*["']?[^\s"']{4,}""",
    "endpoint": r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])""",
}
KINDS = [*STRONG, *WEAK]
IDENTIFIERS, SECRETS = ("access", "weak_id"), ("assign", "hex", "weak_secret")
#: What separates scopes.
BLANK = r"\n\s*\n"
_SPAN = "array<struct<start:long,rank:int,end:long,kind:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _before(lengths: Column) -> Column:
    """For each element of an array, the sum of those before it, in blocks of 64 so that long arrays stay cheap."""
    zero = F.lit(0).cast("long")
    total = lambda a, first, n: F.aggregate(F.slice(a, first, n), zero, lambda x, y: x + y)

    def blocks(a: Column) -> Column:
        at = F.sequence(F.lit(0), F.ceil(F.size(a) / 64).cast("int") - 1)
        return _let(
            F.transform(at, lambda b: total(a, b * 64 + 1, F.lit(64))),
            lambda sums: F.flatten(
                F.transform(
                    at,
                    lambda b: _let(
                        total(sums, F.lit(1), b),
                        lambda off: F.transform(F.sequence(F.lit(0), F.least(F.lit(63), F.size(a) - b * 64 - 1)), lambda i: off + total(a, b * 64 + 1, i)),
                    ),
                )
            ),
        )

    return _let(lengths, blocks)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points, end exclusive, with the
    value of the group; empty for null. The text is split at the matches, and the lengths are summed."""

    def spans(whole: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
        value = whole if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        size = lambda x, y: (F.length(x) + F.length(y)).cast("long")
        return _let(
            gaps,
            lambda g: F.transform(
                F.arrays_zip(_before(F.zip_with(g, whole, size)).alias("at"), g.alias("gap"), whole.alias("whole"), value.alias("value")),
                lambda p: F.struct((p["at"] + F.length(p["gap"])).alias("start"), (p["at"] + F.length(p["gap"]) + F.length(p["whole"])).alias("end"), p["value"].alias("value")),
            ),
        )

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:long,end:long,value:string>>"))


def find(text: Column, kind: str) -> Column:
    """The spans of a kind as array<struct<start, rank, end, kind>>."""
    found = matches(text, (STRONG | WEAK)[kind], 2 if kind == "assign" else 0)
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(m["value"]) >= ASSIGN_LEAST)
    return F.transform(found, lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("rank"), m["end"], F.lit(kind).alias("kind"))).cast(_SPAN)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k (hash of id and text), id, base (spans of the strong kinds), parts (all kinds and the starts of blank lines; null in texts without an identifier),
    written: one row per row of `docs`, by one scan."""
    text = docs[text_col]
    base = F.array_sort(F.concat(*(find(text, kind) for kind in STRONG)))
    blank = F.transform(matches(text, BLANK), lambda m: F.struct(m["start"], F.lit(-1).alias("rank"), m["start"].alias("end"), F.lit("blank").alias("kind"))).cast(_SPAN)
    has_id = text.rlike(STRONG["access"]) | text.rlike(WEAK["weak_id"])
    weak = F.when(has_id, F.concat(*(find(text, kind) for kind in WEAK), blank))
    return keep(docs.select(F.xxhash64(docs[id_col], text).alias("k"), docs[id_col].alias("id"), base.alias("base"), weak.alias("parts")), "secret-spans")


def linked(found: DataFrame) -> DataFrame:
    """k, more: weak spans that complementary parts of their scope complete, for the rows of `spans`."""
    parts = found.where("parts is not null").select("k", F.explode(F.concat("base", "parts")).alias("p")).select("k", "p.*").distinct()
    axis = Window.partitionBy("k").orderBy("start")
    strong = F.col("kind").isin(*STRONG)
    placed = parts.withColumns(
        {
            "scope": F.count(F.when(F.col("kind") == "blank", 1)).over(axis),
            # spans of strong kinds that reach over this start, or start before this end
            "before": F.max(F.when(strong, F.col("end"))).over(axis.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
            "after": F.min(F.when(strong, F.col("start"))).over(axis.rangeBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    ).where("kind != 'blank'")
    inside = (F.col("before") > F.col("start")) | (F.col("after") < F.col("end"))
    placed = placed.where(strong | ~F.coalesce(inside, F.lit(False)))
    scope = Window.partitionBy("k", "scope")
    placed = placed.withColumns({"identifier": F.max(F.col("kind").isin(*IDENTIFIERS)).over(scope), "secret": F.max(F.col("kind").isin(*SECRETS)).over(scope)})
    whole = F.when(F.col("kind") == "weak_secret", F.col("identifier")).when(F.col("kind") == "weak_id", F.col("secret")).otherwise(F.col("identifier") & F.col("secret"))
    return placed.where(F.col("kind").isin(*WEAK) & whole).groupBy("k").agg(F.collect_list(F.struct("start", "rank", "end", "kind")).cast(_SPAN).alias("more"))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k, id, base and spans of each row of `docs`: the strong kinds, and those with the linked weak parts; both arrays of (start, rank, end, kind) by start, then kind.

    Null and empty texts have no spans. Repeated rows and null ids are scanned like others; an
    empty table gives an empty one.
    """
    found = spans(docs, id_col, text_col)
    more = keep(linked(found), "linked-parts")
    every = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN))))
    return found.join(more, "k", "left").select("k", "id", "base", every.alias("spans"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: row (all its columns, whatever their names, as one struct), base and spans as in `found_spans`."""
    found = found_spans(docs, id_col, text_col).where(F.size("spans") > 0).select("k", "base", "spans").dropDuplicates(["k"])
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.xxhash64(docs[id_col], docs[text_col]).alias("k"))
    none = F.array().cast(_SPAN)
    return rows.join(keep(found, "texts-with-spans"), "k", "left").select("row", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of its texts replaced by `mark`; overlapping spans are one. Texts without a span, null ones too, and all other columns stay."""
    found = scan(docs, id_col, text_col)
    at = F.lit(0).cast("long")
    text = F.col("row").getField(text_col)
    gaps = F.aggregate(
        F.col("spans"),
        F.struct(at.alias("at"), F.array().cast("array<struct<at:long,n:long>>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.array_append(acc["out"], F.struct(acc["at"].alias("at"), (s["start"] - acc["at"]).alias("n")))).otherwise(acc["out"]).alias("out"),
        ),
    )
    cut = lambda g: F.substr(text, (g["at"] + 1).cast("int"), g["n"].cast("int"))
    clean = _let(gaps, lambda g: F.concat(F.array_join(F.transform(g["out"], cut), mark), F.lit(mark), F.substr(text, (g["at"] + 1).cast("int"))))
    out = found.withColumn("_clean", F.when(F.size("spans") > 0, clean).otherwise(text))
    return out.select(*(F.col("_clean").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_spans(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *(count(kind).alias(f"n_{kind}") for kind in STRONG),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
