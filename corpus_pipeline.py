"""A training corpus from raw documents: graded, deduplicated, cleaned of secrets, mixed, tokenized."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlens.llm import bpe, minhash, mixing, ordinal, secrets
from pitlens.llm.common import keep, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grade model selects; it is fitted on the labelled ones among them, at most `ordinal.MAX_LABELED`.

    Null and empty texts are scored as texts without words. Labels with null ids or flags that decide nothing, and labels of no document, don't
    count; without two grades among them, all documents stay. Repeated rows are judged alike and stay as often; an empty table
    gives an empty one. Columns stay as they are, whatever their names.
    """
    model = ordinal.train(docs, ordinal.label_grades(read(spark, sf_dir, "labels")))
    return ordinal.score(docs, model).where("_selected").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates: five-word shingles, similarity of 0.8 or more.

    Null and empty texts are near to nothing and stay. Of repeated rows, and of different rows of equal id and text, one stays. Rows of a null id stay only where no
    row of their group has an id. Texts of any length are compared whole; an empty table gives an empty one.
    """
    return minhash.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and n_chars to match.

    Null and empty texts stay as they are. Repeated rows, null ids and very long texts are treated like others; overlapping secrets are replaced once; an
    empty table gives an empty one.
    """
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, up to three times.

    A null source is one source, the last. Null and empty texts have size 0. Repeated rows share their hash and are taken alike. Ties of
    hashes go together, so a source's words stay within its target. An empty table gives an empty one.
    """
    return mixing.apply_mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens, and the hash of the decoded bytes.

    Null and empty texts give no ids and the hash of no bytes. Every row gives one, repeated or not; other columns go.
    """
    done = bpe.decode(bpe.encode(docs))
    return done.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: The stages fit a model and count words of tokenizers; a test computes each stage's rows from its input by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
