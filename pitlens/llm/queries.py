"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, centroids, langid, minhash, mixing, mtree, oracles, ordinal, perplexity, secrets, sharding, substring, tokenfiles, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": secrets.op1_secrets,
    "op2_perplexity": perplexity.op2_perplexity,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_mtree": mtree.op4_mtree,
    "op5_minhash": minhash.op5_minhash,
    "op6_sharding": sharding.op6_sharding,
    "op7_langid": langid.op7_langid,
    "op8_substring": substring.op8_substring,
    "op9_mixing": mixing.op9_mixing,
    "op10_ordinal": ordinal.op10_ordinal,
    "op11_tokenfiles": tokenfiles.op11_tokenfiles,
    "op12_centroids": centroids.op12_centroids,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES: dict[str, str] = {
    "op4_mtree": mtree.ORACLE,
    "op5_minhash": oracles.NEAR_DUPLICATES,
    "op8_substring": oracles.PASSAGES,
    "op9_mixing": mixing.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
