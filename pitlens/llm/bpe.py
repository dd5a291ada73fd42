"""Byte-level BPE encoding and decoding with a local rank file.

Each task builds one tokenizer from the rank file and encodes whole texts in Arrow batches. A long text is
cut first at safe boundaries, places that end a token whatever stands around them: between a
non-space and the white space that follows, or between a letter and a following mark, number or other character
that is neither letter nor space. No token of the splitting pattern crosses them and none looks over
them, so the ids equal those of the uncut text while memory per call stays bounded by CHUNK and the
longest run without a boundary; a run of one kind of characters is one match of the pattern and can't be cut.

White space is matched by looking ahead, which fails on runs of about a million. A run of RUN or more is therefore a piece of its own, without its
last character where something follows, as the pattern leaves that to what follows; being one match, it is encoded without the pattern.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, read

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters after which a long text is cut at the next safe boundary.
CHUNK = 50_000
#: Texts of one output batch hold about so many bytes, or ids.
BATCH_CHARS = 1_000_000
RUN = 100_000
_SPACES = regex.compile(rf"\p{{White_Space}}{{{RUN},}}")
_SAFE = regex.compile(r"(?<=\S)(?=[ \n\t\r])|(?<=\p{L})(?=[^\p{L}\s])")


@functools.lru_cache(maxsize=4)
def tokenizer(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _cut(text: str, at: int, stop: int, chunk: int) -> Iterator[str]:
    while stop - at > chunk and (cut := _SAFE.search(text, at + chunk, stop)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:stop]


def pieces(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """`text` cut at the first safe boundary after each `chunk` characters, and around runs of RUN or more of white space; one piece where there is neither."""
    at = 0
    for run in _SPACES.finditer(text) if len(text) >= RUN else ():
        end = run.end() - (run.end() < len(text))
        yield from _cut(text, at, run.start(), chunk)
        yield text[run.start() : end]
        at = end
    yield from _cut(text, at, len(text), chunk)


def _encode_piece(enc: tiktoken.Encoding, piece: str) -> np.ndarray:
    if len(piece) >= RUN - 1 and piece.isspace():
        return np.array(enc._encode_single_piece(piece), np.uint32)
    return enc.encode_to_numpy(piece, disallowed_special=())


def encode_text(text: str | None, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK) -> np.ndarray:
    enc = tokenizer(ranks, pattern)
    parts = [_encode_piece(enc, p) for p in pieces(text or "", chunk) if p]
    return np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK) -> DataFrame:
    """One row per input row: `id_col` and token_ids array<int>, special tokens read as ordinary text.

    Null and empty texts give no ids; null ids and repeated rows stay as they are; other columns
    are left out, whatever their names; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in _slices(sizes, BATCH_CHARS):
                ids = [encode_text(t, ranks, pattern, chunk) for t in batch.column(1).slice(a, b - a).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), tokens], ["id", "token_ids"])

    bound_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, token_ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """`id_col`, `ids_col` and decoded binary, the bytes that the ids stand for, valid UTF-8 or not.
    Null or empty ids give no bytes; an id that the rank file lacks is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokenizer(ranks, pattern)
        for batch in batches:
            lists = batch.column(1)
            sizes = [n or 0 for n in lists.value_lengths().to_pylist()]
            for a, b in _slices(sizes, BATCH_CHARS):
                part = lists.slice(a, b - a)
                out = [enc.decode_bytes(x or []) for x in (y.values.to_pylist() if y.is_valid else None for y in part)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), part, pa.array(out, pa.binary())], ["id", "ids", "decoded"])

    rows = tokens.select(tokens[id_col].alias("id"), tokens[ids_col].alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary").withColumnsRenamed({"id": id_col, "ids": ids_col})


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(read(spark, sf_dir, "documents")))
    return done.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
