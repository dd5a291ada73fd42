"""Removal of repeated passages: seed and extend over winnowed anchors.

A passage is a window of `length` words. Each window has one anchor, its n-gram of smallest hash,
so equal windows have equal anchors at equal offsets, and every shared run of `length` words shares one.
The windows that an anchor serves are neighbours and form a block, the longest extension of the
anchor to both sides that its windows can reach. Documents are joined on anchors:

* an anchor that occurs once has no repeated window;
* occurrences of one anchor with equal blocks extend alike to both ends: all their windows repeat;
* occurrences with unequal blocks extend only so far: one of each kind of block lists its windows,
  and windows with equal words are matched.

No pairs are made, so a passage in a million documents costs a million rows. Overlapping repeated
windows add up to the maximal repeats, whose words go. Of repeated rows, of equal id and text, one is searched; they lose all their words, if there are enough, as each repeats the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, gram_hashes, keep, mix, read, run_hashes, signed, utf8_slices, word_hashes

LENGTH = 35
ANCHOR = 6


def blocks(words: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, of the block's words and offsets, first window, number of windows less 1) of each block of a document."""
    if len(words) < length:
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int32), none.astype(np.int32)
    grams = gram_hashes(words, anchor)
    at = np.lib.stride_tricks.sliding_window_view(grams, length - anchor + 1).argmin(axis=1)
    at += np.arange(len(at))
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    more = np.diff(np.r_[first, len(at)]) - 1
    with np.errstate(over="ignore"):
        content = mix(run_hashes(words, first, more + length) + (at[first] - first).astype(np.uint64) * np.uint64(1 << 20) + more.astype(np.uint64))
    return grams[at[first]], content, first.astype(np.int32), more.astype(np.int32)


def _lists(ends: list[int], *columns: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c)) for c in columns]


def _flat(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _spans(rows, fields: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """The fields of each row of an array<struct> column as arrays, empty for null."""
    for row in rows:
        yield [np.asarray(row.values.field(f)) if row.is_valid else np.zeros(0, np.int32) for f in fields]


def _fresh(keys: pa.Array, seen: set[int]) -> Iterator[bool]:
    """Whether the task meets each key for the first time; `seen` holds 8 bytes or so for each distinct row of the task."""
    for k in keys.to_pylist():
        yield k not in seen
        seen.add(k)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: `id_col`, n_words, n_removed, text (the kept words joined by one space).

    A word goes if a window of `length` words around it starts anywhere else too, in the same document or
    another; all occurrences go. Null and empty texts have no words; a text under
    `length` words loses none. Repeated rows repeat each other's windows. Null ids are allowed;
    other columns are left out; an empty table gives an empty one. Words and windows are compared by 64-bit hashes.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            found = [blocks(word_hashes(data) if fresh else none, length, anchor) for data, fresh in zip(utf8_slices(batch.column(1)), _fresh(batch.column(0), seen))]
            ends = np.cumsum([0, *(len(f[0]) for f in found)])
            cols = [_flat([f[i] for f in found], np.uint64 if i < 2 else np.int32) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_lists(ends, signed(cols[0]), signed(cols[1]), cols[2], cols[3])], ["k", "a", "b", "s", "l"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            a, w, k, s = [], [], [], []
            for key, data, (anchors, first, more), fresh in zip(batch.column(0).to_pylist(), utf8_slices(batch.column(1)), _spans(batch.column(2), ("a", "s", "l")), _fresh(batch.column(0), seen)):
                if not fresh:
                    continue
                starts = np.repeat(first, more + 1) + np.concatenate([np.arange(m + 1) for m in more])
                w.append(run_hashes(word_hashes(data), starts, np.full(len(starts), length)))
                a.append(np.repeat(anchors, more + 1))
                k.append(np.full(len(starts), key, np.int64))
                s.append(starts.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(_flat(a, np.int64)), pa.array(signed(_flat(w, np.uint64))), pa.array(_flat(k, np.int64)), pa.array(_flat(s, np.int32))], ["a", "w", "k", "s"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, text = [], [], []
            for data, (first, more) in zip(utf8_slices(batch.column(1)), _spans(batch.column(2), ("s", "l"))):
                words = data.tobytes().split()
                n.append(len(words))
                if len(first):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, first, 1)
                    np.subtract.at(edge, first + more + length, 1)
                    kept = np.cumsum(edge[:-1]) == 0
                    words = [x for x, y in zip(words, kept.tolist()) if y]
                gone.append(n[-1] - len(words))
                text.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text, pa.string())], ["id", "n_words", "n_removed", "text"])

    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], docs[text_col]).alias("k"), docs[text_col].alias("text"))
    found = keep(rows.select("k", "text").mapInArrow(find, "k long, a array<long>, b array<long>, s array<int>, l array<int>"), "blocks")
    # blocks of a repeated row come from one task, or from as many as have seen it
    repeated = keep(found.groupBy("k").count().where("count > 1").select("k"), "repeated-rows")
    again = not repeated.isEmpty()
    if again:
        twins = keep(found.where(F.size("a") > 0).join(repeated, "k", "left_semi").dropDuplicates(["k"]), "twins")
        single = keep(found.join(repeated, "k", "left_anti").unionByName(twins), "blocks")
        discard(found)
        found = single
    multi = keep(found.select(F.explode("a").alias("a")).groupBy("a").count().where("count > 1").select("a"), "anchors")
    flat = found.select("k", F.explode(F.arrays_zip("a", "b", "s", "l")).alias("z")).select("k", "z.*")
    seeds = keep(flat.join(multi, "a"), "seeds")
    discard(found, multi)
    kinds = keep(seeds.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("k").alias("one")), "kinds")
    several = keep(kinds.groupBy("a").count().where("count > 1").select("a", F.lit(True).alias("several")), "several")
    open_kinds = keep(kinds.join(several, "a", "left").where("n > 1 or several"), "open-kinds")
    joined = seeds.join(open_kinds, ["a", "b"])
    spans = F.collect_list(F.struct("s", "l"))
    whole = joined.where("n > 1").select("k", "s", "l")
    asked = joined.where("several and k = one").groupBy("k").agg(F.collect_list(F.struct("a", "s", "l")).alias("spans"))
    # equal windows have equal anchors, so both hashes tell them apart
    listed = keep(rows.join(asked, "k").select("k", "text", "spans").mapInArrow(windows, "a long, w long, k long, s int"), "windows")
    twice = keep(listed.groupBy("a", "w").count().where("count > 1").select("a", "w"), "repeated")
    part = listed.join(twice, ["a", "w"]).select("k", "s", F.lit(0).alias("l"))
    gone = whole.union(part)
    if again:
        all_of = twins.select("k", F.lit(0).alias("s"), F.array_max(F.zip_with("s", "l", lambda s, l: s + l)).alias("l"))
        gone = gone.join(repeated, "k", "left_anti").union(all_of)
    marks = keep(gone.groupBy("k").agg(spans.alias("spans")), "marks")
    discard(seeds, kinds, several, open_kinds, listed, twice, repeated, *([twins] if again else []))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(marks, "k", "left").select("id", "text", "spans").mapInArrow(remove, f"id {kind}, n_words long, n_removed long, text string").withColumnRenamed("id", id_col)


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
