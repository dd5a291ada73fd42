"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document is the set of its distinct word shingles. Its sketch has BANDS * ROWS coordinates, filled in
rounds: in each of the first T rounds every shingle is hashed to a random coordinate with a value that
grows with the round; round T + i puts every shingle in coordinate i, so that none stays empty. A
coordinate keeps its smallest value and equals that of another set with probability equal to their
similarity. Large sets are done after a round or so, which makes a sketch cost n + T log T.

Documents of equal set are one class. Classes that share a band of ROWS coordinates are candidates;
at similarity 0.8 a pair shares none of the 42 bands with probability 3e-6. Shingles that no other
candidate has can't be in any intersection, so a count of them bounds the similarity of every pair;
most false candidates go by that. In each bucket all members are first verified against the one with
fewest such shingles, the most central of a group of copies, so a hot bucket of near copies costs a star.

By then most buckets lie within one component. The classes of the other buckets are not paired by
bucket, as a family of texts just under the threshold would give all its pairs, but by rare shingles: with
the shingles of each in one common order, rarest first, two similar enough sets share one among the first few
of both, and what follows it in both bounds what they share. Pairs that pass this and a comparison of
bitmaps are verified. Verification compares the words of both texts, so links don't rest on hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, discard, gram_hashes, keep, lower_ascii, mix, read, signed, utf8_slices, word_hashes
from .graph import components

BANDS, ROWS = 42, 6
#: 64-bit words of a set's bitmap.
BITMAP = 32
#: Hash values made at once while filling a sketch.
_BLOCK = 4096


def shingles(data: np.ndarray, words: int) -> np.ndarray:
    """Distinct hashes of the word n-grams of UTF-8 bytes, ASCII lower-cased; a shorter text is one shingle, one without words none."""
    hashes = word_hashes(lower_ascii(data))
    return np.unique(gram_hashes(hashes, min(words, len(hashes)))) if len(hashes) else hashes


def alike(x: bytes, y: bytes, words: int, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union holds for the shingles of two texts themselves."""
    a, b = (data.lower().split() for data in (x, y))
    a, b = (set(zip(*(w[i:] for i in range(min(words, len(w)))))) for w in (a, b))
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """`size` coordinates of a non-empty set of hashes."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, _BLOCK // len(items))
    for first in range(0, 2 * size, step):
        rounds = np.arange(first, min(first + step, 2 * size), dtype=np.uint64)[:, None]
        with np.errstate(over="ignore"):
            value = mix(items[None, :] + rounds * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        bins = ((value >> np.uint64(40)) * np.uint64(size)) >> np.uint64(24)
        bins = np.where(rounds < size, bins, np.maximum(rounds, np.uint64(size)) - np.uint64(size))
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds << np.uint64(40)) | (value & np.uint64((1 << 40) - 1))).ravel())
        if (out != np.iinfo(np.uint64).max).all():
            break
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = coordinates.reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        with np.errstate(over="ignore"):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return keys


def set_hash(items: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(signed(mix(mix(items + np.uint64(77)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(items))))[0])


def sketched(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """id, k (hash of id and text), n (shingles), set (hash of the set; k where it is empty), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column(1).to_pylist()
            n, sets, keys, ends = [], [], [], [0]
            for k, data in zip(ks, utf8_slices(batch.column(2))):
                items = shingles(data, words)
                n.append(len(items))
                sets.append(set_hash(items) if len(items) else k)
                if len(items):
                    keys.append(band_keys(sketch(items, bands * rows), bands, rows))
                ends.append(ends[-1] + bands * bool(len(items)))
            flat = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sets, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["id", "k", "n", "set", "bands"],
            )

    source = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], docs[text_col]).alias("k"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, k long, n long, set long, bands array<long>")


def shingle_sets(docs: DataFrame, picks: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """set, text, items (sorted hashes), bits (bitmap of the items), for `picks` (set, k); of repeated rows, one for each task that meets them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for one in batch.column(0).to_pylist():
                fresh.append(one not in seen)
                seen.add(one)
            if not all(fresh):
                batch = batch.filter(pa.array(fresh))
            items = [shingles(data, words) for data in utf8_slices(batch.column(1))]
            ends = np.cumsum([0, *map(len, items)]).astype(np.int32)
            flat = signed(np.concatenate(items)) if items else np.zeros(0, np.int64)
            bits = np.zeros((len(items), BITMAP * 64), bool)
            for i, one in enumerate(items):
                bits[i, one % np.uint64(BITMAP * 64)] = True
            bits = np.packbits(bits, axis=1).view(np.int64).ravel() if len(items) else np.zeros(0, np.int64)
            starts = pa.array(np.arange(len(items) + 1) * BITMAP, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.ListArray.from_arrays(starts, pa.array(bits))], ["set", "text", "items", "bits"])

    texts = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("k"), docs[text_col].alias("text"))
    return texts.join(picks, "k").select("set", "text").mapInArrow(run, "set long, text string, items array<long>, bits array<long>")


def single(sets: DataFrame) -> DataFrame:
    """`sets`, a stored table, with one row for each set, stored anew only if repeated rows have left more."""
    more = keep(sets.groupBy("set").count().where("count > 1").select("set"), "repeated-sets")
    if more.isEmpty():
        return sets
    once = keep(sets.join(more, "set", "left_anti").unionByName(sets.join(more, "set", "left_semi").dropDuplicates(["set"])), "sets")
    discard(sets, more)
    return once


def verified(pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The distinct `pairs` (a, b) of classes that are similar enough, larger first, by their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [[bytes(data) for data in utf8_slices(batch.column(i))] for i in (2, 3)]
            yield batch.select([0, 1]).filter(pa.array([alike(x, y, words, percent) for x, y in zip(*texts)], pa.bool_()))

    pairs = keep(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    side = lambda name, text: sets.select(F.col("set").alias(name), F.col("text").alias(text))
    links = keep(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
    discard(pairs)
    return links


def across(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of `rest` (set, n, m, root) of unlike roots that may be similar enough; n items, m at most shared with any.

    Items are ordered by how many of these sets have them. If the smaller set a and the larger b are similar enough they share
    alpha = percent / (100 + percent) * (|a| + |b|) items or more, hence one among the first |a| - alpha + 1 of a and |b| - alpha + 1 of b,
    and of the first such one no more than those from it on in either. As |b| lies between |a| and 100 / percent * |a|, the
    lengths of both starts are bounded by the set's own size. Of one item, pairs are made between the sets outside its commonest root and all others, so
    a component's own members never meet.
    """
    p = percent
    once = keep(rest.join(sets, "set").dropDuplicates(["set"]).select("set", "n", "items", "bits"), "rest-sets")
    tokens = once.select("set", F.explode("items").alias("item"))
    counts = keep(tokens.groupBy("item").agg(F.count("*").alias("c")).where("c > 1"), "rest-items")
    # an item of one set can't match, and comes first in the order: only its number matters
    shared = tokens.join(counts, "item").groupBy("set").agg(F.array_sort(F.collect_list(F.struct("c", "item"))).alias("order"))
    reach = (F.floor(((100 + p) * F.col("m") - p * F.col("n")) / p)).cast("long")
    probe = F.col("n") - F.ceil(p * F.col("n") / 100) + 1
    index = F.when(reach >= F.col("n"), F.col("n") - F.ceil(2 * p * F.col("n") / (100 + p)) + 1).otherwise(0)
    ranked = rest.join(shared, "set").withColumn("skipped", F.col("n") - F.size("order"))
    ranked = ranked.select("set", "n", "root", reach.alias("reach"), index.alias("index"), probe.alias("probe"), "skipped", F.posexplode(F.slice("order", F.lit(1), F.greatest(probe - F.col("skipped"), F.lit(0)).cast("int"))))
    starts = ranked.select("set", "n", "root", "reach", (F.col("pos") + F.col("skipped")).alias("pos"), F.col("col.item").alias("item"), (F.col("pos") + F.col("skipped") < F.col("index")).alias("small"))
    starts = keep(starts, "rest-starts")
    heads = keep(starts.groupBy("item").agg(F.mode("root").alias("head"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("item", "head"), "rest-heads")
    odd = starts.join(heads, "item").where("root != head").select("item", *(F.col(c).alias(f"a_{c}") for c in ("set", "n", "root", "reach", "pos", "small")))
    odd = keep(odd, "rest-odd")
    least = p * (F.col("a_n") + F.col("n")) / (100 + p)
    fits = (F.col("n") <= F.col("a_reach")) & (F.col("a_n") <= F.col("reach")) & (F.least(F.col("a_n") - F.col("a_pos"), F.col("n") - F.col("pos")) >= least)
    roles = ((F.col("a_n") <= F.col("n")) & F.col("a_small")) | ((F.col("n") <= F.col("a_n")) & F.col("small"))
    found = odd.join(starts, "item").where((F.col("a_root") != F.col("root")) & fits & roles).select(F.greatest("a_set", "set").alias("a"), F.least("a_set", "set").alias("b")).distinct()
    pairs = keep(found, "rest-pairs")

    def apart(a: str, b: str) -> Column:
        """Items of set a that b can't have, by their bitmaps."""
        return sum((F.bit_count(F.col(f"{a}bits")[i].bitwiseAND(F.bitwise_not(F.col(f"{b}bits")[i]))) for i in range(BITMAP)), F.lit(0))

    side = lambda name: once.select(F.col("set").alias(name), F.col("n").alias(f"{name}n"), F.col("bits").alias(f"{name}bits"))
    most = F.least(F.col("an") - apart("a", "b"), F.col("bn") - apart("b", "a"))
    close = keep(pairs.join(side("a"), "a").join(side("b"), "b").where(100 * most >= p * (F.col("an") + F.col("bn") - most)).select("a", "b"), "rest-close")
    discard(once, counts, starts, heads, odd, pairs)
    return close


def cluster(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: `id_col`, row_hash (of id and text), n_shingles, class_id (hash of its set), component_id (smallest id linked with it, over any number
    of links, itself included).

    Two documents are linked if 100 * intersection >= percent * union of their sets of `words`-word
    shingles. Null and empty texts have no shingles and are linked with nothing: their component
    is their own id. Null ids never are the smallest, unless all are. Repeated rows share a class and
    get a row each. Equal sets are told by 64-bit hashes, links by the words. Other columns are left out.
    """
    bound_batches(docs.sparkSession)
    made = keep(sketched(docs, id_col, text_col, words, bands, rows), "sketches")
    full = made.where("n > 0")
    classes = keep(full.groupBy("set").agg(F.min("id").alias("first_id"), F.min("k").alias("k"), F.first("n").alias("n")), "classes")
    members = full.dropDuplicates(["set"]).select("set", "n", F.explode("bands").alias("key"))
    live = keep(members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "buckets")
    bucketed = keep(members.join(live, "key"), "members")
    picks = bucketed.select("set").distinct().join(classes.select("set", "k"), "set")
    sets = single(keep(shingle_sets(docs, picks, id_col, text_col, words), "sets"))
    # an item of one set only names that set by its largest owner
    owners = sets.select("set", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c"), F.max("set").alias("set"))
    lone = keep(owners.where("c = 1").groupBy("set").agg(F.count("*").alias("lone")), "lone-items")
    members = bucketed.join(lone, "set", "left").withColumn("m", F.col("n") - F.coalesce("lone", F.lit(0))).where(100 * F.col("m") >= percent * F.col("n")).drop("lone")
    members = keep(members, "bounded-members")
    # fewest lone items first; xor with the key draws among equals
    rank = (F.col("n") - F.col("m")) * (1 << 40) + F.col("set").bitwiseXOR(F.col("key")).bitwiseAND(F.lit((1 << 40) - 1))
    leaders = keep(members.groupBy("key").agg(F.min_by("set", rank).alias("leader"), F.count("*").alias("c")).where("c > 1").drop("c"), "leaders")
    led = keep(members.join(leaders, "key"), "led-members")
    discard(live, bucketed, lone, members, leaders)

    most = F.least("m", "lm")
    near = 100 * most >= percent * (F.col("n") + F.col("ln") - most)
    sizes = led.where("set = leader").select("leader", F.col("n").alias("ln"), F.col("m").alias("lm")).distinct()
    stars = led.where("set != leader").select("set", "n", "m", "leader").distinct().join(sizes, "leader").where(near)
    links = verified(stars.select(F.col("set").alias("a"), F.col("leader").alias("b")), sets, words, percent)
    roots = components(links)
    placed = keep(led.join(roots.withColumnRenamed("node", "set"), "set", "left").select("key", "set", "n", "m", F.coalesce("root", "set").alias("root")), "placed")
    mixed = keep(placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key"), "mixed")
    rest = keep(placed.join(mixed, "key", "left_semi").select("set", "n", "m", "root").distinct(), "rest")
    close = across(rest, sets, percent)
    more = verified(close, sets, words, percent)
    every = components(links.union(more))
    named = every.join(classes.withColumnRenamed("set", "node"), "node").select("node", "root", "first_id")
    least = keep(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "least-ids")
    named = named.join(least, "root").select(F.col("node").alias("set"), "component_id")
    final = keep(classes.join(named, "set", "left").select("set", F.coalesce("component_id", "first_id").alias("component_id")), "components")
    discard(classes, sets, led, links, roots, placed, mixed, rest, close, more, every, least)
    out = made.join(final, "set", "left")
    return out.select(F.col("id").alias(id_col), F.col("k").alias("row_hash"), F.col("n").alias("n_shingles"), F.col("set").alias("class_id"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose id is that of their component, one of each; repeated rows count once. All columns stay."""
    found = cluster(docs, id_col, text_col, words, percent)
    head = F.col(id_col).eqNullSafe(F.col("component_id"))
    # what goes is far less than what stays
    marked = found.groupBy("row_hash").agg(F.bool_or(head).alias("head"), F.count("*").alias("c")).where("not head or c > 1")
    marked = keep(marked.select(F.col("row_hash").alias("_mark"), "head"), "marked")
    packed = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("_hash"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    same = F.col("_hash") == F.col("_mark")
    once = packed.join(marked, same, "left_anti")
    again = packed.join(marked.where("head"), same, "left_semi").dropDuplicates(["_hash"])
    return once.union(again).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(read(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
