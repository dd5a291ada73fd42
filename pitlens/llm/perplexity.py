"""Quality rules: text counts, and perplexity under word pairs over a modified Kneser-Ney spelling model.

The spelling model is over trigrams of 128 symbols: case-folded ASCII letters, marks, and 82 symbols for code points beyond
ASCII, by remainder, so that the letters of one alphabet differ. It has at most 128**3 trigrams however large the corpus is. Spark counts them over
all documents; the smoothed log probabilities and back-off weights are stored in arrays sorted by hash.

It is the base of a model of word pairs, which grows with the corpus: P(u, v) = (c(u, v) + K * S(u) * S(v)) / (N + K), S being
spelling, c and N numbers of pairs, those of u and v in all other documents, and K a share of N. Pairs are counted
and looked up in hash partitions: every batch of texts sends its distinct pairs, each with the texts that have it, and
each partition returns sums by text. What a text gains over spelling, by symbol, is low in word salad; copies gain much, which is no fault.

Both the mean surprise of spelling and the gain are compared with bands of the document's language, drawn around the median by
the robust spread of all its documents, in standard errors for the text's length. A text is
rejected above (noise) or below (repetition) the band of the first, or if it gains too little.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, keep, mix, read, signed, utf8_slices, word_bounds, word_hashes

SYMBOLS = 128
_BITS = 7
_MASK = SYMBOLS - 1
#: Half widths of the bands, in robust standard deviations of the language's documents.
UPPER, LOWER = 4.5, 6.0
#: Standard deviation between texts of any length; least robust spread of the standardized values.
BETWEEN, LEAST_SPREAD = 0.01, 0.25
MIN_WORDS, WINDOW, MAX_REPEAT = 10, 5, 20
#: K as a share of all pairs; variance of the gain of one symbol.
PRIOR, GAIN_VARIANCE = 0.25, 1.0
#: Symbols in a hash partition of pairs; pairs and texts in a batch that sends them; nats in a step of the spelling's log probability.
SHARE, BATCH_PAIRS, BATCH_TEXTS, STEP = 1 << 25, 1 << 20, 1 << 15, 0.5


def _table() -> np.ndarray:
    """Symbol of each code point under 128."""
    out = np.full(128, 45, np.uint8)
    for first, marks in enumerate([" ", "\n\t\r\x0b\x0c", ".", ",", "!", "?", "'\"`", "-_", ":;", "()[]{}", "|", "#", "*", "$", "%", "&", "<>"], 28):
        for c in marks:
            out[ord(c)] = first
    out[97:123] = np.arange(1, 27)
    out[65:91] = np.arange(1, 27)
    out[48:58] = 27
    return out


_ASCII = _table()
_MARKS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def code_points(text: str) -> np.ndarray:
    """Of a lower-cased text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray) -> np.ndarray:
    """Number of the trigram of symbols that ends at each code point; two of the start, which is 0, come before."""
    s = np.zeros(len(codes) + 2, np.int32)
    s[2:] = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], 46 + codes % np.uint32(SYMBOLS - 46))
    return (s[:-2] << 2 * _BITS) | (s[1:-1] << _BITS) | s[2:]


def rules(data: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 bytes."""
    hashes, (starts, ends) = word_hashes(data), word_bounds(data)
    n = len(hashes)
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    seen: set[bytes] = set()
    repeated = 0
    for line in data.tobytes().split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            repeated += line in seen
            seen.add(line)
    covered = 0
    found = gram_hashes(hashes, WINDOW)
    if len(found):
        _, inverse, count = np.unique(found, return_inverse=True, return_counts=True)
        edge = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(count[inverse] > 1)
        edge[at] += 1
        edge[at + WINDOW] -= 1
        covered = int((np.cumsum(edge[:-1]) > 0).sum())
    return n, int((points[ends] - points[starts]).sum()), int(_MARKS[data].sum()), repeated, covered


class Model:
    """Hashes of n-grams in ascending order, with log probability and log back-off weight of each."""

    _unpacked: tuple[str, np.ndarray] | None = None

    def __init__(self, keys: np.ndarray, logp: np.ndarray, backoff: np.ndarray):
        self.keys, self.logp, self.backoff, self.name = keys, logp, backoff, uuid.uuid4().hex
        #: Variance of the surprise of one symbol, symbols and word pairs counted.
        self.variance, self.n_symbols, self.n_pairs = 0.0, 0, 0

    def table(self) -> np.ndarray:
        """Surprise of all trigrams, looked up in the hash arrays once by each worker."""
        if Model._unpacked is None or Model._unpacked[0] != self.name:
            Model._unpacked = self.name, self.surprise(np.arange(1 << 3 * _BITS)).astype(np.float32)
        return Model._unpacked[1]

    @staticmethod
    def hashed(gram: np.ndarray, order: int) -> np.ndarray:
        return mix(gram.astype(np.uint64) + np.uint64(order << 40))

    def find(self, gram: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = self.hashed(gram, order)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        seen = self.keys[at] == key
        return seen, np.where(seen, self.logp[at], 0.0), np.where(seen, self.backoff[at], 0.0)

    def surprise(self, gram: np.ndarray) -> np.ndarray:
        """-log P of the last symbol of each trigram."""
        out = np.zeros(len(gram))
        back = np.zeros(len(gram))
        done = np.zeros(len(gram), bool)
        low = _MASK
        for order, tail, context in ((3, gram, gram >> _BITS), (2, gram & ((1 << 2 * _BITS) - 1), (gram >> _BITS) & low), (1, gram & low, None)):
            seen, logp, _ = self.find(tail, order)
            out = np.where(seen & ~done, back + logp, out)
            done |= seen
            if context is not None:
                back = np.where(done, back, back + self.find(context, order - 1 + 10)[2])
        return -out


def kneser_ney(gram: np.ndarray, count: np.ndarray) -> Model:
    """Interpolated modified Kneser-Ney from trigram counts, down to the uniform distribution."""
    tri = np.bincount(gram, count, minlength=1 << 3 * _BITS)
    seen3 = tri > 0
    bi = seen3.reshape(SYMBOLS, -1).sum(axis=0).astype(float)  # distinct symbols before each pair
    uni = (bi > 0).reshape(SYMBOLS, -1).sum(axis=0).astype(float)

    def discounts(c: np.ndarray) -> np.ndarray:
        n = [max(1, int((c == i).sum())) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]
        return np.array([0, *d])

    def level(c: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities and back-off weights by context; `lower` by last symbols."""
        d = discounts(c)[np.minimum(c, 3).astype(int)]
        c, d = c.reshape(-1, SYMBOLS), d.reshape(-1, SYMBOLS)
        total = np.maximum(c.sum(axis=1, keepdims=True), 1)
        weight = np.where(c.sum(axis=1, keepdims=True) > 0, d.sum(axis=1, keepdims=True) / total, 1.0)
        lower = np.tile(lower.reshape(-1, SYMBOLS), (len(c) // lower.reshape(-1, SYMBOLS).shape[0], 1))
        return (np.maximum(c - d, 0) / total + weight * lower).ravel(), weight.ravel()

    p1, w0 = level(uni, np.full(SYMBOLS, 1 / SYMBOLS))
    p2, w1 = level(bi, p1)
    p3, w2 = level(tri, p2)
    keys, logp, back = [], [], []
    for order, c, p in ((1, uni, p1), (2, bi, p2), (3, tri, p3)):
        at = np.flatnonzero((c > 0) | (order == 1))
        keys.append(Model.hashed(at, order)), logp.append(np.log(p[at])), back.append(np.zeros(len(at)))
    for order, w in ((11, w1), (12, w2)):
        at = np.flatnonzero(w < 1)
        keys.append(Model.hashed(at, order)), logp.append(np.zeros(len(at))), back.append(np.log(np.maximum(w[at], 1e-12)))
    keys, logp, back = map(np.concatenate, (keys, logp, back))
    order = np.argsort(keys)
    return Model(keys[order], logp[order].astype(np.float32), back[order].astype(np.float32))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """The spelling model, from the trigram counts of all `docs`. The driver gets at most 128**3 rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, n_pairs = np.zeros(1 << 3 * _BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n_pairs += max(0, len((text or "").encode("utf-8", "surrogatepass").split()) - 1)
                gram = grams(code_points((text or "").lower()))
                if len(gram) < 200_000:
                    np.add.at(have, gram, 1)
                else:
                    have += np.bincount(gram, minlength=len(have))
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n_pairs, have[at]])], ["gram", "n"])

    counts = docs.select(docs[text_col]).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    n_pairs, counts = int(counts["n"][counts["gram"] < 0].sum()), counts[counts["gram"] >= 0]
    gram, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    model = kneser_ney(gram, n)
    model.n_pairs = n_pairs
    if len(n):
        surprise = model.surprise(gram)
        model.variance, model.n_symbols = float(np.average(surprise**2, weights=n) - np.average(surprise, weights=n) ** 2), int(n.sum())
    return model


def pairs(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: hashes of its distinct word pairs, their counts, and the surprise of both words' spelling in steps, 255 at most."""
    text = text.lower()
    hashes = word_hashes(text.encode("utf-8", "surrogatepass"))
    if len(hashes) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    codes = code_points(text)
    gram, (starts, ends) = grams(codes), word_bounds(codes)
    # each word as if it began the text
    gram[starts] &= _MASK
    gram[(starts + 1)[ends - starts > 1]] &= (1 << 2 * _BITS) - 1
    total = np.r_[0, np.cumsum(table[gram], dtype=float)]
    word = total[ends] - total[starts]
    pair, at, n = np.unique(gram_hashes(hashes, 2), return_index=True, return_counts=True)
    return pair, n, np.minimum((word[:-1] + word[1:])[at] / STEP, 255).astype(np.uint8)


def _planes(a: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of each number, byte by byte, which compresses well."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data: np.ndarray, width: int) -> np.ndarray:
    whole = np.zeros((len(data) // width, 8), np.uint8)
    whole[:, :width] = data.reshape(width, -1).T
    return whole.ravel().view("<u8").astype(np.int64)


_WIDTHS = (8, 1, 2, 2, 4)


def _pack(pair: np.ndarray, base: np.ndarray, doc: np.ndarray, times: np.ndarray) -> bytes:
    """Rows sorted by pair: each pair once, as the step from the one before, its base and number of texts, then the texts and their counts."""
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    parts = (np.diff(pair[first], prepend=np.uint64(0)), base[first], np.diff(np.r_[first, len(pair)]), doc, times)
    head = np.array([len(first), len(pair)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(_planes(a, w) for a, w in zip(parts, _WIDTHS)))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, bases, numbers of texts of each; texts and counts."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n, rows = (int(x) for x in data[:8].view("<u4"))
    out, at = [], 8
    for width, size in zip(_WIDTHS, (n, n, n, rows, rows)):
        out.append(_numbers(data[at : at + width * size], width))
        at += width * size
    out[0] = np.cumsum(out[0])
    return tuple(out)


_SENT = "p int, batch long, size int, data binary"


def gains(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k (hash of id and text), gain and n: what word pairs gain on spelling in the texts with this hash, in nats, and their pairs.

    Every batch of texts sends its pairs by partition; each partition counts its pairs over all batches, less
    a document's own, and returns sums by document. Hashes of pairs have 10 bits more than the corpus's size asks for.
    """
    parts = max(1, -(-model.n_symbols // SHARE))
    drop = np.uint64(64 - min(62, int(model.n_symbols).bit_length() + 10))

    def messages(keys: list[int], found: list[tuple]) -> pa.RecordBatch:
        keys, words = np.array(keys, np.int64), np.array([int(n.sum()) for _, n, _ in found], np.int64)
        name = int(signed(mix(np.array([mix(keys.view(np.uint64)).sum(dtype=np.uint64)], np.uint64)))[0])
        out = [(-1, name, len(keys), keys.tobytes() + words.tobytes())]
        pair, times, base = (np.concatenate([f[i] for f in found]) for i in range(3))
        pair, doc = pair >> drop, np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        order = np.argsort(pair, kind="stable")
        pair, times, base, doc = pair[order], times[order], base[order], doc[order]
        top = np.uint64(64) - drop
        part = (pair >> np.maximum(top, np.uint64(30)) - np.uint64(30)) * np.uint64(parts) >> np.minimum(top, np.uint64(30))
        edge = np.searchsorted(part, np.arange(parts + 1))
        out += [(p, name, len(keys), _pack(pair[a:b], base[a:b], doc[a:b], times[a:b])) for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], ["p", "batch", "size", "data"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys, found, total = model.table(), [], [], 0
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(k), found.append(pairs(text.as_py() or "", table))
                total += len(found[-1][0])
                if total >= BATCH_PAIRS or len(keys) >= BATCH_TEXTS:
                    yield messages(keys, found)
                    keys, found, total = [], [], 0
        if keys:
            yield messages(keys, found)

    smooth, whole = np.log(PRIOR * max(1, model.n_pairs)), np.log((1 + PRIOR) * max(1, model.n_pairs))

    def add(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("p")[0].as_py() < 0:
            return table

        def sums_of(data: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            pair, _, texts, _, times = _unpack(data.as_py())
            return pair, np.add.reduceat(times, np.r_[0, np.cumsum(texts)[:-1]])

        # one block is unpacked at a time, so texts that share a pair stay packed
        pair, count = map(np.concatenate, zip(*map(sums_of, table.column("data"))))
        order = np.argsort(pair)
        new = np.r_[True, np.diff(pair[order]) != 0]
        total = np.empty(len(pair), np.int64)
        total[order] = np.add.reduceat(count[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        out, at = [], 0
        for data in table.column("data"):
            _, base, texts, doc, times = _unpack(data.as_py())
            others = np.repeat(total[at : at + len(base)], texts) - times
            with np.errstate(divide="ignore"):
                gain = times * (np.logaddexp(np.log(others) + np.repeat(base, texts) * STEP, smooth) - whole)
            sums, have = np.bincount(doc, gain), np.unique(doc)
            out.append(have.astype("<u2").tobytes() + sums[have].astype("<f4").tobytes())
            at += len(base)
        return pa.table([table.column("p"), table.column("batch"), table.column("size"), pa.chunked_array([pa.array(out, pa.binary())])], ["p", "batch", "size", "data"])

    def gather(table: pa.Table) -> pa.Table:
        sums, keys, words = np.zeros(max(table.column("size").to_pylist())), [], []
        for p, size, data in zip(*(table.column(c).to_pylist() for c in ("p", "size", "data"))):
            if p < 0:
                both = np.frombuffer(data, np.int64)
                keys.append(both[:size]), words.append(both[size:])
            else:
                n = len(data) // 6
                sums[np.frombuffer(data, "<u2", n)] += np.frombuffer(data, "<f4", n, 2 * n)
        # equal batches have one name, and their sums are already together
        return pa.table([keys[0], sums, np.sum(words, axis=0)], ["k", "gain", "n"])

    rows = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("k"), docs[text_col].alias("text"))
    spread = F.when(F.col("p") < 0, -1 - F.pmod("batch", F.lit(parts))).otherwise(F.col("p"))
    sums = rows.mapInArrow(send, _SENT).withColumn("p", spread.cast("int")).groupBy("p").applyInArrow(add, _SENT)
    return sums.groupBy("batch").applyInArrow(gather, "k long, gain double, n long").groupBy("k").agg(F.sum("gain").alias("gain"), F.sum("n").alias("n"))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: `id_col`, lang (null as empty), the counts of `rules`, k (hash of id and text), length in symbols, surprise (mean nats of a
    symbol's spelling, null without symbols)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            counts, scored = [], []
            for data in utf8_slices(batch.column(2)):
                counts.append(rules(data))
                gram = grams(code_points(bytes(data).decode("utf-8", "surrogatepass").lower()))
                scored.append((len(gram), float(table[gram].mean()) if len(gram) else None))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)] + [pa.array([x[i] for x in scored], t) for i, t in enumerate((pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *columns], ["id", "lang", "k", *NAMES, "length", "surprise"])

    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"), docs[text_col].alias("text"), F.xxhash64(docs[id_col], docs[text_col]).alias("k"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang string, k long, {', '.join(f'{n} long' for n in NAMES)}, length long, surprise double").withColumnRenamed("id", id_col)


def _median(column: str | Column) -> Column:
    return F.percentile_approx(column, 0.5, 10000)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", upper: float = UPPER, lower: float = LOWER) -> DataFrame:
    """`rate` with perplexity (of a symbol, under the word pairs), base_failed, band_z (surprise less the language's median, in its robust spread), salad_z
    (the same of the gain it lacks) and kept.

    Null and empty texts have zero counts and fail the base rules. A null language is a language of its
    own. Repeated rows are rated each; null ids are allowed; other columns are left out; an empty table gives an empty one.
    """
    model = train(docs, text_col)
    found = keep(gains(docs, model, id_col, text_col), "gains")
    gain = F.when(F.col("length") > 0, F.coalesce(F.try_divide("gain", "n"), F.lit(0.0)) * F.greatest(F.col("n_words") - 1, F.lit(0)) / F.col("length"))
    rated = keep(rate(docs, model, id_col, text_col, lang_col).join(found, "k", "left").withColumn("gain", gain).drop("k", "n"), "rated")
    usual = keep(rated.groupBy("lang").agg(_median("surprise").alias("s"), _median("gain").alias("g")), "usual")
    error = lambda variance: F.sqrt(BETWEEN**2 + F.try_divide(F.lit(variance), F.col("length")))
    errors = {"over": (F.col("surprise") - F.col("s")) / error(model.variance), "lack": (F.col("g") - F.col("gain")) / error(GAIN_VARIANCE)}
    rated = rated.join(usual, "lang").withColumns(errors)
    middle = keep(rated.groupBy("lang").agg(_median("over").alias("over_middle"), _median("lack").alias("lack_middle")), "middles")
    off = {name: F.col(name) - F.col(f"{name}_middle") for name in errors}
    rated = rated.join(middle, "lang")
    # the gains of copies spread far below
    spreads = rated.groupBy("lang").agg(_median(F.abs(off["over"])).alias("over_spread"), _median(F.when(off["lack"] >= 0, off["lack"])).alias("lack_spread"))
    rated = rated.join(keep(spreads, "spreads"), "lang")
    band = {name: off[name] / F.greatest(F.col(f"{name}_spread") * 1.4826, F.lit(LEAST_SPREAD)) for name in errors}
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    inside = (band["over"] <= upper) & (band["over"] >= -lower) & (band["lack"] <= upper)
    return rated.select(
        id_col,
        "lang",
        *NAMES,
        F.exp(F.col("surprise") - F.col("gain")).alias("perplexity"),
        failed.alias("base_failed"),
        band["over"].alias("band_z"),
        band["lack"].alias("salad_z"),
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select("doc_id", *NAMES, "base_failed", "kept")
