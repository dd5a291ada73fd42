"""Language of mixed texts: script ranges, per-word scores, Viterbi with a switching penalty.

The model holds, for each language, log probabilities of hashed letter trigrams counted by Spark over
all training texts, and for each script the languages that use it. A word's script narrows its
candidates; its trigrams score them. The best path over the words pays a penalty for each change of
language and labels spans; the language with most letters is the text's.
"""

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, read

BITS = 16
#: Price of a change of language, in nats.
SWITCH = 12.0
#: A language is a candidate for a script that at least this share of its training letters has.
SCRIPT_SHARE = 0.005
#: First code point of ranges, and their script; letters elsewhere are "other".
RANGES = [(0x0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other")]
SCRIPTS = list(dict.fromkeys(s for _, s in RANGES))
_STARTS = np.array([a for a, _ in RANGES], np.uint32)
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in RANGES], np.int8)
#: Letters of a batch that are scored at once.
_BATCH = 1_000_000


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with a space before and after; ends of the texts."""
    joined = [f" {t} ".lower() for t in texts]
    ends = np.cumsum([len(t) for t in joined])
    return np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def _letters_and_marks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the code points are letters (Unicode categories L), and combining marks (M)."""
    high = np.unique(codes[codes > 127])
    kind = np.array([unicodedata.category(chr(c))[0] for c in high.tolist()], "U1")
    ascii_letter = ((codes >= 97) & (codes <= 122)) | ((codes >= 65) & (codes <= 90))
    return ascii_letter | np.isin(codes, high[kind == "L"]), np.isin(codes, high[kind == "M"])


def words_of(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, ...]:
    """Of the words in `texts`, runs of letters and their marks: text number, first code point in it, length, letters, script; and of each letter or mark its word and its trigram's slot."""
    codes, ends = _codes(texts)
    letter, mark = _letters_and_marks(codes)
    # marks without a letter in their run make no word
    part = letter | mark
    run = np.cumsum(part & ~np.r_[False, part[:-1]])
    part &= np.bincount(run, letter, minlength=run[-1] + 1 if len(run) else 0)[run] > 0
    at = np.flatnonzero(part)
    first = at[~part[at - 1]] if len(at) else at
    word = np.searchsorted(first, at, side="right") - 1
    size = np.bincount(word, minlength=len(first))
    letters = np.bincount(word, letter[at], minlength=len(first)).astype(np.int64)
    clean = np.where(part, codes, 32).astype(np.uint64)
    with np.errstate(over="ignore"):
        slot = (mix((clean[at - 1] << np.uint64(42)) | (clean[at] << np.uint64(21)) | clean[at + 1]) >> np.uint64(64 - bits)).astype(np.int32) if len(at) else at
    script = _SCRIPT_OF[np.searchsorted(_STARTS, codes[first], side="right") - 1] if len(first) else first
    text = np.searchsorted(ends, first, side="right")
    start = first - np.r_[0, ends][text] - 1
    return text, start, size, letters, script, word, slot


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= _BATCH:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


class Model:
    """langs; trigrams (slots x langs, log probabilities less their mean); allowed (scripts x langs)."""

    def __init__(self, langs: list[str], trigrams: np.ndarray, allowed: np.ndarray, switch: float = SWITCH):
        self.langs, self.trigrams, self.allowed, self.switch = langs, trigrams, allowed, switch

    def label(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Text number, start, length, letters and language number of each word, by Viterbi over each text's words."""
        text, start, size, letters, script, word, slot = words_of(texts)
        n, k = len(text), len(self.langs)
        if not n or not k:
            return text, start, size, letters, np.zeros(n, np.int16)
        bounds = np.searchsorted(word, np.arange(n))
        scores = np.add.reduceat(self.trigrams[slot], bounds, axis=0) + np.where(self.allowed[script], 0, -1e4).astype(np.float32)
        count = np.bincount(text, minlength=len(texts))
        first = np.r_[0, np.cumsum(count)[:-1]]
        order = np.argsort(-count, kind="stable")
        first, count = first[order], count[order]
        best = np.zeros((len(order), k), np.float32)
        back = np.zeros((n, k), np.int16)
        steps, live = int(count[0]), len(order)
        for step in range(steps):
            live = int(np.searchsorted(-count[:live], -step, side="left"))
            now = first[:live] + step
            if step:
                top = best[:live].argmax(axis=1)
                change = best[np.arange(live), top] - self.switch
                changed = change[:, None] > best[:live]
                back[now] = np.where(changed, top[:, None], np.arange(k))
                best[:live] = np.where(changed, change[:, None], best[:live])
            best[:live] += scores[now]
        label = np.zeros(n, np.int16)
        state = best.argmax(axis=1)
        for step in range(steps - 1, -1, -1):
            live = int(np.searchsorted(-count, -step, side="left"))
            now = first[:live] + step
            label[now] = state[:live]
            state[:live] = back[now, state[:live]]
        return text, start, size, letters, label


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> Model:
    """Counts trigrams and scripts over all of `docs` with a language. What reaches the driver is one row for each language
    and slot or script: 2**bits and a few, times the languages, however many texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang"):
                texts = part["text"].tolist()
                for a, b in chunks(texts):
                    _, _, _, letters, script, _, slot = words_of(texts[a:b], bits)
                    have = sums.setdefault(lang, np.zeros((1 << bits) + len(SCRIPTS), np.int64))
                    have[: 1 << bits] += np.bincount(slot, minlength=1 << bits)
                    have[1 << bits :] += np.bincount(script, letters, minlength=len(SCRIPTS)).astype(np.int64)
        for lang, have in sums.items():
            slots = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots), pa.string()), pa.array(slots, pa.int32()), pa.array(have[slots])], ["lang", "slot", "n"])

    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")).where("lang is not null and text is not null")
    counts = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros(((1 << bits) + len(SCRIPTS), len(langs)))
    table[counts["slot"], counts["lang"].map({x: i for i, x in enumerate(langs)})] = counts["n"]
    grams, scripts = table[: 1 << bits], table[1 << bits :]
    used = max(1, int((grams.sum(axis=1) > 0).sum()))
    logs = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * used))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32) if langs else logs.astype(np.float32), allowed)


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: `id_col`, lang_pred, score (share of the letters in spans of that language), spans array<struct<start, end, lang>>
    in code points of the lower-cased text, end exclusive.

    `und` with score 0 and no spans where the text is null, has no letter (Unicode categories L; numbers like ½ or Ⅷ are none), or nothing was learned.
    Ties go to the smaller code. Repeated rows and null ids are kept; an empty table gives an empty one; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(every):
                text, start, size, count, label = model.label(every[a:b])
                k = len(model.langs)
                letters = np.bincount(text * max(1, k) + label, count, minlength=(b - a) * max(1, k)).reshape(b - a, -1) if k else np.zeros((b - a, 1))
                total, top = letters.sum(axis=1), letters.argmax(axis=1)
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (label[1:] != label[:-1])
                opens = np.flatnonzero(new) if k else np.zeros(0, int)
                closes = np.r_[opens[1:], len(text)][: len(opens)] - 1
                names = np.array(model.langs or ["und"], object)
                items = pa.StructArray.from_arrays([pa.array(start[opens].astype(np.int64)), pa.array((start + size)[closes].astype(np.int64)), pa.array(names[label[opens]], pa.string())], ["start", "end", "lang"])
                ends = np.searchsorted(text[opens], np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.where(total > 0, names[top], "und"), pa.string()), pa.array(letters.max(axis=1) / np.maximum(total, 1)), pa.ListArray.from_arrays(pa.array(ends), items)],
                    ["id", "lang_pred", "score", "spans"],
                )

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>").withColumnRenamed("id", id_col)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return detect(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))
