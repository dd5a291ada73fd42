"""Token ids in binary files of independent zstandard frames with a seek table.

A file holds the ids of neighbouring documents as little-endian unsigned 32-bit integers, one after another, cut into
frames of FRAME_IDS ids that are compressed each on its own. A last, skippable frame is the seek table of zstandard's public
seekable format: for each frame its compressed and its plain size and the low 32 bits of the XXH64 of its plain bytes. Any zstandard
tool decompresses the whole file; a reader that knows the table decompresses only the frames that a document lies in and holds
each against its checksum.

Spark deals documents to files by ranges of their ids and sorts within them, so that file after file they ascend. Each task streams its range into
a file of a name of its own, and returns where each document lies; these rows are the index, a Parquet table. A task that is run again writes
another file, and only the file that the index names counts.

Words are encoded once for each task: between a character other than white space and a space a token ends whatever stands around, so a text is cut
there, its distinct words are looked up, and only new ones go to the tokenizer. Texts where white space meets white space around a space are encoded whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import pieces
from ..functions.shared import scratch
from .common import bound_batches, read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 0
FRAME_IDS = 65_536
LEVEL = 3
#: A reading task takes whole runs of a file of so many ids, about so many in all.
SPAN_IDS, TASK_IDS = 1 << 21, 1 << 24
#: Words that a task remembers at most; then it starts anew.
MEMO = 800_000
#: Bytes of text encoded at once.
BATCH_BYTES = 8_000_000

# fixed values of zstandard's seekable format
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")

_WHITE = r"\t-\r\x{85}\pZ"
#: Between these a cut before a space might part one token.
_ODD = rf"[{_WHITE}] ([{_WHITE}]|\z)"
#: Letters of old, so that any version of Unicode knows them, and signs but for the apostrophe, which letters may follow within a token.
_LETTER, _SIGN = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
_WORD = re.compile(rf"[{_LETTER}]{{1,999}}\Z")
#: Runs of letters and of signs, also parted by single line ends: tokens end between them.
_RUNS = re.compile(rf"[{_LETTER}{_SIGN}](?:\n?[{_LETTER}{_SIGN}])+\Z")
_RUN = re.compile(rf"[{_LETTER}]+|[{_SIGN}]+|\n")
#: The characters by which byte-level vocabularies write bytes.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class FrameWriter:
    """Appends bytes to `out` in frames of `size` bytes; `close` writes what is left and the seek table."""

    def __init__(self, out, size: int = FRAME_IDS * 4, level: int = LEVEL):
        self.out, self.size, self.pending, self.table = out, size, bytearray(), []
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def _frame(self, data: bytes) -> None:
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def write(self, data: bytes) -> None:
        self.pending += data
        at = 0
        while len(self.pending) - at >= self.size:
            self._frame(bytes(self.pending[at : at + self.size]))
            at += self.size
        del self.pending[:at]

    def close(self) -> None:
        if self.pending:
            self._frame(bytes(self.pending))
            self.pending.clear()
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + FOOTER.size) + entries + FOOTER.pack(len(self.table), CHECKSUMS, SEEKABLE))


class FrameReader:
    """Random access to the plain bytes of a file by its seek table. `frames_read` counts frames decompressed."""

    def __init__(self, file):
        self.file, self.last, self.frames_read = file, (-1, b""), 0
        file.seek(0, 2)
        end = file.tell()
        if end < FOOTER.size + 8:
            raise ValueError("the file has no seek table")
        file.seek(end - FOOTER.size)
        count, descriptor, magic = FOOTER.unpack(file.read(FOOTER.size))
        width = 12 if descriptor & CHECKSUMS else 8
        length = count * width + FOOTER.size
        if magic != SEEKABLE or end < length + 8:
            raise ValueError("the file has no seek table")
        file.seek(end - length - 8)
        if struct.unpack("<II", file.read(8)) != (SKIPPABLE, length):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(file.read(count * width), "<u4").reshape(count, -1)
        self.sums = table[:, 2] if width == 12 else None
        self.packed, self.plain = (np.r_[0, np.cumsum(table[:, i], dtype=np.int64)] for i in (0, 1))
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            self.file.seek(int(self.packed[i]))
            size = int(self.plain[i + 1] - self.plain[i])
            try:
                data = self.zstd.decompress(self.file.read(int(self.packed[i + 1] - self.packed[i])), max_output_size=size)
            except zstandard.ZstdError as e:
                raise ValueError(f"frame {i} is damaged: {e}") from e
            if len(data) != size or self.sums is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} doesn't match its checksum")
            self.last = (i, data)
            self.frames_read += 1
        return self.last[1]

    def read(self, start: int, end: int) -> bytes:
        """The plain bytes from `start` to `end`."""
        if start >= end:
            return b""
        first, last = np.searchsorted(self.plain, [start, end - 1], side="right") - 1
        if start < 0 or end > self.plain[-1]:
            raise ValueError("the range lies outside the file")
        return b"".join(self.frame(i)[max(0, start - self.plain[i]) : end - self.plain[i]] for i in range(first, last + 1))


class Encoder:
    """Ids of texts by a tokenizer file of the tokenizers library. `plain` encodes one text as the library does; `batch` gives the same for many."""

    def __init__(self, path: str, memo: int = MEMO):
        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        #: Only the byte-level pattern is known to end tokens before spaces.
        self.by_words = made["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        self.specials = [t["content"] for t in made["added_tokens"]]
        #: A special token between texts parts them wholly, so many are encoded in one call.
        self.between = next(((t["content"], t["id"]) for t in made["added_tokens"] if t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])), None)
        #: A word of letters is one piece of the byte-level pattern, so the model alone encodes it.
        self.model = self.tokenizer.model if self.by_words and not any(_WORD.match(s.strip()) for s in self.specials) else None
        self.memo = memo
        self._forget()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def plain(self, text: str) -> np.ndarray:
        """A long text in pieces cut at safe boundaries, unless it holds a special token's string, which a cut might part."""
        if not self.by_words or any(s in text for s in self.specials):
            return self._ids(text)
        return np.concatenate([np.zeros(0, np.uint32), *(self._ids(p) for p in pieces(text))])

    def _forget(self) -> None:
        # numbers of words after a space and of words that start a text; ids of number i are ids[starts[i] : starts[i] + sizes[i]]
        self.words, self.heads, self.count, self.used = {}, {"": 0}, 1, 0
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        #: Batches that held a word.
        self.uses = np.zeros(1 << 16, np.int64)

    def _trim(self) -> None:
        """Forget words that one batch alone held; all of them, should many be left."""
        number = np.fromiter(self.words.values(), np.int64, len(self.words))
        again = self.uses[number] > 1
        if again.sum() > self.memo // 2:
            again[:] = False
        keys, number = [*itertools.compress(self.words, again.tolist())], number[again]
        ids, sizes = self._gather(number), self.sizes[number]
        self._forget()
        self._add(self.words, keys, ids, sizes)
        self.uses[1 : self.count] = 1

    def _add(self, known: dict[str, int], keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, count = self.count, self.count + len(keys)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while count > len(self.sizes):
            self.starts, self.sizes, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.uses))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[first:count] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:count] = sizes
        known.update(zip(keys, range(first, count)))
        self.used += len(ids)
        self.count = count

    def _encode(self, known: dict[str, int], keys: list[str], before: str) -> None:
        """Learn new words: those of letters by the model, others many in a call, as a special token between them parts them wholly. Very long ones, and those beside
        a word that holds its string, go one by one."""
        if self.model:
            letters, keys = [k for k in keys if _WORD.match(k)], [k for k in keys if not _WORD.match(k)]
            space, tokens = _BYTES[32] if before else "", self.model.tokenize
            found = [[t.id for t in tokens(space + (k if k.isascii() else k.encode().decode("latin-1").translate(_BYTES)))] for k in letters]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self._add(known, letters, np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)
        many = (keys if max(map(len, keys), default=0) < 1000 else [k for k in keys if len(k) < 1000]) if self.between else []
        alone = [k for k in keys if len(k) >= 1000] if len(many) < len(keys) else []
        for a in range(0, len(many), 20_000):
            part = many[a : a + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([before + (self.between[0] + before).join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.between[1])
            if len(ends) == len(part) - 1:
                self._add(known, part, np.delete(ids, ends), np.diff(np.r_[-1, ends, len(ids)]) - 1)
            else:
                alone += part
        for k in alone if self.between else keys:
            ids = self.plain(before + k)
            self._add(known, [k], ids, np.array([len(ids)]))

    def _learn(self, words: list[str], heads: list[str]) -> None:
        """Learn new words. One that is runs of letters and of signs is put together of these; there are fewer runs than words."""
        runs = {w: _RUN.findall(w) for w in words if not w.isalpha() and _RUNS.match(w) and not any(s in w for s in self.specials)}
        runs = {w: r for w, r in runs.items() if len(r) > 1}
        firsts, rest = {r[0] for r in runs.values()}, set(itertools.chain.from_iterable(r[1:] for r in runs.values()))
        self._encode(self.words, [*firsts.union(w for w in words if w not in runs).difference(self.words)], " ")
        self._encode(self.heads, [*rest.union(heads).difference(self.heads)], "")
        if runs:
            counts = np.fromiter(map(len, runs.values()), np.int64, len(runs))
            parts = np.fromiter(itertools.chain.from_iterable((self.words[r[0]], *map(self.heads.__getitem__, r[1:])) for r in runs.values()), np.int64, int(counts.sum()))
            self._add(self.words, [*runs], self._gather(parts), np.add.reduceat(self.sizes[parts], np.cumsum(counts) - counts))

    def _gather(self, number: np.ndarray) -> np.ndarray:
        """The ids of words one after another."""
        sizes, starts = self.sizes[number], self.starts[number]
        total = np.cumsum(sizes)
        return self.ids[np.repeat(starts - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        odd = np.asarray(pc.match_substring_regex(texts, _ODD)) if self.by_words else np.ones(len(texts), bool)
        out: list[np.ndarray] = [None] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = self.plain(texts[i].as_py())
        even = np.flatnonzero(~odd)
        if len(even):
            lists = pc.split_pattern(texts.take(pa.array(even)), " ")
            first = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
            coded = lists.flatten().dictionary_encode()
            words, heads = (x.to_numpy(zero_copy_only=False).tolist() for x in (coded.dictionary, lists.flatten().take(pa.array(first))))
            if self.count > self.memo:
                self._trim()
            self._learn([*itertools.filterfalse(self.words.__contains__, words)], [*itertools.filterfalse(self.heads.__contains__, heads)])
            number = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            self.uses[number] += 1
            number = number[np.asarray(coded.indices)]
            number[first] = [self.heads[w] for w in heads]
            ids, total = self._gather(number), np.cumsum(self.sizes[number])
            ends = np.r_[total[first[1:] - 1], total[-1]]
            for i, a, b in zip(even, np.r_[0, ends[:-1]], ends):
                out[i] = ids[a:b]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    at, total = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if total and total + n > BATCH_BYTES:
            yield texts.slice(at, i - at)
            at, total = i, 0
        total += n
    yield texts.slice(at)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, which may be in any store that Arrow opens."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end: int = END, frame_ids: int = FRAME_IDS) -> None:
    """Write the ids of every text of `docs`, each with the id `end` after it, under `path`: data/*.zst, the Parquet table index
    (`id`, file, at: ids of the file before the document's, n_tokens) and the Parquet table files (file, n_docs, n_tokens, base: ids of all files before).

    Documents stand in ascending order of their ids, those without one last, those of one id by the hash of the text; repeated rows stay. Null and
    empty texts have only the end id. The string of a special token in a text is that token, as the library reads it. Other columns are left out. An empty table
    gives no file and empty tables. Files that no index row names come from tasks that were run again, and are deleted.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, at, part = None, 0, TaskContext.get().partitionId()
        store, folder = _open(f"{path}/data")
        name = f"{part:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            if batch.num_rows and writer is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}", compression=None)
                writer = FrameWriter(out, frame_ids * 4)
            sizes = []
            for texts in _slices(batch.column(1)) if batch.num_rows else ():
                for ids in encoder(tokenizer).batch(texts):
                    writer.write(ids.astype("<u4").tobytes() + struct.pack("<I", end))
                    sizes.append(len(ids) + 1)
            n = np.array(sizes, np.int64)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * len(n), pa.string()), pa.array([part] * len(n), pa.int32()), pa.array(before), pa.array(n)], ["id", "file", "part", "at", "n_tokens"])
        if writer is not None:
            writer.close()
            out.close()

    bound_batches(spark)
    # the last key deals equal rows out, should there be very many
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).withColumns({"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("id").asc_nulls_last(), F.col("_tie").asc(), F.col("_row").asc()]
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    dealt.mapInArrow(run, f"id {kind}, file string, part int, at long, n_tokens long").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    files = index.groupBy("file", "part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # one row per file
    base = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files.select("file", "n_docs", "n_tokens", base.alias("base")).write.parquet(f"{path}/files")
    _sweep(spark, path)


def _sweep(spark: SparkSession, path: str) -> None:
    """Delete files that the table of files doesn't name; a name a file, so it is short."""
    named = {r["file"] for r in spark.read.parquet(f"{path}/files").select("file").toLocalIterator()}
    store, folder = _open(f"{path}/data")
    for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name not in named:
            store.delete_file(info.path)


def load(spark: SparkSession, path: str, wanted: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """`id_col`, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit integers, with the end id) of each document written
    under `path`; of those only whose id is in `id_col` of `wanted`, where that is given.

    A task reads runs of a file in order, so each frame that holds a wanted document is decompressed once or, at a run's edge, twice, and no other is. A frame that
    doesn't match its checksum is an error. Null ids of `wanted` match null ids. An empty table gives an empty one.
    """
    index, files = spark.read.parquet(f"{path}/index"), spark.read.parquet(f"{path}/files")
    if wanted is not None:
        ids = wanted.select(wanted[id_col].alias("_wanted")).distinct()
        index = index.join(ids, F.col("id").eqNullSafe(F.col("_wanted")), "left_semi")
    total = index.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(1, total // TASK_IDS, min(spark.sparkContext.defaultParallelism, total // FRAME_IDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(f"{path}/data")
        name, file, reader = None, None, None
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
            got, first, held = [], 0, 0
            for i, (wants, at, n) in enumerate(rows):
                if wants != name:
                    if file is not None:
                        file.close()
                    name, file = wants, store.open_input_file(f"{folder}/{wants}")
                    reader = FrameReader(file)
                got.append(reader.read(4 * at, 4 * (at + n)))
                held += len(got[-1])
                if held > BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(first, len(got))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(4), part.column(3), pa.array(got, pa.binary())], ["id", "start", "n_tokens", "ids"])
                    got, first, held = [], i + 1, 0
        if file is not None:
            file.close()

    kind = index.schema["id"].dataType.simpleString()
    placed = index.join(files.select("file", "base"), "file").select("id", "file", "at", "n_tokens", (F.col("base") + F.col("at")).alias("start"))
    dealt = placed.repartition(tasks, "file", F.floor(F.col("at") / SPAN_IDS)).sortWithinPartitions("file", "at")
    return dealt.mapInArrow(run, f"id {kind}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def op11_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write(read(spark, sf_dir, "documents"), path)
    return load(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
