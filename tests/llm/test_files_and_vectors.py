"""Token files, centroid clustering and whitening against brute force, and on odd rows."""

import collections
import hashlib
import io
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlens.llm import bpe, centroids, exact, tokenfiles, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id long, file string, at long, start long, n_tokens long"
ROWS = [
    (7, "token  files \n\n  with   spaces \n end ", 1, "f", 2, 3, 4),
    (3, None, 1, "f", 2, 3, 4),
    (5, "", None, None, None, None, None),
    (None, "no id", 1, "f", 2, 3, 4),
    (None, None, 1, "f", 2, 3, 4),
    (9, "same row", 1, "f", 2, 3, 4),
    (9, "same row", 1, "f", 2, 3, 4),
    (9, "other text", 1, "f", 2, 3, 4),
    (1, "a b" + " " * 200_000 + "c" + "\n" * 150_000, 1, "f", 2, 3, 4),
    (2, "lorem ipsum, dolor sit amet. " * 40_000, 1, "f", 2, 3, 4),
    (4, "one <|endoftext|> two<|endoftext|>three", 1, "f", 2, 3, 4),
    (6, "naïve 漢字 \xa0 x\xa0 y \x85z\x1c w don't (it's) 12th\tx", 1, "f", 2, 3, 4),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenfiles.TOKENIZER)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("seed", range(3))
def test_encoder_equals_the_library(library, seed):
    import pyarrow as pa

    draw = np.random.default_rng(seed)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\xa0", "a", "don't", "ab", "12", ",", "'s", "é", "漢", "<|endoftext|>", "\x1c", "\x85", "　", "'", "’"]
    texts = ["".join(parts[i] for i in draw.integers(0, len(parts), draw.integers(0, 14))) for _ in range(4000)] + [None, "", " ", "  "]
    made = tokenfiles.Encoder(tokenfiles.TOKENIZER, memo=500)
    for a in range(0, len(texts), 700):
        for text, got in zip(texts[a : a + 700], made.batch(pa.array(texts[a : a + 700], pa.string()))):
            assert got.tolist() == ids_of(library, text)[:-1], text


def test_token_files(spark, library, tmp_path):
    for name, df in (("odd", spark.createDataFrame(ROWS, SCHEMA).repartition(5)), ("small", spark.read.parquet(f"{SF}/documents.parquet"))):
        path = f"file://{tmp_path}/{name}"
        tokenfiles.write(df, path, frame_ids=1000)
        got = tokenfiles.load(spark, path).collect()
        want = collections.Counter((r["doc_id"], np.array(ids_of(library, r["text"]), "<u4").tobytes()) for r in df.collect())
        assert collections.Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
            at += r["n_tokens"]
        order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
        assert order == sorted(order, key=lambda i: (i is None, i))


def test_token_files_of_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    tokenfiles.write(empty, f"file://{tmp_path}/none")
    assert tokenfiles.load(spark, f"file://{tmp_path}/none").collect() == []


def test_any_tool_reads_the_files(spark, library, tmp_path):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    tokenfiles.write(df.coalesce(1), f"{tmp_path}/one", frame_ids=5000)
    files = [r["file"] for r in spark.read.parquet(f"{tmp_path}/one/files").orderBy("base").collect()]
    plain = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f"{tmp_path}/one/data/{f}", "rb"), read_across_frames=True).read() for f in files)
    want = [i for r in sorted(df.collect(), key=lambda r: r["doc_id"]) for i in ids_of(library, r["text"])]
    assert np.frombuffer(plain, "<u4").tolist() == want


def test_only_wanted_frames_are_read(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 50).alias("text"))
    path = f"{tmp_path}/wanted"
    tokenfiles.write(df.coalesce(1), path, frame_ids=500)
    first = spark.read.parquet(f"{path}/files").orderBy("base").first()["file"]
    with open(f"{path}/data/{first}", "r+b") as file:
        data = bytearray(file.read())
        data[12] ^= 0xFF
        file.seek(0)
        file.write(data)
    wanted = spark.createDataFrame([(300,), (300,), (5000,)], "doc_id long")
    assert [r["doc_id"] for r in tokenfiles.load(spark, path, wanted).collect()] == [300]
    with pytest.raises(Exception, match="damaged|checksum"):
        tokenfiles.load(spark, path).collect()


def test_frames_are_checked_and_counted():
    out = io.BytesIO()
    writer = tokenfiles.FrameWriter(out, 100)
    data = bytes(range(256)) * 5
    writer.write(data[:7])
    writer.write(data[7:])
    writer.close()
    reader = tokenfiles.FrameReader(out)
    assert reader.read(0, len(data)) == data and reader.frames_read == 13
    reader = tokenfiles.FrameReader(out)
    assert reader.read(250, 420) == data[250:420] and reader.frames_read == 3
    assert reader.read(5, 5) == b"" and reader.frames_read == 3
    with pytest.raises(ValueError):
        reader.read(1200, 1281)
    # right data under a wrong checksum
    raw = bytearray(out.getvalue())
    raw[-9 - 1] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        tokenfiles.FrameReader(io.BytesIO(raw)).read(1270, 1280)
    raw = out.getvalue()[:-4] + struct.pack("<I", 1)
    with pytest.raises(ValueError, match="seek table"):
        tokenfiles.FrameReader(io.BytesIO(raw))


def test_query_of_token_files(spark, library):
    from pitlens.llm import queries

    got = {r["doc_id"]: r for r in queries.QUERIES["op11_tokenfiles"](spark, SF).collect()}
    start = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(library, r["text"])
        assert got[r["doc_id"]].asDict() == {"doc_id": r["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)


def test_bpe_of_long_white_space():
    """Over a million characters of white space: the pattern takes all but the last one, as that belongs to what follows."""
    enc = bpe.tokenizer(bpe.RANKS, bpe.public_tokenizers.PATTERN)
    run = " " * 1_200_000
    whole = enc._encode_single_piece(run)
    less = enc._encode_single_piece(run[:-1])
    for text, want in ((run, whole), (run + "x", [*less, *enc.encode(" x")]), ("ab, c" + run, [*enc.encode("ab, c"), *whole]), (f"a{run}b{run}", [*enc.encode("a"), *less, *enc.encode(" b"), *whole])):
        assert bpe.encode_text(text).tolist() == want
    lines = "\n" * 1_100_000
    assert bpe.encode_text(f"x{lines}y").tolist() == [*enc.encode("x"), *enc._encode_single_piece(lines[:-1]), *enc.encode("\ny")]
    for text in ("a" + " \n\t　" * 30_000 + "b", "\x1c" * 120_000 + "a", " " * 150_000 + "\xa0x", "x" * 150_000 + "\r" * 100_000):
        assert bpe.encode_text(text).tolist() == enc.encode(text)


def whole(v, scale):
    return [int(np.floor(scale * float(x))) for x in v]


def brute_clusters(rows, k=8, rounds=10, dim=64, scale=1024, seed="3"):
    kept = [(i, whole(v, scale)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        cents = [[sum(col) // len(own[n]) for col in zip(*own[n])] if own[n] else c for n, c in enumerate(cents)]
    done = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = collections.Counter()
    for _, n, d in done:
        inertia[n] += d
    long = lambda x: x if x < 2**63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    none = {n for _, n, d in done if long(d) is None}
    every = None if none else long(sum(inertia.values()))
    return collections.Counter((i, n, long(d), None if n in none else long(inertia[n]), every, sha[n]) for i, n, d in done)


VECTORS = "vec_id long, embedding array<float>, id long, x long, cluster int, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS)


def test_centroids(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    got, _ = centroids.cluster(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == brute_clusters(rows)


def odd_rows(dim, scale):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.standard_normal(dim) * scale).astype(np.float32).tolist()) for i in range(60)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (100, None), (101, [None] * dim), (102, [float("nan")] * dim), (103, [float("inf")] + [0.0] * (dim - 1)), (105, [-0.0] * dim)]
    return rows


@pytest.mark.parametrize("scale", [1e-4, 1, 1e6, 1e12, 1e30])
def test_centroids_of_odd_rows(spark, scale):
    rows = [*odd_rows(6, scale), (104, [1.0] * 5), (106, [])]
    got, _ = centroids.cluster(table(spark, rows).repartition(4), k=5, rounds=4, dim=6)
    assert collections.Counter(map(tuple, got.collect())) == brute_clusters(rows, 5, 4, 6)


def test_centroids_of_few_and_equal_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(2, [0.0, 0.0]), (3, [0.001, 0.0]), (2, [2.0**30, 2.0**120])]):
        got, _ = centroids.cluster(table(spark, rows), k=3, rounds=3, dim=2)
        assert collections.Counter(map(tuple, got.collect())) == brute_clusters(rows, 3, 3, 2)


def test_search_rejects_most_centroids_and_breaks_ties():
    draw = np.random.default_rng(2)
    x = (draw.standard_normal((3000, 64)) * 200 + draw.standard_normal((3000, 1)) * 900).astype(np.int64)
    cents = x[:200].tolist() + x[:3].tolist()
    book = centroids.Codebook(cents)
    number, distance = book.search(x)
    far = ((x[:, None, :] - np.array(cents)[None, :, :]) ** 2).sum(axis=2)
    assert (number == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    assert book.computed < 0.5 * far.size


def test_exact_sums(spark):
    values = [[0, -1, 2**63 - 1, -(2**63)], [10**45, -(10**45), 1, -1], [-(2**62), 2**62, 2**40, -(2**40)]]

    def emit(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield from exact.partial_sums([(i % 2, values[i % 3])])

    got = exact.total_sums(spark.range(12).mapInArrow(emit, exact.SCHEMA))
    for g in (0, 1):
        assert got[g] == {d: 2 * sum(v[d] for v in values) for d in range(4)}
    x = np.array([[2**62, -(2**62)], [2**62, -(2**62)], [2**62, -1]])
    assert exact.column_sums(x) == [3 * 2**62, -(2**63) - 1]


def check_white(got, rows, dim, most=4):
    kept = [(i, np.array(whole([*v, *[0.0] * (dim - len(v))], 256), object)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, np.array([max(min(int(x), 2**63 - 1), -(2**63)) for x in v], object)) for i, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), np.array([sum(c) for c in zip(*fit)], object)
    centred = np.array([[float(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    by = collections.defaultdict(list)
    for r in got:
        by[r["vec_id"], r["deviation"]].append(r)
    assert len(got) == k * len(kept)
    for i, v in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        deviation = deviation if deviation < 2**63 else None
        assert {r["component"] for r in by[i, deviation]} == set(range(1, k + 1))
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-6
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-8)
    return kept, fit, n, sums, values, k


def test_whitening(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    kept, fit, n, sums, values, k = check_white(got, rows, 64)
    white = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    centred = np.array([[float(n * a - s) / n for a, s in zip(v, sums)] for _, v in kept])
    _, axes = np.linalg.eigh(np.array(fit, float).T @ np.array(fit, float) / n - np.outer(sums / n, sums / n).astype(float))
    for c in range(1, k + 1):
        want = centred @ axes[:, -c] / np.sqrt(values[c - 1])
        have = np.array([white[i, c] for i, _ in kept])
        assert np.abs(have - np.sign(have @ want) * want).max() < 1e-8


@pytest.mark.parametrize("scale", [0.01, 1, 1e5, 1e9])
def test_whitening_of_odd_rows(spark, scale, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = odd_rows(6, scale)
    check_white(whitening.whiten(table(spark, rows).repartition(7)).collect(), rows, 6)
    rows += [(104, [3.0 * scale] * 2), (106, [])]
    check_white(whitening.whiten(table(spark, rows)).collect(), rows, 6)


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        assert whitening.whiten(table(spark, rows)).collect() == []
    rows = [(i, [float(i), float(2 * i), 5.0]) for i in range(9)]
    check_white(whitening.whiten(table(spark, rows)).collect(), rows, 3)
    rows = [(i, [float(i)]) for i in (1, 2, 4)]
    check_white(whitening.whiten(table(spark, rows)).collect(), rows, 1)
    rows = [(i, [float(x == i) for x in range(8)]) for i in range(8)]
    check_white(whitening.whiten(table(spark, rows)).collect(), rows, 8)


def test_largest_longs(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    # the second direction's variance can't be told from 0 beside the first's
    got = whitening.whiten(table(spark, rows)).collect()
    assert {(r["vec_id"], r["component"], r["deviation"]) for r in got} == {(1, 1, None), (2, 1, None), (3, 1, 589825)}


@pytest.mark.parametrize("kind", ["random", "graded", "cluster", "zeros", "wilkinson", "wide"])
def test_solver_equals_dense_singular_values(kind):
    draw = np.random.default_rng(4)
    n = 40
    m = draw.standard_normal((n, n))
    if kind == "graded":
        m *= 10.0 ** -np.arange(n)[None, :]
    if kind == "cluster":
        u, v = np.linalg.qr(m)[0], np.linalg.qr(draw.standard_normal((n, n)))[0]
        m = u @ np.diag(np.r_[[5, 5, 5, 4, 4], np.ones(n - 5)]) @ v
    if kind == "zeros":
        m[:, 3:20] = 0
    if kind == "wilkinson":
        m = np.diag(np.abs(np.arange(n) - n / 2) + 1) + np.diag(np.ones(n - 1), 1)
    if kind == "wide":
        m = m[:12]
    r = np.linalg.qr(m, mode="r")
    a, b, v = whitening.bidiagonal(r)
    have = np.sqrt(whitening.squared_values(a, b))
    want = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(have[: len(want)], want, rtol=1e-12, atol=1e-13 * want[0])
    axes, values, every = whitening.principal(r, 5)
    assert axes.shape[1] == 5 and np.abs(axes.T @ axes - np.eye(5)).max() < 1e-9
    assert np.abs(r.T @ (r @ axes) - axes * values).max() < 1e-10 * values[0]
    assert every == pytest.approx((r**2).sum())


def test_small_values_are_found_to_relative_accuracy():
    """A bidiagonal matrix determines even its smallest singular values; the product of all is that of the diagonal."""
    a, b = 10.0 ** -np.arange(0, 24, 2.0), np.ones(11) * 10.0 ** -np.arange(1, 23, 2.0)
    assert np.prod(whitening.squared_values(a, b) * 1e24) == pytest.approx(np.prod(a**2 * 1e24), rel=1e-12)


def brute_search(rows, k, scale=64):
    kept = [(i, whole(v, scale)) for i, v in rows]
    out = []
    for i, q in kept:
        if i % 5 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept if j != i))[:k]
            out += [(i, r + 1, j, exact.as_long(-s)) for r, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 1e6, 1e7, 1e12, 3e38])
def test_tree_search_of_large_components(spark, size):
    from pitlens.llm import mtree

    draw = np.random.default_rng(1)
    rows = [(i, (draw.standard_normal(8).clip(-1, 1) * (size if i % 3 else 1.0)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(150 + i, rows[7][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = mtree.search(df, df.where("vec_id % 5 = 0"), k=9, page=32, block=16)
    assert sorted(map(tuple, got.collect())) == brute_search(rows, 9)


def test_a_leaf_of_equal_vectors_stays_small():
    """16,384 queries against a page of 16,384 entries of one leaf take under 500 MB, and ties go to the smaller ids."""
    import tracemalloc

    from pitlens.llm import mtree

    n, dim = 16_384, 8
    draw = np.random.default_rng(0)
    x = np.repeat(draw.integers(-50, 50, (64, dim)), n // 64, axis=0).astype(float)
    most = float((x * x).sum(axis=1).max())
    tree = mtree.Tree(mtree._lift(x[:1], most), most)
    leaf, apart, up = tree.place(mtree._lift(x, most))
    tree.close(np.array([n]), np.array([apart.max()]), np.array([up.max()]), n)
    ids = draw.permutation(n)
    tracemalloc.start()
    row, found, scores, _ = mtree.Page(ids, x, leaf, apart, tree).search(np.arange(n), x, 20, np.full(n, -np.inf))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 500 and len(row) == 20 * n
    for q in range(0, n, 1111):
        s = x @ x[q]
        want = sorted((-s[j], ids[j]) for j in range(n) if ids[j] != q)[:20]
        assert [(-v, i) for v, i in zip(scores[row == q], found[row == q])] == want
