"""Exact top-k search by inner product with a paged M-tree.

Inner products become distances: with one more coordinate, sqrt(M**2 - |x|**2) for candidates and 0 for
queries, |q' - x'|**2 = |q|**2 + M**2 - 2 q.x, a Euclidean metric in which the nearest is the best.

The tree has a root, nodes, leaves and entries. The routing objects of nodes and leaves are vectors drawn by hash, at most LEAVES;
each leaf belongs to the nearest node's, each vector to the nearest leaf of its nearest node. Every
entry stores its distance to its leaf, every leaf its covering radius and its distance to its node, every node its
radius. These are computed once, when vectors are placed. Leaves of one node are bundled into pages of up to PAGE
entries, the unit that a task holds; a larger leaf is dealt over several pages.

A query prunes by the triangle inequality: a node by its radius, a leaf first by the stored distance
to its node, without computing its own, then by its radius, an entry by its stored distance to the leaf. Leaves are
visited best first. A first pass over the page of the nearest leaf gives a lower bound of the query's k-th score, a second visits
the other pages with leaves in reach of it, and pages answer with scores of at least the bound. Only pages that
a query is routed to are read, each once for every BLOCK of its queries. Products are made in tiles of QUERIES times ENTRIES, of which each query keeps its best, so a
page takes some 200 MB at most, however many vectors are equal.

Geometry is in floats with some slack; scores are exact: products of floats while these hold them, of 64-bit integers while these do, of Python's integers for
vectors beyond.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, keep, read
from .exact import as_long, dense, finite, whole

NODES = 32
#: Routing objects of leaves at most, and entries of a leaf where there are fewer.
LEAVES, LEAF = 4096, 64
PAGE = BLOCK = 16384
#: Rounds in which each query picks its own next leaf; later ones go through the leaves together.
BEST_FIRST = 4
#: Slack of bounds against rounding; scores are integers.
EPS = 1e-6
#: Distances are roots of differences, so a small one is off by this share of the vectors' norms at most.
NEAR = 1e-7
#: Sides of a tile of products.
QUERIES, ENTRIES = 2048, 1024
#: Norms up to which each kind of number holds all scores, and what stands for no score.
KINDS = {"float": (2.0**52, -np.inf), "int": (2.0**62, -(2**62)), "object": (1e90, -(10**99))}


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(-1, dim)


def _cast(x: np.ndarray, kind: str) -> np.ndarray:
    """Whole floats as numbers of a kind of KINDS."""
    if kind == "object":
        return np.array([list(map(int, row)) for row in x.tolist()], object).reshape(x.shape)
    return x if kind == "float" else x.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int, kind: str) -> np.ndarray:
    """Columns of the `k` highest scores of each row, in order, ties to the smaller id. `ids` is a row for all or one for each."""
    if kind == "object":
        each = np.broadcast_to(ids, scores.shape)
        return np.array([sorted(range(len(s)), key=lambda j: (-s[j], i[j]))[:k] for s, i in zip(scores.tolist(), each.tolist())]).reshape(len(scores), -1)
    return np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=-1)[:, :k]


def _few(scores: np.ndarray, ids: np.ndarray, k: int, kind: str) -> np.ndarray:
    """Columns of the `k` highest scores of each row of a tile, in any order; floats are told from each other and from ties by one partition."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    if kind != "float":
        return _best(scores, ids, k, kind)
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))[::-1]
    key = np.where(np.isfinite(scores), scores, -(2.0**52)).astype(np.int64) * ENTRIES + rank
    return np.argpartition(key, key.shape[1] - k, axis=1)[:, -k:]


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """Candidates with their further coordinate."""
    return np.column_stack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


class Tree:
    """Routing objects, their parents and, once vectors are placed, covering radii and pages. Vectors are lifted; `most` is M**2."""

    def __init__(self, drawn: np.ndarray, most: float, n_nodes: int = NODES):
        self.leaves, self.nodes, self.most = drawn, drawn[:n_nodes], most
        near = _distance(drawn, self.nodes)
        self.parent = near.argmin(axis=1)
        self.to_parent = near[np.arange(len(drawn)), self.parent]
        self.children = [np.flatnonzero(self.parent == i) for i in range(len(self.nodes))]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf of each lifted vector, its distance to the leaf and to the node."""
        near = _distance(x, self.nodes)
        # of equal nodes one has the leaves
        node = np.where([len(c) > 0 for c in self.children], near, np.inf).argmin(axis=1)
        leaf, apart = np.zeros(len(x), np.int32), np.zeros(len(x))
        for i in np.unique(node):
            at = np.flatnonzero(node == i)
            far = _distance(x[at], self.leaves[self.children[i]])
            best = far.argmin(axis=1)
            leaf[at], apart[at] = self.children[i][best], far[np.arange(len(at)), best]
        return leaf, apart, near[np.arange(len(x)), node]

    def close(self, count: np.ndarray, radius: np.ndarray, node_radius: np.ndarray, page: int) -> None:
        """Take in the entries and radii of the leaves and nodes; bundle leaves into pages."""
        self.radius, self.node_radius = radius, node_radius
        self.first_page, self.pages, used = np.zeros(len(count), int), np.ones(len(count), int), 0
        for children in self.children:
            room = 0
            for leaf in children:
                if count[leaf] > room:
                    self.first_page[leaf], self.pages[leaf] = used, max(1, -(-count[leaf] // page))
                    used += self.pages[leaf]
                    room = page - count[leaf] if self.pages[leaf] == 1 else 0
                else:
                    self.first_page[leaf] = used - 1
                    room -= count[leaf]
        self.count = count

    def reachable(self, q: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Whether each leaf may hold something within `reach` of each lifted query; their distances where computed, else inf; distances computed."""
        to_node = _distance(q, self.nodes)
        open_node = (to_node - self.node_radius[None, :] <= reach[:, None])[:, self.parent]
        need = open_node & (np.abs(to_node[:, self.parent] - self.to_parent[None, :]) - self.radius[None, :] <= reach[:, None]) & (self.count > 0)[None, :]
        far = np.full(need.shape, np.inf)
        rows, leaves = need.any(axis=1), need.any(axis=0)
        far[np.ix_(rows, leaves)] = _distance(q[rows], self.leaves[leaves])
        far[~need] = np.inf
        return far - self.radius[None, :] <= reach[:, None], far, int(rows.sum() * leaves.sum()) + to_node.size


def _reach(norm: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Distance that a score of `bound` means; inf where nothing bounds."""
    return np.sqrt(np.maximum(norm - 2 * bound, 0)) * (1 + EPS) + EPS + NEAR * np.sqrt(norm)


class Page:
    """The entries of a page by leaf and distance."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, apart: np.ndarray, tree: Tree, kind: str = "float"):
        order = np.lexsort((apart, leaf))
        self.ids, self.x, self.apart, self.tree, self.kind = ids[order], _cast(x[order], kind), apart[order], tree, kind
        self.leaf, self.first = np.unique(leaf[order], return_index=True)
        self.last = np.r_[self.first[1:], len(x)]

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(row of the query, id, score) of the k best candidates of each query with a score of at least its `bound`, and the products computed."""
        parts = [self._search(query_ids[a : a + QUERIES], q[a : a + QUERIES], k, bound[a : a + QUERIES]) for a in range(0, len(q), QUERIES)]
        rows, ids, scores, products = zip(*parts) if parts else ([np.zeros(0, int)], [np.zeros(0, np.int64)], [np.zeros(0)], [0])
        return np.concatenate([r + i * QUERIES for i, r in enumerate(rows)]), np.concatenate(ids), np.concatenate(scores), sum(products)

    def _search(self, query_ids: np.ndarray, q: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        norm = (q * q).sum(axis=1) + self.tree.most
        bound, products, none = bound.copy(), 0, KINDS[self.kind][1]
        asked = _cast(q, self.kind)
        scores = np.full((len(q), k), none, asked.dtype)
        ids = np.full((len(q), k), np.iinfo(np.int64).max)
        centre = _distance(np.column_stack([q, np.zeros(len(q))]), self.tree.leaves[self.leaf])
        least = centre - self.tree.radius[None, self.leaf]

        def visit(at: np.ndarray, leaf: int) -> None:
            a, b = self.first[leaf], self.last[leaf]
            far = _reach(norm, bound)[at]
            lo = a + np.searchsorted(self.apart[a:b], (centre[at, leaf] - far).min(), side="left")
            hi = a + np.searchsorted(self.apart[a:b], (centre[at, leaf] + far).max(), side="right")
            for first in range(lo, hi, ENTRIES):
                compute(at, first, min(first + ENTRIES, hi))

        def compute(at: np.ndarray, lo: int, hi: int) -> None:
            nonlocal products
            products += len(at) * (hi - lo)
            found = asked[at] @ self.x[lo:hi].T
            # a bound may be rounded up where scores aren't floats
            low = bound[at] - (0 if self.kind == "float" else np.abs(np.where(np.isfinite(bound[at]), bound[at], 0)) * EPS)
            out = (query_ids[at][:, None] == self.ids[None, lo:hi]) | (found.astype(float) < low[:, None])
            better = np.flatnonzero(~out.all(axis=1))
            if not len(better):
                return
            found[out] = none
            at, found = at[better], found[better]
            few = _few(found, self.ids[lo:hi], k, self.kind)
            found = np.take_along_axis(found, few, axis=1)
            names = np.where(found == none, np.iinfo(np.int64).max, self.ids[lo:hi][few])
            both, names = np.concatenate([scores[at], found], axis=1), np.concatenate([ids[at], names], axis=1)
            best = _best(both, names, k, self.kind)
            scores[at], ids[at] = np.take_along_axis(both, best, axis=1), np.take_along_axis(names, best, axis=1)
            last = scores[at, -1]
            bound[at] = np.maximum(bound[at], np.where(last == none, -np.inf, last.astype(float)))

        order = np.argsort(least, axis=1, kind="stable")
        every = np.arange(len(q))
        done = np.zeros(least.shape, bool)
        for step in range(min(BEST_FIRST, least.shape[1])):
            leaf = order[:, step]
            active = np.flatnonzero(least[every, leaf] <= _reach(norm, bound))
            done[active, leaf[active]] = True
            for one in np.unique(leaf[active]):
                visit(active[leaf[active] == one], one)
        for one in np.argsort(least.mean(axis=0)):
            at = np.flatnonzero((least[:, one] <= _reach(norm, bound)) & ~done[:, one])
            if len(at):
                visit(at, one)
        row, col = np.nonzero(scores != none)
        return row, ids[row, col], scores[row, col], products


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, x array<double> of floor(scale * component); vectors that are null or hold null or non-finite components, and null ids, are left out."""
    v = vectors[vec_col]
    return vectors.where(vectors[id_col].isNotNull() & finite(v)).select(vectors[id_col].cast("long").alias("id"), whole(v, scale).alias("x"))


def _sortable(score: int) -> str:
    """Text that sorts like the number, of up to 99 digits."""
    return f"{int(score >= 0)}{score if score >= 0 else 10**99 + score:099d}"


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0, page: int = PAGE, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), `id_col`, score: for each row of `queries` (same columns) its `k` candidates among `vectors` of highest inner
    product of floor(scale * component), ties to the smaller id; all, if there are fewer.

    A candidate with the query's id is the query itself and never counts. Rows with a null id, vector or component and those with a
    non-finite component take no part. Shorter vectors are filled up with zeros. Repeated candidates count each; repeated queries
    count once, with their smallest vector. An empty table gives an empty one; other columns are left out. Scores that a long can't hold are null, and
    ranked by their value still; squared norms beyond 1e90 are an error.
    """
    spark = vectors.sparkSession
    schema = f"query_id long, rank int, {id_col} long, score long"
    rows = quantized(vectors, id_col, vec_col, scale)
    asked = quantized(queries, id_col, vec_col, scale).groupBy("id").agg(F.min("x").alias("x"))
    size = lambda df: df.agg(F.max(F.size("x")).alias("dim"), F.max(F.aggregate("x", F.lit(0.0), lambda a, b: a + b * b)).alias("most"), F.count("*").alias("n")).first()
    have, ask = size(rows), size(asked)
    if not have["n"] or not ask["n"]:
        return spark.createDataFrame([], schema)
    dim, most = max(1, have["dim"], ask["dim"]), float(have["most"])
    kind = next((name for name, (bound, _) in KINDS.items() if max(most, float(ask["most"])) < bound), None)
    if kind is None:
        raise ValueError("the squared norms of these vectors are beyond 1e90")
    # at most LEAVES rows
    drawn = rows.orderBy(F.xxhash64("id"), "id", "x").limit(min(LEAVES, max(NODES, have["n"] // LEAF))).collect()
    tree = Tree(_lift(np.array([np.pad(r["x"], (0, dim - len(r["x"]))) for r in drawn], float), most), most)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = dense(batch.column(1), dim)
            leaf, apart, up = tree.place(_lift(x, most))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(leaf, pa.int32()), pa.array(apart), pa.array(up)], ["id", "x", "leaf", "apart", "up"])

    placed = keep(rows.mapInArrow(assign, "id long, x binary, leaf int, apart double, up double"), "vectors")
    # at most LEAVES rows
    stats = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max("apart").alias("radius"), F.max("up").alias("up")).toPandas()
    count, radius, node_radius = np.zeros(len(tree.leaves), int), np.zeros(len(tree.leaves)), np.zeros(len(tree.nodes))
    count[stats["leaf"]], radius[stats["leaf"]] = stats["n"], stats["radius"]
    np.maximum.at(node_radius, tree.parent[stats["leaf"]], stats["up"].to_numpy())
    tree.close(count, radius, node_radius, page)
    plan = spark.createDataFrame([(int(i), int(tree.first_page[i]), int(tree.pages[i])) for i in np.flatnonzero(count)], "leaf int, first int, pages int")
    paged = F.col("first") + F.pmod(F.xxhash64("id", F.lit(7)), F.col("pages")).cast("int")
    # the plan has at most LEAVES rows
    stored = keep(placed.join(F.broadcast(plan), "leaf").select("id", "x", "leaf", "apart", paged.alias("page")), "entries")
    discard(placed)

    def route(first: bool):
        """Pages of each query: that of its nearest leaf, or the others with a leaf within reach of its bound."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, 2048):
                    batch = whole.slice(start, 2048)
                    x = dense(batch.column(1), dim) if first else _matrix(batch.column(1).to_pylist(), dim)
                    q = np.column_stack([x, np.zeros(len(x))])
                    if first:
                        bound = np.full(len(x), -np.inf)
                        far = tree.reachable(q, np.full(len(x), np.inf))[1]
                        row, page_of = np.arange(len(x)), tree.first_page[far.argmin(axis=1)]
                        home = page_of
                    else:
                        bound, home = np.asarray(batch.column(2)), np.asarray(batch.column(3))
                        near = tree.reachable(q, _reach((q * q).sum(axis=1) + most, bound))[0]
                        row, leaf = np.nonzero(near)
                        n = tree.pages[leaf]
                        row, page_of = np.repeat(row, n), np.repeat(tree.first_page[leaf], n) + np.concatenate([np.zeros(0, int), *(np.arange(c) for c in n)])
                        both = np.unique(np.column_stack([row, page_of]), axis=0).astype(int)
                        row, page_of = both[both[:, 1] != home[both[:, 0]]].T
                    texts = [v.tobytes() for v in x]
                    columns = [batch.column(0).take(pa.array(row)), pa.array([texts[i] for i in row], pa.binary()), pa.array(bound[row]), pa.array(home[row], pa.int32()), pa.array(page_of, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "x", "bound", "home", "page"])

        return run

    # with numbers of any size, `score` is text that sorts like them
    answers = f"query_id long, id long, score {'string' if kind == 'object' else 'long'}, value long, near double"

    def answer(key: tuple, entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(asked):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="object" if kind == "object" else "int64"), "value": pd.Series(dtype="Int64"), "near": pd.Series(dtype=float)})
        held = Page(entries["id"].to_numpy(), _matrix(entries["x"], dim), entries["leaf"].to_numpy(), entries["apart"].to_numpy(), tree, kind)
        row, ids, scores, _ = held.search(asked["id"].to_numpy(), _matrix(asked["x"], dim), k, asked["bound"].to_numpy())
        near = scores.astype(float)
        if kind == "object":
            shown, value = [_sortable(v) for v in scores.tolist()], pd.array([as_long(v) for v in scores.tolist()], "Int64")
        else:
            shown = value = scores.astype(np.int64)
        return pd.DataFrame({"query_id": asked["id"].to_numpy()[row], "id": ids, "score": shown, "value": value, "near": near})

    def visit(routed: DataFrame) -> DataFrame:
        """Answers of the pages, each joined with its blocks of queries only."""
        blocks = routed.groupBy("page").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        blocks = keep(blocks, "blocks")
        dealt = routed.join(blocks, "page").withColumn("block", F.pmod(F.xxhash64("id", F.lit(9)), F.col("blocks")).cast("int"))
        held = stored.join(blocks, "page").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        key = ["page", "block"]
        return held.drop("blocks").groupBy(*key).cogroup(dealt.drop("blocks").groupBy(*key)).applyInPandas(answer, answers)

    routed = "id long, x binary, bound double, home int, page int"
    first = keep(asked.mapInArrow(route(True), routed), "queries")
    near = keep(visit(first), "near")
    bounds = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("near").alias("least")).where(F.col("n") >= k)
    second = first.join(bounds, F.col("id") == F.col("query_id"), "left").select("id", "x", F.coalesce("least", F.lit(float("-inf"))).alias("bound"), "home")
    found = near.union(visit(keep(second.mapInArrow(route(False), routed), "routed")))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), F.col("value").alias("score"))


def op4_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
