"""Exact top-k by integer inner product over M-trees.

Each task builds one M-tree for every few thousand vectors it reads and stores it as a row: paged nodes with a routing
vector, a covering radius and the distance to the parent's routing vector, and leaf pages whose entries hold their
distance to the page's routing vector.  An inner product is no metric, so a tree works in one dimension more: a vector v
gets the coordinate sqrt(M - |v|^2), M the largest squared norm of the tree, and a query 0; then
distance(q, v)^2 = |q|^2 + M - 2 <q, v>, and the nearest are those of the highest product.  A search keeps a queue of
nodes by their least possible distance, stops when that exceeds the k-th best so far, and skips nodes and entries whose
stored parent distance already shows, by the triangle inequality, that they are too far.  Distances only ever prune (with
a slack above rounding error); scores are exact integers: products are taken in doubles where the components show that no
sum can pass 2**53, and in 64-bit integers else.

The queries go to all trees in blocks of bounded size, each tree answers with its own top k, and the answers of a query
are merged.  Ties go to the smaller id.

Defined results: vectors that are null, empty, or hold a null or non-finite component, and rows without id, take no part;
a row is never an answer to the query of the same id; only vectors of the query's dimension are compared; rows with the
same id are separate answers, queries with the same id and vector are asked once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Vectors of one tree, entries of a leaf page, children of a routing node, queries sent at once.
TREE, PAGE, FANOUT, BLOCK = 8192, 512, 24, 4096
#: Rounding error of distances, as a share of the distance and of the largest one possible.
SLACK, ROUNDING = 1e-6, 4e-7

TREE_SCHEMA = "dim int, most double, ids binary, vectors binary, spread binary, radius binary, to_parent binary, pivot binary, child binary, n_child binary, leaf binary"


def clean(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x) of the rows that take part."""
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null and e is not null and size(e) > 0").where(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return kept.select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("v"))


class Tree:
    """vectors: int64 matrix.  Entries are put in the order of the pages, so that a leaf is a run of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        x = vectors.astype(np.float64)
        norm = (x * x).sum(axis=1)
        self.most = float(norm.max())
        x = np.concatenate([x, np.sqrt(np.maximum(0, self.most - norm))[:, None]], axis=1)
        rng = np.random.default_rng(len(ids))
        nodes, order, spread = [], [], np.zeros(len(ids))

        def far(rows: np.ndarray, pivot: int) -> np.ndarray:
            return np.sqrt(np.maximum(0, ((x[rows] - x[pivot]) ** 2).sum(axis=1)))

        def grow(rows: np.ndarray, pivot: int, to_parent: float) -> int:
            me, d = len(nodes), far(rows, pivot)
            nodes.append(None)
            if len(rows) <= page:
                by = np.argsort(d, kind="stable")
                nodes[me] = [float(d.max()), to_parent, pivot, len(order), len(rows), True, []]
                spread[rows] = d
                order.extend(rows[by].tolist())
                return me
            picks = rng.choice(rows, min(fanout, len(rows)), replace=False)
            apart = np.stack([far(rows, p) for p in picks])
            nearest = apart.argmin(axis=0)
            groups = [(p, rows[nearest == i]) for i, p in enumerate(picks)]
            if max(len(g) for _, g in groups) == len(rows):  # equal vectors: any split will do
                groups = [(g[0], g) for g in np.array_split(rows, fanout)]
            children = [grow(g, p, float(far(np.array([p]), pivot)[0])) for p, g in groups if len(g)]
            nodes[me] = [float(d.max()), to_parent, pivot, 0, len(children), False, children]
            return me

        grow(np.arange(len(ids)), 0, 0.0)
        order = np.array(order)
        links = [c for n in nodes for c in n[6]]
        at = np.cumsum([0] + [len(n[6]) for n in nodes])
        self.radius, self.to_parent = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
        self.leaf = np.array([n[5] for n in nodes])
        self.child = np.array([n[3] if n[5] else at[i] for i, n in enumerate(nodes)])
        self.n_child = np.array([n[4] for n in nodes])
        self.links = np.array(links, np.int64)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.pivot = place[[n[2] for n in nodes]]
        self.ids, self.spread = ids[order], spread[order]
        self._hold(vectors[order].astype(np.int64))

    def _hold(self, whole: np.ndarray) -> None:
        self.whole, self.vectors = whole, whole.astype(np.float64)
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def row(self) -> dict:
        return {
            "dim": self.vectors.shape[1], "most": self.most, "ids": self.ids.astype(np.int64).tobytes(), "vectors": self.whole.tobytes(), "spread": self.spread.tobytes(), "radius": self.radius.tobytes(), "to_parent": self.to_parent.tobytes(), "pivot": self.pivot.tobytes(),
            "child": np.concatenate([self.child, self.links]).tobytes(), "n_child": self.n_child.tobytes(), "leaf": self.leaf.tobytes(),
        }

    @classmethod
    def of(cls, row: dict) -> Tree:
        me = object.__new__(cls)
        me.most, me.ids = row["most"], np.frombuffer(row["ids"], np.int64)
        me._hold(np.frombuffer(row["vectors"], np.int64).reshape(-1, row["dim"]))
        for name in ("spread", "radius", "to_parent"):
            setattr(me, name, np.frombuffer(row[name]))
        me.pivot, me.n_child, me.leaf = np.frombuffer(row["pivot"], np.int64), np.frombuffer(row["n_child"], np.int64), np.frombuffer(row["leaf"], bool)
        both = np.frombuffer(row["child"], np.int64)
        me.child, me.links = both[: len(me.leaf)], both[len(me.leaf) :]
        return me

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best, best first, and how many products were computed."""
        whole, q = q, q.astype(np.float64)
        most = self.largest * float(np.abs(q).max(initial=0)) * len(q)
        if most >= 2.0**63:
            raise OverflowError("products of these vectors may not fit 64 bits")
        exact = most < 2.0**53
        product = (lambda rows: self.vectors[rows] @ q) if exact else (lambda rows: self.whole[rows] @ whole)
        c = float(q @ q) + self.most
        rounding = ROUNDING * np.sqrt(c)
        dist = lambda score: np.sqrt(np.maximum(0, c - 2 * score))
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.float64 if exact else np.int64)
        limit, asked = np.inf, 1
        d0 = float(dist(self.vectors[self.pivot[0]] @ q))
        queue = [(max(0.0, d0 - self.radius[0]), 0, d0)]
        while queue:
            least, node, d = heapq.heappop(queue)
            margin = limit + SLACK * (1 + limit) + rounding
            if least > margin:
                break
            if self.leaf[node]:
                s, e = self.child[node], self.child[node] + self.n_child[node]
                near = np.abs(d - self.spread[s:e]) <= margin
                n = int(near.sum())
                asked += n
                # few: only those; most: the page as one block
                rows, score = (s + np.flatnonzero(near), None) if 2 * n < e - s else (np.arange(s, e), product(slice(s, e)))
                score = product(rows) if score is None else score
                good = self.ids[rows] != own
                if len(best) == k:
                    good &= score >= best[-1]
                if good.any():
                    ids, score = np.concatenate([best_ids, self.ids[rows[good]]]), np.concatenate([best, score[good]])
                    order = np.lexsort((ids, -score))[:k]
                    best_ids, best = ids[order], score[order]
                    if len(best) == k:
                        limit = float(dist(float(best[-1])))
            else:
                kids = self.links[self.child[node] : self.child[node] + self.n_child[node]]
                kids = kids[np.abs(d - self.to_parent[kids]) - self.radius[kids] <= margin]
                asked += len(kids)
                far = dist(self.vectors[self.pivot[kids]] @ q)
                for kid, x, low in zip(kids.tolist(), far.tolist(), np.maximum(0, far - self.radius[kids]).tolist()):
                    if low <= margin:
                        heapq.heappush(queue, (low, kid, x))
        return best_ids, best.astype(np.int64), asked


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, offsets) of an array<long> column without nulls."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False).astype(np.int64), offsets


def build_index(vectors: DataFrame, tree: int = TREE) -> DataFrame:
    """TREE_SCHEMA: a row is a tree over at most `tree` vectors of one dimension.  vectors: as from clean()."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def emit(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([Tree(np.array([i for i, _ in rows]), np.array([v for _, v in rows])).row()], schema=_ARROW)

        for batch in batches:
            flat, offsets = _matrix(batch.column(1))
            for i, key in enumerate(batch.column(0).to_pylist()):
                v = flat[offsets[i] : offsets[i + 1]]
                rows = held.setdefault(len(v), [])
                rows.append((key, v))
                if len(rows) == tree:
                    yield emit(rows)
                    rows.clear()
        for rows in held.values():
            if rows:
                yield emit(rows)

    return vectors.select("vec_id", "v").mapInArrow(plant, TREE_SCHEMA)


_ARROW = pa.schema([("dim", pa.int32()), ("most", pa.float64()), *((c, pa.binary()) for c in ("ids", "vectors", "spread", "radius", "to_parent", "pivot", "child", "n_child", "leaf"))])


def search(index: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score.  queries: as from clean()."""
    asked = queries.dropDuplicates(["vec_id", "v"])
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.pmod(F.hash("vec_id"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        sent = index.sparkSession.sparkContext.broadcast([(r[0], np.array(r[1], np.int64)) for r in asked.where(F.col("block") == b).select("vec_id", "v").collect()])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(n)[i].as_py() for n, name in enumerate(batch.schema.names)}
                    tree = Tree.of(row)
                    ids, found, scores = [], [], []
                    for own, q in sent.value:
                        if len(q) == row["dim"]:
                            got, score, _ = tree.search(own, q, k)
                            ids.append(np.full(len(got), own)), found.append(got), scores.append(score)
                    if ids:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (ids, found, scores)], ["query_id", "vec_id", "score"])

        part = index.mapInArrow(run, "query_id long, vec_id long, score long")
        out = part if out is None else out.unionAll(part)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The k best others of each row whose vec_id is divisible by `every`."""
    ready = clean(vectors)
    index = written(build_index(ready), "m-trees")
    return search(index, ready.where(F.col("vec_id") % every == 0), k)
