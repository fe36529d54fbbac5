"""Near duplicates by DartMinHash signatures.

A document is the weighted set of its five-word shingles (weight: occurrences).  Every unit of an element's weight is a
region into which a hash throws darts, in order of rank; a document keeps the darts below a rank at which it expects
k ln k + 2k of them, hashes each dart to one of k coordinates, and the earliest dart of a coordinate is its signature
value.  So a signature costs one look at each shingle and a few hundred darts, not k hashes a shingle, and two documents
agree in a coordinate with the probability of their weighted Jaccard similarity.

Documents with the same shingles are one text and one node.  Nodes that share a band of ROWS coordinates meet in a bucket.
No bucket is paired off, for all that matters is which component a member belongs to:

* Every member is compared with the bucket's leader (the member that meets most others); links give components.
* In a bucket of at most DIRECT members, members of different components are compared.
* In a larger one a member is described by its residual: the shingles in which it differs from the leader.  Two members of
  different components can only be linked if their residuals share a certain number of shingles, so the rarest shingles of
  the residuals (as many as leave fewer than that number) are the next round's buckets.  What a group has in common is in no
  residual, so the work follows the members and not their square.

A comparison estimates from the signatures and, unless that is far from the threshold, counts the shingles themselves.

Defined results: a text of fewer than five words is one shingle of all its words; texts without words are the same only if
equal, and null or empty texts are the copies of none; rows with the same doc_id are separate documents; the kept one of
a class has the smallest doc_id (nulls last, then input order), and a class is named by it, so classes whose smallest
doc_ids are equal have the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import drop, owned, small_batches, written
from .textbytes import LOWER_VALUES, VALUES, chunks, fingerprints, mix, owners, prefix_sums, word_bounds

SHINGLE, SIMILARITY = 5, 0.8
ROWS = 5
#: Chance that a pair at the threshold meets in no bucket.
MISSED = 1.5e-5
#: Standard deviations of an estimate below and above the threshold beyond which no exact count is made.
BELOW, ABOVE = 5.3, 4.4
#: Members of a bucket, of those put forward to all, up to which they are compared directly where in different components.
DIRECT = 16
#: Pairs for each of the first round's members at which all that a later round has left is compared directly.
PAIRS_EACH = 4
#: Words of the bit table that sieves documents: it is broadcast, and never has more rows than this.
SIEVE_WORDS = 1 << 17

SIGNATURE_SCHEMA = "doc_id long, fp long, uid long, digest long, digest2 long, shingles long, signature binary, bands array<long>"
_U = np.uint64


def design(similarity: float) -> tuple[int, float, float]:
    """(bands of ROWS coordinates, estimate below which a pair is surely no link, estimate above which it surely is one)."""
    if not 0.4 <= similarity < 1:
        raise ValueError(f"similarity {similarity}: from 0.4 to below 1")
    bands = math.ceil(math.log(MISSED) / math.log(1 - similarity**ROWS))
    deviation = math.sqrt(similarity * (1 - similarity) / (bands * ROWS))
    return bands, similarity - BELOW * deviation, similarity + ABOVE * deviation


def shingle_cells(words: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(cell hashes, first cell of each text): one cell for each unit of weight of the shingles of each text."""
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    start = np.concatenate([[0], np.cumsum(n)])
    of = owners(start)
    at = first[:-1][of] + np.arange(start[-1]) - start[:-1][of]
    length = np.minimum(count[of], size)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        inside = k < length
        h[inside] = mix(h[inside] * _U(0x9E3779B97F4A7C15) + words[at[inside] + k] + _U(k))
    # the how-manieth occurrence in its text each one is
    mine = mix(h + mix(of.astype(np.uint64)))
    order = np.argsort(mine, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = mine[order][1:] != mine[order][:-1]
    place = np.arange(len(order))
    nth = np.empty(len(order), np.uint64)
    nth[order] = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64) if len(order) else 0
    return mix(h + nth * _U(0xC2B2AE3D27D4EB4F)), start


def dart_signatures(cells: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    """uint32 matrix, a row of k values for each text; texts without cells have zeros."""
    n = len(start) - 1
    weight = np.diff(start)
    out = np.zeros(n * k, np.uint32)
    todo, darts = np.flatnonzero(weight > 0), k * math.log(k) + 2 * k
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = darts / weight[todo]
        of = owners(start)
        alive = np.flatnonzero(limit[of] > 0)
        rank = np.zeros(len(alive))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        nth = 0
        while len(alive):
            dart = mix(cells[alive] + _U((nth + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            rank = rank - np.log(((dart >> _U(11)).astype(np.float64) + 1) * 2.0**-53)
            kept = rank <= limit[of[alive]]
            alive, rank, dart = alive[kept], rank[kept], mix(dart[kept] + _U(1))
            found.append((of[alive] * k + ((dart >> _U(32)) % _U(k)).astype(np.int64), rank, dart))
            nth += 1
        where, ranks, values = (np.concatenate(x) for x in zip(*found))
        late_first = np.argsort(-ranks, kind="stable")
        full = np.zeros(n * k, bool)
        out[where[late_first]] = (values[late_first] & _U(0xFFFFFFFF)).astype(np.uint32)
        full[where] = True
        todo = todo[~full.reshape(n, k)[todo].all(axis=1)]
        darts *= 2  # a coordinate stayed empty: throw deeper
    return out.reshape(n, k)


def _shingles(column: pa.Array) -> Iterator[tuple]:
    """(first row, end row, bytes, offsets, cells, first cell of each text) of runs of texts."""
    for row, end, data, offsets in chunks(column):
        s, e, first = word_bounds(data, offsets)
        yield row, end, data, offsets, *shingle_cells(fingerprints(prefix_sums(data, LOWER_VALUES), s, e), first)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("fp"))


def signatures(docs: DataFrame, n_bands: int) -> DataFrame:
    """SIGNATURE_SCHEMA.  fp: a hash of the text; uid: unique and in input order; signature: 16 bits of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, end, data, offsets, cells, start in _shingles(batch.column(1)):
                values = dart_signatures(cells, start, n_bands * ROWS)
                n = end - row
                ids = np.arange(uid, uid + n)
                uid += n
                weight = np.diff(start)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(cells))])
                square = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(cells ^ _U(0x5555)))])
                digest, digest2 = total[start[1:]] - total[start[:-1]], square[start[1:]] - square[start[:-1]]
                # texts without words: equal bytes, or nothing
                whole = fingerprints(prefix_sums(data, VALUES), offsets[:-1], offsets[1:])
                bare, empty = weight == 0, np.diff(offsets) == 0
                digest = np.where(empty, mix(ids.astype(np.uint64)), np.where(bare, whole, digest))
                digest2 = np.where(empty, ids.astype(np.uint64), np.where(bare, _U(1), digest2))
                bands = np.zeros((n, n_bands), np.uint64)
                for r in range(ROWS):
                    bands = mix(bands + values[:, r::ROWS].astype(np.uint64) + _U(r + 1))
                bands += np.arange(n_bands, dtype=np.uint64)  # another hash for each band
                bands = mix(bands)
                flat = pa.array(bands[~bare].reshape(-1).view(np.int64))
                at = np.concatenate([[0], np.cumsum(np.where(bare, 0, n_bands))]).astype(np.int32)
                short = values.astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n), batch.column(2).slice(row, n), pa.array(ids), pa.array(digest.view(np.int64)), pa.array(digest2.view(np.int64)), pa.array(weight.astype(np.int64)),
                        pa.array([v.tobytes() for v in short], pa.binary()), pa.ListArray.from_arrays(pa.array(at), flat),
                    ],
                    ["doc_id", "fp", "uid", "digest", "digest2", "shingles", "signature", "bands"],
                )

    return _keyed(docs).mapInArrow(run, SIGNATURE_SCHEMA)


# cells are stored sorted, six bytes each: two of a text's, or of two texts', are equal by chance once in 2**48


def _packed(cells: np.ndarray) -> bytes:
    return np.sort(cells & _U((1 << 48) - 1)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    six = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).reshape(-1)


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, the share of equal coordinates, for rows (a, b, signature, signature)."""
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((x == y).mean(axis=1))], ["a", "b", "score"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, the similarity, for rows (a, b, cells, cells)."""
    for batch in batches:
        score = np.empty(batch.num_rows)
        for i in range(batch.num_rows):
            both = np.concatenate([_unpacked(batch.column(2)[i]), _unpacked(batch.column(3)[i])])
            both.sort(kind="stable")
            same = int((both[1:] == both[:-1]).sum())  # cells are distinct within a text
            score[i] = same / max(1, len(both) - same)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["a", "b", "score"])


def residual(x: np.ndarray, leader: np.ndarray, out: bool, similarity: float) -> tuple[np.ndarray, int, int]:
    """(the cells that only one of x and leader has, near, most): how many of them, in any order that all members share, x puts
    forward to partners whose residual is not smaller, and to all.

    With r = (1 - similarity) / (1 + similarity), sets are linked if they differ in at most r (|x| + |y|) cells; then |y| is at
    most |x| / similarity, and their residuals f share at least t = (|f(x)| + |f(y)| - r (|x| + |y|)) / 2 cells.  Of sets that
    share t cells, the first |f| - t + 1 of one and of the other have a cell in common.  Whatever y is, t is at least
    * |f(x)| - r |x| (1 + 1 / similarity), for |f(x)| and |f(y)| differ by no more than x and y do; half of that is taken off
      if |f(y)| is not smaller;
    * (|f(x)| - r (|x| + |leader|)) / 2, for |f(y)| is at least the difference of the sizes of y and leader;
    * more than (|f(x)| + r (|leader| - |x|)) / 2 if y is not linked to the leader.  A member that is not `out` is only paired
      with such."""
    both = np.sort(np.concatenate([x, leader]))
    alone = np.ones(len(both), bool)
    same = both[1:] == both[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    cells, r = both[alone], (1 - similarity) / (1 + similarity)
    m, most = len(cells), r * len(x) * (1 + 1 / similarity)
    least = 1 if out else math.floor((m + r * (len(leader) - len(x))) / 2 + 1e-9) + 1
    near = max(1, least, math.ceil(m - most / 2 - 1e-9))
    any_ = max(1, least, math.ceil(m - most - 1e-9), math.ceil((m - r * (len(x) + len(leader))) / 2 - 1e-9))
    return cells, max(0, m - near + 1), max(0, m - near + 1, m - any_ + 1)


def _residuals(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """leader, uid, weight, size, near, most, cells (array) for rows (leader, uid, out, cells, leader's cells)."""
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            sets = [_unpacked(x) for x in part.column(3)]
            found = [residual(x, _unpacked(y), o, similarity) for x, y, o in zip(sets, part.column(4), part.column(2).to_pylist())]
            numbers = [[len(x) for x in sets], [len(f[0]) for f in found], [f[1] for f in found], [f[2] for f in found]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(n, pa.int32()) for n in numbers), pa.array([f[0].view(np.int64) if f[2] else [] for f in found], pa.list_(pa.int64()))],
                ["leader", "uid", "weight", "size", "near", "most", "cells"],
            )


def _slot(fp: str) -> tuple[Column, Column]:
    """(word, bit) of the bit table that a fingerprint stands for."""
    return F.pmod(F.col(fp), F.lit(SIEVE_WORDS)).alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({fp}, 40) & 63 AS INT))").alias("bit")


def sieved(docs: DataFrame, wanted: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of docs(.., __fp) that may (inside) or surely do not have a fingerprint of wanted(fp).  The bit table has a
    fixed size; when it is full, all rows may."""
    table = wanted.select(*_slot("fp")).groupBy("word").agg(F.bit_or("bit").alias("mask")).toDF("__word", "__mask")
    word, bit = _slot("__fp")
    hit = F.coalesce("__mask", F.lit(0)).bitwiseAND(F.col("__bit")) != 0
    return docs.withColumns({"__word": word, "__bit": bit}).join(F.broadcast(table), "__word", "left").where(hit if inside else ~hit).drop("__word", "__bit", "__mask")


class _Comparer:
    """Scores pairs of nodes(uid, doc_id, fp, signature) and keeps what it has read and found."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, similarity: float, owner: str):
        self.docs, self.nodes, self.similarity, self.owner = _keyed(docs), nodes, similarity, owner
        _, self.no, self.yes = design(similarity)
        self.cells: DataFrame | None = None
        self.scores: DataFrame | None = None

    def read(self, uids: DataFrame) -> DataFrame:
        """uid, cells of at least the nodes uids(uid); each text is read once."""
        need = uids.distinct() if self.cells is None else uids.distinct().join(self.cells.select("uid"), "uid", "left_anti")
        need = written(self.nodes.select("uid", "doc_id", "fp").join(need, "uid", "left_semi").withColumnsRenamed({"doc_id": "its_id", "fp": "its_fp"}), "near-needed")
        n = need.count()
        if n:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row, end, _, _, cells, start in _shingles(batch.column(1)):
                        packed = [_packed(cells[a:b]) for a, b in zip(start[:-1].tolist(), start[1:].tolist())]
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(packed, pa.binary())], ["uid", "cells"])

            some = sieved(self.docs.withColumnRenamed("fp", "__fp"), need.select(F.col("its_fp").alias("fp")))
            its = some["doc_id"].eqNullSafe(need["its_id"]) & (some["__fp"] == need["its_fp"])
            with owned(self.owner):
                new = written(some.join(need, its).select("uid", "text").mapInArrow(run, "uid long, cells binary"), "near-cells")
                if new.count() > n:  # rows with the same id and text
                    new = written(new.dropDuplicates(["uid"]), "near-cells")
            self.cells = new if self.cells is None else self.cells.unionAll(new)
        return self.cells

    def links(self, pairs: DataFrame) -> DataFrame:
        """a, b: the linked ones of the distinct pairs(a, b) that were not compared before."""
        todo = written(pairs if self.scores is None else pairs.join(self.scores, ["a", "b"], "left_anti"), "near-pairs")

        def score(p: DataFrame, of: DataFrame, column: str, how) -> DataFrame:
            left, right = of.select(F.col("uid").alias("a"), F.col(column).alias("x")), of.select(F.col("uid").alias("b"), F.col(column).alias("y"))
            return p.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(how, "a long, b long, score double")

        with owned(self.owner):
            rough = written(score(todo, self.nodes, "signature", _estimates), "near-estimates")
        unsure = F.col("score").between(self.no, self.yes)
        grey = rough.where(unsure).select("a", "b")
        new = rough.where(~unsure)
        if grey.limit(1).count():
            cells = self.read(grey.select(F.col("a").alias("uid")).union(grey.select("b")))
            with owned(self.owner):
                new = new.unionAll(written(score(grey, cells, "cells", _counts), "near-counts"))
        self.scores = new.select("a", "b") if self.scores is None else self.scores.unionAll(new.select("a", "b"))
        return new.where(F.col("score") >= self.similarity).select("a", "b")


def _labelled(df: DataFrame, labels: DataFrame | None, column: str) -> DataFrame:
    """df with the component of `column` as <column>_label; a node without links is its own component."""
    if labels is None:
        return df.withColumn(f"{column}_label", F.col(column))
    side = labels.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
    return df.join(side, F.col(column) == F.col("__node"), "left").withColumn(f"{column}_label", F.coalesce("__label", column)).drop("__node", "__label")


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """labels (node, label) after more links: only the components that these join are labelled anew."""
    between = _labelled(_labelled(links, labels, "a"), labels, "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).where("a <> b").distinct()
    between = written(between, "near-between")
    if not between.limit(1).count():
        return labels
    joined = components(between)
    if labels is None:
        return joined
    of = joined.select(F.col("node").alias("label"), F.col("label").alias("new"))
    moved = labels.join(of, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return written(moved.unionAll(joined.join(labels.select("node"), "node", "left_anti")), "near-labels")


def _refined(large: DataFrame, comparer: _Comparer) -> DataFrame:
    """MEMBER: the buckets by rare cells of the residuals, for large(leader, uid, out), distinct.  A far member is put forward
    to members with smaller residuals only."""
    mixed = large.where("out").select("leader").distinct()
    large = written(large.where("uid <> leader").join(mixed, "leader"), "near-large")
    cells = comparer.read(large.select("uid").union(large.select("leader")))
    both = large.join(cells, "uid").join(cells.select(F.col("uid").alias("leader"), F.col("cells").alias("leading")), "leader").select("leader", "uid", "out", "cells", "leading")
    similarity, own = comparer.similarity, ["leader", "uid", "weight", "size", "near", "most"]
    rows = written(both.mapInArrow(lambda it: _residuals(it, similarity), "leader long, uid long, weight int, size int, near int, most int, cells array<long>").where("most > 0"), "near-residuals")
    each = rows.select(*own, F.explode("cells").alias("cell"))
    often = written(each.groupBy("leader", "cell").agg(F.count("*").alias("n")).where("n > 1"), "near-often")
    counted = each.join(often, ["leader", "cell"], "left").groupBy(*own).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "cell"))).alias("order"))
    placed = F.transform(F.slice("order", 1, F.col("most")), lambda c, i: F.struct(c["n"].alias("n"), c["cell"].alias("cell"), i.alias("at")))
    first = counted.select(*own, F.explode(F.filter(placed, lambda c: c["n"] > 1)).alias("c"))
    return first.select(F.xxhash64("leader", "c.cell").alias("bucket"), "uid", (F.col("c.at") >= F.col("near")).alias("far"), "c.at", "size", "weight")


#: Columns of the table of bucket members; at, size and weight: place in the residual, its size, and the text's.
MEMBER = ("bucket", "uid", "far", "at", "size", "weight")


def _apart(small: DataFrame, similarity: float) -> DataFrame:
    """a, b: the members of a bucket that are in different components and may be linked by what their residuals can share."""
    r = (1 - similarity) / (1 + similarity)
    x, y = small.alias("x"), small.alias("y")
    rest = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))
    need = (F.col("x.size") + F.col("y.size") - r * (F.col("x.weight") + F.col("y.weight"))) / 2
    put = F.when(F.col("x.size") < F.col("y.size"), ~F.col("x.far")).when(F.col("x.size") > F.col("y.size"), ~F.col("y.far")).otherwise(~(F.col("x.far") & F.col("y.far")))
    on = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.uid") < F.col("y.uid")) & (F.col("x.label") != F.col("y.label")) & put & (rest >= need - 1e-9)
    return x.join(y, on).select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b")).distinct()


def _met(pairs: DataFrame, labels: DataFrame | None, comparer: _Comparer) -> DataFrame | None:
    """labels after each uid of pairs(uid, leader) that is in another component than its leader was compared with it."""
    meet = written(pairs.where("uid <> leader").distinct(), "near-meet")
    apart = _labelled(_labelled(meet, labels, "uid"), labels, "leader").where("uid_label <> leader_label")
    return _merged(labels, comparer.links(apart.select(F.least("uid", "leader").alias("a"), F.greatest("uid", "leader").alias("b")).distinct()))


def _round(members: DataFrame, labels: DataFrame | None, comparer: _Comparer, direct: int, spare: int | None) -> tuple[DataFrame | None, DataFrame | None, int]:
    """(members of the next round's buckets or None, labels, rows of members).  spare: pairs that may be left for all to be
    compared directly; None in the first round, in which every bucket has a leader."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.count(F.when(~F.col("far"), 1)).alias("near"))
    sized = written(members.join(sizes, "bucket"), "near-sized")
    # rows of a bucket each carry n, so the sum of near over rows is the number of pairs put forward
    seen = sized.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.when(F.col("near") > direct, F.col("near"))), F.lit(0)).alias("pairs")).first()
    few = spare is not None and seen["pairs"] <= spare
    led = sized if spare is None else sized.where(F.col("near") > direct)
    if not few:
        degree = led.groupBy("uid").agg(F.sum("n").alias("degree"))
        best = F.max(F.struct("degree", (-F.col("uid")).alias("minus"))).alias("best")
        leaders = written(led.join(degree, "uid").groupBy("bucket").agg(best).select("bucket", (-F.col("best.minus")).alias("leader"), F.col("best.degree").alias("degree")), "near-leaders")
        labels = _met(led.join(leaders.drop("degree"), "bucket").select("uid", "leader"), labels, comparer)
    # what is left in different components: pairs where few are put forward, finer buckets else
    now = written(_labelled(sized, labels, "uid").withColumnRenamed("uid_label", "label"), "near-now")
    mixed = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
    now = written(now.join(mixed, "bucket"), "near-mixed")
    labels = _merged(labels, comparer.links(_apart(now if few else now.where(F.col("near") <= direct), comparer.similarity)))
    if few:
        return None, labels, seen["rows"]
    large = written(_labelled(now.where(F.col("near") > direct).join(leaders, "bucket"), labels, "leader"), "near-large")
    if not large.limit(1).count():
        return None, labels, seen["rows"]
    # the buckets whose leaders are in one component take one of these as the leader of all
    one = large.groupBy("leader_label").agg(F.max(F.struct("degree", (-F.col("leader")).alias("minus"))).alias("best"))
    large = written(large.select("uid", "leader_label").distinct().join(one, "leader_label").select("uid", (-F.col("best.minus")).alias("leader")), "near-large")
    labels = _met(large, labels, comparer)
    out = written(_labelled(_labelled(large, labels, "uid"), labels, "leader").select("leader", "uid", (F.col("uid_label") != F.col("leader_label")).alias("out")), "near-out")
    fresh = written(_refined(out, comparer), "near-fresh")
    known = _labelled(fresh, labels, "uid")
    useful = known.groupBy("bucket").agg(F.min("uid_label").alias("low"), F.max("uid_label").alias("high"), F.min("far").alias("far")).where("low < high AND NOT far").select("bucket")
    return fresh.join(useful, "bucket").select(*MEMBER), labels, seen["rows"]


def _components(docs: DataFrame, all_: DataFrame, texts: DataFrame, similarity: float, direct: int, work: str) -> DataFrame | None:
    """node, label of the texts that are linked with another; None if none is.  The tables of a round are deleted when what
    goes on from it is stored."""
    spark, first = docs.sparkSession, f"{work} first"
    with owned(first):
        reps = written(all_.select("uid", "bands").join(texts.select("uid"), "uid", "left_semi"), "near-bands")
        met = reps.select("uid", F.explode("bands").alias("bucket"))
        shared = written(met.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "near-shared")
    none = F.lit(0)
    with owned(work):
        members = written(met.join(shared, "bucket").select("bucket", "uid", F.lit(False).alias("far"), none.alias("at"), none.alias("size"), none.alias("weight")), "near-members")
        drop(spark, first)
        nodes = written(all_.select("uid", "doc_id", "fp", "signature").join(members.select("uid").distinct(), "uid", "left_semi"), "near-nodes")
    comparer, labels, spare, n = _Comparer(docs, nodes, similarity, work), None, None, 0
    while members is not None and members.limit(1).count():
        n += 1
        with owned(f"{work} {n}"):
            members, labels, size = _round(members, labels, comparer, direct, spare)
        with owned(work):
            members, labels = (written(members, "near-members") if members is not None else None), (written(labels, "near-labels") if labels is not None else None)
        drop(spark, f"{work} {n}")
        spare = PAIRS_EACH * size if spare is None else spare
    return labels


def classes(docs: DataFrame, similarity: float = SIMILARITY, direct: int = DIRECT) -> DataFrame:
    """doc_id, fp (hash of the text), uid, class_id (smallest doc_id of its class), kept, for every row of docs(doc_id, text)."""
    spark, work = docs.sparkSession, f"near {uuid4().hex}"
    small_batches(spark)
    all_ = written(signatures(docs, design(similarity)[0]), "near-signatures")
    key = ["digest", "digest2", "shingles"]
    texts = written(all_.groupBy(*key).agg(F.min("uid").alias("uid"), F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "uid")).alias("first")), "near-texts")
    with owned(work):
        labels = _components(docs, all_, texts, similarity, direct, work)
        named = _labelled(texts, labels, "uid").withColumnRenamed("uid_label", "label")
        firsts = named.groupBy("label").agg(F.min("first").alias("class"))
        classed = named.join(firsts, "label").select(*key, "class")
    classed = written(classed, "near-classes")
    drop(spark, work)
    return all_.select("doc_id", "fp", "uid", *key).join(classed, key).select("doc_id", "fp", "uid", F.col("class.doc_id").alias("class_id"), (F.col("uid") == F.col("class.uid")).alias("kept"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each class, all columns as they were.  Rows with the same id and text are told apart by
    nothing: one of them stays, unless they are empty."""
    of = written(classes(docs, similarity).groupBy("doc_id", "fp").agg(F.max("kept").alias("kept"), F.count("*").alias("n")).where("n > 1 OR NOT kept"), "near-judged")
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__fp": F.xxhash64("text")})
    judged = of.select(F.col("doc_id").alias("__its_id"), F.col("fp").alias("__its_fp"), F.col("kept").alias("__kept"))
    maybe = sieved(keyed, of).join(judged, F.col("__id").eqNullSafe(F.col("__its_id")) & (F.col("__fp") == F.col("__its_fp")), "left")
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    out = sieved(keyed, of, inside=False).select(docs.columns).unionAll(maybe.where(F.col("__kept").isNull() | (F.col("__kept") & empty)).select(docs.columns))
    if of.where("kept").limit(1).count():
        out = out.unionAll(maybe.where(F.col("__kept") & ~empty).dropDuplicates(["__id", "__fp"]).select(docs.columns))
    return out
