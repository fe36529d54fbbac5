"""Quality classifier: a generalised additive model with pairwise interactions.

Features of every whole text come from its bytes, vectorised over chunks of texts.  The model is fitted on a bounded
sample of labelled rows (SAMPLE, chosen by a hash of the id): every feature is cut into quantile bins and shallow trees
are boosted on one feature after another, round after round, each tree adding to that feature's look-up table; then the
pairs of features that explain most of what is left get two-dimensional tables in the same way.  A score is the logistic
of a sum of looked-up bins, so scoring is a few vectorised additions a feature.

Rows of the held-out fold (crc32 of the id as text, modulo 5, is 0) are never used to fit; labels, lang, source and the
id are no features.

Defined results: null texts count as empty and are scored; labels that are null or whose document is absent are not used;
repeated labels of a document are all used; with labels of one class only, or none, every score is the class's share
(0.5 without labels); a null doc_id is in no fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import INK_BYTE, LOWER_VALUES, VALUES, chunks, fingerprints, mix, owners, prefix_sums, word_bounds

#: Labelled rows used to fit.
SAMPLE = 40_000
BINS, ROUNDS, RATE = 48, 120, 0.08
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 12, 40
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "long_words", "short_words", "upper", "digit", "punctuation", "symbols", "pipes", "exclaims", "quotes", "space", "newline", "non_ascii", "sentence_ends",
    "commas", "caps_words", "symbol_words", "distinct_words", "top_word", "repeated_pairs", "log_lines", "line_words", "repeated_lines", "ended_lines", "short_lines", "byte_entropy",
]


def _bytes_in(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _DIGIT = _bytes_in("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_in("0123456789")
_PUNCTUATION = _bytes_in("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_SYMBOLS = _bytes_in("#$%&*+<=>@\\^_`{}~")
_LINE = np.ones(256, bool)
_LINE[10] = False
_NON_ASCII = np.arange(256) >= 128


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a chunk."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, len(FEATURES)))
    put = lambda name, x: out.__setitem__((slice(None), FEATURES.index(name)), x)

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)

    put("log_bytes", np.log1p(size))
    for name, table in (("upper", _UPPER), ("digit", _DIGIT), ("punctuation", _PUNCTUATION), ("symbols", _SYMBOLS), ("pipes", _bytes_in("|")), ("exclaims", _bytes_in("!")), ("quotes", _bytes_in("\"'")), ("space", ~INK_BYTE), ("newline", ~_LINE), ("non_ascii", _NON_ASCII), ("sentence_ends", _bytes_in(".?!")), ("commas", _bytes_in(",;:"))):
        put(name, share(table))
    start, end, first = word_bounds(data, offsets, INK_BYTE)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    own, length = owners(first), end - start

    def mean(x: np.ndarray) -> np.ndarray:
        return np.bincount(own, x, n) / some

    put("log_words", np.log1p(words))
    put("word_bytes", mean(length))
    put("long_words", mean(length > 14))
    put("short_words", mean(length <= 2))
    if len(start):
        caps = np.concatenate([[0], np.cumsum(_UPPER[data])])
        marks = np.concatenate([[0], np.cumsum(_PUNCTUATION[data])])
        put("caps_words", mean((caps[end] - caps[start]) * 2 > length))
        put("symbol_words", mean((marks[end] - marks[start]) * 3 >= length))
        key = fingerprints(prefix_sums(data, LOWER_VALUES), start, end)
        mine = mix(key + mix(own.astype(np.uint64)))
        distinct, at, count = np.unique(mine, return_index=True, return_counts=True)
        put("distinct_words", np.bincount(own[at], minlength=n) / some)
        top = np.zeros(n)
        np.maximum.at(top, own[at], count)
        put("top_word", top / some)
        pair = own[1:] == own[:-1]
        two = mix(mine[:-1] * np.uint64(3) + mine[1:])[pair]
        _, at = np.unique(two, return_index=True)
        pairs = np.bincount(own[1:][pair], minlength=n)
        put("repeated_pairs", 1 - np.bincount(own[1:][pair][at], minlength=n) / np.maximum(pairs, 1))
    ls, le, lfirst = word_bounds(data, offsets, _LINE)
    lines, lown = np.diff(lfirst).astype(float), owners(lfirst)
    put("log_lines", np.log1p(lines))
    put("line_words", np.log1p(words / np.maximum(lines, 1)))
    if len(ls):
        key = fingerprints(prefix_sums(data, VALUES), ls, le)
        _, at = np.unique(mix(key + mix(lown.astype(np.uint64))), return_index=True)
        put("repeated_lines", 1 - np.bincount(lown[at], minlength=n) / np.maximum(lines, 1))
        put("ended_lines", np.bincount(lown, _bytes_in(".?!\"'")[data[le - 1]], n) / np.maximum(lines, 1))
        put("short_lines", np.bincount(lown, (le - ls) < 30, n) / np.maximum(lines, 1))
    if len(data):
        text_of = np.repeat(np.arange(n), np.diff(offsets))
        counts = np.bincount(text_of * 256 + data, minlength=n * 256).reshape(n, 256)
        p = counts / np.maximum(size, 1)[:, None]
        put("byte_entropy", -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1))
    return out


def featurised(docs: DataFrame) -> DataFrame:
    """doc_id and the columns FEATURES, for every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *(pa.array(x[:, i]) for i in range(x.shape[1]))], ["doc_id", *FEATURES])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(["doc_id long", *(f"{c} double" for c in FEATURES)]))


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


class Gam:
    """Look-up tables over quantile bins; x has a row for each text and a column for each feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = BINS, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS):
        share = (y.mean() if len(y) else 0.5).clip(1e-4, 1 - 1e-4) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for c in x.T]
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        if len(y) and 0 < y.mean() < 1:
            self._boost(x, y.astype(float), rounds, rate, pairs, pair_rounds)

    def _binned(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(self.cuts)]

    @staticmethod
    def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3, penalty: float = 1.0) -> np.ndarray:
        """Newton steps of a tree of so many leaves over a line of bins with gradient sums g and weight sums h."""
        edges = [0, len(g)]
        cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
        value = lambda s, e: (cg[e] - cg[s]) ** 2 / (ch[e] - ch[s] + penalty)
        for _ in range(leaves - 1):
            best, where = 1e-9, None
            for s, e in zip(edges, edges[1:]):
                if e - s > 1:
                    at = np.arange(s + 1, e)
                    gain = value(s, at) + value(at, e) - value(s, e)
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, where = gain[k], at[k]
            if where is None:
                break
            edges = sorted([*edges, int(where)])
        out = np.zeros(len(g))
        for s, e in zip(edges, edges[1:]):
            out[s:e] = (cg[e] - cg[s]) / (ch[e] - ch[s] + penalty)
        return out

    @staticmethod
    def _box(g: np.ndarray, h: np.ndarray, penalty: float = 1.0) -> tuple[float, np.ndarray]:
        """(gain, Newton steps) of the best tree that splits once along each axis of a grid of bins."""
        cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
        a, b = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]
        if not a.size or not b.size:
            return 0.0, np.zeros_like(g)
        quads = lambda c: (c[a, b], c[a, -1] - c[a, b], c[-1, b] - c[a, b], c[-1, -1] - c[a, -1] - c[-1, b] + c[a, b])
        qg, qh = quads(cg), quads(ch)
        gain = sum(x * x / (w + penalty) for x, w in zip(qg, qh)) - cg[-1, -1] ** 2 / (ch[-1, -1] + penalty)
        i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
        out = np.zeros_like(g)
        rows, cols = np.arange(g.shape[0]) > i, np.arange(g.shape[1]) > j
        for k, (r, c) in enumerate(((~rows, ~cols), (~rows, cols), (rows, ~cols), (rows, cols))):
            out[np.ix_(r, c)] = qg[k][i, j] / (qh[k][i, j] + penalty)
        return float(gain[i, j]), out

    def _boost(self, x: np.ndarray, y: np.ndarray, rounds: int, rate: float, pairs: int, pair_rounds: int) -> None:
        bins, margin = self._binned(x), np.full(len(y), self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-margin))
            return y - p, p * (1 - p)

        for _ in range(rounds):
            for i, b in enumerate(bins):
                if len(self.tables[i]) < 2:
                    continue
                g, h = slopes()
                step = rate * self._tree(np.bincount(b, g, len(self.tables[i])), np.bincount(b, h, len(self.tables[i])))
                self.tables[i] += step
                margin += step[b]
        coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for c in x.T]
        cell = [np.searchsorted(c, x[:, i], "right") for i, c in enumerate(coarse)]

        def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            return np.bincount(cell[i] * shape[1] + cell[j], w, shape[0] * shape[1]).reshape(shape)

        g, h = slopes()
        ranked = sorted(((self._box(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
        self.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for _, i, j in ranked[:pairs]]
        for _ in range(pair_rounds):
            for i, j, _, _, table in self.pairs:
                g, h = slopes()
                step = rate * self._box(grid(i, j, g), grid(i, j, h))[1]
                table += step
                margin += step[cell[i], cell[j]]

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        for table, b in zip(self.tables, self._binned(x)):
            margin += table[b]
        for i, j, ci, cj, table in self.pairs:
            margin += table[np.searchsorted(ci, x[:, i], "right"), np.searchsorted(cj, x[:, j], "right")]
        return 1 / (1 + np.exp(-margin))


def _known(labels: DataFrame, sample: int) -> DataFrame:
    """labelled, quality of at most `sample` labelled rows outside the held-out fold: small enough to broadcast."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return usable.select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("labelled"), "labelled", "quality").limit(sample)


def fit(featured: DataFrame, known: DataFrame) -> Gam:
    rows = featured.join(F.broadcast(known), F.col("doc_id") == F.col("labelled")).select("quality", *FEATURES).toPandas()
    return Gam(rows[FEATURES].to_numpy(float), rows["quality"].to_numpy())


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs, by a model fitted on labels(doc_id, quality)."""
    featured = written(featurised(docs), "quality-features")
    model = fit(featured, _known(labels, sample))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "held_out": f["held_out"], "score": model.score(f[FEATURES].to_numpy(float))})

    out = featured.withColumn("held_out", held_out()).mapInPandas(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is at least the threshold, all columns as they were."""
    known = written(_known(labels, sample), "quality-labels")
    model = fit(featurised(docs.join(F.broadcast(known), docs["doc_id"].cast("long") == known["labelled"], "left_semi")), known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            keep = np.concatenate([model.score(features(data, offsets)) >= threshold for _, _, data, offsets in chunks(column)] or [np.zeros(0, bool)])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
