"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Evidence.  A token is a word of the text (A-Z lower-cased); its features are the word and its beginnings of PREFIXES bytes.  Of
a bounded sample of labelled rows each feature gets the number of toxic and of other texts that hold it.  A Dirichlet prior of
weight PRIOR smooths the two counts; it is centred on the shares of the next shorter feature, and for the shortest on the
share of toxic texts.  A feature weighs what the next shorter one weighs (0 without one), moved into ERRORS standard errors
around its own log-odds against that share: so a longer word of a toxic beginning keeps its weight.  A token weighs what
its longest feature known from MIN_TEXTS texts weighs, so unseen words take the weight of their beginning, and what nothing
is known of weighs nothing.

Passages.  A token scores its weight less DRIFT.  A linear-time scan finds all maximal scoring segments of a text: runs of
tokens whose score no longer or shorter run within them betters.  Only tokens of positive score can begin or end one, so the
scan steps from one to the next.

Calibration.  On texts that are not toxic the best segment of n tokens exceeds x with probability 1 - exp(-K n exp(-rate x));
rate and K have the greatest likelihood for the best segments of those texts (of a text without one it is known that none
exceeds 0) and a faint prior.  A segment of score x has the evidence rate * x - ln(K n): it is significant if that is
positive.  A text has the root of the sum of their squares, in which many faint segments, as long texts have, do not
outweigh a strong one.
A logistic curve over the logarithm of that evidence, fitted to the counts of labelled texts in bins, gives the score.

All texts are scored whole in one pass without a shuffle.  What is fitted is bounded: SAMPLE labelled rows, FEATURES features
(those found in most texts), two numbers of the null distribution and two of the curve.

Defined results: null texts count as empty and are scored; labels that are null or whose document is absent are not used;
rows of one id are separate texts; with labels of one class, or none, every score is the class's share (0 without labels); a
null doc_id is in no fold.  Very long texts are worked on whole.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import LOWER_VALUES, chunks, fingerprints, mix, owners, prefix_sums, word_bounds

#: Labelled rows used to fit, and features that the model keeps.
SAMPLE, FEATURES = 40_000, 1 << 18
PREFIXES = (4, 5, 6, 7, 8, 10)
MIN_TEXTS, PRIOR, ERRORS = 3, 16.0, 2.0
DRIFT = 0.4
THRESHOLD = 0.7
#: Segments of a text, the best ones, whose evidence is put together; more add nothing to a text that has so many.
MOST = 64
_BIN = 0.05


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def _levels(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length or 0 for whole words, tokens that have the feature, its fingerprint), from words to the shortest beginnings."""
    sums = prefix_sums(data, LOWER_VALUES)
    yield 0, np.arange(len(start)), fingerprints(sums, start, end)
    for n in reversed(PREFIXES):
        some = np.flatnonzero(end - start > n)
        yield n, some, mix(fingerprints(sums, start[some], start[some] + n) + np.uint64(n))


class Model:
    """Weights by fingerprint, the two numbers of the null distribution, the two of the curve."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.rate, self.log_k = 1.0, 0.0
        self.curve = (0.0, 0.0)

    def token_scores(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, known = np.zeros(len(start)), np.zeros(len(start), bool)
        if len(self.keys):
            for _, some, key in _levels(data, start, end):
                new = ~known[some]
                some, key = some[new], key[new]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                out[some[hit]], known[some[hit]] = self.weights[at[hit]], True
        return out - DRIFT

    def evidence(self, scores: list[float], tokens: int) -> float:
        """Root of the sum of squares of the evidence of the best segments; 0 without a significant one."""
        base = self.log_k + math.log(max(tokens, 1))
        return math.sqrt(sum(max(self.rate * x - base, 0.0) ** 2 for x in sorted(scores, reverse=True)[:MOST]))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a + b * np.log1p(evidence))))


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """(score, first token, end) of all maximal scoring segments of a sequence of scores, in order.

    Candidates are kept with the sums before and after them.  A new one looks for the nearest candidate that begins lower; if
    that one also ends lower the two are joined, with all between them, and the search goes on from there."""
    sums = np.cumsum(scores)
    before: list[float] = []
    after: list[float] = []
    span: list[tuple[int, int]] = []
    link: list[int] = []  # the nearest earlier candidate that begins lower
    for i in np.flatnonzero(scores > 0).tolist():
        right = float(sums[i])
        left, first = right - float(scores[i]), i
        j = len(before) - 1
        while True:
            while j >= 0 and before[j] >= left:
                j = link[j]
            if j < 0 or after[j] >= right:
                break
            left, first = before[j], span[j][0]
            del before[j:], after[j:], span[j:]
            j = link[j]
            del link[len(before) :]
        before.append(left)
        after.append(right)
        span.append((first, i + 1))
        link.append(j)
    return [(r - l, s, e) for l, r, (s, e) in zip(before, after, span)]


def _known(labels: DataFrame, sample: int) -> DataFrame:
    """labelled, toxic of at most `sample` labelled rows outside the held-out fold: small enough to broadcast."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return usable.select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("labelled"), "labelled", "toxic").limit(sample)


def _counted(sample: DataFrame) -> DataFrame:
    """key, parent (of the next shorter feature, 0 without one), level, toxic, other: texts of sample(toxic, text) that hold
    each feature; a task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            keys, parents, levels, marks = [], [], [], []
            for row, end, data, offsets in chunks(batch.column(1)):
                s, e, first = word_bounds(data, offsets)
                own = owners(first)
                shorter = np.zeros(len(s), np.uint64)  # of each token, the feature below the one at hand
                for n, some, key in [*_levels(data, s, e)][::-1]:
                    _, at = np.unique(mix(key + mix(own[some].astype(np.uint64))), return_index=True)  # once a text
                    keys.append(key[at])
                    parents.append(shorter[some[at]])
                    levels.append(np.full(len(at), n or 255, np.int32))
                    marks.append(y[row + own[some[at]]])
                    shorter[some] = key
            if keys and sum(map(len, keys)):
                key, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
                toxic = np.bincount(at, np.concatenate(marks), len(key)).astype(np.int64)
                n = np.bincount(at, minlength=len(key))
                parent, level = np.concatenate(parents)[first], np.concatenate(levels)[first]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(parent.view(np.int64)), pa.array(level), pa.array(toxic), pa.array(n - toxic)], ["key", "parent", "level", "toxic", "other"])

    counted = sample.select("toxic", "text").mapInArrow(run, "key long, parent long, level int, toxic long, other long").groupBy("key")
    return counted.agg(F.first("parent").alias("parent"), F.first("level").alias("level"), F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _weights(found: pd.DataFrame, share: float, prior: float, errors: float) -> np.ndarray:
    """Weight of each feature: its parent's (0 without one), moved into so many standard errors around the log-odds of its
    own counts, which are smoothed towards its parent's shares."""
    keys, parents = found["key"].to_numpy(), found["parent"].to_numpy()
    order = np.argsort(keys)
    at = order[np.minimum(np.searchsorted(keys, parents, sorter=order), len(keys) - 1)]
    known = keys[at] == parents
    # the share of other texts is kept beside that of toxic ones: down a chain of pure features it falls below what 1 - share tells
    out, rest, weight = np.full(len(keys), share), np.full(len(keys), 1 - share), np.zeros(len(keys))
    toxic, other = found["toxic"].to_numpy(float), found["other"].to_numpy(float)
    for level in sorted(found["level"].unique()):
        here = np.flatnonzero(found["level"].to_numpy() == level)
        above = [np.where(known[here], x[at[here]], y) for x, y in ((out, share), (rest, 1 - share), (weight, 0.0))]
        t, c = toxic[here] + prior * above[0], other[here] + prior * above[1]
        out[here], rest[here] = t / (t + c), c / (t + c)
        odds, wide = np.log(t / c) - math.log(share / (1 - share)), errors * np.sqrt(1 / t + 1 / c)
        weight[here] = np.clip(above[2], odds - wide, odds + wide)
    return weight


def _scanned(data: np.ndarray, offsets: np.ndarray, model: Model) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, token scores, starts, ends) of each text of a chunk."""
    s, e, first = word_bounds(data, offsets)
    scores = model.token_scores(data, s, e)
    for i in range(len(offsets) - 1):
        part = slice(first[i], first[i + 1])
        yield i, scores[part], s[part], e[part]


def _null_parts(sample: DataFrame, model: Model) -> DataFrame:
    """place, n, tokens: bins of the score of the best segment (place; 0 without one) of texts that are not toxic, with their
    texts and the tokens of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                for _, scores, _, _ in _scanned(data, offsets, model):
                    if len(scores):
                        place = math.floor(max((x for x, _, _ in segments(scores)), default=0.0) / _BIN + 0.5)
                        texts, tokens = best.get(place, (0, 0))
                        best[place] = (texts + 1, tokens + len(scores))
        yield pa.RecordBatch.from_pylist([{"place": k, "n": n, "tokens": t} for k, (n, t) in best.items()], schema=pa.schema([("place", pa.int64()), ("n", pa.int64()), ("tokens", pa.int64())]))

    return sample.where("toxic = 0").select("text").mapInArrow(run, "place long, n long, tokens long").groupBy("place").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))


def _null(rows: list) -> tuple[float, float]:
    """(rate, ln K) of the greatest likelihood for the bins of _null_parts and half a text that exceeds 0 by no more than
    DRIFT, which alone decides if no text does; rate by halving, within 0.05 and 5."""
    score, n, tokens = (np.array([r[k] for r in rows], float) for k in ("place", "n", "tokens"))
    score *= _BIN
    texts, total = n[score > 0].sum() + 0.5, (n * score).sum() + 0.5 * DRIFT
    if not len(rows):
        return 1.0, 0.0
    low, high = 0.05, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        tail = tokens * np.exp(-mid * score)
        low, high = (mid, high) if texts / mid + texts * (tail * score).sum() / tail.sum() > total else (low, mid)
    rate = (low + high) / 2
    return rate, math.log(texts / (tokens * np.exp(-rate * score)).sum())


def _evidence(frame: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """carry, tokens, passages, evidence of every row of frame(text, carry)."""
    types = dict(frame.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(len(carry))):
                n, out = np.zeros((2, end - row), np.int64), np.zeros(end - row)
                for i, scores, _, _ in _scanned(data, offsets, model):
                    found = [x for x, _, _ in segments(scores)]
                    base = model.log_k + math.log(max(len(scores), 1))
                    n[0, i], n[1, i], out[i] = len(scores), sum(model.rate * x > base for x in found), model.evidence(found, len(scores))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(row, end - row) for k in range(len(carry))), pa.array(n[0]), pa.array(n[1]), pa.array(out)], [*carry, "tokens", "passages", "evidence"])

    return frame.select(*carry, "text").mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in carry), "tokens long, passages long, evidence double"]))


def _curve(bins: list[tuple[float, int, int]], penalty: float = 0.01) -> tuple[float, float]:
    """Logistic intercept and slope over log1p(evidence) from (evidence, toxic texts, other texts), by Newton steps."""
    x, t, c = (np.array(v, float) for v in zip(*bins))
    design = np.stack([np.ones(len(x)), np.log1p(x)])
    beta = np.array([math.log((t.sum() + 0.5) / (c.sum() + 0.5)), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(beta @ design)))
        slope = design @ (t - (t + c) * p) - penalty * beta * [0, 1]
        curved = (design * ((t + c) * p * (1 - p))) @ design.T + np.diag([1e-9, penalty])
        step = np.linalg.solve(curved, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels(doc_id, toxic) over docs(doc_id, text)."""
    known = written(_known(labels, sample), "toxic-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), F.col("doc_id") == F.col("labelled")).select("toxic", "text")
    rows = written(rows, "toxic-sample")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        model = Model(np.zeros(0, np.uint64), np.zeros(0))
        model.curve = (40.0 if toxic else -40.0, 0.0)
        return model
    share = toxic / (toxic + other)
    counted = _counted(rows).where(F.col("toxic") + F.col("other") >= MIN_TEXTS)
    found = counted.orderBy((F.col("toxic") + F.col("other")).desc(), "key").limit(FEATURES).toPandas()
    model = Model(found["key"].to_numpy(np.int64).view(np.uint64), _weights(found, share, PRIOR, ERRORS))
    model.rate, model.log_k = _null(_null_parts(rows, model).collect())
    graded = _evidence(rows, model, ["toxic"]).groupBy(F.round(F.log1p("evidence"), 1).alias("x")).agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    model.curve = _curve([(math.expm1(r["x"]), r["t"], r["c"]) for r in graded.collect()])
    return model


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, tokens, passages of every row of docs, by a model fitted on labels."""
    model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    a, b = model.curve
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log1p("evidence"))))
    out = _evidence(rows, model, ["doc_id", "held_out"]).withColumn("score", score)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "tokens", "passages")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, start, end (code points, end exclusive), score, evidence of every significant passage of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                out: list[tuple] = []
                for i, scores, s, e in _scanned(data, offsets, model):
                    base = model.log_k + math.log(max(len(scores), 1))
                    out += [(row + i, int(place[s[a]] - place[offsets[i]]), int(place[e[b - 1]] - place[offsets[i]]), x, model.rate * x - base) for x, a, b in segments(scores) if model.rate * x > base]
                if out:
                    at, *rest = zip(*out)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *map(pa.array, rest)], ["doc_id", "start", "end", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, `end` long, score double, evidence double")
