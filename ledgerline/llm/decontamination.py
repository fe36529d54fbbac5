"""Benchmark decontamination over a distributed positional inverted index.

The index is split by documents: each task indexes the texts it reads, in shards of a few megabytes, and stores for every
term of a shard the sorted list of its positions.  Every word of every text is indexed, nothing is shuffled and no term
has a list outside its shard, so a passage or a word that a third of all texts share lengthens many short lists and no
long one.  A search sends the benchmark's phrases (in blocks of bounded size) to all shards; in a shard the phrases that
lack a term fall out at once, and the others intersect the offset-adjusted position lists of their terms, rarest first.
With `slop` > 0 the words may stand up to so many positions further apart, in order (proximity instead of phrase).

Words are runs of digits, letters and non-ASCII characters in text with A-Z lower-cased; they are held as 64-bit
fingerprints (two words share one with a chance of about 2**-60).

Defined results: null or empty texts have no words, no hits and no items; rows with the same doc_id are separate
documents; benchmark rows with the same item_id are one item, a null item_id counts as an item named "null"; items
without words match nothing; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .textbytes import LOWER_VALUES, chunks, fingerprints, owners, prefix_sums, word_bounds

WINDOW = 10
#: Benchmark words that are searched for in one pass (about 100 bytes each in every task); a larger benchmark takes more passes.
BLOCK_WORDS = 500_000

INDEX_SCHEMA = "part int, shard int, doc_ids binary, null_ids binary, n_words binary, terms binary, counts binary, steps binary"
HIT_SCHEMA = "part int, shard int, nth int, doc_id long, n_words long, hits array<int>, items array<string>"


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word fingerprints, first word of each row) by chunks."""
    for row, end, data, offsets in chunks(column):
        start, stop, first = word_bounds(data, offsets)
        yield row, end, fingerprints(prefix_sums(data, LOWER_VALUES), start, stop), first


def _shard(ids: pa.Array, words: np.ndarray, first: np.ndarray) -> dict[str, bytes]:
    """The binary fields of one shard."""
    order = np.argsort(words, kind="stable")
    position = (order + owners(first)[order]).astype(np.int32)
    terms, counts = np.unique(words, return_counts=True)
    fields = {
        "doc_ids": ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), "null_ids": ids.is_null().to_numpy(zero_copy_only=False), "n_words": np.diff(first).astype(np.int32),
        "terms": terms, "counts": counts.astype(np.int32), "steps": np.diff(position, prepend=np.int32(0)).astype(np.int32),
    }
    return {k: x.tobytes() for k, x in fields.items()}


def build_index(docs: DataFrame) -> DataFrame:
    """INDEX_SCHEMA: a row is a shard.  Word k of the shard's i-th document stands at position k + i (one position stays
    empty between documents, so no phrase crosses them); the lists of the sorted terms follow one another as steps."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, end, words, first in _words(batch.column(1)):
                fields = _shard(batch.column(0).slice(row, end - row), words, first)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), *(pa.array([x], pa.binary()) for x in fields.values())], ["part", "shard", *fields])
                number += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(index, INDEX_SCHEMA)


class Phrases:
    """The windows of a block of items: words as numbers in `terms`, -1 beyond a short window's end."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        names, texts = [str(i) if i is not None else "null" for i, _ in items], pa.array([t for _, t in items], pa.string())
        rows, owner = [], []
        for row, end, words, first in _words(texts):
            for i in range(end - row):
                own = words[first[i] : first[i + 1]]
                if not len(own):
                    continue
                size = min(window, len(own))
                got = np.lib.stride_tricks.sliding_window_view(own, size)
                wide = np.zeros((len(got), window), np.uint64)
                wide[:, :size] = got
                rows.append((wide, np.full(len(got), size)))
                owner.append(np.full(len(got), row + i))
        words = np.concatenate([r for r, _ in rows]) if rows else np.zeros((0, window), np.uint64)
        self.size = np.concatenate([s for _, s in rows]) if rows else np.zeros(0, np.int64)
        self.owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        used = np.arange(window) < self.size[:, None]
        self.terms, flat = np.unique(words[used], return_inverse=True)
        self.words = np.full(words.shape, -1)
        self.words[used] = flat
        self.names = names


def _blocks(benchmark: DataFrame, window: int, limit: int) -> Iterator[Phrases]:
    held, n = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        held.append((row[0], row[1]))
        n += len((row[1] or "").split())
        if n >= limit:
            yield Phrases(held, window)
            held, n = [], 0
    if held:
        yield Phrases(held, window)


def _near(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values of `wanted` are in the sorted `places`."""
    at = np.searchsorted(places, wanted)
    at[at == len(places)] = 0
    return places[at] == wanted


def _matches(lists: list[np.ndarray], slop: int, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the words of one window, (first, last + 1) of spans that together cover each occurrence; lists[k]: sorted positions of
    word k; base: the position of each document's first word."""
    by_rarity = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    if not slop:
        start = lists[by_rarity[0]] - by_rarity[0]
        for k in by_rarity[1:]:
            start = start[_near(lists[k], start + k)]
            if not len(start):
                break
        return start, start + len(lists)
    # in order, each word at most slop + 1 positions after the one before, in one document; the rarest word's neighbourhood
    # bounds the rest.  A word's position is reachable if the places before it hold a reachable one of the word before.
    reach = (slop + 1) * len(lists)
    around = lists[by_rarity[0]]
    near = [p[np.searchsorted(around, p - reach) < np.searchsorted(around, p + reach, "right")] for p in lists]

    def from_(p: np.ndarray) -> np.ndarray:
        return np.maximum(p - slop - 1, base[np.searchsorted(base, p, "right") - 1])

    held = [near[0]]
    for p in near[1:]:
        held.append(p[np.searchsorted(held[-1], from_(p)) < np.searchsorted(held[-1], p)])
    # back from the last word: of word k, what leads on to a position of word k + 1 that leads to an end
    spans = [(held[-1], held[-1] + 1)]
    for k in range(len(lists) - 2, -1, -1):
        after, low = held[k + 1], from_(held[k + 1])
        spans.append((held[k][np.searchsorted(held[k], low)], after + 1))
        # +1 where the reach of an `after` begins, -1 where it ends: which positions lie in any of them
        opened, closed = np.sort(low), after
        held[k] = held[k][np.searchsorted(opened, held[k], "right") > np.searchsorted(closed, held[k], "right")]
    return np.concatenate([a for a, _ in spans]), np.concatenate([b for _, b in spans])


def _search_shard(row: dict, phrases: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(ids, null flags, words of the shard's documents, per document its hit words and item numbers)."""
    terms, counts = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.int32)
    places = np.cumsum(np.frombuffer(row["steps"], np.int32), dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(counts)])
    n_words = np.frombuffer(row["n_words"], np.int32).astype(np.int64)
    base = np.cumsum(n_words) - n_words + np.arange(len(n_words))  # position of each document's first word
    found: dict[int, tuple[list, set]] = {}
    if len(terms) and len(phrases.terms):
        at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
        there = np.append(terms[at] == phrases.terms, True)  # the last stands for the -1 of short windows
        marks = np.zeros(int(base[-1] + n_words[-1]) + 2, np.int32)
        pairs = []
        for w in np.flatnonzero(there[phrases.words].all(axis=1)).tolist():
            own = at[phrases.words[w, : phrases.size[w]]]
            first, last = _matches([places[begin[t] : begin[t + 1]] for t in own], slop, base)
            if len(first):
                doc = np.searchsorted(base, first, "right") - 1
                same = doc == np.searchsorted(base, last - 1, "right") - 1
                np.add.at(marks, first[same], 1)
                np.add.at(marks, last[same], -1)
                pairs.append((np.unique(doc[same]), int(phrases.owner[w])))
        hit = np.flatnonzero(np.cumsum(marks) > 0)
        of = np.searchsorted(base, hit, "right") - 1
        inside = hit - base[of] < n_words[of] if len(hit) else np.zeros(0, bool)
        hit, of = hit[inside], of[inside]
        docs, first = np.unique(of, return_index=True)  # hits are in order, so those of a document stand together
        for doc, s, e in zip(docs.tolist(), first, [*first[1:], len(of)]):
            found[doc] = ((hit[s:e] - base[doc]).tolist(), set())
        for docs_, item in pairs:
            for doc in docs_.tolist():
                found[doc][1].add(phrases.names[item])
    per_doc = [found.get(i, ((), ())) for i in range(len(n_words))]
    return np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["null_ids"], bool), n_words, per_doc


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """index: stored rows of build_index().  HIT_SCHEMA: every document with its hit words (their numbers in the text) and the items whose windows occur."""

    def one(phrases: Phrases) -> DataFrame:
        sent = index.sparkSession.sparkContext.broadcast(phrases)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                    ids, null, n_words, per_doc = _search_shard(row, sent.value, slop)
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, mask=null), pa.array(n_words), pa.array([h for h, _ in per_doc], pa.list_(pa.int32())), pa.array([sorted(s) for _, s in per_doc], pa.list_(pa.string()))],
                        ["part", "shard", "nth", "doc_id", "n_words", "hits", "items"],
                    )

        return index.mapInArrow(run, HIT_SCHEMA)

    passes = [one(p) for p in _blocks(benchmark, window, block_words)] or [one(Phrases([], window))]
    if len(passes) == 1:
        return passes[0]
    out = passes[0]
    for more in passes[1:]:
        out = out.unionAll(more)
    merged = out.groupBy("part", "shard", "nth").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return merged


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, for every row of docs."""
    hits = search(written(build_index(docs), "positional-index"), benchmark, window)
    n_hit = F.size("hits").cast("long")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in which no window of an item occurs, all columns as they were.  A task indexes each chunk of its
    texts, searches the shard and passes on the clean rows, so the texts are neither shuffled nor joined back."""
    for phrases in _blocks(benchmark, window, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, keep = batch.schema.names, []
                for row, end, words, first in _words(batch.column(names.index("text"))):
                    _, _, _, per_doc = _search_shard(_shard(pa.nulls(end - row, pa.int64()), words, first), sent.value, 0)
                    keep += [not len(hits) for hits, _ in per_doc]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
