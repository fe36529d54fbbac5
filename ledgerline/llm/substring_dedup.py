"""Removal of repeated substrings with suffix arrays of shards.

A byte goes when a string of LENGTH bytes that covers it also starts anywhere else.  Equal strings must meet in one shard,
so every window of LENGTH bytes is assigned to an anchor that its content alone determines: the leftmost of its GRAM-byte
grams with the smallest hash.  Neighbouring windows share anchors, so a document becomes a few hundred regions a hundred
kilobytes, each known by its anchor's fingerprint; equal windows have equal anchors at equal places.  Regions whose anchor
occurs once in the corpus hold no repeat, and regions that are equal byte for byte are one string with a count.

Where an anchor has several different strings, their windows are split into spans of so many places before the anchor.  All
windows of a span share a core of bytes, so spans with different cores have no window in common; a core that only one
string has is done, and equal spans are one again.  The different spans of a core go to one shard, whose suffix array is
built by induced sorting; the permuted common prefixes tell which windows start elsewhere too.  A core that exceeds a shard
is split into shorter spans, down to single windows, which are all equal.  The flags return to all documents that hold the
string.

Passages.  Strings of LENGTH bytes miss repeats of fewer bytes that still are whole passages.  With `words` each text is told
the words that stand in passages of so many words that another document has too (passages.py); they are counted, not removed.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing; rows with the same doc_id are separate
documents; an empty table gives no rows.  Fingerprints have 64 bits (two strings share one with a chance of about 2**-60).
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import passages
from .store import brief_shuffles, drop, owned, written
from .suffix_array import repeated
from .textbytes import VALUES, buffers, chunks, fingerprints, mix, prefix_sums, ranges

LENGTH, GRAM = 400, 32
#: Windows of a span at each splitting (each a multiple of the next), and bytes of a shard (whole cores).
SPANS, SHARD_BYTES = (48, 12, 3, 1), 1 << 20

REGION_SCHEMA = "doc_id long, fp long, at int, windows int, lead int, anchor long, string long"
STRING_SCHEMA = "anchor long, string long, copies int, lead int, bytes binary"
PIECE_SCHEMA = f"{STRING_SCHEMA}, large boolean"
SPAN_SCHEMA = "anchor long, string long, copies int, lead int, first int, windows int, core long, span long"


def regions(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's distance from it, anchor fingerprint, string fingerprint) of the maximal runs
    of windows of a text that have the same anchor; positions count from the text's begin."""
    return passages.runs(prefix_sums(data, VALUES), offsets, length, gram)


def _regions(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                of, at, count, lead, anchor, string = regions(data, offsets, length, gram)
                pick = pa.array(of + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(2).take(pick), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(lead.astype(np.int32)), pa.array(anchor), pa.array(string)], ["doc_id", "fp", "at", "windows", "lead", "anchor", "string"])

    return docs.mapInArrow(run, REGION_SCHEMA)


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """anchor, string, copies, lead, bytes of the wanted regions of each text."""
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        want = batch.column(1)
        flat = want.flatten()
        starts = offsets[np.repeat(np.arange(len(want)), want.value_lengths().fill_null(0).to_numpy())]
        at, windows = flat.field("at").to_numpy(), flat.field("windows").to_numpy()
        begin = starts + at
        raw = [data[b : b + w - 1 + length].tobytes() for b, w in zip(begin.tolist(), windows.tolist())]
        for k in range(0, len(raw), 4096):  # one text can have very many regions
            part = flat.slice(k, 4096)
            yield pa.RecordBatch.from_arrays([*(part.field(c) for c in ("anchor", "string", "copies", "lead")), pa.array(raw[k : k + 4096], pa.binary())], ["anchor", "string", "copies", "lead", "bytes"])


def _spans(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """SPAN_SCHEMA for rows (anchor, string, copies, lead, bytes): the spans of each region, with the fingerprints of the
    core that all windows of a full span would share and of the span's own bytes."""
    for batch in batches:
        lead_, anchor_ = batch.column(3).to_numpy().astype(np.int64), batch.column(0).to_numpy()
        for row, end, data, offsets in chunks(batch.column(4)):
            lead, n = lead_[row:end], np.diff(offsets) - length + 1
            # window i stands lead - i before the anchor; span number q holds the distances q * size ... + size - 1
            high, low = lead // size, (lead - n + 1) // size
            pieces = high - low + 1
            of = np.repeat(np.arange(end - row), pieces)
            q = high[of] - ranges(np.zeros(end - row, np.int64), pieces)
            first = np.maximum(0, lead[of] - q * size - size + 1)
            last = np.minimum(n[of] - 1, lead[of] - q * size)
            sums, base = prefix_sums(data, VALUES), offsets[:-1][of]
            middle = base + lead[of] - q * size
            core = mix(fingerprints(sums, middle, middle - size + 1 + length) ^ mix(q.astype(np.uint64) ^ anchor_[row:end][of].view(np.uint64)))
            span = fingerprints(sums, base + first, base + last + length)
            pick = pa.array(of + row)
            numbers = [pa.array(x.astype(np.int32)) for x in (lead[of] - first, first, last - first + 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pick) for i in range(3)), *numbers, pa.array(core.view(np.int64)), pa.array(span.view(np.int64))], ["anchor", "string", "copies", "lead", "first", "windows", "core", "span"])


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """PIECE_SCHEMA, a row for each span, for rows (bytes, wanted spans)."""
    names = ["anchor", "string", "copies", "lead", "bytes", "large"]
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        want = batch.column(1)
        flat = want.flatten()
        begin = offsets[np.repeat(np.arange(len(want)), want.value_lengths().fill_null(0).to_numpy())] + flat.field("first").to_numpy()
        end = begin + flat.field("windows").to_numpy() - 1 + length
        for k in range(0, len(flat), 4096):
            raw = pa.array([data[b:e].tobytes() for b, e in zip(begin[k : k + 4096].tolist(), end[k : k + 4096].tolist())], pa.binary())
            part = flat.slice(k, 4096)
            yield pa.RecordBatch.from_arrays([*(part.field(c) for c in ("core", "span", "copies", "lead")), raw, part.field("large")], names)


def _sorted_shards(batches: Iterator[pa.RecordBatch], length: int, limit: int) -> Iterator[pa.RecordBatch]:
    """anchor, string, first, count of the runs of repeated windows of the single strings, for rows (anchor, string, copies,
    bytes) in the order of anchors, whose strings stay together."""
    held: list[tuple[int, int, int, bytes]] = []
    size, last = 0, None

    def flush() -> pa.RecordBatch:
        out = []
        for (anchor, string, copies, _), twice in zip(held, repeated([h[3] for h in held], length)):
            if copies == 1:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
                out += [(anchor, string, s, e - s) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "string", "first", "count"])

    for batch in batches:
        for anchor, string, copies, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if size >= limit and anchor != last:
                yield flush()
                size = 0
            held.append((anchor, string, copies, raw))
            size, last = size + len(raw), anchor
    if held:
        yield flush()


def _mixed(kinds: DataFrame, group: str, *more: Column) -> DataFrame:
    """The groups of several different strings of which one is single; in others the number of copies says all."""
    return kinds.groupBy(group).agg(F.count("*").alias("different"), F.min("copies").alias("least"), *more).where("different > 1 AND least = 1").drop("different", "least")


def _split(strings: DataFrame, length: int, spans: tuple[int, ...], shard: int) -> DataFrame:
    """anchor, string, first, count: the runs of repeated windows of the single ones of the stored strings (STRING_SCHEMA;
    copies: 1, or 2 for more)."""
    size = spans[0]
    parts = written(strings.mapInArrow(lambda it: _spans(it, length, size), SPAN_SCHEMA), "substring-spans")
    kinds = written(parts.groupBy("core", "span").agg(F.sum("copies").alias("copies"), F.min(F.struct("anchor", "string", "first", "windows", "lead")).alias("one")), "substring-kinds")
    cores = _mixed(kinds, "core", F.sum(F.col("one.windows") + length - 1).alias("n"))
    cores = written(cores.select("core", ((F.col("n") > shard) & F.lit(len(spans) > 1)).alias("large")), "substring-cores")
    wanted = kinds.join(cores, "core").select("core", "span", F.least("copies", F.lit(2)).cast("int").alias("copies"), "large", "one.*")
    by_string = written(wanted.groupBy("anchor", "string").agg(F.collect_list(F.struct("first", "windows", "lead", "core", "span", "copies", "large")).alias("want")), "substring-by-string")
    pieces = written(strings.join(by_string, ["anchor", "string"]).select("bytes", "want").mapInArrow(lambda it: _cut_out(it, length), PIECE_SCHEMA), "substring-pieces")
    near = pieces.where("NOT large").select("anchor", "string", "copies", "bytes").repartition("anchor").sortWithinPartitions("anchor", "string")
    found = near.mapInArrow(lambda it: _sorted_shards(it, length, shard), "anchor long, string long, first int, count int")
    large = pieces.where("large").drop("large")
    if large.limit(1).count():
        found = found.unionAll(_split(large, length, spans[1:], shard))
    equal = kinds.where("copies > 1").select("core", "span", F.lit(0).alias("first"), F.col("one.windows").alias("count"))
    inner = written(found.unionAll(equal).toDF("core", "span", "inside", "count"), "substring-inner")
    return parts.where("copies = 1").select("anchor", "string", "first", "core", "span").join(inner, ["core", "span"]).select("anchor", "string", (F.col("first") + F.col("inside")).alias("first"), "count")


def _marks(docs: DataFrame, length: int, gram: int, spans: tuple[int, ...], shard: int) -> DataFrame:
    """doc_id, fp, runs (first window, windows) of the repeated windows of each text that has any.  Tables are deleted when what goes on from
    them is stored."""
    spark, work = docs.sparkSession, f"substring {uuid4().hex}"
    with owned(work):
        all_ = written(_regions(docs, length, gram), "substring-regions")
        often = written(all_.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "substring-anchors")
    shared = written(all_.join(often, "anchor"), "substring-shared")
    drop(spark, work)
    with owned(work):
        found = _repeats(docs, shared, length, spans, shard)
    flags = written(found, "substring-flags")
    drop(spark, work)
    return shared.select("doc_id", "fp", "at", "anchor", "string").join(flags, ["anchor", "string"]).groupBy("doc_id", "fp").agg(F.collect_list(F.struct((F.col("at") + F.col("first")).alias("first"), "count")).alias("runs"))


def _repeats(docs: DataFrame, shared: DataFrame, length: int, spans: tuple[int, ...], shard: int) -> DataFrame:
    """anchor, string, first, count: the runs of repeated windows of the strings of the stored regions."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "fp", "at", "windows", "lead"))
    kinds = written(shared.groupBy("anchor", "string").agg(F.least(F.count("*"), F.lit(2)).cast("int").alias("copies"), one.alias("one")), "substring-strings")
    whole = kinds.where("copies > 1").select("anchor", "string", F.lit(0).alias("first"), F.col("one.windows").alias("count"))
    # the bytes of the strings of mixed anchors, once each
    want = kinds.join(written(_mixed(kinds, "anchor"), "substring-mixed"), "anchor").select("anchor", "string", "copies", "one.*")
    by_doc = written(want.groupBy("doc_id", "fp").agg(F.collect_list(F.struct("at", "windows", "anchor", "string", "copies", "lead")).alias("want")), "substring-wanted")
    same = docs["doc_id"].eqNullSafe(by_doc["doc_id"]) & (docs["fp"] == by_doc["fp"])
    strings = docs.join(by_doc, same).select("text", "want").mapInArrow(lambda it: _strings(it, length), STRING_SCHEMA)
    if docs.groupBy("doc_id", "fp").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        strings = strings.dropDuplicates(["anchor", "string"])  # rows with the same id and text bring them each
    return whole.unionAll(_split(written(strings, "substring-texts"), length, spans, shard))


def _cut(text: bytes, runs: list[dict] | None, length: int) -> tuple[bytes, int, int]:
    """(what stays, bytes removed, maximal removed runs)."""
    if not runs:
        return text, 0, 0
    marks = np.zeros(len(text) + 1, np.int64)
    first = np.array([r["first"] for r in runs])
    np.add.at(marks, first, 1)
    np.add.at(marks, first + np.array([r["count"] for r in runs]) - 1 + length, -1)
    gone = np.cumsum(marks)[:-1] > 0
    raw = np.frombuffer(text, np.uint8)
    return raw[~gone].tobytes(), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) > 0).sum())


def _ready(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("fp"), *more)


def _covered(found: pa.Array, length: int) -> np.ndarray:
    """Items of each text in any of its runs (first window, windows) of windows of so many items."""
    flat, of = found.flatten(), np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy())
    first = flat.field("first").to_numpy() + (of << 40)  # texts one behind the other
    last = first + flat.field("count").to_numpy() - 1 + length
    order = np.argsort(first)
    first, last, of = first[order], last[order], of[order]
    before = np.append(0, np.maximum.accumulate(last)[:-1]) if len(last) else last
    return np.bincount(of, np.maximum(last - np.maximum(first, before), 0), len(found)).astype(np.int64)


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, spans: tuple[int, ...] = SPANS, shard: int = SHARD_BYTES, words: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) for every row of docs(doc_id, text); with `words` also
    n_passage_words: its words in passages of so many words that stand in another document."""
    ready = _ready(docs)
    with brief_shuffles(docs.sparkSession):
        runs = _marks(ready, length, gram, spans, shard)
        more = passages.repeated(ready, words) if words else None
    runs = runs.select(F.col("doc_id").alias("run_id"), F.col("fp").alias("run_fp"), "runs")
    if words:
        runs = runs.join(more, runs["run_id"].eqNullSafe(more["doc_id"]) & (runs["run_fp"] == more["fp"]), "full")
        runs = runs.select(F.coalesce("run_id", "doc_id").alias("run_id"), F.coalesce("run_fp", "fp").alias("run_fp"), "runs", "passages")
    both = ready.join(runs, F.col("doc_id").eqNullSafe(F.col("run_id")) & (F.col("fp") == F.col("run_fp")), "left").select("doc_id", "text", "runs", *["passages"] * bool(words))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                raw = [x.encode() for x in part.column(1).to_pylist()]
                out = [_cut(x, r, length) for x, r in zip(raw, part.column(2).to_pylist())]
                columns = [part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[0] for o in out], pa.binary())]
                if words:
                    columns.append(pa.array(_covered(part.column(3), words)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_passage_words"][: len(columns)])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary" + ", n_passage_words long" * bool(words))


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `words` also n_passage_words."""
    out = deduplicated(docs, **options)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), *(c for c in out.columns if c == "n_passage_words"))
