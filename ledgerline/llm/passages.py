"""Passages of so many words that stand in several documents, whatever their case and what stands between the words.

Every window of WORDS consecutive words is assigned to an anchor that its words alone determine: the leftmost of its runs of
GRAM words with the smallest hash.  Neighbouring windows share anchors and become one region; regions whose anchor occurs once
in the corpus hold no repeat.  Regions of equal words are one string with a count of documents; where an anchor has several
different strings their windows are compared one by one, dealt by the fingerprint of their words.

Defined results: rows with the same doc_id are separate documents; a window that returns only within its own document is no
passage; null texts and texts of fewer words hold none.  Fingerprints have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, owned, written
from .textbytes import LOWER_VALUES, chunks, fingerprints, mix, owners, powers, prefix_sums, ranges, word_bounds

WORDS, GRAM = 50, 12

REGION_SCHEMA = "doc_id long, fp long, first int, windows int, anchor long, string long, again boolean"
WINDOW_SCHEMA = "anchor long, string long, copies int, doc long, first int, window long"


def runs(sums: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's distance from it, anchor fingerprint, string fingerprint) of the maximal runs
    of windows of `length` items of a text that have the same anchor; positions count from the text's begin.  sums: of the
    items, as prefix_sums gives them."""
    n, span = len(sums) - 1, length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return (none,) * 6
    at = np.arange(n - gram + 1)
    grams = fingerprints(sums, at, at + gram)
    key = (grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    # the least key of each run of `span` grams: of blocks' suffixes and prefixes
    wide = np.full(-(-len(key) // span) * span, np.uint64((1 << 64) - 1))
    wide[: len(key)] = key
    blocks = wide.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    start = ranges(offsets[:-1], windows)
    if not len(start):
        return (none,) * 6
    of = np.repeat(np.arange(len(windows)), windows)
    least = np.minimum(behind[start], ahead[start + span - 1])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    return of[first], begin - offsets[of[first]], count, anchor[first] - begin, grams[anchor[first]].view(np.int64), fingerprints(sums, begin, begin + count - 1 + length).view(np.int64)


def word_sums(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums over the words, first word of each text)."""
    start, end, first = word_bounds(data, offsets)
    out = np.zeros(len(start) + 1, np.uint64)
    np.cumsum(fingerprints(prefix_sums(data, LOWER_VALUES), start, end) * powers(len(start)), out=out[1:])
    return out, first


def _regions(docs: DataFrame, words: int, gram: int) -> DataFrame:
    """REGION_SCHEMA; again: an earlier region of the text has the same string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                of, at, count, _, anchor, string = runs(*word_sums(data, offsets), words, gram)
                again = np.ones(len(of), bool)
                again[np.unique(mix(string.view(np.uint64) ^ mix(of.astype(np.uint64))), return_index=True)[1]] = False
                pick = pa.array(of + row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(2).take(pick), pa.array(at.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(anchor), pa.array(string), pa.array(again)], ["doc_id", "fp", "first", "windows", "anchor", "string", "again"])

    return docs.mapInArrow(run, REGION_SCHEMA)


def _windows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """WINDOW_SCHEMA for rows (doc, text, wanted regions)."""
    for batch in batches:
        doc, want = batch.column(0).to_numpy(), batch.column(2)
        flat, many = want.flatten(), np.append(0, np.cumsum(want.value_lengths().fill_null(0).to_numpy()))
        for row, end, data, offsets in chunks(batch.column(1)):
            sums, first = word_sums(data, offsets)
            part = flat.slice(int(many[row]), int(many[end] - many[row]))
            of = owners(many[row : end + 1])
            at, n = part.field("first").to_numpy().astype(np.int64), part.field("windows").to_numpy().astype(np.int64)
            inside = ranges(np.zeros(len(n), np.int64), n)
            begin = np.repeat(first[of] + at, n) + inside
            pick = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays([*(part.field(c).take(pick) for c in ("anchor", "string", "copies")), pa.array(doc[row + np.repeat(of, n)]), pa.array(inside.astype(np.int32)), pa.array(fingerprints(sums, begin, begin + words).view(np.int64))], ["anchor", "string", "copies", "doc", "first", "window"])


def repeated(docs: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """doc_id, fp, passages (first window, windows) of the texts of docs(doc_id, text, fp) that hold any.  Tables are deleted when what
    goes on from them is stored."""
    spark, work = docs.sparkSession, f"passages {uuid4().hex}"
    with owned(work):
        all_ = written(_regions(docs, words, gram), "passage-regions")
        often = written(all_.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "passage-anchors")
    shared = written(all_.join(often, "anchor"), "passage-shared")
    drop(spark, work)
    with owned(work):
        found = _repeats(docs, shared, words)
    flags = written(found.groupBy("anchor", "string").agg(F.collect_list(F.struct("first", "count")).alias("flags")), "passage-flags")
    drop(spark, work)
    back = shared.select("doc_id", "fp", F.col("first").alias("begin"), "anchor", "string").join(flags, ["anchor", "string"])
    return back.groupBy("doc_id", "fp").agg(F.flatten(F.collect_list(F.transform("flags", lambda x: F.struct((F.col("begin") + x["first"]).alias("first"), x["count"].alias("count"))))).alias("passages"))


def _repeats(docs: DataFrame, shared: DataFrame, words: int) -> DataFrame:
    """anchor, string, first, count: the runs of windows of the strings of the stored regions that stand in several documents."""
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "fp", "first", "windows"))
    kinds = shared.groupBy("anchor", "string").agg(F.least(F.sum((~F.col("again")).cast("int")), F.lit(2)).cast("int").alias("copies"), one.alias("one"))
    kinds = written(kinds.withColumn("doc", F.xxhash64("one.doc_id", "one.fp")), "passage-strings")
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("different"), F.min("copies").alias("least"), F.max("copies").alias("most"), F.min("doc").alias("low"), F.max("doc").alias("high"))
    mixed = written(mixed.where("different > 1 AND least = 1 AND (most > 1 OR low <> high)").select("anchor"), "passage-mixed")
    want = kinds.join(mixed, "anchor").select("anchor", "string", "copies", "one.*")
    by_doc = written(want.groupBy("doc_id", "fp").agg(F.collect_list(F.struct("first", "windows", "anchor", "string", "copies")).alias("want")), "passage-wanted")
    same = docs["doc_id"].eqNullSafe(by_doc["doc_id"]) & (docs["fp"] == by_doc["fp"])
    texts = docs.join(by_doc, same).select(F.xxhash64(docs["doc_id"], docs["fp"]).alias("doc"), "text", "want")
    windows = written(texts.mapInArrow(lambda it: _windows(it, words), WINDOW_SCHEMA), "passage-windows")
    twice = windows.groupBy("window").agg(F.max("copies").alias("most"), F.min("doc").alias("low"), F.max("doc").alias("high")).where("most > 1 OR low <> high").select("window")
    found = windows.where("copies = 1").join(written(twice, "passage-twice"), "window").select("anchor", "string", "first", F.lit(1).alias("count"))
    whole = kinds.where("copies > 1").select("anchor", "string", F.lit(0).alias("first"), F.col("one.windows").alias("count"))
    return whole.unionAll(found)
