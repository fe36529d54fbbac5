"""Packing by concatenating and cutting.

All documents are laid end to end in the order of the input's partitions and the stream is cut every `size` ids.  Two
passes give each document its place without moving a text: the first tokenises each partition once, stores the ids with
their place inside the partition, and a prefix sum over the partitions' token totals (one number a partition) gives the
global offsets; the second cuts each document at the window boundaries it crosses.  No shuffle of documents, and no
group: a document of any length is split into as many boundary records as it needs.

Defined results: a null text is an empty one (its end id alone); an empty table gives no piece; rows with the same
doc_id are separate documents; a null doc_id stays null; further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written
from .textbytes import chunks, owners, ranges
from .tokens import encoder, tokenizer_path

SEQUENCE = 2048
END_ID = 1

TOKENS_SCHEMA = "doc_id long, part int, pos long, doc_tokens long, ids binary"
PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long, ids binary"


def _binaries(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary Arrow array with row i = bytes of values[first[i]:first[i + 1]]."""
    offsets = (first * values.dtype.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """TOKENS_SCHEMA: one row a document, with its place (`part`, `pos`) in the stream of its partition; ids are
    little-endian uint16 where the vocabulary allows, else uint32."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos, enc = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                ids, first = enc.encode_chunk(data, offsets, end_id)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(np.full(end - row, part, np.int32)), pa.array(first[:-1] + pos), pa.array(np.diff(first)), _binaries(ids, first)], ["doc_id", "part", "pos", "doc_tokens", "ids"])
                pos += len(ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, TOKENS_SCHEMA)


def _cut(size: int, with_ids: bool, width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            doc = batch.column(0)
            n, place, total = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3))
            pieces = (place + n - 1) // size - place // size + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = ranges(np.zeros(len(n), np.int64), pieces)
            begin = np.maximum(place[row], (place[row] // size + nth) * size)
            end = np.minimum(place[row] + n[row], (begin // size + 1) * size)
            start, seq = begin - place[row], begin // size
            last = total[row] - seq * size  # ids of this sequence, if it's the last
            padded = np.where((last < size) & ((last & (last - 1)) == 0), last, size)
            out, crc = [], np.empty(len(row), np.int64)
            for i, (r, s, e) in enumerate(zip(row.tolist(), start.tolist(), (start + end - begin).tolist())):
                ids = np.frombuffer(batch.column(4)[r].as_buffer(), kind)[s:e]
                crc[i] = zlib.crc32(ids.astype("<u4"))
                if with_ids:
                    out.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays(
                [doc.take(pa.array(row)), *map(pa.array, (start, end - begin, crc, n[row], seq, begin % size, padded)), pa.array(out, pa.binary()) if with_ids else pa.nulls(len(row), pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to", "ids"],
            )

    return cut


def pack(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """PIECES_SCHEMA: one row for each part of a document that lies in one sequence.  padded_to is the length that a
    trainer pads the sequence to: `size`, but the own length of a short last sequence that is a power of two."""
    path = path or tokenizer_path()
    tokens = written(tokenised(docs, path, end_id), "packing-tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    # one row a partition of the input, of two numbers: the only single-task step, and a bounded broadcast
    places = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    placed = tokens.join(F.broadcast(places), "part").select("doc_id", "doc_tokens", (F.col("pos") + F.col("before")).alias("place"), "total", "ids")
    from tokenizers import Tokenizer

    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
    return placed.mapInArrow(_cut(size, with_ids, width), PIECES_SCHEMA)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length, padded_to and the pieces (doc_id, offset, length, ids) by offset.  A
    sequence has at most `size` ids, so its group is bounded."""
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.first("padded_to").alias("padded_to"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("pieces"))
