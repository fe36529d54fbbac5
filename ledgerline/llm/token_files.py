"""Token files with keyed access through a minimal perfect hash.

Documents are put in ascending key order by a range partitioning; each task encodes its key range and cuts it into shards.
A shard is one record of the file: the raw ids of its documents one after another, the keys in order, and an index.  The
index is a minimal perfect hash of the shard's n keys (hash and displace: a seed for each bucket sends the bucket's keys
to free slots out of exactly n), and each slot stores a fingerprint of its key and the place of its document in the
payload.  So a key is found with two hashes and one comparison, and a key that isn't there is refused by its fingerprint.
The records are Parquet rows, committed by Spark's own writer on any file system that Spark writes to.

Defined results: a null text has no ids but the end id; a null key comes first and is found under its own hash; rows
with the same key are told apart by their ordinal (order of their texts) and may go on from record to record, so a record
is bounded whatever a key holds; an empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import new_path, small_batches
from .textbytes import chunks, mix
from .tokens import encoder, tokenizer_path

END_ID = 2
#: A shard ends with the document that brings it to this many documents or ids.
SHARD_DOCS, SHARD_IDS = 512, 1 << 19

SHARD_SCHEMA = "part int, shard int, first_key long, last_key long, ordinal long, ids_before long, n_docs int, n_ids long, width int, payload binary, keys binary, null_keys int, seeds binary, fingerprints binary, begins binary, lengths binary"
_U = np.uint64


def key_hashes(keys: np.ndarray, ordinals: np.ndarray, is_null: np.ndarray) -> np.ndarray:
    h = mix(keys.astype(np.int64).view(np.uint64) + _U(0x51ED270B)) ^ mix(ordinals.astype(np.uint64) + _U(77))
    return np.where(is_null, mix(h + _U(0xA5A5)), h)


def ordinals(keys: np.ndarray, is_null: np.ndarray, carry: int = 0) -> np.ndarray:
    """For sorted keys, the how-manieth of its equals each one is; `carry` equals of the first key stand before them."""
    n = len(keys)
    new = np.ones(n, bool)
    new[1:] = (keys[1:] != keys[:-1]) | (is_null[1:] != is_null[:-1])
    at = np.arange(n)
    out = at - np.maximum.accumulate(np.where(new, at, 0))
    if carry and n:
        out[: int(np.argmax(new[1:])) + 1 if new[1:].any() else n] += carry
    return out


def _slots(h: np.ndarray, seed: np.ndarray | int, n: int) -> np.ndarray:
    return (mix(h + np.asarray(seed, np.uint64) * _U(0x9E3779B97F4A7C15)) % _U(n)).astype(np.int64)


def build(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds of the buckets, slot of each key): a minimal perfect hash of distinct 64-bit hashes.  A bucket of several
    keys has the first seed > 0 that sends them to free slots; one of a single key names its slot as -slot - 1."""
    n = len(h)
    seeds, slot, taken = np.zeros(n // 3 + 1, np.int32), np.zeros(n, np.int64), np.zeros(n, bool)
    bucket = (mix(h ^ _U(0x5BD1E995)) % _U(len(seeds))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    which, first, size = np.unique(bucket[order], return_index=True, return_counts=True)
    single = []
    for b in np.argsort(-size, kind="stable"):
        members = order[first[b] : first[b] + size[b]]
        if len(members) == 1:
            single.append((which[b], members[0]))
            continue
        low = 1
        while True:  # 64 seeds at a time
            tries = _slots(h[members][None, :], np.arange(low, low + 64)[:, None], n)
            ordered = np.sort(tries, axis=1)
            good = ~taken[tries].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                break
            low += 64
        seeds[which[b]], slot[members] = low + k, tries[k]
        taken[tries[k]] = True
    free = np.flatnonzero(~taken)
    for (b, member), s in zip(single, free.tolist()):
        seeds[b], slot[member] = -s - 1, s
    return seeds, slot


def find(h: np.ndarray, seeds: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The slot of each hash, or -1 where the stored fingerprint refuses it."""
    n = len(prints)
    if not n:
        return np.full(len(h), -1)
    seed = seeds[(mix(h ^ _U(0x5BD1E995)) % _U(len(seeds))).astype(np.int64)].astype(np.int64)
    slot = np.where(seed < 0, -seed - 1, _slots(h, np.maximum(seed, 0), n))
    return np.where(prints[slot] == (h >> _U(32)).astype(np.uint32), slot, -1)


def write(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of every text of docs(doc_id, text) to `out`, in ascending doc_id order."""
    small_batches(docs.sparkSession)  # a range of keys may be one batch else
    path = path or tokenizer_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(path)
        before = number = held = 0
        carry = 0  # how many documents of the first key stand in the records before
        keys, nulls, ids, lens = [], [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal before, number, held, carry
            key, null, n = np.concatenate(keys), np.concatenate(nulls), np.concatenate(lens)
            payload = np.concatenate(ids)
            nth = ordinals(key, null, carry)
            h = key_hashes(key, nth, null)
            seeds, slot = build(h)
            prints, begins, lengths = np.zeros(len(h), np.uint32), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
            prints[slot], begins[slot], lengths[slot] = (h >> _U(32)).astype(np.uint32), np.cumsum(n) - n, n
            some = key[~null]
            row = {
                "part": part, "shard": number, "first_key": int(some[0]) if len(some) else None, "last_key": int(some[-1]) if len(some) else None, "ordinal": carry, "ids_before": before, "n_docs": len(h), "n_ids": len(payload), "width": payload.dtype.itemsize,
                "payload": payload.tobytes(), "keys": key.tobytes(), "null_keys": int(null.sum()), "seeds": seeds.tobytes(), "fingerprints": prints.tobytes(), "begins": begins.tobytes(), "lengths": lengths.tobytes(),
            }
            before, number, held, carry = before + len(payload), number + 1, 0, int(nth[-1]) + 1
            for x in (keys, nulls, ids, lens):
                x.clear()
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(1)):
                column = batch.column(0).slice(row, end - row)
                null = column.is_null().to_numpy(zero_copy_only=False)
                key = column.fill_null(0).to_numpy(zero_copy_only=False)
                got, first = enc.encode_chunk(data, offsets, end_id)
                at = 0
                while at < len(key):
                    if held and (held >= SHARD_DOCS or sum(map(len, ids)) >= SHARD_IDS):
                        last = keys[-1][-1], nulls[-1][-1]
                        yield flush()
                        carry = carry if (key[at], null[at]) == last else 0  # equal keys may go on in the next record
                    room = max(1, SHARD_DOCS - held)
                    stop = min(len(key), at + room, max(at + 1, int(np.searchsorted(first, first[at] + SHARD_IDS))))
                    keys.append(key[at:stop]), nulls.append(null[at:stop]), ids.append(got[first[at] : first[stop]]), lens.append(np.diff(first[at : stop + 1]))
                    held, at = held + stop - at, stop
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc()).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "zstd").parquet(out)


_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("ordinal", pa.int64()), ("ids_before", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), *((c, pa.binary()) for c in ("payload", "keys")), ("null_keys", pa.int32()), *((c, pa.binary()) for c in ("seeds", "fingerprints", "begins", "lengths"))])


class Shard:
    """Keyed access to one record of the file."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.null = np.arange(len(self.keys)) < row["null_keys"]
        self.ordinal = row["ordinal"]
        self.seeds, self.prints = np.frombuffer(row["seeds"], np.int32), np.frombuffer(row["fingerprints"], np.uint32)
        self.begins, self.lengths = np.frombuffer(row["begins"], np.int64), np.frombuffer(row["lengths"], np.int64)

    def places(self, keys: np.ndarray, ordinal: np.ndarray, is_null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, length) of each key in the payload; -1 for keys that aren't there."""
        slot = find(key_hashes(keys, ordinal, is_null), self.seeds, self.prints)
        return np.where(slot < 0, -1, self.begins[slot]), np.where(slot < 0, -1, self.lengths[slot])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def read(spark: SparkSession, out: str) -> DataFrame:
    """The records, each with the number of ids in all records before it (`ids_before`)."""
    small_batches(spark)  # a record is a row of a megabyte or more
    rows = spark.read.schema(SHARD_SCHEMA).parquet(out)
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row for each task that wrote
    places = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    return rows.join(F.broadcast(places), "part").withColumn("ids_before", F.col("ids_before") + F.col("before_part")).drop("before_part")


def documents(records: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document: each key of a record is looked up in its index and its
    ids are taken from the payload."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = Shard(row)
            begin, n = shard.places(shard.keys, ordinals(shard.keys, shard.null, shard.ordinal), shard.null)
            crc = [zlib.crc32(shard.ids[b : b + k].astype("<u4")) for b, k in zip(begin.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard.keys, mask=shard.null), pa.array(begin + row["ids_before"]), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return records.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(records: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, ids (array) of the wanted keys(doc_id): a key goes to the records whose key range holds it (of the records only
    their ranges are read for that), the keys of a record are put together, and each record is read once.  Keys that aren't
    stored give no row; of equal keys the first document is returned."""
    wanted = keys.select(F.col("doc_id").cast("long").alias("want")).where("want is not null").distinct()
    at = records.select("part", "shard", "first_key", "last_key").join(wanted, F.col("want").between(F.col("first_key"), F.col("last_key")))
    groups = at.groupBy("part", "shard").agg(F.collect_list("want").alias("want"))
    held = records.select(*[c for c in records.columns if c not in ("ids_before", "n_ids")])
    near = held.join(groups, ["part", "shard"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard, key = Shard(row), np.array(row["want"], np.int64)
            begin, n = shard.places(key, np.zeros(len(key), np.int64), np.zeros(len(key), bool))
            for k in np.flatnonzero(begin >= 0):
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(key[k : k + 1]), "ids": pa.array([shard.ids[begin[k] : begin[k] + n[k]].astype(np.int64)], pa.list_(pa.int64()))})

    return near.mapInArrow(take, "doc_id long, ids array<long>")


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes docs and returns documents() of what is read back."""
    out = new_path(docs.sparkSession, "token-files")
    write(docs, out, path, end_id)
    return documents(read(docs.sparkSession, out))
