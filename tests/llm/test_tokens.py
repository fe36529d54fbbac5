"""Packing and token files against the tokenizers library, one text at a time."""

import tracemalloc
import zlib

import numpy as np
import pytest
from data import table, texts

from ledgerline.llm import packing, token_files, tokens
from ledgerline.llm.textbytes import powers
from ledgerline.llm.tokens import tokenizer_path


def encode(text, end):
    from tokenizers import Tokenizer

    encode.made = getattr(encode, "made", None) or Tokenizer.from_file(tokenizer_path())
    return [*encode.made.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(pieces, rows, size):
    """Every document is whole, every sequence gapless and at most `size`, and every id in one piece."""
    left = [(i, encode(t, 1)) for i, t in rows]
    place = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    at, k = 0, 0
    while k < len(place):
        p = place[k]
        ids = []
        while True:
            p = place[k]
            assert (p["sequence_id"], p["offset"]) == (at // size, at % size) and p["start"] == len(ids) and p["offset"] + p["length"] <= size
            got = np.frombuffer(p["ids"], "<u2").tolist()
            assert len(got) == p["length"] and crc(got) == p["ids_crc32"]
            ids += got
            at, k = at + p["length"], k + 1
            if len(ids) == p["doc_tokens"]:
                break
        left.remove((p["doc_id"], ids))
    assert not left
    last = at % size or size
    for p in pieces:
        short = p["sequence_id"] == (at - 1) // size and last & (last - 1) == 0
        assert p["padded_to"] == (last if short else size)


@pytest.mark.parametrize("size", [2048, 16])
def test_packing_edge_cases(spark, size):
    check_pieces(packing.pack(table(spark), size=size).collect(), texts(), size)
    assert packing.pack(table(spark, [])).count() == 0


def test_packing_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = packing.pack(docs)
    check_pieces(pieces.collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], 2048)
    assert packing.sequences(pieces).agg({"length": "max"}).first()[0] <= 2048


def test_token_files(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df, rows in ((table(spark), texts()), (docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])):
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] is not None, r[1] or "")))
        want, at = [], 0
        for key, text in rows:
            ids = encode(text, 2)
            want.append((key, at, len(ids), crc(ids)))
            at += len(ids)
        got = sorted((tuple(r) for r in token_files.round_trip(df).collect()), key=lambda r: r[1])
        assert got == want
    assert token_files.round_trip(table(spark, [])).count() == 0


def test_lookup(spark):
    from ledgerline.llm.store import new_path

    out = new_path(spark, "test-token-files")
    token_files.write(table(spark), out)
    got = {r["doc_id"]: r["ids"] for r in token_files.lookup(token_files.read(spark, out), spark.createDataFrame([(3,), (7,), (99,), (None,), (7,)], "doc_id long")).collect()}
    by_id = dict(texts())
    assert got == {k: encode(by_id[k], 2) for k in (3, 7)}


def test_perfect_hash_is_minimal_and_refuses_strangers():
    for n in (1, 2, 7, 512, 3000):
        keys = np.arange(n, dtype=np.int64) * 7919 - 5
        h = token_files.key_hashes(keys, np.zeros(n, np.int64), np.zeros(n, bool))
        seeds, slot = token_files.build(h)
        assert sorted(slot.tolist()) == list(range(n))
        prints = np.zeros(n, np.uint32)
        prints[slot] = (h >> np.uint64(32)).astype(np.uint32)
        assert token_files.find(h, seeds, prints).tolist() == slot.tolist()
        other = token_files.key_hashes(keys + 1, np.zeros(n, np.int64), np.zeros(n, bool))
        assert (token_files.find(other, seeds, prints) == -1).all()


def test_one_key_in_many_records(spark, tmp_path):
    rows = [(7, f"word {i % 900}") for i in range(1300)] + [(None, f"none {i}") for i in range(700)] + [(8, "last"), (3, "first")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = str(tmp_path / "files")
    token_files.write(docs, out)
    records = token_files.read(spark, out)
    assert records.agg({"n_docs": "max"}).first()[0] <= token_files.SHARD_DOCS and records.count() >= 4
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"]) for r in token_files.documents(records).collect())
    assert len(got) == len(rows) and min(r[3] for r in got) >= 2
    assert [r[2] for r in got] == [sum(x[3] for x in got[:k]) for k in range(len(got))]
    found = token_files.lookup(records, spark.createDataFrame([(7,), (8,), (3,), (99,)], "doc_id long")).collect()
    assert sorted(r["doc_id"] for r in found) == [3, 7, 8]


def test_workers_get_small_batches(spark, tmp_path, monkeypatch):
    """A range of keys of 40 MB goes to its worker in parts, and so do the records that are read back."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 12000) AS text").coalesce(1)
    out, real, rows = str(tmp_path / "files"), token_files.chunks, token_files._rows

    def seen(column):
        if column.nbytes > 10 << 20:
            raise ValueError(f"a batch of {column.nbytes} bytes")
        yield from real(column)

    def seen_rows(batches):
        for batch in batches:
            if batch.nbytes > 14 << 20:
                raise ValueError(f"records of {batch.nbytes} bytes")
            yield from rows([batch])

    monkeypatch.setattr(token_files, "chunks", seen)
    token_files.write(docs, out)
    monkeypatch.setattr(token_files, "_rows", seen_rows)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    got = token_files.documents(token_files.read(spark, out)).selectExpr("count(*)", "min(n_tokens) > 12000").first()
    assert tuple(got) == (400, True)


def _chunk(words):
    data = " ".join(words).encode()
    return np.frombuffer(data, np.uint8), np.array([0, len(data)])


def test_the_memo_of_words_is_bounded_by_ids_and_small(monkeypatch):
    """Few words may hold many ids; and what is kept of a word is little more than its ids."""
    monkeypatch.setattr(tokens, "MEMO_IDS", 20_000, raising=False)
    rng = np.random.default_rng(3)
    enc = tokens.WordEncoder(tokenizer_path())
    for _ in range(12):
        words = ["again", *("".join(map(chr, rng.integers(97, 123, 3000))) for _ in range(5))]
        got, _ = enc.encode_chunk(*_chunk(words), 2)
        assert got.tolist() == encode(" ".join(words), 2)
        assert len(enc.flat) < 20_000 + 15_000
    enc._forget()
    assert len(enc.keys) == 1 and enc.flat.tolist() == encode("again", 2)[:-1]  # what is met again stays
    monkeypatch.setattr(tokens, "MEMO_IDS", 6_000_000)
    enc = tokens.WordEncoder(tokenizer_path())
    words = sorted({"".join(map(chr, rng.integers(97, 123, 9))) for _ in range(20_000)})
    powers(1 << 19), powers(1 << 19, True)  # tables of the process, not of the words
    tracemalloc.start()
    try:
        enc.encode_chunk(*_chunk(words), 2)
        assert tracemalloc.get_traced_memory()[0] < 250 * len(words)
    finally:
        tracemalloc.stop()
