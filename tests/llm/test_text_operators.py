"""Personal data, quality, decontamination, near duplicates and repeated substrings against brute force."""

import hashlib
import re
import time
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from data import SCHEMA, prose, table, texts, words

from ledgerline.llm import decontamination, near_dup, passages, pii, quality, queries, substring_dedup
from ledgerline.llm.store import brief_shuffles, shared_dir, written
from ledgerline.llm.suffix_array import permuted_lcp, repeated, suffix_array

sha = lambda s: hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df, [tuple(r) for r in df.select("doc_id", "text").collect()]


# personal data


def base_spans(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [f"{k}:{s}:{e}" for k, s, e in out]


ODD = [(50, "a@b.co_x@y.zz a@@b.c a@b@c.d x" + "y" * 5000 + "@z.com."), (51, "1.2.3.4.5.6.7.8 00000255.0.0.1 999.1.1.1 1.2.3"), (52, "4111-1111-1111-1111 4111111111111112 " + "1 " * 3000), (53, "+1+49 (0) 30 1234567 +1 .. 2 +123456789012345678"), (54, "𝒳é a@b.cd 𝒳 8.8.8.8"), (55, "Call (415) 555-0100 now; Dr. Ada Lovelace, SSN 123-45-6789")]


def test_base_spans(spark, sf):
    df, rows = documents(spark, sf)
    for df, rows in ((df, rows), (table(spark, texts() + ODD), texts() + ODD)):
        want = sorted((str(i), sha(",".join(base_spans(t)))) for i, t in rows)
        got = pii.spans(df).collect()
        assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in got) == want
        for r in got:
            kept = [s for s in r["spans"].split(",") if s]
            counts = Counter(s.split(":")[0] for t in [dict(rows).get(r["doc_id"])] for s in base_spans(t)) if list(dict(rows)).count(r["doc_id"]) and sum(i == r["doc_id"] for i, _ in rows) == 1 else None
            if counts is not None:
                assert [r[f"n_{k}"] for k in pii.BASE] == [counts[k] for k in pii.BASE]
                assert set(base_spans(dict(rows)[r["doc_id"]])) <= set(kept)


def test_redaction_keeps_columns_and_masks(spark):
    got = pii.redacted(table(spark, texts() + ODD))
    assert got.schema.simpleString() == table(spark).schema.simpleString()
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    assert by_id[54] == "𝒳é [EMAIL] 𝒳 [IP]" and by_id[4] is None and by_id[5] == ""
    assert "555-1655" not in by_id[15] or by_id[15].startswith("other")
    assert pii.redacted(table(spark, [])).count() == 0 and pii.spans(table(spark, [])).count() == 0


def test_expectation_maximisation_finds_the_reliable_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    votes = [np.where(rng.random(4000) < acc, truth, ~truth) for acc in (0.95, 0.9, 0.6, 0.85)]
    cells = Counter((0, "".join("+" if v[i] else "-" for v in votes), 0) for i in range(4000))
    model, _ = pii.estimate([(*k, n) for k, n in cells.items()])
    found = [m[1, "+"] for m in model]
    assert np.allclose(found, (0.95, 0.9, 0.6, 0.85), atol=0.05)


# quality


def test_quality_holds_out_and_ranks(spark):
    rng = __import__("random").Random(3)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        rows.append((i, prose(rng, 60).upper() + " !!" if bad else prose(rng, 60) + "."))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 1, 0), (3, None, 0), (10_000, 1, 0)]
    got = {r["doc_id"]: r for r in quality.scored(table(spark, rows + [(None, None), (-1, "")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 402
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    held = [(r["score"], i % 4 != 0) for i, r in got.items() if i is not None and i >= 0 and r["held_out"]]
    assert min(s for s, y in held if y) > max(s for s, y in held if not y)


def test_quality_auc_on_held_out_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.scored(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    order = got["score"].rank()
    y = got["quality"] == 1
    auc = (order[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.9, auc


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.scored(table(spark), none).collect()} == {0.5}
    assert quality.scored(table(spark, []), none).count() == 0
    kept = quality.keep_good(table(spark), none)
    assert kept.count() == len(texts()) and kept.schema.simpleString() == table(spark).schema.simpleString()


# decontamination


def contaminated(rows, items, window=10):
    found = {}
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[k : k + n]), set()).add("null" if name is None else str(name))
    out = []
    for i, text in rows:
        w, hit, got = words(text), set(), set()
        for n in {len(k) for k in found}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in found:
                    hit |= set(range(k, k + n))
                    got |= found[key]
        out.append((str(i), len(w), len(hit), len(got), sha(",".join(sorted(got))), bool(hit)))
    return sorted(out)


def test_decontamination(spark):
    base = words(dict(texts())[1])
    items = [(0, " ".join(base[5:40])), (10, " ".join(base[30:60])), (2, "One, two"), (3, ""), (4, None), (None, " ".join(base[100:112])), (2, "one two"), (5, "nowhere to be found at all in any of these documents")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contaminated(texts(), items)
    for limit in (500_000, 20):  # one pass, and several
        index = written(decontamination.build_index(table(spark)), "test-index")
        got = decontamination.search(index, bench, block_words=limit)
        rows = sorted((str(r["doc_id"]), r["n_words"], len(r["hits"]), len(r["items"]), sha(",".join(sorted(r["items"]))), len(r["hits"]) > 0) for r in got.collect())
        assert rows == want
    assert sorted((str(r[0]), *r[1:]) for r in decontamination.contamination(table(spark), bench).collect()) == want
    clean = decontamination.clean(table(spark), bench)
    assert Counter(str(r["doc_id"]) for r in clean.collect()) == Counter(i for i, *_, bad in want if not bad)
    assert decontamination.contamination(table(spark, []), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(table(spark), none).where("contaminated").count() == 0


def test_proximity(spark):
    docs = table(spark, [(1, "alpha x beta y gamma"), (2, "alpha beta gamma"), (3, "gamma beta alpha"), (4, "alpha x x x beta gamma")])
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    hits = lambda slop: {r["doc_id"] for r in decontamination.search(decontamination.build_index(docs), bench, slop=slop).where("size(hits) > 0").collect()}
    assert hits(0) == {2} and hits(1) == {1, 2} and hits(3) == {1, 2, 4}


def test_proximity_of_repeated_words():
    rng = np.random.default_rng(3)
    assert [x.tolist() for x in decontamination._matches([np.array(p) for p in ([0], [1, 3], [5])], 2, np.array([0]))][0]  # alpha beta x beta x gamma
    for _ in range(300):
        text, base = rng.integers(0, 4, 40), np.array([0, 11, 27])
        text[[10, 26]] = 9  # the gaps between documents
        item, slop = rng.integers(0, 4, rng.integers(1, 5)), int(rng.integers(1, 4))
        want, ways = set(), [(p,) for p in np.flatnonzero(text == item[0]).tolist()]
        for w in item[1:]:
            ways = [(*x, p) for x in ways for p in range(x[-1] + 1, min(x[-1] + slop + 2, 40)) if text[p] == w and sum(base <= p) == sum(base <= x[0])]
        for x in ways:
            want |= set(range(x[0], x[-1] + 1))
        lists = [np.flatnonzero(text == w) for w in item]
        got = set()
        if all(len(p) for p in lists):
            for a, b in zip(*decontamination._matches(lists, slop, base)):
                got |= set(range(a, b))
        assert got == want


# near duplicates


def classes(rows, similarity=0.8):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter({("bytes", t): 1}) if t else None)
    label = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and sum((sets[a] & sets[b]).values()) >= similarity * sum((sets[a] | sets[b]).values()):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize(("direct", "each"), [(near_dup.DIRECT, near_dup.PAIRS_EACH), (3, 0)])  # the second sends nearly every bucket through the residuals
def test_near_duplicates(spark, direct, each, monkeypatch):
    monkeypatch.setattr(near_dup, "PAIRS_EACH", each)
    rng = __import__("random").Random(9)
    rows = [(i if t != "other text, same key" else 16, t) for i, t in texts()]
    seed = prose(rng, 120).split()
    for i in range(40):  # a group whose members are nearer to the first than to each other
        copy = list(seed)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        rows.append((100 + i, " ".join(copy)))
    rows += [(200 + i, prose(rng, 80)) for i in range(30)]
    label = classes(rows)
    want = {}
    for k, (i, _) in enumerate(rows):
        want.setdefault(label[k], []).append(i)
    got = {}
    result = near_dup.classes(table(spark, rows), direct=direct).collect()
    assert len(result) == len(rows)
    kept = Counter()
    for r in result:
        got.setdefault((r["class_id"], sha(str(r["doc_id"])) if r["class_id"] is None else ""), []).append(r["doc_id"])
        kept[r["class_id"]] += r["kept"]
    by = lambda groups: sorted(sorted(map(str, g)) for g in groups if None not in g)
    assert by(got.values()) == by(want.values())
    assert sum(kept.values()) == len(want)
    out = near_dup.deduplicated(table(spark, rows))
    assert out.count() == len(want) and out.schema.simpleString() == table(spark).schema.simpleString()
    assert near_dup.classes(table(spark, [])).count() == 0


def test_near_duplicates_whole_table(spark, sf):
    """Every pair of weighted Jaccard 0.8 or more, found through shared shingles, against the classes of all of sf0.01."""
    df, rows = documents(spark, sf.replace("sf0.001", "sf0.01"))
    cells = []
    for _, text in rows:
        w, seen = words(text), Counter()
        n = max(0, len(w) - 4) or min(1, len(w))
        for k in range(n):
            seen[tuple(w[k : k + 5])] += 1
        cells.append(seen)
    holders = {}
    for k, seen in enumerate(cells):
        for shingle, n in seen.items():
            holders.setdefault(shingle, []).append((k, n))
    shared = Counter()
    for held in holders.values():
        for (a, m), (b, n) in combinations(held, 2):
            shared[a, b] += min(m, n)
    size = [sum(c.values()) for c in cells]
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (size[a] + size[b] - n)]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    of = {r["doc_id"]: r["class_id"] for r in near_dup.classes(df).collect()}
    found = sum(of[rows[a][0]] == of[rows[b][0]] for a, b in links)
    print(f"near duplicates: {found} of {len(links)} links")
    assert links and found == len(links)
    worded = [k for k in range(len(rows)) if size[k]]
    assert len({of[rows[k][0]] for k in worded}) == len({root(k) for k in worded})


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    cells = rng.integers(0, 1 << 64, 900, dtype=np.uint64)
    for shared in (100, 300, 550):
        a, b = cells[:600], cells[600 - shared : 1200 - shared]
        sig = near_dup.dart_signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 2000)
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        assert abs((sig[0] == sig[1]).mean() - true) < 0.05


# repeated substrings


def cut(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(x[k : k + length] for x in raw for k in range(len(x) - length + 1))
    out = []
    for (i, _), x in zip(rows, raw):
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((str(i), len(x), sum(gone), sum(g and not p for g, p in zip(gone, [False, *gone])), sha(kept)))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard": 1}, {"shard": 3000}, {"length": 60, "gram": 8, "shard": 500, "spans": (6, 2, 1)}, {"length": 60, "gram": 60, "shard": 1, "spans": (1,)}])
def test_repeated_substrings(spark, options):
    got = substring_dedup.digests(table(spark), **options).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == cut(texts(), options.get("length", 400))


def test_repeated_substrings_whole_table(spark, sf):
    df, rows = documents(spark, sf)
    assert sorted((str(r[0]), *r[1:]) for r in substring_dedup.digests(df).collect()) == cut(rows, 400)
    assert substring_dedup.digests(table(spark, [])).count() == 0


def test_repeated_substrings_leave_little_on_disk(spark):
    """Of the tables only what the result reads, of the jobs before it no shuffle files; and the result can be read twice."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    local = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    tables = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file:"), "ledgerline").glob("*")}
    shuffles = lambda: {p.name.split("_")[1] for d in local for p in Path(d).rglob("shuffle_*")}
    there, shuffled, before = tables(), shuffles(), spark.conf.get(setting)
    out = substring_dedup.digests(table(spark), words=passages.WORDS, shard=1)
    assert sorted(x.rsplit("-", 1)[0] for x in tables() - there) == ["passage-flags", "passage-shared", "substring-flags", "substring-shared"]
    for _ in range(50):  # files go in the background
        if not (left := shuffles() - shuffled):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting) == before
    for _ in range(2):
        assert sorted((str(r[0]), *r[1:5]) for r in out.collect()) == cut(texts(), 400)
    with brief_shuffles(spark):
        with brief_shuffles(spark):
            pass
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting) == before


def passage_words(rows, n=50):
    held, spoken = {}, [words(t) for _, t in rows]
    for k, w in enumerate(spoken):
        for i in range(len(w) - n + 1):
            held.setdefault(tuple(w[i : i + n]), set()).add(k)
    return [len({p for i in range(len(w) - n + 1) if len(held[tuple(w[i : i + n])]) > 1 for p in range(i, i + n)}) for w in spoken]


def test_passages_shorter_than_the_strings(spark):
    rng = __import__("random").Random(12)
    passage = prose(rng, 55)[:399].rsplit(" ", 1)[0]
    n = len(words(passage))
    assert n >= 50 and len(passage.encode()) < 400
    rows = [(1, f"{prose(rng, 90)} {passage} {prose(rng, 20)}"), (2, f"{prose(rng, 30)}\n{re.sub('[a-z]', lambda m: m[0].upper(), passage).replace(' ', ', ')}. {prose(rng, 90)}"), (3, f"{passage} -- {prose(rng, 60)} {passage}"), (4, prose(rng, 400))]
    own = prose(rng, 60)
    rows += [(5, f"{own} {prose(rng, 9)} {own}"), (6, " ".join(passage.split()[:49]) + " other " + prose(rng, 50)), (7, None), (None, passage), (8, ""), (9, "of " * 300), (9, "of " * 300), (10, "of " * 120 + prose(rng, 70)), (11, "on " * 300)]
    for extra in ([], texts()):
        got = substring_dedup.digests(table(spark, rows + extra), words=passages.WORDS).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_passage_words"]) for r in got) == sorted((str(i), len((t or "").encode()), k) for (i, t), k in zip(rows + extra, passage_words(rows + extra)))
    assert [k for k in passage_words(rows)][:6] == [n, n, 2 * n, 0, 0, 0]


def test_passages_whole_table(spark, sf):
    df, rows = documents(spark, sf)
    got = queries.op10_substring_dedup(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_passage_words"]) for r in got) == sorted((i, k) for (i, _), k in zip(rows, passage_words(rows)))


@pytest.mark.parametrize("small", [1024, 0])
def test_suffix_array_and_common_prefixes(monkeypatch, small):
    monkeypatch.setattr("ledgerline.llm.suffix_array.SMALL_ALPHABET", small)
    rng = __import__("random").Random(3)
    for _ in range(300):
        n, letters = rng.randint(0, 60), rng.choice([1, 2, 3, 250])
        t = np.array([rng.randint(1, letters) for _ in range(n)] + [0])
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: t[i:].tolist())
        lcp = permuted_lcp(t, sa, 64)
        for k in range(1, n + 1):
            x, y = t[sa[k] :].tolist(), t[sa[k - 1] :].tolist()
            same = next((m for m, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
            assert lcp[sa[k]] == same
    assert [x.tolist() for x in repeated([b"abcabd", b"ab", b""], 2)] == [[True, False, False, True, False], [True], []]
