"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, chat, conversation_repair, decontamination, html_main, mtree, near_dup, packing, passages, pii, quality, substring_dedup, token_files, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(_table(spark, sf_dir, "documents"))


def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", same), (-7, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(rows.unionAll(more))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op9_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(_table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(_table(spark, sf_dir, "documents"), words=passages.WORDS)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return conversation_repair.repaired(conversation_repair.damaged(rows), rows)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digests(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_packing, op2_pii, op3_html_main, op4_token_files, op5_quality, op6_chat, op7_decontamination, op8_near_dup, op9_mtree, op10_substring_dedup, op11_conversation_repair, op12_toxicity, op13_centroids)}

_ESC = lambda x: f"replace(replace(replace({x}, chr(92), repeat(chr(92), 2)), '<', chr(92) || '<'), '>', chr(92) || '>')"

_NEAREST = "SELECT row, vec_id, v, c, d FROM (SELECT k.row, k.vec_id, k.v, m.c, CAST(list_sum(list_transform(list_zip(k.v, m.m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept k, {0} m) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1"
#: Floors of quotients of whole numbers: the remainder is made non-negative first.
_MOVED = "SELECT m.c, coalesce(n.m, m.m) AS m FROM {0} m LEFT JOIN (SELECT c, list(s ORDER BY i) AS m FROM (SELECT c, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS s FROM {1}, range(1, 65) r(i) GROUP BY c, i) GROUP BY c) n ON n.c = m.c"
_CENTROIDS = f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM kept QUALIFY c < 16),
        a1 AS MATERIALIZED ({_NEAREST.format("m0")}), m1 AS MATERIALIZED ({_MOVED.format("m0", "a1")}),
        a2 AS MATERIALIZED ({_NEAREST.format("m1")}), m2 AS MATERIALIZED ({_MOVED.format("m1", "a2")}),
        a3 AS MATERIALIZED ({_NEAREST.format("m2")}), m3 AS MATERIALIZED ({_MOVED.format("m2", "a3")}),
        a4 AS MATERIALIZED ({_NEAREST.format("m3")})
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string((SELECT any_value(m) FROM m3 WHERE m3.c = a4.c), ',')) AS centroid_sha256
        FROM a4"""

ORACLE_SQL: dict[str, str] = {
    "op6_chat": f"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
            UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
               CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<turn ' || {_ESC("r")} || '>' || {_ESC("t")} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id""",
    "op7_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
               FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, win)),
        h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op9_mtree": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE dealt AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS UBIGINT))),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)) + z))) % 20 AS d
            FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations)),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
            FROM dealt WHERE d <> 0),
        marked AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen FROM damaged),
        judged AS MATERIALIZED (
            SELECT conv_id, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before, row_number() OVER w - 1 AS pos,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen THEN 'd' WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE ' ' END AS fault
            FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen)),
        follows(a, b) AS (VALUES ('n', 's'), ('n', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
        inserted(a, b, letters, price) AS (VALUES ('n', 'n', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0), ('n', 'u', 'I', 2), ('s', 'u', 'I', 2), ('u', 'a', 'I', 2), ('a', 'u', 'I', 2), ('n', 'a', 'II', 4), ('s', 'a', 'II', 4)),
        walk AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS pos, 'n' AS ends, {'c': CAST(0 AS BIGINT), 'e': ''} AS best FROM judged WHERE pos = 0
            UNION ALL
            SELECT conv_id, pos, ends, min(best) FROM (
                SELECT w.conv_id, w.pos + 1 AS pos, s.ends, {'c': w.best.c + i.price + s.price, 'e': w.best.e || i.letters || s.letter} AS best
                FROM walk w JOIN inserted i ON i.a = w.ends JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.pos = w.pos,
                     LATERAL (SELECT i.b AS ends, 3 AS price, 'D' AS letter
                              UNION ALL SELECT f.b, CASE WHEN j.initial = f.b THEN 0 ELSE 2 END + CASE WHEN j.fault = 't' THEN 1 ELSE 0 END, CASE WHEN j.initial = f.b THEN 'K' ELSE 'R' END
                              FROM follows f WHERE f.a = i.b AND j.fault IN ('t', ' ') AND (f.b <> 's' OR j.initial = 's')) s) x
            GROUP BY conv_id, pos, ends),
        size AS (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                        count(*) FILTER (pos > 0 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
        best AS (SELECT w.conv_id, min({'c': w.best.c + i.price, 'e': w.best.e || i.letters}) AS best
                 FROM walk w JOIN size z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.pos JOIN inserted i ON i.a = w.ends AND i.b IN ('n', 'a') GROUP BY w.conv_id),
        letters AS (SELECT conv_id, i, substr(e, i, 1) AS letter FROM (SELECT conv_id, best.e AS e, unnest(range(1, length(best.e) + 1)) AS i FROM best)),
        placed AS (SELECT conv_id, i, letter, count(*) FILTER (letter <> 'I') OVER w - 1 AS pos, count(*) FILTER (letter <> 'D') OVER w - 1 AS place FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
        told AS (SELECT p.conv_id, p.i, p.letter, p.place, j.role, j.text, max(CASE WHEN p.place = 0 AND p.letter = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS s
                 FROM placed p LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.pos = p.pos AND p.letter <> 'I' WHERE p.letter <> 'D'),
        digest AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - s) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i)) AS sha FROM told GROUP BY conv_id)
        SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(best.best.c, 0) AS cost, coalesce(best.best.e, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN digest ON digest.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_centroids": _CENTROIDS,
}
