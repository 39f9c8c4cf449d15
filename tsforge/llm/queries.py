"""The thin queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tsforge.llm import bpe, conversations, decontamination, exact_dedup, filter_audit, html_text, line_dedup, media, mixing, quality, simhash, substring_dedup, token_files
from tsforge.llm.common import table


def op1_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark, sf_dir):
    found = exact_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_token_files(spark, sf_dir):
    return token_files.read_index(token_files.write(table(spark, sf_dir, "documents")))


def op4_quality_classifier(spark, sf_dir):
    stats = quality.described(table(spark, sf_dir, "documents"))
    return quality.score(stats, quality.fit(stats, table(spark, sf_dir, "labels")))


def op5_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark, sf_dir):
    found = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash_near_dedup(spark, sf_dir):
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_source_mixing(spark, sf_dir):
    return mixing.Mix(table(spark, sf_dir, "documents")).taken().select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_media_columns(spark, sf_dir):
    return media.payload_features(media.store_texts(table(spark, sf_dir, "documents")))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_decontamination(spark, sf_dir):
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    words = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    ids = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", words.alias("n_hit"), F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"), (words > 0).alias("contaminated"))


def op13_conversation_repair(spark, sf_dir):
    return conversations.Repair(conversations.damaged(table(spark, sf_dir, "conversations"))).results()


def _then(key: str, cost: str, letter: str) -> str:
    """SQL: a key (eight digits of cost, then letters; least is cheapest, then least in letters) with an edit before it."""
    return f"CASE WHEN {key} < '9' THEN printf('%08d', left({key}, 8)::INT + {cost}) || '{letter}' || substr({key}, 9) ELSE '99999999' END"


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_files": op3_token_files,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_html_extraction": op9_html_extraction,
    "op10_media_columns": op10_media_columns,
    "op11_filter_audit": op11_filter_audit,
    "op12_decontamination": op12_decontamination,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             p AS (SELECT doc_id, ws, unnest(range(len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13),
             g AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY md5(array_to_string(ws[i + 1:i + 13], ' '))) AS again FROM p),
             c AS (SELECT DISTINCT doc_id, i + k AS pos FROM g, range(13) AS r(k) WHERE again),
             e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
             k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM e ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)
    """,
    "op6_line_dedup": r"""
        WITH w AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
             p AS (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM w),
             n AS (SELECT doc_id, i, k, array_to_string(ls[i + 1:i + k], chr(10)) AS run FROM p, range(1, 4) AS r(k) WHERE i + k <= len(ls)),
             g AS (SELECT doc_id, i, k, row_number() OVER (PARTITION BY k, md5(run) ORDER BY doc_id, i) > 1 AS again FROM n
                   WHERE k = 3 OR len(regexp_extract_all(run, '[^\x20\x09-\x0D]+')) >= 8),
             c AS (SELECT DISTINCT doc_id, i + o AS pos FROM g, range(3) AS s(o) WHERE again AND o < k),
             e AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM w),
             k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS kept, count(*) AS n FROM e ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(ls) AS n_lines, len(ls) - coalesce(n, 0) AS n_deleted, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)
    """,
    # each flag by row, each step by counting rows: nothing of the cube
    "op11_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
             l AS (SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 END), 0) AS toxic FROM labels GROUP BY doc_id),
             f AS (SELECT part, len(ws) < 50 AS A, 100 * len(list_distinct(ws)) < 65 * len(ws) AS B,
                          100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * len(text) AS C, regexp_matches(text, '[#$%&*|]') AS D,
                          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS E, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
                   FROM t LEFT JOIN l USING (doc_id)),
             b AS (SELECT part, [A, B, C, D, E] AS fails, list_sum([A::INT, B::INT, C::INT, D::INT, E::INT]) AS n_fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
             c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
             o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c c, c d, c e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
             s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
             m AS (SELECT part, filter_order, step, ascii(substr(filter_order, step, 1)) - 64 AS k, n_fails, fails, n, good, toxic,
                          list_bool_or([false] || list_transform(range(1, step), lambda i: fails[ascii(substr(filter_order, i, 1)) - 64])) AS gone FROM b, s),
             r AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT gone AND NOT fails[k]), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails[k]), 0)::BIGINT AS removed,
                          coalesce(sum(n) FILTER (gone AND fails[k]), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (n_fails = 1 AND fails[k]), 0)::BIGINT AS unique_fails,
                          coalesce(sum(good) FILTER (NOT gone AND fails[k]), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails[k]), 0)::BIGINT AS toxic_lost
                   FROM m GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM r
    """,
    "op12_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
             i AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(len(ws) - least(len(ws), 10) + 1)) AS a FROM b WHERE len(ws) > 0),
             w AS (SELECT DISTINCT item_id, n, array_to_string(ws[a + 1:a + n], ' ') AS said FROM i),
             k AS (SELECT DISTINCT n FROM w),
             p AS (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS a FROM d, k WHERE len(ws) >= n),
             f AS (SELECT doc_id, n, a, item_id FROM (SELECT doc_id, n, a, array_to_string(ws[a + 1:a + n], ' ') AS said FROM p) JOIN w USING (n, said)),
             h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, a + o AS pos FROM f, range(10) AS r(o) WHERE o < n) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM f) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
    # states from the last row to the first: s0 nothing yet, ss after s, su after u, sa after a
    "op13_conversation_repair": rf"""
        WITH RECURSIVE
             o AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                          coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
             w AS (SELECT *, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(id, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                                 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)) % 20 AS draw FROM o),
             d AS (SELECT c, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                          CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM w),
             n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
             f AS (SELECT *, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS pair,
                          CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                               WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM n),
             r AS (SELECT *, left(role, 1) AS k, fault IN ('blank', 'duplicate') AS goes, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS late FROM f),
             p AS (
                SELECT c, max(i) + 1 AS i, '00000000' AS s0, '00000004II' AS ss, '00000002I' AS su, '00000000' AS sa FROM r GROUP BY c
                UNION ALL
                SELECT c, i, least(s0, {_then("su", "2", "I")}), least(ss, {_then("su", "2", "I")}), su, sa
                FROM (SELECT c, i, s0, ss, least(su, {_then("sa", "2", "I")}) AS su, least(sa, {_then("su", "2", "I")}) AS sa
                FROM (SELECT c, i, least(d0, CASE WHEN goes THEN '99999999' WHEN k = 's' THEN ks WHEN k = 'u' THEN ku WHEN k = '' THEN k0 ELSE '99999999' END, ru) AS s0,
                             least(ds, CASE WHEN goes THEN '99999999' WHEN k = 'u' THEN ku WHEN k = '' THEN ks ELSE '99999999' END, ru) AS ss,
                             least(du, CASE WHEN goes THEN '99999999' WHEN k = 'a' THEN ka WHEN k = '' THEN ku ELSE '99999999' END, ra) AS su,
                             least(da, CASE WHEN goes THEN '99999999' WHEN k = 'u' THEN ku WHEN k = '' THEN ka ELSE '99999999' END, ru) AS sa
                FROM (SELECT p.c, r.i, goes, k, {_then("s0", "3", "D")} AS d0, {_then("ss", "3", "D")} AS ds, {_then("su", "3", "D")} AS du, {_then("sa", "3", "D")} AS da,
                             {_then("s0", "late", "K")} AS k0, {_then("ss", "late", "K")} AS ks, {_then("su", "late", "K")} AS ku, {_then("sa", "late", "K")} AS ka,
                             CASE WHEN goes THEN '99999999' ELSE {_then("su", "2 + late", "R")} END AS ru, CASE WHEN goes THEN '99999999' ELSE {_then("sa", "2 + late", "R")} END AS ra
                FROM p JOIN r ON r.c = p.c AND r.i = p.i - 1)))),
             b AS (SELECT c, left(s0, 8)::BIGINT AS cost, substr(s0, 9) AS audit FROM p WHERE i = 1),
             l AS (SELECT c, unnest(range(1, length(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM b WHERE audit <> ''),
             a AS (SELECT *, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY j) AS i FROM l),
             e AS (SELECT a.c, j, letter, role, text, k, CASE WHEN letter = 'D' OR letter = 'K' AND k IN ('s', '') THEN 0 ELSE 1 END AS counts FROM a LEFT JOIN r ON r.c = a.c AND r.i = a.i AND letter <> 'I'),
             t AS (SELECT c, j, letter, role, CASE letter WHEN 'I' THEN '' ELSE text END AS text, coalesce(sum(counts) OVER (PARTITION BY c ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS odd FROM e),
             m AS (SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN odd = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS said FROM t WHERE letter <> 'D' GROUP BY c),
             g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                          count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY c)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
        FROM (SELECT DISTINCT c, conv_id FROM o) LEFT JOIN g USING (c) LEFT JOIN b USING (c) LEFT JOIN m USING (c)
    """,
}
