"""The corpus operators as queries ``(spark, folder) -> DataFrame`` over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import conversation_repair, hard_negatives, vector_copies
from tallybook.llm.best_fit_packing import packed_documents
from tallybook.llm.decontamination import contamination
from tallybook.llm.exact_dedup import exact_duplicates
from tallybook.llm.gru_lm import scores
from tallybook.llm.jaccard_join import components
from tallybook.llm.language_id import languages
from tallybook.llm.license_scan import licenses
from tallybook.llm.token_planes import round_trip
from tallybook.llm.toxicity import toxicity
from tallybook.llm.warc import round_trip as warc_round_trip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op6_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(_table(spark, folder, "documents")).drop("text_key")


ORACLES["op8_exact_dedup"] = """
    WITH rows AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           doc_id = first_value(doc_id) OVER best AS kept,
           sha256(norm) AS text_sha256
    FROM rows
    WINDOW best AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


ORACLES["op10_decontamination"] = """
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
    ),
    item_words AS (
        SELECT item_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
        FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)
    ),
    item_windows AS (
        SELECT DISTINCT item_id, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win
        FROM (SELECT item_id, words, least(10, len(words)) AS size,
                     unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos
              FROM item_words WHERE len(words) > 0)
    ),
    sizes AS (SELECT DISTINCT size FROM item_windows),
    found AS (
        SELECT d.doc_id, d.pos, i.size, i.item_id
        FROM (SELECT doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS win
              FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
                    FROM doc_words, sizes WHERE len(words) >= size)) d
        JOIN item_windows i ON d.size = i.size AND d.win = i.win
    ),
    hit AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id
    ),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return components(_table(spark, folder, "documents")).drop("text_key")


ORACLES["op9_jaccard_join"] = """
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + 3), ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS pos
              FROM words WHERE len(words) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    meets AS (
        SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common
        FROM shingles l JOIN shingles r ON l.shingle = r.shingle AND l.doc_id <> r.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM meets o JOIN sizes x ON o.a = x.doc_id JOIN sizes y ON o.b = y.doc_id
        WHERE 100 * common >= 85 * (x.n + y.n - common)
    ),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    )
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
"""


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return languages(_table(spark, folder, "documents"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc_round_trip(_table(spark, folder, "pages"))


ORACLES["op4_warc"] = """
    WITH payloads AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest FROM pages
    ),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least_id FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id > least_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id > least_id THEN least_id END AS refers_to
    FROM firsts
"""


@query
def op5_gru_lm(spark: SparkSession, folder: str) -> DataFrame:
    return scores(_table(spark, folder, "documents"))


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses(_table(spark, folder, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.relabelled(hard_negatives.participants(_table(spark, folder, "embeddings")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
    WITH given AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    pairs AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
        FROM given a JOIN given r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.vec) = len(r.vec)
    ),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    ),
    negatives AS (
        SELECT anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
        FROM positives p JOIN pairs n USING (anchor_id)
        WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 10
"""


@query
def op12_itq_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return vector_copies.near_copies(_table(spark, folder, "embeddings"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(_table(spark, folder, "conversations"))
    return conversation_repair.repair(rows).summary


ORACLES["op13_conversation_repair"] = """
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
        FROM conversations
    ),
    hashed AS (
        SELECT *, xor(list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT),
                             list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(key[i]) AS BIGINT))),
                lambda c, b: list_reduce(
                    list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
            CAST(4294967295 AS BIGINT)) % 20 AS kind
        FROM given
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed)
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged
    ),
    faulty AS (
        SELECT conv_id, turn, role, text, place, role[1] AS letter,
               lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1] AS neighbours,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
        FROM placed
    ),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
        FROM faulty GROUP BY conv_id
    ),
    walk AS (
        -- cheapest cost, audit and lines after nothing (e), a system (s), a user (u) and an assistant turn (a)
        SELECT conv_id, CAST(0 AS BIGINT) AS place,
               {'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS e,
               {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS s,
               {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS u,
               {'c': CAST(1000000000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS a
        FROM (SELECT DISTINCT conv_id FROM given)
        UNION ALL
        SELECT conv_id, place,
               {'c': e.c + 3, 'a': e.a || 'D', 't': e.t},
               list_sort([{'c': s.c + 3, 'a': s.a || 'D', 't': s.t},
                          {'c': e.c + keeps_s, 'a': e.a || 'K', 't': list_append(e.t, line)}])[1],
               list_sort([{'c': u.c + 3, 'a': u.a || 'D', 't': u.t},
                          {'c': e.c + as_u, 'a': e.a || edit_u, 't': list_append(e.t, line_u)},
                          {'c': s.c + as_u, 'a': s.a || edit_u, 't': list_append(s.t, line_u)},
                          {'c': a.c + as_u, 'a': a.a || edit_u, 't': list_append(a.t, line_u)}])[1],
               list_sort([{'c': a.c + 3, 'a': a.a || 'D', 't': a.t},
                          {'c': u.c + as_a, 'a': u.a || edit_a, 't': list_append(u.t, line_a)}])[1]
        FROM (
            SELECT conv_id, place, line, line_u, line_a, edit_u, edit_a, keeps_s, as_u, as_a, e, s, u,
                   list_sort([a, {'c': u.c + 2, 'a': u.a || 'I', 't': list_append(u.t, 'assistant:')}])[1] AS a
            FROM (
                SELECT f.conv_id, f.place, e, s, a, role || ':' || text AS line,
                       CASE WHEN letter = 'u' THEN role ELSE 'user' END || ':' || text AS line_u,
                       CASE WHEN letter = 'a' THEN role ELSE 'assistant' END || ':' || text AS line_a,
                       CASE WHEN letter = 'u' THEN 'K' ELSE 'R' END AS edit_u,
                       CASE WHEN letter = 'a' THEN 'K' ELSE 'R' END AS edit_a,
                       CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 1 ELSE 0 END AS must,
                       must + CASE WHEN letter = 's' THEN 0 ELSE 1000000000 END AS keeps_s,
                       must + CASE WHEN letter = 'u' THEN 0 ELSE 2 END AS as_u,
                       must + CASE WHEN letter = 'a' THEN 0 ELSE 2 END AS as_a,
                       list_sort([u, {'c': e.c + 2, 'a': e.a || 'I', 't': list_append(e.t, 'user:')},
                                  {'c': s.c + 2, 'a': s.a || 'I', 't': list_append(s.t, 'user:')},
                                  {'c': a.c + 2, 'a': a.a || 'I', 't': list_append(a.t, 'user:')}])[1] AS u
                FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1
            )
        )
    ),
    ends AS (
        SELECT conv_id, place, e, s, a, list_sort([u, {'c': e.c + 2, 'a': e.a || 'I', 't': list_append(e.t, 'user:')},
                                                   {'c': s.c + 2, 'a': s.a || 'I', 't': list_append(s.t, 'user:')}])[1] AS u
        FROM walk
    ),
    best AS (
        SELECT conv_id, place, list_sort([e, a, {'c': u.c + 2, 'a': u.a || 'I', 't': list_append(u.t, 'assistant:')}])[1] AS way
        FROM ends
    )
    SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.c AS cost, way.a AS audit,
           sha256(array_to_string(way.t, chr(10))) AS repaired_sha256
    FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
    WHERE b.place = coalesce(n, 0)
"""
