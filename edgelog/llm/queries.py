"""One query per operator over its whole table, and the SQL it must equal where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edgelog.llm import (
    byte_bpe, chat, collocations, decontaminate, exact_dedup, filter_audit, html_text, quality, shared, simhash, token_files, toxicity, url_filter,
    warc,
)

#: Where the public vocabulary lies; the operators take any path.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shared.ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(_table(spark, sf_dir, "pages"))


ORACLES["op1_url_filter"] = """
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages
), parsed AS (
  SELECT page_id,
    CASE WHEN mark = 0 THEN '' ELSE translate(regexp_extract(substr(url, mark + 3), '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
    CASE WHEN mark = 0 THEN '' ELSE regexp_extract(substr(url, mark + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM cut
), rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), judged AS (
  SELECT p.page_id, p.host, p.path,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS said
  FROM (SELECT *, row_number() OVER () AS row FROM parsed) p
  LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.row, p.page_id, p.host, p.path
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN
  regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|cheap|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(chat.with_probe(_table(spark, sf_dir, "conversations")))


ORACLES["op4_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM rows
), turns AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before,
    length(replace(replace(replace(role, '\', '\s'), '<', '\l'), '#', '\h')) AS role_chars,
    length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '#', '\h')) AS text_chars FROM sized
), told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS said,
    coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS loss,
    sum(text_chars + CASE WHEN before IS NOT DISTINCT FROM role THEN 6 ELSE role_chars + 18 END) AS chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars FROM told
"""


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(_table(spark, sf_dir, "pages"))


ORACLES["op5_warc"] = """
WITH held AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), sized AS (
  SELECT page_id, payload, octet_length(payload) AS payload_bytes,
    max(page_id) OVER (PARTITION BY payload) AS kept FROM held
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM sized
"""


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(_table(spark, sf_dir, "pages"))


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(_table(spark, sf_dir, "documents"))


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(_table(spark, sf_dir, "documents"))


ORACLES["op10_exact_dedup"] = """
WITH spaced AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS normal FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(normal) AS text_sha256
FROM spaced WINDOW same AS (PARTITION BY normal)
"""


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=100, top=2000)


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS p FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3), (4), (5)) t(k) WHERE len(w) >= k)
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE len(p) = 1 GROUP BY lang
), counts AS (
  SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, t.n,
    CAST(1000 AS HUGEINT) * c.f * t.n // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM counts WHERE len(p) > 1) c
  JOIN counts l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, k)
  JOIN counts r ON r.lang = c.lang AND r.p = list_slice(c.p, k + 1, len(c.p))
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
  SELECT lang, list_slice(p, i, i + k - 1) AS p, max(f) AS most FROM (
    SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i FROM counts, (VALUES (2), (3), (4)) t(k) WHERE len(p) > k)
  GROUP BY ALL
), told AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.p = b.p
  WHERE i.most IS NULL OR 100 * i.most < 100 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score FROM told
QUALIFY rank <= 2000
"""


@_query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), end=1)


@_query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM texts
), said AS (
  SELECT doc_id, max(coalesce(CAST(quality = 1 AS INT), 0)) AS good, max(coalesce(CAST(toxic = 1 AS INT), 0)) AS toxic FROM labels GROUP BY doc_id
), masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS INT) AS mask
  FROM split LEFT JOIN said USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask
), letters(f, name) AS (
  VALUES (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D'), (4, 'E')
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o, a.name || b.name || c.name || d.name || e.name AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, o[step] AS f, coalesce(list_sum([1 << x FOR x IN o[1:step - 1]]), 0)::INT AS before
  FROM orders, range(1, 6) s(step)
), told AS (
  SELECT part, filter_order, step, f,
    sum(docs) FILTER (mask & (before | (1 << f)) = 0) AS kept,
    sum(docs) FILTER (mask & before = 0 AND mask & (1 << f) <> 0) AS removed,
    sum(docs) FILTER (mask & before <> 0 AND mask & (1 << f) <> 0) AS redundant,
    sum(docs) FILTER (mask = 1 << f) AS unique_fails,
    sum(good) FILTER (mask & before = 0 AND mask & (1 << f) <> 0) AS good_lost,
    sum(toxic) FILTER (mask & before = 0 AND mask & (1 << f) <> 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM told
"""
