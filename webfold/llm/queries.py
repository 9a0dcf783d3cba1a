"""Registered queries of this subpackage, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, table
from .decontaminate import leak_report
from .exact_dedup import exact_dedup
from .html_extraction import extract_text
from .language_id import languages
from .line_dedup import dedup_lines
from .packing import pack
from .periodic_runs import run_report, with_planted_periods
from .quality import quality
from .set_join import near_duplicates
from .tool_calls import QUERY_SCHEMAS, as_tool_messages, link_calls
from .toxicity import toxicity
from .vector_codes import vector_codes
from .warc import read_archives, write_archives

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = shared_folder(spark, "archives")
    write_archives(pages, path)
    return (read_archives(spark, path, pages.schema["page_id"].dataType.simpleString(), payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_kept", F.sha2("text", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_calls(as_tool_messages(table(spark, sf_dir, "conversations")), QUERY_SCHEMAS)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(with_planted_periods(table(spark, sf_dir, "documents")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_warc": op4_warc,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_vector_codes": op13_vector_codes,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: crc32 of the decimal id, bit by bit: DuckDB has no function for it.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(c) AS BIGINT) for c in string_split(CAST(doc_id AS VARCHAR), '')]),
       lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, _: xor(z >> 1, 3988292384 * (z & 1)))))"""


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Assignment by inner products (whole numbers in doubles, so exact), a pair of tables a round."""
    distance = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, [floor({scale} * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT r, vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
book0 AS (SELECT p, r AS e, x AS c FROM parts WHERE r < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS (
  SELECT r, vec_id, label, p, any_value(x) AS x, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT parts.*, e, {distance} AS d FROM parts JOIN book{k} USING (p)) GROUP BY r, vec_id, label, p)""")
        if k < rounds:
            steps.append(f"""means{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c
  FROM (SELECT p, e, i, floor(sum(y) / count(*)) AS m FROM (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{k}) GROUP BY p, e, i)
  GROUP BY p, e),
book{k + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e))""")
    steps.append(f"""coded AS (
  SELECT r, vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r, vec_id, label),
digest AS (SELECT sha256(string_agg(array_to_string([CAST(CAST(y AS BIGINT) AS VARCHAR) for y in c], ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})""")
    return ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"""


ORACLE = {
    "op12_periodic_runs": rf"""
WITH docs AS (
  SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sized AS MATERIALIZED (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g, CASE WHEN len(w) > 0 THEN h // 10 % len(w) END AS a FROM docs),
sizes AS MATERIALIZED (SELECT doc_id, n, planted, g, a FROM sized),
raw AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM sized),
words AS MATERIALIZED (
  SELECT p.doc_id, p.i, r.word
  FROM (SELECT raw.doc_id, i, CASE WHEN planted AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END AS j FROM raw JOIN sizes USING (doc_id)) p
  JOIN raw r ON r.doc_id = p.doc_id AND r.i = p.j),
-- a run of four periods q holds four multiples of q in a row, with equal words
places AS (SELECT doc_id, n, q, unnest(range(0, n - 3 * q, q)) AS i FROM (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM sizes)),
first AS MATERIALIZED (SELECT s.*, word FROM places s JOIN words USING (doc_id, i)),
second AS MATERIALIZED (SELECT s.* FROM first s JOIN words b ON b.doc_id = s.doc_id AND b.i = s.i + s.q AND b.word = s.word),
third AS MATERIALIZED (SELECT s.* FROM second s JOIN words b ON b.doc_id = s.doc_id AND b.i = s.i + 2 * s.q AND b.word = s.word),
hopeful AS MATERIALIZED (SELECT DISTINCT s.doc_id, n, q FROM third s JOIN words b ON b.doc_id = s.doc_id AND b.i = s.i + 3 * s.q AND b.word = s.word),
pairs AS MATERIALIZED (SELECT h.doc_id, h.q, a.i, a.word FROM hopeful h JOIN words a USING (doc_id)),
breaks AS (
  SELECT a.doc_id, a.q, a.i FROM pairs a JOIN words b ON b.doc_id = a.doc_id AND b.i = a.i + a.q WHERE a.word <> b.word
  UNION ALL SELECT doc_id, q, -1 FROM hopeful UNION ALL SELECT doc_id, q, n - q FROM hopeful),
stretches AS (SELECT doc_id, q, i + 1 AS start, lead(i) OVER (PARTITION BY doc_id, q ORDER BY i) - i - 1 + q AS length FROM breaks),
long AS (SELECT doc_id, start, length, q AS period FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT * FROM long r WHERE NOT EXISTS (
  SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.period < r.period AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
reports AS (
  SELECT doc_id, count(*) AS n_runs, arg_max((start, length, period), (length / period, -start, -period)) AS best,
         sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed_sha256 FROM words w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period, 1000 * best[2] // best[3] AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM docs d LEFT JOIN reports USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_vector_codes": _codes_sql(),
    "op1_decontamination": rf"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, unnest([array_to_string(w[i:i + 9], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS win,
         least(len(w), 10) AS n
  FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS win
  FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT g.doc_id, g.i, g.n, s.item_id FROM grams g JOIN wins s USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY 1),
ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)), ',') AS ids FROM found GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""",
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op3_jaccard_join": rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)])) AS s
  FROM docs WHERE len(w) > 0),
nodes AS (SELECT min(doc_id) AS node, s, len(s) AS n FROM sets GROUP BY s),
tokens AS (SELECT node, n, unnest(s) AS t FROM nodes),
ranked AS (SELECT node, n, t, row_number() OVER (PARTITION BY node ORDER BY df, t) AS r
           FROM (SELECT *, count(*) OVER (PARTITION BY t) AS df FROM tokens)),
prefix AS (SELECT node, n, t FROM ranked WHERE r <= n - CAST(ceil(80 * n / 100) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.node AS x, b.node AS y FROM prefix a JOIN prefix b ON a.t = b.t AND a.node < b.node AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
links AS (SELECT x, y FROM pairs JOIN nodes a ON a.node = x JOIN nodes b ON b.node = y
          WHERE 180 * len(list_intersect(a.s, b.s)) >= 80 * (a.n + b.n)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT node, node AS label FROM nodes UNION SELECT edges.y, label FROM reach JOIN edges ON node = x),
label AS (SELECT node, min(label) AS label FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(l.label, d.doc_id) AS component_id
FROM docs d LEFT JOIN sets USING (doc_id) LEFT JOIN nodes n ON sets.s = n.s LEFT JOIN label l ON l.node = n.node""",
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, strlen(h) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS first,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(x, CAST(k // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1) for k in range(0, 32)], '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d""",
    "op5_line_dedup": r"""
WITH places AS (
  SELECT doc_id, i AS place, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
lines AS (SELECT doc_id, place, w, md5(array_to_string(w, ' ')) AS key FROM (SELECT doc_id, place, regexp_extract_all(line, '\S+') AS w FROM places) WHERE len(w) > 0),
firsts AS (SELECT key, min((doc_id, place)) AS first, any_value(w) AS w FROM lines GROUP BY key),
long AS (SELECT key, first, w, len(w) AS n FROM firsts WHERE len(w) >= 4),
cuts AS (SELECT key, first, n, gap, md5(array_to_string(list_concat(w[1:gap - 1], w[gap + 1:]), ' ')) AS rest
         FROM (SELECT *, unnest(range(1, n + 1)) AS gap FROM long)),
replaced AS (SELECT key, first > min(first) OVER (PARTITION BY n, gap, rest) AS goes FROM cuts),
longer AS (SELECT c.key, c.first > l.first AS goes FROM cuts c JOIN long l ON c.rest = l.key),
shorter AS (SELECT l.key, c.first < l.first AS goes FROM cuts c JOIN long l ON c.rest = l.key),
near AS (SELECT DISTINCT key FROM (FROM replaced UNION ALL FROM longer UNION ALL FROM shorter) WHERE goes),
kept AS (
  SELECT l.doc_id, l.place, (l.doc_id, l.place) = f.first AND near.key IS NULL AS keep
  FROM lines l JOIN firsts f USING (key) LEFT JOIN near USING (key))
SELECT d.doc_id, count(k.keep) AS n_lines, count(*) FILTER (k.keep) AS n_kept,
       sha256(coalesce(string_agg(p.line, chr(10) ORDER BY p.place) FILTER (coalesce(k.keep, true)), '')) AS kept_sha256
FROM documents d JOIN places p USING (doc_id) LEFT JOIN kept k ON k.doc_id = p.doc_id AND k.place = p.place
GROUP BY d.doc_id""",
    "op8_chat_formatting": """
WITH calls AS (
  SELECT u.conv_id, u.turn, u.text, concat('call_', u.conv_id, '_', u.turn) AS call_id, a.text AS content,
         CASE length(u.text) % 3 WHEN 0 THEN 'lookup' WHEN 1 THEN 'summarise' ELSE 'translate' END AS name,
         len(string_split(trim(u.text, ' '), ' ')) AS words, b.turn IS NULL AS begins
  FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations b ON b.conv_id = u.conv_id AND b.turn = u.turn - 2 AND b.role = 'user'
  WHERE u.role = 'user'),
chains AS (SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM calls),
checked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS level,
         CASE WHEN name = 'lookup' AND words > 30 THEN 'words is over 30' WHEN name = 'translate' THEN 'lang is missing' END AS error,
         CASE WHEN content IS NULL THEN 'unanswered' ELSE 'linked' END AS status
  FROM chains)
SELECT conv_id, turn, call_id, CAST(level AS INTEGER) AS level, status, CASE WHEN error IS NULL THEN 0 ELSE 1 END AS n_errors,
       concat('{"arguments":{"text":', CAST(to_json(text) AS VARCHAR), ',"words":', words, '},"call_id":"', call_id, '"',
              CASE WHEN content IS NULL THEN '' ELSE concat(',"content":', CAST(to_json(content) AS VARCHAR)) END,
              ',"conv_id":', conv_id, ',"errors":[', coalesce('"' || error || '"', ''), '],"level":', level, ',"name":"', name, '","status":"', status,
              '","turn":', turn, '}') AS json
FROM checked
UNION ALL
SELECT a.conv_id, a.turn, concat('call_', a.conv_id, '_', a.turn - 1), NULL, 'orphan', 0,
       concat('{"call_id":"call_', a.conv_id, '_', a.turn - 1, '","content":', CAST(to_json(a.text) AS VARCHAR), ',"conv_id":', a.conv_id,
              ',"errors":[],"status":"orphan","turn":', a.turn, '}')
FROM conversations a LEFT JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1 AND u.role = 'user'
WHERE a.role = 'assistant' AND u.conv_id IS NULL""",
    "op10_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, string_split_regex(regexp_replace(body, '<br>', ' ', 'g'), '<h1>|</h1>|<p>|</p>') AS blocks FROM a),
c AS (SELECT page_id, url, [trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))
                            for x in blocks] AS lines FROM b)
SELECT page_id, url, array_to_string([x for x in lines if x <> ''], chr(10)) AS text, length(array_to_string([x for x in lines if x <> ''], chr(10))) AS n_chars
FROM c""",
}
