"""One query per operator over its whole table, and the oracle SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.decontaminate import find_leaks
from martloom.llm.html import extract_text
from martloom.llm.language import held_out as language_held_out
from martloom.llm.language import learn as learn_languages
from martloom.llm.language import predict as predict_language
from martloom.llm.lines import drop_shared_lines
from martloom.llm.mixing import mix_sources, mix_sql
from martloom.llm.neardup import duplicate_groups
from martloom.llm.negatives import hard_negatives
from martloom.llm.quality import judge
from martloom.llm.texts import table
from martloom.llm.tokens import Tokenizer, count_tokens
from martloom.llm.toxicity import held_out as toxicity_held_out
from martloom.llm.toxicity import learn as learn_toxicity
from martloom.llm.toxicity import score_toxicity
from martloom.llm.trie import prefix_trie, spliced, turns_of
from martloom.llm.urls import judge_urls
from martloom.llm.warc import read_archives, write_archives
from martloom.session import cut_lineage, scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_near_duplicates(spark: SparkSession, base: str) -> DataFrame:
    return duplicate_groups(table(spark, base, "documents"))


@query
def op2_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    return judge(table(spark, base, "documents"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"

ORACLES["op1_near_duplicates"] = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc, place) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc, b FROM reached JOIN edges ON place = a),
groups AS (SELECT doc, min(place) AS component FROM reached GROUP BY doc)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component AS component_id, doc_id = component AS kept
FROM documents JOIN groups ON doc = doc_id LEFT JOIN sizes USING (doc_id)
"""

ORACLES["op2_quality_rules"] = rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (SELECT doc_id, pos, array_to_string(w[pos:pos+4], ' ') AS seen FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS pos FROM words)),
twice AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, seen) > 1),
repeats AS (SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words FROM twice, range(5) r(k) GROUP BY doc_id),
facts AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(text, '\p{{Lu}}')) AS capitals,
  len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS lettered,
  len(list_filter(range(1, len(w)), lambda i: w[i] = w[i+1])) AS doubled
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 10 * n_symbols <= n_words AND (n_dup_lines < 3 OR 10 * n_dup_lines <= 3 * n_lines) AND 10 * doubled <= 3 * n_words
  AND 2 * n_words <= word_chars AND word_chars <= 15 * n_words AND 10 * capitals <= 3 * word_chars AND 10 * lettered >= 5 * n_words AS kept
FROM judged
"""

ORACLES["op4_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS largest FROM payloads)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(h, ((i // 8) * 10 + 1)::BIGINT, 10))::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN largest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN largest <> page_id THEN largest END AS refers_to
FROM first
"""


@query
def op3_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    return (drop_shared_lines(table(spark, base, "documents"))
            .select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")))


ORACLES["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op6_mixing(spark: SparkSession, base: str) -> DataFrame:
    return mix_sources(table(spark, base, "documents")).drop("source")


ORACLES["op6_mixing"] = mix_sql()


@query
def op9_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return find_leaks(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query
def op10_language_id(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    trees = learn_languages(docs.filter(~language_held_out(F.col("doc_id"))))
    return predict_language(docs, trees).withColumn("held_out", language_held_out(F.col("doc_id")))


@query
def op8_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    model = learn_toxicity(docs.filter(~toxicity_held_out(F.col("doc_id"))), table(spark, base, "labels"))
    return score_toxicity(docs, model).withColumn("held_out", toxicity_held_out(F.col("doc_id")))


@query
def op4_warc(spark: SparkSession, base: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_archives(table(spark, base, "pages"), folder)
    return read_archives(spark, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_url_filter(spark: SparkSession, base: str) -> DataFrame:
    return judge_urls(table(spark, base, "pages"))


@query
def op5_html_text(spark: SparkSession, base: str) -> DataFrame:
    return extract_text(table(spark, base, "pages"))


@query
def op11_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    vectors = table(spark, base, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0).drop("positive_rank")


ORACLES["op11_hard_negatives"] = """
WITH whole AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
windows AS (SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INTEGER AS rank,
  negative_id, positive_score, negative_score
FROM windows QUALIFY rank <= 10
"""


@query
def op12_prefix_trie(spark: SparkSession, base: str) -> DataFrame:
    turns = cut_lineage(turns_of(table(spark, base, "conversations")))
    return prefix_trie(spliced(turns), turns.filter("number = 1").select("conv"))


ORACLES["op12_prefix_trie"] = """
WITH said AS (SELECT conv_id AS c, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS whole,
    strlen(coalesce(text, ''))::BIGINT AS bytes FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'h': sha256(whole), 'b': bytes} ORDER BY turn NULLS FIRST, substr(sha256(whole), 1, 32)) AS turns FROM said GROUP BY c),
heads AS (SELECT c, turns, ((4294967295 - list_reduce(flatten(list_transform(range(1, len(c::VARCHAR) + 1),
    lambda i: [ascii(substr(c::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END, 4294967295)) % 9)::BIGINT AS h FROM own),
rebuilt AS (SELECT x.c, list_concat(coalesce(b.turns, [])[1:x.h], x.turns[x.h + 1:]) AS turns FROM heads x LEFT JOIN own b ON b.c = x.c - x.c % 5),
places AS (SELECT c, len(turns) AS n, d, list_transform(turns[1:d], lambda t: t.h) AS prefix, CASE WHEN d > 0 THEN turns[d].b ELSE 0 END AS bytes
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256 FROM places GROUP BY prefix, d),
children AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
filled AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, d)),
under AS (SELECT prefix[1:up] AS prefix, up AS d, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM filled) GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, u.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM filled f JOIN under u USING (prefix, d) LEFT JOIN nodes p ON p.prefix = f.prefix[1:f.d - 1] AND p.d = f.d - 1
"""


@query
def op13_token_counts(spark: SparkSession, base: str) -> DataFrame:
    tokenizer = Tokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    counted = count_tokens(table(spark, base, "documents"), tokenizer, scratch_path(spark, "token-counts"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
