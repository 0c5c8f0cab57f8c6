"""The registered queries of this subpackage: name -> function(spark, sf_dir), with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsieve.llm import bpe, chat, collocations, decontam, divergence, hostrank, imatch, langid, licenses, neardup, pagediff, toxicity, warc

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extract(table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrank.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.classify(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", langid.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs)).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 made of the template's own control strings."""
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.format_turns(chat.of_texts(rows)))


QUERIES = {f.__name__: f for f in (op1_imatch, op2_page_differencing, op3_byte_bpe, op4_url_filter, op5_decontaminate, op6_license_scan, op7_toxicity, op8_warc, op9_language_id, op10_minhash_neardup, op11_collocations, op12_divergence, op13_chat)}
ORACLES = {
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM q""",
    "op10_minhash_neardup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(low.other, s.doc_id)) AS component_id, least(s.doc_id, coalesce(low.other, s.doc_id)) = s.doc_id AS kept
FROM s LEFT JOIN low USING (doc_id)""",
    "op11_collocations": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p FROM (SELECT *, unnest([1, 2, 3]) AS k FROM w)),
f AS (SELECT lang, k, p, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE f >= 10),
cand AS (SELECT lang, p, f AS a, k, unnest(CASE k WHEN 2 THEN [1] ELSE [1, 2] END) AS cut FROM often WHERE k > 1),
cuts AS (SELECT *, p[1:cut] AS p1, p[cut + 1:] AS p2 FROM cand),
c AS (SELECT cuts.lang, cuts.p, a, cut, l.f AS l, r.f AS r, 1000000 * a * a // (l.f * r.f) AS score
  FROM cuts JOIN often l ON l.lang = cuts.lang AND l.p = cuts.p1 JOIN often r ON r.lang = cuts.lang AND r.p = cuts.p2),
low AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
gone AS (SELECT lang, p, max(a) AS most FROM (SELECT lang, p[1:2] AS p, a FROM low WHERE len(p) = 3 UNION ALL SELECT lang, p[2:3], a FROM low WHERE len(p) = 3) GROUP BY lang, p),
kept AS (SELECT low.* FROM low LEFT JOIN gone ON gone.lang = low.lang AND gone.p = low.p WHERE coalesce(100 * gone.most < 50 * low.a, true)),
top AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM top JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS a FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*) AS v, sum(a) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(s.n, 0)::HUGEINT AS n, coalesce(v.v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source) s USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (g.n + g.v) AS p FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM (SELECT p.*, 1 + 1000000000::HUGEINT * (a + 1) // (v.n + v.v) AS q FROM p JOIN kept USING (lang, term) JOIN v USING (lang)) WHERE c > 0 AND p > q),
all_rows AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM all_rows
QUALIFY part = 'pair' OR rank <= 200""",
    "op13_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g'), '\[(/?(?:INST|SYS|TURN|IMAGE|AUDIO|DOCUMENT)[ \]])', '[\\\1', 'g') AS escaped FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(escaped) + CASE role WHEN 'user' THEN 18 WHEN 'system' THEN 16 WHEN 'assistant' THEN 5 ELSE 19 + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
}
