"""The operators as queries over whole tables, and their SQL where it can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowfunds.llm import (
    bpe,
    chat_format,
    decontamination,
    fingerprints,
    line_dedup,
    near_dedup,
    phrases,
    quality,
    repeat_dedup,
    source_mixing,
    spelling,
    token_files,
    toxicity,
)
from fallowfunds.llm.common import small_batches, table
from fallowfunds.sources.scratch import scratch_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
LINK_PERCENT = 85
SAID = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(SAID).alias("text"),
    )
    formatted = chat_format.format_conversations(turns.unionByName(extra), public_tokenizers.path(TOKENIZER))
    return chat_format.digests(formatted)


def op2_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    found = near_dedup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"), LINK_PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return toxicity.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return quality.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf, "documents").select("doc_id", "text"))


def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def token_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"


def op8_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    path = token_folder(spark)
    docs = table(spark, sf, "documents")
    token_files.write(token_files.encode(docs, public_tokenizers.path(TOKENIZER), END_ID), path)
    return token_files.checksums(token_files.with_starts(token_files.read(spark, path)))


def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    mixed = source_mixing.mix(docs)
    return mixed.select("doc_id", "source", "epoch", "n_tokens", "weight", "block", "order_key")


def op10_repeat_dedup(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    found = repeat_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return spelling.variants(table(spark, sf, "documents").select("doc_id", "text"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return phrases.collocations(table(spark, sf, "documents").select("text", "lang"))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_near_dedup": op2_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_ids": op8_token_ids,
    "op9_source_mixing": op9_source_mixing,
    "op10_repeat_dedup": op10_repeat_dedup,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}

_ESCAPED = r"replace(replace(replace(replace({}, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#'), '##', '#\#')"
_SPACE_FIRST = r"CAST(regexp_matches({}, '^[\t-\r\x1C-\x20\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]') AS BIGINT)"

ORACLES = {
    "op1_chat_formatting": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace({_ESCAPED.format("role")}, chr(10), '\n')) + length({_ESCAPED.format("text")})
    + {_SPACE_FIRST.format("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""",
    "op7_line_dedup": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (s.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared s ON keyed.key = s.key GROUP BY doc_id
""",
    "op5_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM sized)),
lengths AS (SELECT DISTINCT m FROM windows),
places AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, lengths WHERE len(w) >= m)),
found AS (SELECT doc_id, s, p.m AS m, item FROM places p JOIN windows b ON p.m = b.m AND p.win = b.win),
hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(s, s + m)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
""",
    # The smallest exponent on the grid at which the least of the sources is read twice at most; the
    # rest follows from it. Sums of whole numbers and rounded budgets, so engines agree.
    "op9_source_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(source, '') AS src, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n FROM documents),
sizes AS (SELECT src, CAST(sum(n) AS BIGINT) AS tokens, CAST(ceil(sqrt(count(*))) AS BIGINT) AS blocks FROM docs GROUP BY src),
span AS (SELECT max(tokens) AS most, min(tokens) AS least, sum(tokens) AS total FROM sizes WHERE tokens > 0),
grid AS (SELECT CASE WHEN ln(most / least) <= ln(2.0) THEN 0.0
    ELSE ceil((1 - ln(2.0) / ln(most / least)) * 1048576) / 1048576 END AS a FROM span),
norm AS (SELECT sum(pow(tokens / total, a)) AS z FROM sizes, span, grid WHERE tokens > 0),
budgets AS (
  SELECT src, blocks, tokens, CASE WHEN tokens > 0 THEN pow(tokens / total, a) / z ELSE 0 END AS weight,
    CAST(round(tokens * pow(tokens / most, a - 1)) AS BIGINT) AS given FROM sizes, span, grid, norm),
plans AS (
  SELECT *, CASE WHEN tokens > 0 THEN given // tokens ELSE 1 END AS passes,
    CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest FROM budgets),
placed AS (
  SELECT d.*, p.weight, p.passes, p.rest, p.tokens,
    CAST('0x' || substr(md5('7:block:' || id), 1, 8) AS BIGINT) % p.blocks AS block FROM docs d JOIN plans p ON d.src = p.src),
ends AS (
  SELECT *, sum(n) OVER (PARTITION BY src ORDER BY md5('7:order:' || passes || ':' || src || ':' || block), block) AS upto
  FROM (SELECT src, block, passes, rest, tokens, CAST(sum(n) AS BIGINT) AS n FROM placed GROUP BY ALL)),
last AS (
  SELECT src, block AS at_block, md5('7:order:' || passes || ':' || src || ':' || block) AS at_order, rest - (upto - n) AS left_over
  FROM ends WHERE tokens > 0 AND upto > rest AND upto - n <= rest),
inside AS (
  SELECT p.src, md5('7:doc:' || passes || ':' || id) AS key, left_over,
    sum(p.n) OVER (PARTITION BY p.src ORDER BY md5('7:doc:' || passes || ':' || id)) AS upto
  FROM placed p JOIN last l ON p.src = l.src AND p.block = l.at_block),
cut AS (SELECT src, max(key) AS at_key FROM inside WHERE upto <= left_over GROUP BY src),
copies AS (
  SELECT p.*, passes + CASE WHEN coalesce(
      (md5('7:order:' || passes || ':' || p.src || ':' || block), block) < (at_order, at_block)
      OR (block = at_block AND md5('7:doc:' || passes || ':' || id) <= at_key), FALSE) THEN 1 ELSE 0 END AS n_copies
  FROM placed p LEFT JOIN last l ON p.src = l.src LEFT JOIN cut c ON p.src = c.src)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, n AS n_tokens, round(weight, 9) AS weight, block,
  md5('7:order:' || epoch || ':' || src || ':' || block) || md5('7:doc:' || epoch || ':' || id) AS order_key
FROM (SELECT *, unnest(range(n_copies)) AS epoch FROM copies)
""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[s:s + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM pieces, (VALUES (1), (2), (3), (4)) sizes(m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, m, phrase, w, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON c.lang = x.lang AND array_to_string(c.w[1:k], ' ') = x.phrase
  JOIN f y ON c.lang = y.lang AND array_to_string(c.w[k + 1:], ' ') = y.phrase
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, w, f, k, unnest(range(1, m - k + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS k FROM f WHERE m > 2))
  GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM scored s JOIN total t ON s.lang = t.lang LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.phrase
WHERE i.phrase IS NULL OR CAST(100 AS HUGEINT) * i.f < CAST(80 AS HUGEINT) * a
QUALIFY rank <= 2000
""",
}
