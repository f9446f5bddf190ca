"""The registered queries of the numbered operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    chat_format, decontaminate, divergence, exact_dedup, fill_in_middle, language_id, license_scan, near_dedup, packing,
    sentence_pieces, sharding, token_counts, toxicity,
)
from marquee.llm.common import ROW, read_definition, read_table, whole_text

SHARDS = 16
#: A text with more tokens is marked.
TOKEN_LIMIT = 1024


def vocabulary(name: str) -> str:
    """Definition of one of the public tokenizers."""
    import public_tokenizers

    return read_definition(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (by doc_id) and pages (by page_id) in one table: their hosts and declarations are judged together."""
    docs, pages = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages")
    model = language_id.learn_text_model(language_id.labelled_documents(docs), language_id.LanguagePolicy())
    found = language_id.identify(docs, pages, model)
    return found.select("doc_id", "page_id", "lang", "probability", "kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"))
    return counted.select(
        "doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, labels).drop("evidence")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = near_dedup.NearPolicy(words=3, percent=85)
    found = near_dedup.near_components(read_table(spark, sf_dir, "documents"), policy)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop(ROW)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learned from four fifths of the conversations and recovered for all."""
    fold = F.crc32(F.col("conv").cast("string").cast("binary")) % 5
    return chat_format.format_chats(read_table(spark, sf_dir, "conversations"), fold != 0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP8_SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
    count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size, sha256(coalesce(text, '')) AS text_sha256
  FROM documents)
"""


#: Phrases whose every place is counted, and their labels. Fixed values.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.summary(license_scan.scan(docs, PHRASES))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_slots(read_table(spark, sf_dir, "documents"), [1.0] * SHARDS, 1.0)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


OP10_SQL = """
WITH crc_table AS (
  SELECT list(CAST(c AS UBIGINT) ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), range(8)::UBIGINT[]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
    FROM range(256) t(b))),
bytes AS (
  SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda p: CAST(('0x' || p) AS UBIGINT)) AS bs FROM documents),
crcs_of AS (
  SELECT doc_id, len(bs) + 1 AS size, CAST(xor(4294967295::UBIGINT,
    list_reduce(list_prepend(4294967295::UBIGINT, bs),
      lambda c, b: xor(c >> 8, crcs[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) AS BIGINT) AS text_crc32
  FROM bytes, crc_table),
draws AS (
  SELECT doc_id, s AS shard,
    -1.0 / ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || s), 1, 13) AS BIGINT)
      AS DOUBLE) + 0.5) / 4503599627370496.0) AS score
  FROM documents, range(17) t(s)),
placed AS (
  SELECT doc_id, CAST(first(shard ORDER BY score DESC, shard) FILTER (WHERE shard < 16) AS INT) AS shard,
    CAST(first(shard ORDER BY score DESC, shard) AS INT) AS grown_shard
  FROM draws GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM placed JOIN crcs_of USING (doc_id)
"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = """
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS d, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
vocab AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(s.total, 0) + 2 * v.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN vocab v USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
whole AS (
  SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (c.n + 2) // (s.total + 2 * v.v) AS q
  FROM kept k JOIN vocab v USING (lang)
  JOIN (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) c USING (lang, term)
  JOIN (SELECT lang, sum(n) AS total FROM counts GROUP BY ALL) s USING (lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM dense JOIN whole USING (lang, term)
  WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM results)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank FROM ranked
WHERE part = 'pair' OR r <= 10
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(read_table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(units[:least(a, b)], '') AS p, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(units[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    return sentence_pieces.encode(read_table(spark, sf_dir, "documents"), model)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_token_counts": op2_token_counts,
        "op3_toxicity": op3_toxicity,
        "op4_near_dedup": op4_near_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_chat_format": op6_chat_format,
        "op7_packing": op7_packing,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_sharding": op10_sharding,
        "op11_source_divergence": op11_source_divergence,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_sentence_pieces": op13_sentence_pieces,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_exact_dedup": OP8_SQL, "op10_sharding": OP10_SQL, "op11_source_divergence": OP11_SQL,
        "op12_fill_in_middle": OP12_SQL,
    }
