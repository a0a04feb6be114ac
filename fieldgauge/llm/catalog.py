"""The operators' registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm import cascade, jaccard, katz, licenses, lines, minhash, mixing, nearest, packing, phrases, spelling, warc, weak
from fieldgauge.llm.frames import read, stored
from fieldgauge.session import scratch

TOKENIZER = "byte_bpe_50k.json"


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    return katz.score(docs, held).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "backoffs"
    )


def op2_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak.score(read(spark, sf_dir, "documents"), labels=read(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return cascade.apply(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", "licence", "dice", "n_matches", F.array_join("licences", ",").alias("licences")
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text, the text with its last third replaced by the next one's first code
    points, and how like their fingerprints are."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    printed = minhash.with_fingerprint(docs, F.col("text"), "fingerprint")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substr(F.col("text"), F.lit(1), n - third), F.substr(F.col("next.text"), F.lit(1), third)
    )
    both = minhash.with_fingerprint(
        minhash.next_rows(printed, "doc_id", ["text", "fingerprint"])
        .withColumn("edited", edited)
        .select("doc_id", F.length("text").cast("long").alias("n_chars"), "fingerprint", "edited", F.col("next.fingerprint").alias("following")),
        F.col("edited"),
        "edited_fingerprint",
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        minhash.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        minhash.likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    records = stored(spark, warc.read(spark, path, with_payload=False), "warc-records")
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return warc.original_bytes(records).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to_id").alias("refers_to"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_katz,
        op2_weak_quality,
        op3_quality_rules,
        op4_jaccard_join,
        op5_licences,
        op6_fingerprints,
        op7_mixing,
        op8_warc,
        op9_packing,
        op10_line_dedup,
        op11_spelling_variants,
        op12_collocations,
        op13_nearest,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = {
    "op10_line_dedup": f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), line AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM line
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op12_collocations": f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
), gram AS (
  SELECT lang, unnest(w) AS g, 1 AS k FROM cut
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM cut, unnest(range(1, len(w))) AS s(i)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3
  FROM cut, unnest(range(1, len(w) - 1)) AS s(i)
), f AS (
  SELECT lang, g, k, CAST(count(*) AS HUGEINT) AS c FROM gram GROUP BY ALL
), total AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang
), candidate AS (
  SELECT lang, g, k, c, string_split(g, ' ') AS w FROM f WHERE k > 1 AND c >= 10
), taken AS (
  SELECT DISTINCT p.lang, p.g FROM candidate p JOIN candidate t
  ON p.lang = t.lang AND p.k = 2 AND t.k = 3 AND 100 * t.c >= 50 * p.c
    AND (p.g = t.w[1] || ' ' || t.w[2] OR p.g = t.w[2] || ' ' || t.w[3])
), half AS (
  SELECT x.lang, x.g, x.c AS a, i, l.c AS l, r.c AS r, 1000000 * x.c * x.c // (l.c * r.c) AS score
  FROM candidate x, unnest(range(1, x.k)) AS s(i), f l, f r
  WHERE l.lang = x.lang AND r.lang = x.lang
    AND l.g = array_to_string(x.w[1:i], ' ') AND r.g = array_to_string(x.w[i + 1:], ' ')
), lowest AS (
  SELECT * FROM half QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM lowest WHERE (lang, g) NOT IN (SELECT (lang, g) FROM taken)
)
SELECT lang, rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
