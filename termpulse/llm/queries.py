"""One query for each operator over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import page_sql
from termpulse.llm import decontaminate, exact, fertility, huffman, lm, merkle, packing, quality, repair, secrets, simhash, structure_sql, substring, warc
from termpulse.session import shared_dir

VOCABULARY, PIECES, RANKS = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Date of the landed pages, which have none of their own.
CRAWLED = "2024-01-30T06:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=1)
    digested = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    packed = packing.pack(digested)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("secrets")).alias("spans")
    )


def op4_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    huffman.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY), end_id=2)
    digest = lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    return huffman.decoded(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", digest)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.cleaned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def op7_brown_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.responses(table(spark, sf_dir, "pages"), date=F.lit(CRAWLED), keep=["page_id"])
    return warc.derive(records, keep=["page_id"]).drop("payload_digest")


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with the faults of the contract; null is one space, but in conv_id and turn only where they are hashed."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(shown("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1))))
    return turns.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = repair.repair(damaged(turns))
    rows = turns.select("conv_id").distinct().withColumn("conv", repair.conversation())
    rows = rows.join(found.summary(), "conv", "left").join(repair.digests(found.repaired()), "conv", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select(
        "conv_id",
        *map(count, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda text: merkle.leaf([*map(F.col, ("doc_id", "source", "lang", "n_chars")), text])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, leaf(F.translate("text", UPPER, LOWER)))
    rows = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    manifest = merkle.build(rows, by="source", digest="leaf", order=["doc_id"], keep=["doc_id", "tampered"])
    found = merkle.folded(merkle.proofs(manifest), F.coalesce("row.tampered", "leaf"))
    text = lambda digest: F.lower(F.hex(digest))
    return found.select(
        "row.doc_id",
        *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(text("siblings"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fertility.judged(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    base = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select(*base, "kind", "length_class", *fertility.REACH, F.array_join("outside", ",").alias("outside"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scan": op3_secret_scan,
    "op4_token_binary": op4_token_binary,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_brown_lm_scores": op7_brown_lm_scores,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_warc_derivatives": op10_warc_derivatives,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_tokeniser_fertility": op13_tokeniser_fertility,
}


def _shingles(name: str, key: str) -> str:
    """A table of the different five-word shingles of each text."""
    return rf"""
{name}_w AS (SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM {name}),
{name}_s AS (SELECT {key}, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM {name}_w)"""


END = "chr(13) || chr(10)"


def _record_id(*parts: str) -> str:
    h = "md5(" + " || chr(10) || ".join(parts) + ")"
    return f"'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-3' || {h}[14:16] || '-a' || {h}[18:20] || '-' || {h}[21:32] || '>'"


def _field(name: str, value: str) -> str:
    return f"'{name}: ' || regexp_replace({value}, '[\\r\\n]+', ' ', 'g') || {END}"


SQL = {
    "op11_conversation_repair": structure_sql.REPAIR,
    "op12_merkle_manifest": structure_sql.MERKLE,
    "op5_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (k) WHERE doc_id > f),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT a.doc_id, count(g.p) AS n_removed, string_agg(a.x, ' ' ORDER BY a.p) FILTER (g.p IS NULL) AS t
  FROM words a LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.p = a.p GROUP BY a.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op10_warc_derivatives": page_sql.with_(page_sql.SHOWN, page_sql.HREFS, f"""
texts AS (SELECT page_id, {page_sql.stripped(page_sql.plain('title'))} AS title,
  array_to_string(list_filter(list_transform(nodes, lambda n: {page_sql.stripped(page_sql.plain('n'))}), lambda n: n <> ''), chr(10)) AS text
  FROM (SELECT page_id, regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title\\s*>', 1) AS title,
    string_split(regexp_replace(html, '{page_sql.TAG}', chr(2), 'g'), chr(2)) AS nodes FROM shown)),
outlinks AS (SELECT page_id, string_agg({_field('outlink', "href || ' L a/@href'")}, '' ORDER BY pos) AS outlinks FROM links GROUP BY page_id),
r AS (SELECT page_id, url AS target_uri, {_record_id("'response'", "CAST(page_id AS VARCHAR)", "url")} AS refers_to,
  'HTTP/1.1 200 OK' || {END} || 'Content-Type: text/html; charset=utf-8' || {END} || 'Content-Length: ' || strlen(html) || {END} AS http_header,
  'sha256:' || sha256(html) AS source_payload_digest, html FROM pages),
d AS (SELECT *, 'sha256:' || sha256(http_header || {END} || html) AS source_block_digest, {_record_id("'metadata'", "refers_to")} AS metadata_id,
  {_record_id("'conversion'", "refers_to")} AS conversion_id FROM r JOIN texts USING (page_id) LEFT JOIN outlinks USING (page_id)),
b AS (SELECT *, 'metadata' AS record_type, metadata_id AS record_id, 'application/warc-fields' AS content_type,
  {_field('title', 'title')} || {_field('conversion', 'conversion_id')} || {_field('source-payload-digest', 'source_payload_digest')}
  || {_field('source-block-digest', 'source_block_digest')} || 'source-header: HTTP/1.1 200 OK' || {END}
  || 'source-header: Content-Type: text/html; charset=utf-8' || {END} || 'source-header: Content-Length: ' || strlen(html) || {END}
  || coalesce(outlinks, '') AS block FROM d
  UNION ALL SELECT *, 'conversion', conversion_id, 'text/plain; charset=utf-8', text FROM d)""") + f"""
SELECT page_id, record_type, record_id, refers_to, target_uri, '{CRAWLED}' AS warc_date, content_type, http_header,
  'sha256:' || sha256(block) AS block_digest, block, source_payload_digest, source_block_digest FROM b""",
    "op8_benchmark_decontamination": f"""
WITH {_shingles('documents', 'doc_id')}, {_shingles('benchmark', 'item_id')},
n AS (SELECT item_id, count(*) AS n_shingles FROM benchmark_s GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM documents_s JOIN benchmark_s USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared FROM shared JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
    "op6_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS rn, count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM g""",
}
