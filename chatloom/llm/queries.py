"""The operators over whole tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, divergence, fixity, language, licenses, main_text, packing, quality
from . import sentence_pieces, sharding, simhash, spans, vafile
from .tables import Scratch

SHARDS = 16
NEIGHBOURS = 5
# One vector in so many is a query.
QUERY_STEP = 50
PAGES_PER_FILE = 1024
# Of so many pages one is changed, one lost and one cut short in the replica.
DAMAGE_STEP = 97
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), SHARDS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(_table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(_table(spark, sf_dir, "pages"))


def op5_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as archive records, audited against a replica with damage to some."""
    key, url, html = F.col("page_id"), F.col("url"), F.coalesce("html", F.lit(""))
    residue = F.coalesce(key % DAMAGE_STEP, F.lit(0))
    harmed = (
        F.when(residue == 1, F.concat(F.lit("\x01"), F.substring(html, 2, 2**31 - 1)))
        .when(residue == 3, F.substring(html, F.lit(1), F.floor(F.length(html) / 2).cast("int")))
        .otherwise(html)
    )
    record, copy = fixity.warc_record(key, url, html), fixity.warc_record(key, url, harmed)
    scratch = Scratch(spark, "archive")
    rows = _table(spark, sf_dir, "pages").select(
        F.floor(F.coalesce(key, F.lit(-1)) / PAGES_PER_FILE).cast("bigint").alias("file"),
        "page_id",
        F.monotonically_increasing_id().alias("row"),
        F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record, 256).alias("digest"),
        F.octet_length(copy).cast("bigint").alias("copy_length"),
        F.when(residue != 2, F.sha2(copy, 256)).alias("copy_digest"),
    )
    rows = scratch.put(rows, "records")
    laid = scratch.put(fixity.laid_out(rows, ["page_id", "row"], "archive"), "laid")
    replica = laid.filter("copy_digest is not null").select(
        "file", "start", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest")
    )
    found = fixity.audit(laid, replica)
    return found.join(laid.select("file", "start", "page_id"), ["file", "start"], "left").select(
        "page_id", "file", "start", "length", "digest", "replica_length", "replica_digest", "state"
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.nearest(
        _table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, NEIGHBOURS
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.contaminated_spans(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


def op10_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_scores(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), learned=True
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(TOKENIZER),
        public_tokenizers.path(PIECES),
    )


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    encoded = sentence_pieces.encode_texts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)
    )
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_sharding, op2_license_scan, op3_simhash, op4_main_text, op5_fixity, op6_nearest,
        op7_decontamination, op8_quality, op9_packing, op10_language_scores,
        op11_alignment, op12_sentence_pieces, op13_divergence,
    )
    return {f.__name__: f for f in listed}
