"""The registered queries of this package: each operator over its whole table, in the columns of its contract."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import balls, brown, decontamination, gnat, merkle, minhash, personal, pieces, secret_scan, sharding, toxicity, twins, urls, vectors
from panelspark.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def crc(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query
def op3_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", F.coalesce(crc(4) == 2, F.lit(False)))
    model = toxicity.fit(docs.filter(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded_col="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # only the text is needed here, so the written table of spans holds no texts
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.find(docs, keep=["doc_id"])
    base = F.filter("spans", lambda s: s["rank"] < 4)
    kinds = F.transform("spans", lambda s: s["kind"])
    many = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in personal.RULES]
    return found.select(
        "doc_id", *many, F.sha2(personal.listing(base), 256).alias("base_sha256"), personal.listing(F.col("spans")).alias("spans")
    )


@query
def op4_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(table(spark, sf_dir, "embeddings"))


@query
def op7_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
        ("com", "/fr/", "allow"), ("com", "/de/", "block"),
    ]
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity"
    )


@query
def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    )
    return sharding.sharded(docs, keep=["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", F.coalesce(crc(10) == 0, F.lit(False)))
    model, late = brown.fit(docs.filter(~F.col("held_out")).select("text"))
    return brown.score(docs, model, late, keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity"
    )


@query
def op9_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secret_scan.findings(docs).select(
        "doc_id", "start", "end", F.sha2("found", 256).alias("found_sha256"), "label", F.round("score", 6).alias("score"),
        (F.col("score") >= 0.5).alias("secret"),
    )


@query
def op13_merkle_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = merkle.manifest(docs, others={"tampered": ({"text": lower}, crc(5) == 0)})
    folded = merkle.fold(F.col("tampered"), F.col("up"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("up")), 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = gnat.coded(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(gnat.digest(books)))


@query
def op11_ball_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balls.top_products(table(spark, sf_dir, "embeddings"), every=50)


SQL |= {"op11_ball_trees": twins.OP11, "op12_gnat_codes": twins.OP12, "op13_merkle_intervals": twins.OP13}
