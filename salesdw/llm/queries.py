"""One query per text operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesdw.llm import (
    host_rules,
    id_store,
    katz,
    kmeans_tree,
    line_dedup,
    packing,
    periodic_runs,
    piece_sampling,
    simhash,
    substring,
    suffix_dedup,
    toxicity,
    whitening,
)
from salesdw.llm.common import PIECE_TOKENIZER, WORD_TOKENIZER, in_split, tokenizer_path
from salesdw.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

SEQUENCE_IDS = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    cut = packing.cut_documents(documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER), SEQUENCE_IDS)
    facts = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    packed, _ = packing.pack(staging.put(facts, "pieces"), staging, SEQUENCE_IDS)
    return packed


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), Staging(spark))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf_dir), Staging(spark), carry=["doc_id"]).select("row.*", "*").drop("row")


def repair_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    shards = staging.put(id_store.encode_shards(documents(spark, sf_dir), tokenizer_path(WORD_TOKENIZER)), "shards")
    read = id_store.decode_shards(shards).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    placed = read.join(id_store.shard_starts(shards), ["part", "shard"])
    start = (F.col("before") + F.col("shard_start")).alias("start")
    return placed.select("doc_id", start, "n_tokens", "ids_crc32")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Staging(spark).put(substring.units(documents(spark, sf_dir)), "units")
    return substring.repeated(found).drop("text_hash")


def katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", in_split(0, 10))
    scored, train_tokens = katz.score(docs, Staging(spark))
    return scored.withColumn("train_tokens", F.lit(train_tokens).cast("long"))


def lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(~in_split(2, 4)), Staging(spark))
    scored = toxicity.score(docs, model, ["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", in_split(2, 4).alias("held_out"), "score", predicted)


def gumbel_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples a document; ``decodes`` says whether the library turns the pieces into the text again."""
    path = tokenizer_path(PIECE_TOKENIZER)
    docs = documents(spark, sf_dir).withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    samples = piece_sampling.sample_segmentations(docs, path, ["doc_id", "text_crc32"], spelled=True)
    decodes = (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("decodes")
    facts = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion"]
    return samples.select(*facts, F.crc32("ids").alias("ids_crc32"), decodes)


def line_dedup_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.matching_lines(documents(spark, sf_dir), Staging(spark)).drop("text_hash")


def kmeans_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kmeans_tree.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return kmeans_tree.search(vectors, vectors.where("vec_id % 20 = 0"), Staging(spark))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(documents(spark, sf_dir), Staging(spark), carry=["doc_id"])
    n_kept = F.octet_length("kept").cast("bigint")
    return found.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - n_kept).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(documents(spark, sf_dir).select("doc_id", "text"), loop_by="doc_id")
    earlier = lambda a, b: (a["length"] > b["length"]) | (
        (a["length"] == b["length"]) & F.struct(a["start"], a["period"]).__lt__(F.struct(b["start"], b["period"]))
    )
    best = F.try_element_at(F.array_sort("runs", lambda a, b: F.when(earlier(a, b), -1).when(earlier(b, a), 1).otherwise(0)), F.lit(1))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "row.doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whitening.whiten(vectors, "embedding", Staging(spark)).select("row.vec_id", "*").drop("row")


def llm_queries() -> dict[str, Query]:
    return {
        "op1_best_fit_packing": best_fit_packing,
        "op2_substring_dedup": substring_dedup,
        "op3_simhash_near_dedup": simhash_near_dedup,
        "op4_host_quality_rules": host_quality_rules,
        "op5_katz_backoff": katz_backoff,
        "op6_lexicon_toxicity": lexicon_toxicity,
        "op7_line_dedup": line_dedup_edits,
        "op8_gumbel_piece_sampling": gumbel_piece_sampling,
        "op9_repair_id_store": repair_id_store,
        "op10_kmeans_tree": kmeans_tree_search,
        "op11_suffix_array_dedup": suffix_array_dedup,
        "op12_periodic_runs": periodic_run_detection,
        "op13_chebyshev_whitening": chebyshev_whitening,
    }
