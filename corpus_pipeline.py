"""A training corpus from raw documents: five stages, each on all that the one before has kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesdw.llm import host_rules, line_dedup, packing, simhash, substring
from salesdw.llm.common import WORD_TOKENIZER, tokenizer_path
from salesdw.llm.queries import SEQUENCE_IDS
from salesdw.staging import Staging

KEPT_CHUNKS = 100_000

# Fingerprints, sampled choices and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


_staged: list[Staging] = []


def _staging(spark: SparkSession, docs: DataFrame) -> Staging:
    """A folder for one stage's tables. Those of earlier stages go as soon as a stage starts on rows that do not read them,
    as their results are written by then."""
    files = docs.inputFiles()
    for old in [one for one in _staged if not any(one.path in file for file in files)]:
        if old.spark.sparkContext._jsc and old.spark.sparkContext.applicationId == spark.sparkContext.applicationId:
            old.release()
        _staged.remove(old)
    _staged.append(Staging(spark))
    return _staged[-1]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep; the others go."""
    return host_rules.judge(docs, _staging(spark, docs)).where("kept").select("row.*")


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line matches within one edit."""
    return line_dedup.remove_lines(docs, _staging(spark, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest doc_id, then the text's hash; nulls last."""
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("row")
    keyed = substring.with_text_hash(docs.select(others, "text"), "_hash")
    keyed = keyed.withColumn("_key", substring.document_name("row.doc_id", "_hash"))
    key = F.struct(F.col("row.doc_id").isNull().alias("unnamed"), "row.doc_id", F.col("_hash").alias("text_hash")).alias("key")
    found = simhash.near_duplicates(keyed.select(key, "text"), _staging(spark, docs), key="key")
    kept = found.where("key = component").select(substring.document_name("key.doc_id", "key.text_hash").alias("_key"))
    stayed = keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key"])
    return stayed.select(*[F.col("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines and sentences that stand in an earlier place."""
    return substring.remove_repeats(docs, _staging(spark, docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    staging = _staging(spark, docs)
    # The other stages run in the same Python workers, beside what these keep.
    cut = packing.cut_documents(docs, tokenizer_path(WORD_TOKENIZER), SEQUENCE_IDS, chunks=KEPT_CHUNKS)
    facts = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(staging.put(facts, "pieces"), staging, SEQUENCE_IDS)[0]


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    staging = Staging(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = staging.put(stage(spark, docs, sf_dir), f"stage-{number + 1}")
    return docs
