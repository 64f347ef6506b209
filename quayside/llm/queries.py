"""One registered query per operator, over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import conversation_repair, decontamination, hard_negatives, mixing, oracles, packing, quality, secrets, sharding, simhash, suffix_dedup, token_files, toxicity, url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str | None] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


END_ID = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        ORACLES[name] = oracle
        return build

    return register


@query("op1_suffix_dedup", oracles.REPEATS)
def op1_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_secrets", oracles.SECRETS)
def op3_secrets(spark, sf_dir):
    return secrets.secret_report(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")


@query("op4_decontamination", oracles.LEAKS)
def op4_decontamination(spark, sf_dir):
    report = decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.withColumnRenamed("_id", "doc_id").drop("_h")


@query("op5_quality")
def op5_quality(spark, sf_dir):
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.quality_report(table(spark, sf_dir, "documents"), trusted)


@query("op6_mixing")
def op6_mixing(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    read = token_files.encoded(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_simhash")
def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select(F.col("_id").alias("doc_id"), simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_url_rules", oracles.URLS)
def op10_url_rules(spark, sf_dir):
    return url_rules.url_verdicts(table(spark, sf_dir, "pages"), [*url_rules.LISTED, *url_rules.UNLISTED])


@query("op11_hard_negatives", oracles.NEGATIVES)
def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", shifted.alias("label"), "embedding"), F.col("id") % 50 == 0)


@query("op12_packing")
def op12_packing(spark, sf_dir):
    return packing.packed(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


@query("op13_conversation_repair")
def op13_conversation_repair(spark, sf_dir):
    report = conversation_repair.repair_report(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
    return report.withColumnRenamed("sha256", "repaired_sha256")
