"""The operators' queries on the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversations, decontaminate, jaccard, language_model, licenses, line_dedup, oracles, packing, pii, quality, rules, secrets, spelling, toxicity
from tidemark.llm.common import fold, table
from tidemark.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Where ``predicted`` turns to 1.
PREDICT_AT = 0.3


def query(name: str, oracle: str | None = None):
    def register(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def _predicted(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.withColumns({"held_out": fold(F.col("doc_id"), folds) == held_out, "predicted": (F.col("score") >= PREDICT_AT).cast("int")})


@query("op1_quality_crf")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model).withColumn("n_bad_lines", F.size("bad_lines")).drop("bad_lines")
    return _predicted(scored, quality.FOLDS, quality.HELD_OUT)


@query("op2_fuzzy_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    gone = line_dedup.removed_lines(docs).groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    found = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n_lines")).join(gone, "doc_id", "left")
    return found.select("doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).alias("n_removed"), F.coalesce(F.array_join("lines", ","), F.lit("")).alias("lines_removed"))


@query("op3_toxicity_crf")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model).withColumn("spans", F.to_json("spans"))
    return _predicted(scored, toxicity.FOLDS, toxicity.HELD_OUT)


@query("op4_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"))
    return packing.assign_sequences(cut_lineage(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")))


@query("op6_license_digests", licenses.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op8_pii_boosted")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan_pii(docs, pii.fit_pii(docs))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    return rules.apply_rules(docs, rules.log_ratios(docs, trusted))


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_spelling_variants", oracles.spelling_variants())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), spelling.DAMAGE)


@query("op12_log_bilinear_lm")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), language_model.FOLDS) == language_model.HELD_OUT, F.lit(False))
    scored = language_model.score_texts(docs, *language_model.fit_model(docs.filter(~held_out)))
    return scored.withColumn("held_out", held_out)


@query("op13_conversation_repair", oracles.conversation_repair())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.summarize_repairs(conversations.damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone"))
