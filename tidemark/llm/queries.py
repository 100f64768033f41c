"""The registered queries of this subpackage, and SQL for those that SQL can express.

Each query applies one operator, with its default parameters, to whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cotrain,
    decontaminate,
    filteraudit,
    hostrules,
    langid,
    lmscore,
    merkle,
    packing,
    piecebpe,
    rangecoder,
    secrets,
    simhash,
    sqltext,
    warc,
)
from tidemark.llm.common import saved


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(divisor: int, id_col: str = "doc_id"):
    """crc32 of the document's id as text, modulo a divisor; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lmscore.scored(table(spark, sf_dir, "documents"), remainder(5) != 1)
    return found.select(
        F.col("id").alias("doc_id"),
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, meta = table(spark, sf_dir, "documents"), ["source", "lang", "n_chars"]
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    model = cotrain.train(docs, table(spark, sf_dir, "labels"), good, meta)
    return cotrain.classified(docs, model, meta).withColumnRenamed("id", "doc_id")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def joined(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, remainder(4) != 2)
    return langid.predicted(docs, model).select(
        F.col("id").alias("doc_id"),
        (remainder(4, "id") == 2).alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        "length",
        F.col("crc32").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op9_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangecoder.round_trip(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32")
    )


def op10_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = hostrules.measured(table(spark, sf_dir, "documents"))
    # Only numbers are kept, so that the texts are measured once.
    rows = saved(measures.select("row.doc_id", "host", *hostrules.MEASURES), "measures")
    return hostrules.judged(rows, hostrules.host_verdicts(rows)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piecebpe.Model(spark)
    rows = piecebpe.decoded(piecebpe.encoded(table(spark, sf_dir, "documents"), model), model)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.expr("octet_length(ids) DIV 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # Tampering adds one to n_chars; a decimal has room for it.
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    claimed = merkle.leaf_of(*fields[:3], more, fields[4])
    leaves = docs.select(
        F.col("lang").alias("part"),
        F.col("doc_id").alias("id"),
        merkle.leaf_of(*fields).alias("leaf"),
        F.when(remainder(7) == 0, claimed).alias("claimed"),
    )
    return merkle.checked(merkle.proofs(leaves)).select(
        F.col("id").alias("doc_id"),
        merkle.text_of(F.col("leaf")).alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_cotrained_quality": op3_cotrained_quality,
    "op4_secret_scan": op4_secret_scan,
    "op5_language_id": op5_language_id,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_range_coded_ids": op9_range_coded_ids,
    "op10_host_quality_rules": op10_host_quality_rules,
    "op11_sentencepiece_bpe": op11_sentencepiece_bpe,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit,
}

SQL = {
    "op2_warc_transactions": sqltext.REVISITS.strip(),
    "op6_benchmark_decontamination": sqltext.DECONTAMINATION.strip(),
    "op10_host_quality_rules": sqltext.HOST_RULES.strip(),
    "op12_merkle_manifest": sqltext.MERKLE.strip(),
    "op13_filter_audit": sqltext.FILTER_AUDIT.strip(),
}
