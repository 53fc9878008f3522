"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levelscope.llm import (
    bpe_codec, decontamination, language_id, license_scan, line_dedup, minhash_dedup, periodic_runs,
    quality_rules, secret_scan, sharding, spelling_variants, substring_dedup, token_counts,
)
from levelscope.llm.oracles import ORACLES
from levelscope.session import stage

#: Where the vocabulary files lie on the driver.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judged(
        documents(spark, sf_dir, "doc_id", "text", "source"), keep=["doc_id"], texts=False
    )
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_frequent_lines", "kept_words",
    )


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    # ends of spans count up, starts down
    n_hit = F.aggregate(
        F.transform("hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(documents(spark, sf_dir), keep=["doc_id", "text"])
    return found.select(
        "row.doc_id",
        F.size(F.split(F.coalesce("row.text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        "removed",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(documents(spark, sf_dir), keep=["doc_id"]).select(
        "row.doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    )
    teaches = F.when(~F.col("held_out"), F.col("lang"))
    counts = stage(language_id.word_counts(docs.select(teaches.alias("lang"), F.col("text").alias("_text"))), "words")
    found = language_id.predicted(docs, language_id.trained(counts), keep=["doc_id", "held_out"], counts=counts)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def near_duplicate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.classes(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_size", "kept")


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.with_token_counts(
        documents(spark, sf_dir), BYTE_BPE, keep=["doc_id"]
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def shard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(sharding.measured(documents(spark, sf_dir)))


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    both = bpe_codec.round_trips(docs, WORD_BPE, keep=["doc_id"])
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


def secret_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir, "doc_id", "text", "source"))
    return found.select(
        "doc_id", F.col("start").alias("first_char"), F.col("end").alias("end_char"), "score", "is_secret"
    )


def variant_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose checksum with the document's id 31 divides lose a code point; a null id alters none."""
    runs = spelling_variants.runs(documents(spark, sf_dir), keep=("doc_id",))
    mark = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary"))
    at = F.pmod(mark, F.char_length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = runs.select(F.when(mark % 31 == 0, lost).otherwise(F.col("run")).alias("word"))
    found = spelling_variants.variants(spelling_variants.counted(words))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def with_planted_period(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the documents, by the checksum of their ids, repeat some of their words to the
    end; a null id changes nothing."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    turn = F.floor(mark / 10)

    def repeated(w):
        n = F.size(w)
        first = F.pmod(turn, n)
        period = 1 + F.floor((n - first) / (3 + turn % 8))
        place = F.sequence(F.lit(0), n - 1)
        moved = F.transform(
            place, lambda i: F.get(w, F.when(i < first, i).otherwise(first + F.pmod(i - first, period)).cast("int"))
        )
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(F.lit(""))

    planted = F.element_at(F.transform(F.array(words), repeated), 1)
    return docs.withColumn("text", F.when((mark % 10 == 0) & F.col("text").isNotNull(), planted).otherwise(F.col("text")))


def periodic_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.scan(with_planted_period(documents(spark, sf_dir)), keep=["doc_id"])
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, F.concat(r.period.cast("string"), F.lit("\n"))))
    return found.withColumn("longest", longest).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir), keep=["doc_id"])

    def listed(*labels):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*labels))), ",")

    starts = F.transform("base", lambda b: b.start.cast("long"))
    base, more = (F.transform(name, lambda d: d.label) for name in ("base", "detections"))
    return found.select(
        "row.doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        listed(base).alias("base_labels"), listed(base, more).alias("labels"), "score",
    )


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # its stages use this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality_query,
        "op2_decontamination": decontamination_query,
        "op3_token_counts": token_query,
        "op4_sharding": shard_query,
        "op5_line_dedup": line_query,
        "op6_substring_dedup": substring_query,
        "op7_language_id": language_query,
        "op8_minhash_dedup": near_duplicate_query,
        "op9_bpe_round_trip": round_trip_query,
        "op10_secret_scan": secret_query,
        "op11_spelling_variants": variant_query,
        "op12_periodic_runs": periodic_query,
        "op13_license_scan": license_query,
        "pipeline": pipeline_query,
    }


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    whole = corpus_pipeline.ORACLE_SQL
    return ORACLES | ({"pipeline": whole} if whole else {})
