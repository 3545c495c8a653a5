"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxvigil.llm import (
    decontamination, divergence, edit_prints, licences, lm_scoring, neighbours, oracles, packing, passages, quality, sharding,
    simhash, target_sampling, toxicity,
)
from rxvigil.session import written_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """Where the ranks of the 50k byte-level BPE lie; with :func:`added_tokens` their ids equal ``byte_bpe_50k.json``'s."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """The strings in ``byte_bpe_50k.json`` that are one id wherever they stand."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with conditions are not supported")
    return {t["content"]: t["id"] for t in tokens}


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = _table(spark, sf_dir, "labels").filter("quality = 1")
    return lm_scoring.score(_table(spark, sf_dir, "documents"), targets)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"), shingle=3, threshold=2)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), byte_bpe(), added=added_tokens())
    return pieces.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found, classes = passages.repeated_passages(docs)

    def names(side: str, alias: str) -> DataFrame:
        return classes.select(F.col("text_hash").alias(f"text_{side}"), F.col("class_id").alias(alias))

    pairs = found.join(names("a", "other_doc_id"), "text_a").join(names("b", "doc_id"), "text_b").select(
        "doc_id", "other_doc_id", "first_b", "past_b", "first_a", "past_a", "n_same", "similarity", F.lit(False).alias("copy")
    )
    many = classes.filter((F.col("n_copies") > 1) & (F.col("n_words") >= passages.Settings.least))
    copies = docs.select("doc_id", passages.text_hash("text").alias("text_hash")).join(many, "text_hash")
    zero, words = F.lit(0), F.col("n_words")
    copies = copies.filter(F.col("doc_id") != F.col("class_id")).select(
        "doc_id", "class_id", zero, words, zero, words, words, F.lit(1.0), F.lit(True)
    )
    return pairs.union(copies)


def quarter(key: str = "doc_id"):
    """crc32 of the key as text, modulo 4; rows with 2 are held out, those with 3 calibrate."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


TOXIC_FROM = 0.3


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learnt from, with the mark of those that calibrate."""
    labels = _table(spark, sf_dir, "labels").filter(quarter() != 2)
    return labels.select("doc_id", "toxic", (quarter() == 3).alias("calibrates"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity_labels(spark, sf_dir))
    return toxicity.apply(docs, model, carry=["doc_id"]).select(
        "doc_id",
        F.coalesce(quarter() == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "evidence",
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many documents are drawn as, by the labels, are good."""
    labels = _table(spark, sf_dir, "labels")
    share = labels.agg(F.avg("quality")).first()[0] or 0.0
    return quality.resample(_table(spark, sf_dir, "documents"), labels.filter("quality = 1"), share)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs).select(
        "doc_id",
        "size",
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("places", lambda p: p["base"])

    def labels(places):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["similarity"])), F.lit(0.0)).alias("score"),
        F.transform(
            F.filter("places", lambda p: ~p["base"]),
            lambda p: F.struct(p["label"].alias("label"), p["first"].alias("first"), p["past"].alias("past"), p["errors"].alias("errors")),
        ).alias("notices"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = written_table(decontamination.build_index(_table(spark, sf_dir, "documents")), "positional-index")
    found = decontamination.search(index, _table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("phrases", lambda p: p["item_id"])))
    words = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        words.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size(F.array_distinct(F.transform("near", lambda p: p["item_id"]))).cast("long").alias("n_near_items"),
    )


def op11_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_sampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_prints.edited_likeness(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_passages": op4_passages,
    "op5_toxicity": op5_toxicity,
    "op6_neighbours": op6_neighbours,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_licences": op9_licences,
    "op10_decontamination": op10_decontamination,
    "op11_target_sampling": op11_target_sampling,
    "op12_edit_prints": op12_edit_prints,
    "op13_divergence": op13_divergence,
}

#: Queries that SQL can express on whole tables.
ORACLES: dict[str, str] = {
    "op11_target_sampling": oracles.OP11_TARGET_SAMPLING,
    "op13_divergence": oracles.OP13_DIVERGENCE,
}
