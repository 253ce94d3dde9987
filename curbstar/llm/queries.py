"""The numbered operators as queries: each takes (session, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.llm import (
    collocations, filter_audit, fingerprint, html, language, minhash, mixing, neighbours, packing,
    repeats, resampling, toxicity, warc,
)
from curbstar.llm.common import crc_of, read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(read(spark, sf_dir, "documents"), least=400)
    # bytes of a character that was cut through show as U+FFFD
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return cut.select("doc_id", *repeats.digest_columns(), text)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(read(spark, sf_dir, "documents"))


def op4_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract_main_text(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), crc_of() % 3 == 1
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.with_scores(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), crc_of() % 4 == 2
    found = language.identify(docs, language.fit(docs, ~held_out), ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality_resampling": op4_quality_resampling,
    "op5_html_extraction": op5_html_extraction,
    "op6_toxicity": op6_toxicity,
    "op7_source_mixing": op7_source_mixing,
    "op8_language_id": op8_language_id,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_arc_to_warc": op12_arc_to_warc,
    "op13_collocations": op13_collocations,
}
