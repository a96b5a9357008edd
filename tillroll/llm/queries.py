"""The registered queries of the operators and of the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import ann, chat, divergence, jaccard, kneser, langid, licensing, mincut, mixing, packing, pii, quality, resample


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with private data replaced by surrogates."""
    return pii.replace(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat formatting read back, per conversation, with one conversation of control strings."""
    planted = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                        "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digest(given.unionByName(planted))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector bin packing of all documents, per piece."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents: set size and component."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights, per document."""
    return mixing.mix_digest(_table(spark, sf_dir, "documents"))


def op6_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages by minimum cut."""
    return mincut.extract(_table(spark, sf_dir, "pages"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth embedding, searched among all."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-first backoff language identification, per document."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-supervision quality rules, per document."""
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op10_kneser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated modified Kneser-Ney scores, per document."""
    return kneser.perplexities(_table(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance resampling of all documents towards the benchmark texts, per document."""
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, per document."""
    return licensing.licenses(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, over all documents."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_pii": op1_pii, "op2_chat": op2_chat, "op3_packing": op3_packing, "op4_jaccard": op4_jaccard, "op5_mixing": op5_mixing, "op6_mincut": op6_mincut, "op7_ann": op7_ann, "op8_langid": op8_langid, "op9_quality": op9_quality, "op10_kneser": op10_kneser,
            "op11_resample": op11_resample, "op12_license": op12_license, "op13_divergence": op13_divergence}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": chat.oracle(), "op5_mixing": mixing.ORACLE, "op12_license": licensing.oracle(),
            "op13_divergence": divergence.ORACLE}
