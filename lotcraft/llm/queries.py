"""The operators over the test tables: one query each, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from lotcraft.llm import (
    bloom_lm, centroid_langid, curriculum, prefix_trie, quality_lines, simhash_tiles, string_tiling, suffix_index,
    super_kmers, surrogates, token_align, token_files, warc_derive,
)


# A deployment passes its own secret.
SURROGATE_KEY = "test tables"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.clean_lines(_table(spark, sf_dir, "documents"), with_text=False)


def op2_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_groups(_table(spark, sf_dir, "documents"))


def op5_curriculum_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mixture(_table(spark, sf_dir, "documents"))


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(_table(spark, sf_dir, "documents"))


def op7_centroid_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_langid.learn_and_identify(_table(spark, sf_dir, "documents"))


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(_table(spark, sf_dir, "documents"), key=SURROGATE_KEY)


def op10_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derive.build(_table(spark, sf_dir, "pages")).withColumnRenamed("source_id", "page_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_kmers.drop_repeats(_table(spark, sf_dir, "documents"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_lines, op2_suffix_index, op3_token_files, op4_simhash_tiles, op5_curriculum_mixture, op6_bloom_lm,
        op7_centroid_langid, op8_string_tiling, op9_surrogates, op10_warc_derive, op11_prefix_trie, op12_super_kmers,
        op13_token_align)
}
ORACLES: dict[str, str] = {
    "op5_curriculum_mixture": curriculum.MIXTURE_SQL.format(documents="documents"),
    "op11_prefix_trie": prefix_trie.TRIE_SQL.format(conversations="conversations"),
    "op12_super_kmers": super_kmers.WINDOWS_SQL.format(documents="documents"),
}
