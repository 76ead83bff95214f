"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sevlab.llm import blob_ledger, crf_pii, jaccard_join, jump_shards, latent_leaks, license_templates, mcd_rules, oracles, piece_codec, slot_negatives, temperature_mix, token_blocks, turn_repair, unit_dedup
from sevlab.llm.common import documents


def op1_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_rules.judge(documents(spark, sf_dir))


def op2_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_leaks.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_pii.find(documents(spark, sf_dir))


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.assign(documents(spark, sf_dir))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.mixture(documents(spark, sf_dir))


#: The vocabulary file of op6 and the id that ends a document.
TOKENIZER_FILE, END_ID = "word_bpe_49k.json", 2


def op6_patched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    segments = token_blocks.write_segments(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER_FILE), END_ID)
    return token_blocks.read_documents(segments)


def op7_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_runs(documents(spark, sf_dir))


def op8_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.secrets(documents(spark, sf_dir))


def op9_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))


def op10_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan(documents(spark, sf_dir))


def op11_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: The model file of op12.
PIECE_FILE = "piece_bpe_32k.model"


def op12_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_codec.round_trips(documents(spark, sf_dir), piece_codec.read_model(public_tokenizers.path(PIECE_FILE)))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.audits(turn_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mcd_quality": op1_mcd_quality,
    "op2_latent_leaks": op2_latent_leaks,
    "op3_crf_pii": op3_crf_pii,
    "op4_jump_shards": op4_jump_shards,
    "op5_temperature_mix": op5_temperature_mix,
    "op6_patched_blocks": op6_patched_blocks,
    "op7_repeated_units": op7_repeated_units,
    "op8_blob_ledger": op8_blob_ledger,
    "op9_signature_join": op9_signature_join,
    "op10_license_dice": op10_license_dice,
    "op11_slot_negatives": op11_slot_negatives,
    "op12_piece_rounds": op12_piece_rounds,
    "op13_turn_repair": op13_turn_repair,
}
ORACLES: dict[str, str] = {
    "op4_jump_shards": oracles.OP4,
    "op5_temperature_mix": oracles.OP5,
    "op8_blob_ledger": oracles.op8(),
    "op9_signature_join": oracles.OP9,
    "op10_license_dice": oracles.op10(),
    "op11_slot_negatives": oracles.OP11,
    "op13_turn_repair": oracles.OP13,
}
