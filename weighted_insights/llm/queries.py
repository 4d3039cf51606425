"""The registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fertility, gridcodes, hyperminhash, lattice, licenses, linecrf, lm, middle, packing, pii, sharding, warc
from .registry import QUERIES, SQL_TWINS, query
from .text import read_table

__all__ = ["QUERIES", "SQL_TWINS"]


@query("op1_semi_markov_pii")
def op1_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_digests(pii.find_personal_data(read_table(spark, folder, "documents")))


@query("op2_tokeniser_fertility")
def op2_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.rate_documents(read_table(spark, folder, "documents"))


@query("op3_cost_balanced_packing")
def op3_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(read_table(spark, folder, "documents")))


@query("op4_line_crf")
def op4_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    return linecrf.quality_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_round_trip(read_table(spark, folder, "documents"))


@query("op6_hyperminhash")
def op6_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(read_table(spark, folder, "documents"), hyperminhash.Settings(shingle=3, percent=85))


@query("op7_attention_lm")
def op7_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.folded_scores(read_table(spark, folder, "documents"))


@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(read_table(spark, folder, "documents"))


@query("op9_seekable_warc")
def op9_seekable_warc(spark: SparkSession, folder: str) -> DataFrame:
    made = warc.read_archives(*warc.write_archives(read_table(spark, folder, "pages")))
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_lattice_near_dedup")
def op10_lattice_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, folder, "embeddings"))


@query("op11_grid_codes", gridcodes.sql())
def op11_grid_codes(spark: SparkSession, folder: str) -> DataFrame:
    return gridcodes.compress_vectors(read_table(spark, folder, "embeddings"))


@query("op12_byte_shards", sharding.SQL)
def op12_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"))


@query("op13_fill_in_middle", middle.SQL)
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle.round_trip(middle.fill_in_middle(read_table(spark, folder, "documents")))
