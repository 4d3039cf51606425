"""Contiguous shards of nearly equal bytes, cut out of one global order by prefix sums.

Documents are ordered by id (then checksum, size and row).  Ranges of that order are partitions; the running total of the
partitions' sizes, plus a running sum inside each, is the number of bytes before every document.  Shards are cut at equal
targets of that number, so each holds a contiguous range of ids and differs from the target by less than the largest document.

All of it is DataFrame expressions.  Texts are read once, for their size and checksum, and do not travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import scratch, settle

SHARDS = 24
#: Bytes that a document counts beyond its text.
OVERHEAD = 8
#: Rows that a partition of the order is made for, and the largest number of partitions.  Beyond their product (1.3e9 rows)
#: partitions get larger (at 5e10 rows 2.5 million rows of some 30 bytes); the number of totals stays bounded.
BLOCK_ROWS = 1 << 16
MOST_BLOCKS = 20_000


def measured(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, at``: bytes that count, checksum of the text, and a number that no other row has."""
    text = F.coalesce(F.col("text"), F.lit(""))
    travels = [F.struct(*keep).alias("document")] if keep else []
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("at"),
        *travels,
    )


def _placed(docs: DataFrame, shards: int, keep: Sequence[str]) -> DataFrame:
    """``doc_id, size, text_crc32, shard, place``: every document with its place in the order of all."""
    order = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "at"]
    rows = settle(measured(docs, keep), "sizes")
    blocks = min(MOST_BLOCKS, 1 + rows.count() // BLOCK_ROWS)
    # Equal keys of any number are split, as no two rows have the same ``at``.
    ranged = settle(rows.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id()), "ranges")

    totals = ranged.groupBy("block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # At most MOST_BLOCKS rows.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("block").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({"upto": F.sum("size").over(upto), "nth": F.row_number().over(inside)}).join(F.broadcast(offsets), "block")
    # Twice the middle byte; decimals, as the product may not fit a long.
    middle = "CAST(2 * (bytes_before + upto) - size AS DECIMAL(19, 0))"
    return summed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr(f"CAST(least({middle} * {int(shards)} div CAST(2 * all_bytes AS DECIMAL(19, 0)), {int(shards) - 1}) AS INT)").alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        *(["document"] if keep else []),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` are the UTF-8 bytes of the text and ``OVERHEAD``; ``slot`` counts from 0 inside a shard, in the order of ids.  A
    document lies in the shard that its middle byte falls into.  ``law`` is ``bytes``; ``grown_shard`` is null, as another number of
    shards moves all cuts.  Columns named by ``keep`` travel along in the struct ``document`` (the text, to write shards out).

    A null text has checksum 0 and no bytes; a null id comes first.  Rows that repeat an id, or are equal in all, are ordered
    by checksum and size and then as they are read, and may be cut apart anywhere.  A document larger than a shard's target
    leaves the shards that it covers empty.  An empty table gives no row; other columns are not read.
    """
    with scratch():
        placed = settle(_placed(docs, shards, keep), "placed", keep=True)
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *(["document"] if keep else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write all columns of the documents under ``path/shard=N``, and return what was written, with ``slot``.

    A shard is written by many tasks, each with its own ranges of ids; ``slot`` gives their order.
    """
    made = shard_documents(docs, shards, keep=docs.columns)
    made.select("document", "slot", "shard").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


#: The same rows in SQL.  The checksum is worked out byte by byte, from a table made by its polynomial.
SQL = f"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS steps),
bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + {OVERHEAD} AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
measured AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size,
         xor(list_reduce(b, lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32
  FROM bytes, polynomial),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS place
  FROM measured),
cut AS (SELECT *, CAST(least((2 * upto - size) * {SHARDS} // (2 * total), {SHARDS - 1}) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""
