"""Contiguous shards of about equal bytes, by global prefix sums (DataFrame operations only).

1. The key columns and sizes are written once, so later passes never read texts again.
2. They are sorted into key ranges; each range reports its total bytes and rows.
3. Prefix sums over the few range totals give every range its global offset; a running sum inside a range adds up to
   the global byte position of each row.
4. A row belongs to the shard that holds its middle byte: ``floor((2 * before + size) * n / (2 * total))``.  Shards
   are contiguous in key order and differ from ``total / n`` by at most one document.

Rows are ordered by ``doc_id`` (NULL first), then size and crc32 of the text.  Range totals are one row a partition,
which bounds the one window without a key and the broadcast of the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, partitions

N_SHARDS = 24
ROW_OVERHEAD = 8
ORDER = ["doc_id", "size", "text_crc32"]


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus the overhead of a row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, start (global byte), shard, slot (gapless row number in the shard).

    Every row gets its own slot, rows that repeat a doc_id included.  With fewer rows than shards some shards stay
    empty.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "shards")
    sizes = scratch.table("sizes", docs.select("doc_id", text_size(F.col("text")).alias("size"),
                                               text_crc(F.col("text")).alias("text_crc32")))
    ranged = scratch.table("ranged", sizes.repartitionByRange(partitions(spark), *ORDER)
                           .withColumn("part", F.spark_partition_id()))
    scratch.drop("sizes")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"),
                            F.sum("bytes").over(everything).alias("total"))
    inside = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (ranged.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.count(F.lit(1)).over(inside))
              .join(F.broadcast(offsets), "part")  # one row a partition
              .withColumn("start", F.col("byte0") + F.col("upto") - F.col("size"))
              .withColumn("row", F.col("row0") + F.col("nth") - 1)
              .withColumn("shard", F.expr(f"cast((2 * start + size) * {int(n_shards)} div (2 * total) as int)"))
              .select(*ORDER, "start", "row", "shard"))
    placed = scratch.table("placed", placed)
    scratch.drop("ranged")
    first = placed.groupBy("shard").agg(F.min("row").alias("row0"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "start", "shard", (F.col("row") - F.col("row0")).alias("slot")))


def shard_cuts(assigned: DataFrame) -> list:
    """The first key (doc_id, size, text_crc32) of every shard with rows, with the shard's number."""
    return (assigned.groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("k")).orderBy("shard")
            .select("shard", "k.*").collect())  # at most n_shards rows


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The documents with a column ``shard``, without moving a text.

    The shards are contiguous in key order, so a row's shard follows from comparing its key with the first keys of
    the shards.  Rows with equal key columns lie in one shard here.  A column ``shard`` of the input is replaced.
    """
    first = docs.select("doc_id", "text")
    cuts = shard_cuts(assign_shards(first, n_shards))
    key = F.struct(F.col("doc_id"), text_size(F.col("text")).alias("size"), text_crc(F.col("text")).alias("text_crc32"))
    shard = F.lit(cuts[0]["shard"] if cuts else 0)
    kind = dict(docs.dtypes)["doc_id"]
    for c in cuts[1:]:
        cut = F.struct(F.lit(c["doc_id"]).cast(kind).alias("doc_id"), F.lit(c["size"]).cast("long").alias("size"),
                       F.lit(c["text_crc32"]).cast("long").alias("text_crc32"))
        shard = F.when(key >= cut, F.lit(c["shard"])).otherwise(shard)
    return docs.withColumn("shard", shard.cast("int"))
