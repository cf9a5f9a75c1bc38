"""Contiguous shards of near-equal byte size, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.prefix import prefix_sums
from stationcast.llm.store import stored

LOWEST = -(1 << 63)


def order_key(text: Column, doc_id: Column) -> tuple[Column, Column]:
    """The global order: equal texts lie together, their copies by id. Neither part is null."""
    return (F.coalesce(F.xxhash64(text), F.lit(0)),
            F.coalesce(doc_id.cast("bigint"), F.lit(LOWEST)))


def assign_shards(docs: DataFrame, shards: int = 40, overhead: int = 16,
                  keep_whole: float = 0.02) -> DataFrame:
    """Place every row of ``docs`` (doc_id, text) into one of ``shards`` contiguous shards.

    Rows are ordered by (hash of the text, doc_id), so that equal texts lie together. A row weighs
    its UTF-8 bytes plus ``overhead``; the global prefix sum of the weights is cut at equal targets,
    and a row belongs to the shard in which its middle lies. A group of equal texts that a cut would
    split goes as one to the shard of its own middle if it weighs at most ``keep_whole`` of a shard;
    larger groups are split, however many rows they have. Slots number a shard's rows from 0.

    Returns doc_id, size, text_crc32, shard, slot and the order key (group, id_key); other columns
    of ``docs`` are not read. A null text weighs ``overhead`` and has the CRC of no bytes, 0; a null
    id orders first; repeated rows are placed one by one; an empty table gives no rows; with fewer
    rows than shards some shards stay empty.
    """
    text, doc_id = F.col("text"), F.col("doc_id")
    group, id_key = order_key(text, doc_id)
    narrow = docs.select(
        doc_id, (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).alias("text_crc32"),
        group.alias("group"), id_key.alias("id_key"), F.lit(1).alias("one"))
    placed, totals = prefix_sums(narrow, ["group", "id_key"],
                                 {"bytes_before": "size", "rows_before": "one"})
    total = max(1, totals["bytes_before"])

    def at(middle_doubled: Column) -> Column:
        return F.least(F.expr("bigint(0)") + F.floor(middle_doubled * shards / (2 * total)),
                       F.lit(shards - 1)).cast("int")

    cut = stored(placed.withColumn("shard", at(2 * F.col("bytes_before") + F.col("size"))), "cut")
    # Shards are contiguous, so at most shards - 1 groups lie on a cut: safe to broadcast.
    split = (cut.groupBy("group")
             .agg(F.min("shard").alias("first"), F.max("shard").alias("last"),
                  F.min("bytes_before").alias("start"), F.sum("size").alias("bytes"))
             .where("first < last").where(F.col("bytes") <= keep_whole * total / shards)
             .select("group", at(2 * F.col("start") + F.col("bytes")).alias("whole")))
    whole = (cut.join(F.broadcast(split), "group", "left")
             .withColumn("shard", F.coalesce("whole", "shard")).drop("whole", "one"))
    first = whole.groupBy("shard").agg(F.min("rows_before").alias("first_row"))
    return (whole.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("rows_before") - F.col("first_row"))
            .select("doc_id", "size", "text_crc32", "shard", "slot", "group", "id_key"))


def shard_rows(docs: DataFrame, shards: int = 40, output: str = "shard") -> DataFrame:
    """``docs`` with its shard as column ``output``; texts are not moved.

    The cuts of ``assign_shards`` are the first keys of the shards, at most ``shards`` rows that
    every row is compared with. Rows equal in id and text share a key and so a shard. A column of
    the same name is replaced.
    """
    cuts = sorted((row["key"]["group"], row["key"]["id_key"], row["shard"]) for row in (
        assign_shards(docs, shards).groupBy("shard")
        .agg(F.min(F.struct("group", "id_key")).alias("key")).collect()))
    group, id_key = order_key(F.col("text"), F.col("doc_id"))
    shard = F.lit(0)
    for cut_group, cut_id, number in cuts:
        past = (group > cut_group) | ((group == cut_group) & (id_key >= cut_id))
        shard = F.when(past, F.lit(number)).otherwise(shard)
    return docs.withColumn(output, shard.cast("int"))


def op10_byte_shards(spark, docs: DataFrame) -> DataFrame:
    """The shard of every document under the law ``bytes``; odd rows as in ``assign_shards``."""
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
