"""Contiguous shards of equal bytes: prefix sums from per-partition totals."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crosslex.llm.common import picked
from crosslex.sources import workspace

#: Bytes that a row counts beside its text.
ROW_BYTES = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``<id>, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Rows are put in order of their id (rows of one id by size and checksum) and cut into
    ``shards`` runs whose bytes are nearly equal: a row belongs to the shard in which
    its middle byte falls, so a shard differs from the mean by at most one row.
    ``slot`` numbers a shard's rows from 0. A null text has only the row's own bytes, a
    null id comes first; repeated rows each take a slot; an empty table gives no rows.

    The text is read once; afterwards only sizes move. They are sorted into ranges and
    written, each range adds up its own bytes, and the running totals of the ranges
    (one row a range) are added to the sums inside them.
    """
    sized = picked(docs, id=id_col, text=text_col).select(
        "id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    order = ["id", "size", "text_crc32"]
    ranged = workspace.settle(
        sized.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged")

    # One row a range: the only rows that a single task sees together.
    totals = ranged.groupBy("range").agg(
        F.sum("size").alias("range_bytes"), F.count(F.lit(1)).alias("range_rows"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    all_ranges = Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("range_bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("range_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("range_bytes").over(all_ranges).alias("all_bytes"))

    inside = Window.partitionBy("range").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(offsets), "range").select(
        "id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(running)).alias("end"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("row"),
        "all_bytes",
    ).withColumn("shard", F.expr(
        f"cast(least({shards - 1}, ((2 * end - size) * {shards}) div (2 * all_bytes)) as int)"))

    # One row a shard.
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
