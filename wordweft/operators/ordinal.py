"""Order without a global sort: prefix sums over bounded blocks, and ranks over range partitions.

No window here ever spans a language, a file or a frequency class. Language, file and count are all
keys that one value may dominate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import cut

RADIX_BITS = 12


def exclusive_scan(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
                   levels: int | None = None) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, in ``order``.

    An integer first key is cut into runs of 2**12 key values; each run is summed on its own, and the
    run totals are scanned the same way, one radix level up. Three levels cover 10**10 dense keys with
    windows of a few thousand rows. Other keys (paths) are range-partitioned, summed per partition, and
    only the partition sums are scanned in one window.
    """
    key = order[0]
    if levels is None:
        integral = df.schema[key].dataType.typeName() in ("long", "integer", "short")
        levels = 2 if integral else 0
        if not integral:
            return _range_scan(df, group, order, value, out)
    if levels == 0:
        return df.withColumn(out, _sum_before(Window.partitionBy(*group).orderBy(*order), value))
    run, total, start = f"_run{levels}", f"_total{levels}", f"_start{levels}"
    rows = df.withColumn(run, F.shiftright(F.col(key), RADIX_BITS))
    totals = rows.groupBy(*group, run).agg(F.sum(value).alias(total))
    starts = exclusive_scan(totals, group, [run], total, start, levels - 1).drop(total)
    inside = _sum_before(Window.partitionBy(*group, run).orderBy(*order), value)
    return (
        rows.withColumn("_inside", inside)
        .join(starts, [*group, run])
        .withColumn(out, F.col("_inside") + F.col(start))
        .drop("_inside", start, run)
    )


def _range_scan(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``exclusive_scan`` over keys of any type. Ranges are sampled, so rows are cut before they are summed."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    placed = cut(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy(*group, "_part").agg(F.sum(value).alias("_sum"))
    starts = sums.select(*group, "_part", _sum_before(Window.partitionBy(*group).orderBy("_part"), "_sum").alias("_start"))
    inside = _sum_before(Window.partitionBy(*group, "_part").orderBy(*order), value)
    return (
        placed.withColumn("_inside", inside).join(F.broadcast(starts), [*group, "_part"])
        .withColumn(out, F.col("_inside") + F.col("_start")).drop("_inside", "_start", "_part")
    )


def _sum_before(window, value: str) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def slab_offsets(rows: DataFrame, value: Column, out: str, group: list[str] = ["lang"]) -> DataFrame:
    """Sum of ``value`` over all rows in earlier slabs: one row per (group, file, slab)."""
    slabs = rows.groupBy(*group, "file", "slab").agg(F.sum(value).alias("_n"))
    return exclusive_scan(slabs, group, ["file", "slab"], "_n", out).drop("_n")


def with_slab_position(lines: DataFrame, out: str = "pos") -> DataFrame:
    """Index of a line in its slab, for sources that do not carry it."""
    w = Window.partitionBy("lang", "file", "slab").orderBy("seq")
    return lines.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))


def with_ordinal(kept: DataFrame, out: str = "ordinal") -> DataFrame:
    """0-based index of each kept line in its language, in file then line order."""
    if "pos" not in kept.columns:
        kept = with_slab_position(kept)
    starts = slab_offsets(kept, F.lit(1).cast("bigint"), "_slab_start")
    return (
        kept.join(starts, ["lang", "file", "slab"])
        .withColumn(out, F.col("_slab_start") + F.col("pos"))
        .drop("_slab_start")
    )


def with_running_sum(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over all earlier lines of the language (lines as in ``with_ordinal``)."""
    starts = slab_offsets(rows, value, "_slab_start")
    w = Window.partitionBy("lang", "file", "slab").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_value", value)
        .withColumn("_inside", F.coalesce(F.sum("_value").over(w), F.lit(0)))
        .join(starts, ["lang", "file", "slab"])
        .withColumn(out, F.col("_slab_start") + F.col("_inside"))
        .drop("_value", "_inside", "_slab_start")
    )


def range_rank(df: DataFrame, group: list[str], order: list[Column], out: str,
               partitions: int | None = None) -> DataFrame:
    """0-based rank within the group by any sort order, for row sets of any size and skew.

    Rows are range-partitioned by (group, order), so a hot group or a long run of ties is spread over
    many tasks. The result is cut before it is counted, because range bounds are sampled. The table of
    starts has at most one row per partition plus one per group, hence the broadcast.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(g) for g in group], *order]
    placed = cut(
        df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    sizes = placed.groupBy(*group, "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", _sum_before(Window.partitionBy(*group).orderBy("_part"), "_n")).drop("_n")
    return (
        placed.join(F.broadcast(starts), [*group, "_part"])
        .withColumn(out, F.col("_start") + F.col("_seq") - F.col("_first"))
        .drop("_part", "_seq", "_first", "_start")
    )


def hash_rank(df: DataFrame, group: list[str], digest: Column, ties: list[str], out: str,
              hex_digits: int = 3) -> DataFrame:
    """0-based rank within the group by a hexadecimal hash of the row.

    A digest is uniform, so its leading digits are balanced, order-preserving buckets: rank inside the
    bucket, then add the size of the earlier buckets (16**hex_digits rows per group, hence the broadcast).
    Digests do not compress, so they are made again behind the shuffle instead of travelling.
    """
    rows = df.withColumn("_bucket", F.substring(digest, 1, hex_digits))
    sizes = rows.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", _sum_before(Window.partitionBy(*group).orderBy("_bucket"), "_n")).drop("_n")
    w = Window.partitionBy(*group, "_bucket").orderBy("_digest", *ties)
    return (
        rows.repartition(*group, "_bucket").withColumn("_digest", F.unhex(digest))
        .withColumn("_in", F.row_number().over(w) - 1)
        .join(F.broadcast(starts), [*group, "_bucket"])
        .withColumn(out, (F.col("_start") + F.col("_in")).cast("bigint"))
        .drop("_bucket", "_digest", "_in", "_start")
    )
