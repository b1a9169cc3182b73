"""Row ids for keyless input: by content, or by position.

``with_content_id`` derives the id from the row's text and an occurrence number for
equal texts; it depends on the data only, so samples drawn from it are reproducible on
any cluster.  Equal rows are counted (with map-side partial counts) and dealt out again,
so a line that makes up a third of the input stays one row until the very end.

``with_row_index`` numbers rows 0 .. n-1.  The tagged rows are written to the shared
folder once; counts, offsets and result all read that table, so no re-planned shuffle
can deal the rows differently in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterpoise.session import scratch_path

ROW_INDEX = "row_index"


def with_content_id(lines: DataFrame, name: str = "id", value_col: str = "value") -> DataFrame:
    """``(value, id)``: id = 64-bit hash of the line and its occurrence number (1, 2, .. for equal lines)."""
    counted = lines.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    dealt = counted.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return dealt.select(value_col, F.xxhash64(value_col, "_k").alias(name))


def with_row_index(df: DataFrame, name: str = ROW_INDEX) -> DataFrame:
    """``df`` plus consecutive numbers from 0, in the order of the written partitions."""
    spark = df.sparkSession
    path = scratch_path(spark, "row-index")
    df.withColumn("_mid", F.monotonically_increasing_id()).write.parquet(path)
    tagged = spark.read.parquet(path).withColumn("_pid", F.shiftright("_mid", 33))
    # One row per partition; its running total needs no driver.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    out = tagged.join(starts, "_pid", "left")
    return out.withColumn(name, (F.col("_start") + place).cast("long")).select(*df.columns, name)
