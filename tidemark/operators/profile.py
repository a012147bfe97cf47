"""Extension: can a column serve as an offset? Its NULLs, ties and bounds, and whether rows come in its order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.offset_column import OffsetColumn
from tidemark.plans.workspace import shared_folder


def offset_profile(df: DataFrame, *names: str) -> DataFrame:
    """One row per column: kind, rows, NULLs, NaNs, distinct values, most rows on one value.

    Rows are counted per value first, which combines map-side: a value that holds a
    third of the table reaches the shuffle as one row per task.
    """
    return reduce(DataFrame.unionAll, (_profile(df, OffsetColumn.of(df.schema, n)) for n in names))


def _profile(df: DataFrame, offset: OffsetColumn) -> DataFrame:
    # NaN counts for itself: a probe passes over it, as it does over NULL.
    kept = df.select(offset.orderable().alias("v"), offset.column().isNull().alias("missing"))
    per_value = kept.groupBy("v", "missing").agg(F.count(F.lit(1)).alias("n"))
    present = F.col("v").isNotNull()

    def rows_where(condition) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return per_value.agg(
        F.lit(offset.name).alias("field"),
        F.lit(offset.kind).alias("kind"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        rows_where(F.col("missing")).alias("n_nulls"),
        rows_where(~present & ~F.col("missing")).alias("n_nans"),
        F.count("v").alias("n_distinct"),
        F.max(F.when(present, F.col("n"))).alias("max_ties"),
        F.min("v").cast("string").alias("start_offset"),
        F.max("v").cast("string").alias("end_offset"),
    )


def offset_order_profile(df: DataFrame, name: str, published: Column | str) -> DataFrame:
    """One row: how many rows were published at or below an offset that had been published before.

    ``published`` tells when a row came: a column of the table, or ``F.col("_metadata.file_modification_time")``
    for whole files. ``n_late`` counts rows at or below the largest offset of earlier publications, which a probe in
    between would have passed (``n_below`` those truly below it); rows published together do not count against each
    other. ``n_publications`` have at least one such row. Rows without an offset or a time are left out.

    Publications are summed up first, which combines map-side; their running maximum is taken by ranges of time: in
    each by itself, on top of the largest offset of the ranges before, of which there are as many as tasks.
    """
    offset = OffsetColumn.of(df.schema, name)
    when = F.col(published) if isinstance(published, str) else published
    rows = df.select(offset.orderable().alias("v"), when.alias("at")).where("v IS NOT NULL AND at IS NOT NULL")
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "publications")
    most = rows.groupBy("at").agg(F.max("v").alias("most"), F.count(F.lit(1)).alias("n"))
    ranged = most.repartitionByRange("at").sortWithinPartitions("at").withColumn("task", F.spark_partition_id())
    ranged.write.parquet(path)
    told = spark.read.schema(ranged.schema).parquet(path)

    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    tops = told.groupBy("task").agg(F.max("most").alias("top"))
    tops = tops.withColumn("before", F.max("top").over(earlier.orderBy("task"))).drop("top")
    within = F.max("most").over(earlier.partitionBy("task").orderBy("at"))
    passed = told.withColumn("own", within).join(F.broadcast(tops), "task")
    passed = passed.select(F.col("at").alias("point"), F.greatest("own", "before").alias("passed")).where("passed IS NOT NULL")
    late = rows.join(passed, (F.col("at") == F.col("point")) & (F.col("v") <= F.col("passed")))
    counted = late.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("passed")).alias("below"))
    found = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_late"),
        F.coalesce(F.sum("below"), F.lit(0)).alias("n_below"),
        F.count(F.lit(1)).alias("n_publications"),
    )
    total = told.agg(F.lit(offset.name).alias("field"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    return total.join(F.broadcast(found))
