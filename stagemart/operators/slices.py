"""Slices of about equal count over a key, for scans that read one slice a task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from stagemart.names import quoted
from stagemart.session import delete_path, new_folder


def _literal(value: str, kind: DataType) -> str:
    """A key, given as text, as SQL spells it."""
    if isinstance(kind, NumericType):
        return value
    text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    names = {DateType: "DATE", TimestampType: "TIMESTAMP", TimestampNTZType: "TIMESTAMP_NTZ"}
    return f"{names[type(kind)]}{text}" if type(kind) in names else text


def cut_points(frame: DataFrame, key: str, slices: int) -> list[str]:
    """Keys, as text and in order, up to which the slices reach: each holds about the same number of rows, and rows of a key are together.

    At most ``slices - 1`` of them; a key that holds more than a slice's share ends one of its own. Null keys count for none. The table is
    read once: keys are counted before they move, laid out by range, and the counts of the ranges
    before a key tell how many rows lie up to it.
    """
    if slices < 1:
        raise ValueError("a table is cut into one slice at least")
    spark, path = frame.sparkSession, new_folder(frame.sparkSession, "slices")
    counted = frame.select(F.col(quoted(key)).alias("key")).where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    counted.write.parquet(f"{path}/counted")
    laid_out = spark.read.schema(counted.schema).parquet(f"{path}/counted").repartitionByRange("key").sortWithinPartitions("key")
    laid_out.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/laid-out")
    keys = spark.read.parquet(f"{path}/laid-out")
    parts = keys.groupBy("part").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a task
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(Window.partitionBy()).alias("all"))
    up_to = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("key"))
    placed = keys.join(F.broadcast(parts), "part").withColumn("up_to", up_to)
    # a key ends a slice if a border lies within its rows, or at their end
    number = F.expr(f"up_to * {slices} div all")
    ends = placed.where((number > F.expr(f"(up_to - n) * {slices} div all")) & (F.col("up_to") < F.col("all")))
    found = [row["said"] for row in ends.orderBy("key").select(F.col("key").cast("string").alias("said")).collect()]
    delete_path(spark, path)
    return found


def slice_predicates(frame: DataFrame, key: str, slices: int) -> list[str]:
    """The slices of :func:`cut_points` as SQL predicates, of which each row meets one; null keys are in the first."""
    kind, name = frame.select(F.col(quoted(key))).schema[0].dataType, quoted(key)
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType, StringType)):
        raise TypeError(f"cannot slice {key}, a {kind.simpleString()}")
    ends = [_literal(said, kind) for said in cut_points(frame, key, slices)]
    if not ends:
        return ["1 = 1"]
    inner = [f"{name} > {low} AND {name} <= {high}" for low, high in zip(ends, ends[1:])]
    return [f"{name} IS NULL OR {name} <= {ends[0]}", *inner, f"{name} > {ends[-1]}"]
