"""Partition-count advice for the JDBC scan of each configured table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    FractionalType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from stagemart.session import delete_path, new_folder

Number = int | float | Decimal

# Rows that one slice may hold, and the statement that writes the advice down.
DEFAULT_THRESHOLD = 5_000
METADATA_UPDATE = "update {schema}.stage_table set num_partitions=%d where table_name='%s';"

# The greatest power of two that the result, a BIGINT, can hold.
_GREATEST_POWER = 62
# The level of rows at the least key, which lie in the first slice however many slices there are.
_EVERY_LEVEL = 1 << 20


def _as_number(frame: DataFrame, column: str) -> Column:
    """The key as a number: days of a date, microseconds of a timestamp."""
    key, kind = F.col(column), frame.select(column).schema[0].dataType
    if isinstance(kind, DateType):
        return F.unix_date(key)
    if isinstance(kind, TimestampType):
        return F.unix_micros(key)
    if isinstance(kind, TimestampNTZType):
        # Put together from its parts, as differences of timestamps depend on the session time zone.
        minutes = (F.unix_date(key.cast("date")) * 24 + F.hour(key)).cast("bigint") * 60 + F.minute(key)
        return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), key) * 1_000_000).cast("bigint")
    if isinstance(kind, NumericType):
        return key
    raise TypeError(f"cannot slice {column}, a {kind.simpleString()}")


def _literal(value: Number) -> Column:
    return F.lit(Decimal(value) if isinstance(value, int) and not -(2**63) <= value < 2**63 else value)


def _raw_literal(kind: DataType, value: int) -> Column | None:
    """A value of the key's own type, which a scan can compare without computing; None for other types."""
    if isinstance(kind, DateType):
        return F.lit(date(1970, 1, 1) + timedelta(days=value))
    if isinstance(kind, TimestampNTZType):
        moment = datetime(1970, 1, 1) + timedelta(microseconds=value)
        return F.lit(moment.isoformat(sep=" ")).cast(kind)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(value))
    return None


def _key_bounds(keys: Mapping[str, DataFrame]) -> dict[str, tuple[Number, Number] | None]:
    """Least and greatest key of every table, by one job over all of them; None without keys."""
    ends = [
        frame.agg(F.lit(name), F.min("key").cast("string"), F.max("key").cast("string")).toDF("name", "lower", "upper")
        for name, frame in keys.items()
    ]
    bounds: dict[str, tuple[Number, Number] | None] = {}
    for name, lower, upper in _union(ends).collect():
        number = _number_type(keys[name].schema["key"].dataType)
        bounds[name] = None if lower is None else (number(lower), number(upper))
    return bounds


def _number_type(kind: DataType) -> type:
    if isinstance(kind, DecimalType) and kind.scale > 0:
        return Decimal
    return float if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType) else int


def number_bounds(bounds: DataFrame) -> tuple[Number, Number] | None:
    """The one row ``(lower, upper)`` of key bounds as the numbers that ``advise_partitions`` takes; None without keys."""
    ends = bounds.select(_as_number(bounds, "lower").alias("lower"), _as_number(bounds, "upper").alias("upper"))
    row, number = ends.first(), _number_type(ends.schema["lower"].dataType)
    return None if row["lower"] is None else (number(row["lower"]), number(row["upper"]))


def _union(frames: list[DataFrame]) -> DataFrame:
    """All rows of the frames; pairs of pairs, so that the plan grows no deeper than it must."""
    while len(frames) > 1:
        frames = [reduce(DataFrame.unionByName, frames[at : at + 2]) for at in range(0, len(frames), 2)]
    return frames[0]


def _decimal_ends(lower: Decimal, upper: Decimal) -> list[Decimal]:
    """Ends of the first slice, cut to the scale that keys can have, until only the least key is left."""
    unit = Decimal(1).scaleb(min(lower.as_tuple().exponent, upper.as_tuple().exponent))
    steps = int((upper - lower) / unit)
    return [lower + (steps >> power) * unit for power in range(1, max(1, steps.bit_length()) + 1)]


def _first_slice_levels(keys: DataFrame, bounds: tuple[Number, Number]) -> tuple[Column, Column]:
    """The half of the range that the first of two slices holds, and how often that slice can be halved with a row still in it."""
    lower, upper = bounds
    key = F.col("key")
    if isinstance(lower, float):
        part = (key - lower) / (upper - lower) if upper > lower else F.lit(0.0)
        level = F.floor(-F.log2(part))
        # The logarithm may be off by one at a power of two; scaling by one is exact.
        level = F.when(part > F.pow(F.lit(2.0), -level), level - 1).when(part <= F.pow(F.lit(2.0), -level - 1), level + 1).otherwise(level)
        return part <= 0.5, F.when(key == lower, _EVERY_LEVEL).otherwise(level.cast("int"))
    if isinstance(lower, int):
        ends = [lower + ((upper - lower) >> power) for power in range(1, max(1, (upper - lower).bit_length()) + 1)]
    else:
        ends = _decimal_ends(lower, upper)
    level = F.when(key == _literal(lower), _EVERY_LEVEL)
    for power, end in enumerate(ends[1:], start=1):
        level = level.when(key > _literal(end), power)
    return key <= _literal(ends[0]), level.otherwise(len(ends))


def _by_first_slice(keys: DataFrame, bounds: tuple[Number, Number], threshold: int) -> DataFrame:
    """One histogram by level serves all numbers of slices. The first of two slices holds all later ones: the rest need not be read."""
    within, level = _first_slice_levels(keys, bounds)
    lower, upper = bounds
    raw = _raw_literal(keys.schema["raw"].dataType, lower + (upper - lower) // 2) if isinstance(lower, int) else None
    rows = keys.filter(within if raw is None else (F.col("raw") <= raw) & within)
    counts = rows.groupBy(level.cast("int").alias("level")).count()

    def add(sums: Column, level: Column) -> Column:
        held = sums["held"] + level["count"]
        found = F.when((sums["too_much"] == 0) & (held > threshold), level["level"]).otherwise(sums["too_much"])
        return F.struct(held.alias("held"), found.alias("too_much"))

    # From the narrowest slice up: the first level that holds too much must be halved once more.
    deepest_first = F.sort_array(F.collect_list(F.struct("level", "count")), asc=False)
    none = F.struct(F.lit(0).cast("bigint").alias("held"), F.lit(0).alias("too_much"))
    power = counts.agg((F.aggregate(deepest_first, none, add)["too_much"] + 1).alias("power"))
    return power.select(F.when(F.col("power") <= _GREATEST_POWER, F.expr("shiftleft(1L, power)")).alias("num_partitions"))


def _finest_slices(keys: DataFrame, bounds: tuple[Number, Number]) -> DataFrame:
    """The ``slice`` of each key among 2^62, in whole numbers: ceil(distance * slices / width) - 1, and 0 for the least key.

    Fewer slices join neighbours, so that a slice of 2^p is told by the first p of these 62 bits. A
    range with fewer keys than that is cut until each key is alone, and the bits that follow are zeros.
    """
    lower, upper = bounds
    rows = keys.filter(F.col("key").isNotNull())
    if isinstance(lower, float):
        part = (F.col("key") - lower) / (upper - lower) if upper > lower else F.lit(0.0)
        return rows.select((F.greatest(F.lit(1).cast("bigint"), F.ceil(part * float(2**_GREATEST_POWER))) - 1).alias("slice"))
    scale = 0
    if isinstance(lower, Decimal):
        scale = keys.schema["key"].dataType.scale
        lower, upper = (int(end.scaleb(scale)) for end in bounds)
    width = max(upper - lower, 1)
    finest = min(_GREATEST_POWER, width.bit_length())  # more slices than the width: the two least keys are parted too
    small = scale == 0 and width.bit_length() + finest < 62 and abs(lower) < 2**62
    kind, mark = ("BIGINT", "L") if small else ("DECIMAL(38, 0)", "BD")
    distance = f"cast(key * {10**scale}BD AS {kind})" if scale else f"cast(key AS {kind})"
    rows = rows.select(F.expr(f"{distance} - ({lower}{mark})").alias("rest"), F.lit(0).cast("bigint").alias("slice"))
    done, most = 0, finest if small else 126 - width.bit_length()  # a decimal holds 126 bits
    if most < 1:
        raise TypeError("keys this far apart cannot be sliced")
    while done < finest:
        step = min(most, finest - done)
        scaled = f"rest * {2**step}{mark}"
        rows = rows.selectExpr(f"cast({scaled} % {width}{mark} AS {kind}) AS rest", f"slice * {2**step}L + ({scaled}) div {width}{mark} AS slice")
        done += step
    return rows.select(F.expr(f"shiftleft(greatest(1L, slice + if(rest > 0, 1L, 0L)) - 1L, {_GREATEST_POWER - finest})").alias("slice"))


def _shared_halvings(threshold: int):
    """Within a task's rows (name, slice, n), in order: after how many halvings stretches of more than ``threshold`` rows still share a slice.

    Comes as (name, halvings, slice, n): for stretches within the task, with a null slice, and beside
    it the rows of the task in the slices that its first and its last key of a table lie in, for slices
    that other tasks hold rows of.
    """
    bits = _GREATEST_POWER

    def shared(batches):
        import numpy as np
        import pyarrow as pa

        def alike(a, b):
            """How many bits from the first on are equal."""
            differ = np.asarray(a ^ b, np.uint64)
            high, low = np.frexp((differ >> np.uint64(31)).astype(np.float64))[1], np.frexp((differ & np.uint64(2**31 - 1)).astype(np.float64))[1]
            return bits - np.where(high > 0, high + 31, low)

        def histogram(slices, counts, key):
            return np.bincount(alike(slices, key), counts, bits + 1).astype(np.int64)

        class Table:
            def __init__(self, name, first):
                self.name, self.first, self.last, self.deepest = name, first, first, -1
                self.from_first, self.from_last = np.zeros(bits + 1, np.int64), np.zeros(bits + 1, np.int64)
                self.slices, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

            def take(self, slices, counts):
                self.from_first += histogram(slices, counts, self.first)
                kept = int(alike(self.last, slices[-1]))
                self.from_last[kept], self.from_last[kept + 1 :] = self.from_last[kept:].sum(), 0
                self.last = slices[-1]
                self.from_last += histogram(slices, counts, self.last)
                slices, counts = np.concatenate([self.slices, slices]), np.concatenate([self.counts, counts])
                through = np.cumsum(counts)
                over = np.searchsorted(through, through - counts + threshold, "right")  # where a stretch from here on holds too much
                full = np.flatnonzero(over < len(slices))
                if len(full):
                    self.deepest = max(self.deepest, int(alike(slices[full], slices[over[full]]).max()))
                begun = int(np.searchsorted(through, through[-1] - threshold, "right"))  # what may go on in the next batch
                self.slices, self.counts = slices[begun:], counts[begun:]

            def told(self):
                rows = [(self.name, self.deepest, None, None)] if self.deepest >= 0 else []
                ends = {}
                for key, held in ((self.first, self.from_first), (self.last, self.from_last)):
                    inside = np.cumsum(held[::-1])[::-1]
                    ends |= {(level, int(key) >> (bits - level)): int(inside[level]) for level in range(bits + 1)}
                return rows + [(self.name, level, number, n) for (level, number), n in ends.items()]

        table = None
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            which, slices, counts = np.asarray(names.indices), np.asarray(batch.column(1)), np.asarray(batch.column(2))
            cuts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]])) if len(which) else ()
            for low, high in zip(cuts[:-1], cuts[1:]):
                name = names.dictionary[int(which[low])].as_py()
                if table is None or table.name != name:
                    if table is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(part) for part in zip(*table.told())], ["name", "halvings", "slice", "n"])
                    table = Table(name, slices[low])
                table.take(slices[low:high], counts[low:high])
        if table is not None:
            yield pa.RecordBatch.from_arrays([pa.array(part) for part in zip(*table.told())], ["name", "halvings", "slice", "n"])

    return shared


def _by_largest_slice(keys: Mapping[str, DataFrame], bounds: Mapping[str, tuple[Number, Number]], threshold: int) -> dict[str, int | None]:
    """The least number of slices of which none holds too much, for all tables together, from one reading of each.

    A slice holds too much if more than ``threshold`` rows that follow each other by key lie in it. Keys
    are counted, laid out by range over all tables, and each task finds the deepest slice that such a
    stretch of its own shares; slices that reach over the border of a task are added up from the few
    that its first and its last key lie in.
    """
    spark = next(iter(keys.values())).sparkSession
    sliced = [_finest_slices(frame, bounds[name]).select(F.lit(name).alias("name"), "slice") for name, frame in keys.items()]
    path = new_folder(spark, "advice")
    _union(sliced).groupBy("name", "slice").agg(F.count("*").alias("n")).write.parquet(path)
    counted = spark.read.schema("name string, slice bigint, n bigint").parquet(path)
    in_order = counted.repartitionByRange("name", "slice").sortWithinPartitions("name", "slice")
    told = in_order.mapInArrow(_shared_halvings(threshold), "name string, halvings bigint, slice bigint, n bigint")
    over = told.groupBy("name", "halvings", "slice").agg(F.sum("n").alias("n")).filter(F.col("slice").isNull() | (F.col("n") > threshold))
    deepest = {row["name"]: row["halvings"] for row in over.groupBy("name").agg(F.max("halvings").alias("halvings")).collect()}
    delete_path(spark, path)
    halvings = {name: max(1, deepest.get(name, 0) + 1) for name in keys}
    return {name: 2**power if power <= _GREATEST_POWER else None for name, power in halvings.items()}


def advise_partitions(
    tables: Mapping[str, tuple[DataFrame, str]],
    threshold: int = DEFAULT_THRESHOLD,
    basis: str = "first",
    metadata_schema: str = "stage",
    bounds: Mapping[str, tuple[Number, Number] | None] | None = None,
) -> DataFrame:
    """``(table_name, num_partitions, metadata_update)`` for each ``{table: (frame, key column)}``.

    Counts rows with ``min <= key <= min + (max - min) / N`` for N = 2, 4, 8, ... and takes the
    least N with at most ``threshold`` of them. Rows at the least key are in the first slice however
    many there are; where they alone are too many, and where N would not fit a BIGINT, the advice
    and its statement are NULL. ``basis="largest"`` looks at the largest slice instead of the first,
    for keys that are not spread evenly; NULL then says that one key alone
    holds too many rows, or that 2^62 slices would not part those that do. ``bounds`` are the least and greatest keys as numbers, where known: days of
    dates, microseconds of timestamps. Each table is scanned twice, its key column only: once for
    bounds that are not known, once for all counts. Keys are numbers, dates or timestamps; those of a decimal
    may lie 2^125 of its units apart, and doubles are sliced as far as their fractions go.
    """
    if basis not in ("first", "largest"):
        raise ValueError("basis must be first or largest")
    keys = {
        name: frame.select(_as_number(frame, key).alias("key"), F.col(key).alias("raw")) for name, (frame, key) in tables.items()
    }
    known = dict(bounds or {})
    unknown = {name: frame for name, frame in keys.items() if name not in known}
    if unknown:
        known |= _key_bounds(unknown)
    held = {name: frame for name, frame in keys.items() if known[name] is not None}
    spark = next(iter(keys.values())).sparkSession
    advised = {name: 2 for name in keys}
    if basis == "largest" and held:
        advised |= _by_largest_slice(held, known, threshold)
    advice = []
    for name in keys:
        if basis == "first" and name in held:
            counted = _by_first_slice(held[name], known[name], threshold)
        else:
            counted = spark.range(1).select(F.lit(advised[name]).cast("bigint").alias("num_partitions"))
        advice.append(counted.select(F.lit(name).alias("table_name"), "num_partitions"))
    update = F.format_string(METADATA_UPDATE.format(schema=metadata_schema), "num_partitions", "table_name")
    return _union(advice).withColumn("metadata_update", F.when(F.col("num_partitions").isNotNull(), update))
