"""``generate_series``: every timestamp from a start to a stop, both included.

Stepping is iterative: a month or year step that lands on a shorter month stays on the shorter
day from there on (31 Jan, 29 Feb, 29 Mar, ...). Spark's ``sequence`` goes back to the first day
instead (31 Jan, 29 Feb, 31 Mar, ...), so starts after the 28th are corrected below.
"""

from __future__ import annotations

import re
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagemart.operators.parsed import ParsedScript

# The accepted step units.
UNITS = ("years", "months", "weeks", "days", "hours", "minutes", "seconds", "microseconds")

FUNCTION_NAME = "generate_series"

_MONTH_STEP = """make_ym_interval(
    IF(step_unit = 'years', INT(step_count), 0), IF(step_unit = 'months', INT(step_count), 0))"""

_CLOCK_STEP = """make_dt_interval(
    CASE step_unit WHEN 'weeks' THEN 7 * INT(step_count) WHEN 'days' THEN INT(step_count) ELSE 0 END,
    IF(step_unit = 'hours', INT(step_count), 0),
    IF(step_unit = 'minutes', INT(step_count), 0),
    CASE step_unit
        WHEN 'seconds' THEN CAST(step_count AS DECIMAL(18, 6))
        WHEN 'microseconds' THEN CAST(BIGINT(step_count) * 0.000001BD AS DECIMAL(18, 6))
        ELSE 0 END)"""

# Re-anchored dates, each moved back to the shortest day seen so far. The stop is put off by three
# days, since a date that sits up to three days too late must not be missed; the filter trims it.
_MONTH_END_SERIES = f"""filter(flatten(transform(
    transform(
        array(sequence(series_from, series_to + INTERVAL '3' DAY, {_MONTH_STEP})),
        series_dates -> named_struct(
            'dates', series_dates,
            'to_30', array_position(transform(series_dates, series_date -> day(series_date) <= 30), true),
            'to_29', array_position(transform(series_dates, series_date -> day(series_date) <= 29), true),
            'to_28', array_position(transform(series_dates, series_date -> day(series_date) <= 28), true))),
    series_run -> transform(series_run.dates, (series_date, series_place) -> series_date - make_dt_interval(greatest(0, day(series_date) -
        CASE WHEN series_run.to_28 BETWEEN 1 AND series_place + 1 THEN 28
             WHEN series_run.to_29 BETWEEN 1 AND series_place + 1 THEN 29
             WHEN series_run.to_30 BETWEEN 1 AND series_place + 1 THEN 30
             ELSE 31 END))))),
    series_date -> series_date <= series_to)"""

_SERIES = f"""CASE
    WHEN series_from IS NULL OR series_to IS NULL OR step_unit IS NULL OR step_count IS NULL THEN NULL
    WHEN step_unit NOT IN ({", ".join(f"'{unit}'" for unit in UNITS)})
        THEN raise_error(concat('unknown step unit ', step_unit))
    WHEN coalesce(try_cast(step_count AS BIGINT), 0) < 1
        THEN raise_error(concat('a step must be a whole number above zero, not ', step_count))
    WHEN series_from > series_to THEN CAST(array() AS ARRAY<TIMESTAMP_NTZ>)
    WHEN step_unit NOT IN ('years', 'months') THEN sequence(series_from, series_to, {_CLOCK_STEP})
    WHEN day(series_from) <= 28 THEN sequence(series_from, series_to, {_MONTH_STEP})
    ELSE {_MONTH_END_SERIES}
    END"""


def register_series(spark: SparkSession) -> None:
    """Make ``generate_series(from, to [, unit [, count]])`` known to SQL in this session.

    A SQL function: Catalyst inlines it, so a literal unit leaves only its own branch and no Python
    worker is involved. NULL in gives NULL out, DATE and TIMESTAMP arguments are accepted, and the
    result is an array of TIMESTAMP_NTZ. TIMESTAMP arguments are taken in the time zone that the
    session has now: Spark keeps it with the function. Spark does not allow a SQL function directly inside
    ``explode``: run the script that ``expand_series`` makes of it, compute the array in a subquery, or use ``explode_series``.
    """
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {FUNCTION_NAME}")
    spark.sql(
        f"""CREATE TEMPORARY FUNCTION {FUNCTION_NAME}(
            series_from TIMESTAMP_NTZ,
            series_to TIMESTAMP_NTZ,
            step_unit STRING DEFAULT 'months',
            step_count STRING DEFAULT '1')
        RETURNS ARRAY<TIMESTAMP_NTZ>
        RETURN {_SERIES}"""
    )


_PARAMETERS = {"series_from": "TIMESTAMP_NTZ", "series_to": "TIMESTAMP_NTZ", "step_unit": "STRING", "step_count": "STRING"}
_DEFAULTS = {"step_unit": "'months'", "step_count": "'1'"}


def expand_series(spark: SparkSession, text: str) -> str:
    """The script with each call of ``generate_series`` replaced by its expression, so that it may stand inside ``explode``.

    Calls and their arguments are found in the plan that Spark's parser makes; what is a comment, a text or
    another name is left alone, as is a script without a call. Arguments are repeated in the expression, so they must be
    deterministic; names that its own steps use begin with ``series_``.
    """
    parts: list[str] = []
    at = 0
    for call in ParsedScript(spark, text).calls(FUNCTION_NAME):
        if call.start < at:  # among the arguments of a call, expanded with it
            continue
        given = dict(zip(_PARAMETERS, call.arguments)) | call.named
        if not {"series_from", "series_to"} <= given.keys() <= _PARAMETERS.keys() or len(given) != len(call.arguments) + len(call.named):
            raise ValueError(f"wrong arguments: {text[call.start:call.end]}")
        given = _DEFAULTS | {name: expand_series(spark, f"SELECT {said}").removeprefix("SELECT ") for name, said in given.items()}
        body = re.sub("|".join(_PARAMETERS), lambda found: f"CAST(({given[found[0]]}) AS {_PARAMETERS[found[0]]})", _SERIES)
        parts += [text[at : call.start], f"({body})"]
        at = call.end
    return "".join(parts) + text[at:]


def generate_series(
    start: Column | str, stop: Column | str, interval: str = "months", value: int | str = 1
) -> Column:
    """The registered SQL function as a column."""
    return F.call_function(FUNCTION_NAME, start, stop, F.lit(interval), F.lit(str(value)))


def explode_series(
    frame: DataFrame,
    start: Column | str,
    stop: Column | str,
    interval: str = "months",
    value: int | str = 1,
    name: str = "series",
) -> DataFrame:
    """One row per element of the series; rows whose series is NULL or empty drop out.

    ``explode`` would have Catalyst add a filter that computes every series a second time, so the
    outer form is used and its NULLs are dropped.
    """
    arrays = frame.withColumn(name, generate_series(start, stop, interval, value))
    return arrays.withColumn(name, F.explode_outer(name)).filter(F.col(name).isNotNull())


def register_explodable_series(spark: SparkSession) -> None:
    """Register ``generate_series`` as an Arrow UDF instead, for scripts that explode the call itself.

    Rows go through Python workers, so ``register_series`` is the one to prefer; the results agree.
    """
    units = UNITS

    # Defined in here, so that they travel to the workers by value: those need not have this package.
    def wall_clock(column: pa.Array) -> np.ndarray:
        if pa.types.is_timestamp(column.type) and column.type.tz is not None:
            column = pc.local_timestamp(column)
        return column.cast(pa.timestamp("us")).to_numpy(zero_copy_only=False).astype("M8[us]")

    def expand(
        first: np.ndarray, last: np.ndarray, unit: str, count: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """All elements of all series in one array, and how many of them each row has."""
        in_months = unit in ("months", "years")
        if in_months:
            step = count * (12 if unit == "years" else 1)
            begin, end = first.astype("M8[M]").astype("int64"), last.astype("M8[M]").astype("int64")
        else:
            step = timedelta(**{unit: count}) // timedelta(microseconds=1)
            begin, end = first.astype("int64"), last.astype("int64")
        sizes = np.maximum((end - begin) // step + 1, 0)
        row = np.repeat(np.arange(len(first)), sizes)
        number = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        position = begin[row] + number * step
        if not in_months:
            return position.astype("M8[us]"), sizes
        months = position.astype("M8[M]")
        shortest = ((months + 1).astype("M8[D]") - months.astype("M8[D]")).astype("int64") - 1
        from_day = (first.astype("M8[D]") - first.astype("M8[M]").astype("M8[D]")).astype("int64")
        # A running minimum within each row: every next row lies below all rows before it.
        below = 100 * row
        day = np.minimum.accumulate(np.minimum(shortest, from_day[row]) - below) + below
        clock = first - first.astype("M8[D]")
        dates = (months.astype("M8[D]") + day.astype("m8[D]")).astype("M8[us]") + clock[row]
        kept = dates <= last[row]
        return dates[kept], np.bincount(row[kept], minlength=len(first))

    def series(start: pa.Array, stop: pa.Array, *step: pa.Array) -> pa.Array:
        first, last, n_rows = wall_clock(start), wall_clock(stop), len(start)
        keys = np.zeros(n_rows, "int64")
        kinds: list[list[str | None]] = []
        for given, default in zip((*step, None, None), ("months", "1")):
            coded = None if given is None else given.dictionary_encode("encode")
            kinds.append([default] if coded is None else coded.dictionary.to_pylist())
            if coded is not None:
                keys = keys * len(kinds[-1]) + coded.indices.to_numpy(zero_copy_only=False)
        known = ~(np.isnat(first) | np.isnat(last))
        order, values, sizes, missing = [], [], [], []
        for key in np.unique(keys).tolist():
            unit, count = kinds[0][key // len(kinds[1])], kinds[1][key % len(kinds[1])]
            rows = np.flatnonzero(keys == key)
            there = known[rows] if unit is not None and count is not None else np.zeros(len(rows), bool)
            size = np.zeros(len(rows), "int64")
            if there.any():
                if unit not in units:
                    raise ValueError(f"unknown step unit {unit}")
                if int(count) < 1:
                    raise ValueError(f"a step must be a whole number above zero, not {count}")
                elements, size[there] = expand(first[rows[there]], last[rows[there]], unit, int(count))
                values.append(elements)
            order.append(rows)
            sizes.append(size)
            missing.append(~there)
        flat = np.concatenate(values) if values else np.array([], "M8[us]")
        offsets = np.concatenate([[0], *(np.cumsum(np.concatenate(sizes)) if sizes else [],)]).astype("int64")
        if offsets[-1] > np.iinfo("int32").max:
            raise OverflowError("a batch of series has more elements than an Arrow list holds: use smaller batches")
        offsets = offsets.astype("int32")
        lists = pa.ListArray.from_arrays(
            offsets, pa.array(flat, pa.timestamp("us")), mask=pa.array(np.concatenate(missing))
        )
        return lists.take(pa.array(np.argsort(np.concatenate(order))))

    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {FUNCTION_NAME}")
    spark.udf.register(FUNCTION_NAME, F.arrow_udf(series, "array<timestamp_ntz>"))
