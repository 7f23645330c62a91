"""Line deduplication: hashes of lines dealt by range, read in order of document and position, and told to the documents as bitmaps.

Built of DataFrame functions alone; no text is moved to find what repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagemart.llm.scratch import Scratch

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineOptions:
    """A line whose key has ``least_chars`` code points or more and is found in ``least_documents`` documents is repeated.

    All lines of a repeated key are dropped, or all but the first of them if ``keep_first``. Keys
    that hold more than one in ``shares`` of all lines, and more than ``slice_rows``, are read in slices of about that size.
    """

    least_chars: int = 1
    least_documents: int = 10
    keep_first: bool = False
    shares: int = 1 << 13
    slice_rows: int = 1 << 10


def line_keys(lines: Column) -> Column:
    """The lines without blanks at both ends, A to Z in lower case.

    Each step is a transform of its own, as what a lambda names twice is computed twice.
    """

    def lowered(inner: Column) -> Column:  # without other than ASCII characters, lower() does no more than asked and is faster
        return F.when(F.octet_length(inner) == F.char_length(inner), F.lower(inner)).otherwise(F.translate(inner, _UPPER, _UPPER.lower()))

    return F.transform(F.transform(lines, lambda line: F.btrim(line, F.lit(_BLANKS))), lowered)


def lines_of(text: Column) -> Column:
    """What lies between line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _document(id_column: str, text_column: str) -> list[Column]:
    """Two numbers that tell documents apart: rows of one id and one text are one document."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    by_text = F.xxhash64(text)
    return [F.coalesce(F.col(id_column).cast("long"), F.xxhash64(F.lit(1), text)).alias("d1"), by_text.alias("d2")]


def _hashed(documents: DataFrame, id_column: str, text_column: str, options: LineOptions) -> DataFrame:
    """(d1, d2, keys): two hashes of the key of each line, null where it is too short to count."""

    def both(key: Column) -> Column:
        return F.when(F.char_length(key) >= options.least_chars, F.struct(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(2), key).alias("g")))

    keys = F.transform(line_keys(lines_of(F.col(text_column).cast("string"))), both)
    return documents.select(*_document(id_column, text_column), keys.alias("keys"))


def _heavy(lines: DataFrame, options: LineOptions) -> tuple[list[int], int]:
    """Hashes that may hold more than one in ``shares`` of the lines, and how many slices the largest needs.

    A frequent-items sketch over all lines; it finds every such hash, and what else it names is
    only sliced in vain.
    """
    tracked = 4 * options.shares
    found = lines.agg(F.expr(f"approx_top_k(h, {2 * options.shares}, {tracked})").alias("top"), F.count("*").alias("lines")).first()
    bound = max(options.slice_rows, found["lines"] // options.shares)
    heavy = {row["item"]: row["count"] for row in found["top"] or () if row["count"] > bound}
    return sorted(heavy), max((-(-count // bound) for count in heavy.values()), default=1)


def repeated_lines(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", options: LineOptions = LineOptions(), scratch: Scratch | None = None
) -> DataFrame:
    """(d1, d2, n_lines, n_dropped, keep) of each document that loses lines; :func:`drop_lines` puts them to use.

    ``keep`` is the bitmap of the lines that stay, compressed to its runs of ones: an array of
    (start, lines), numbered from 0. ``d1`` and ``d2`` are the document, see :func:`drop_lines`.

    Hashes are dealt by range and sorted by document and position within. One pass in that order
    tells where a key or a document begins, so that documents are counted and first occurrences
    found as they come. A key of very many lines is cut into slices by document, whose counts and
    first occurrences are put together afterwards; these are a bounded number of rows.
    """
    scratch = scratch or Scratch(documents.sparkSession, "lines")
    hashed = scratch.keep(_hashed(documents, id_column, text_column, options), "hashed")
    lines = hashed.select("d1", "d2", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key")).where("key is not null")
    lines = lines.select("key.h", "key.g", "d1", "d2", "pos", "n")
    heavy, slices = _heavy(lines, options)
    of_heavy = F.col("h").isin(heavy) if heavy else F.lit(False)
    sliced = lines.withColumn("slice", F.when(of_heavy, F.pmod(F.xxhash64("d1", "d2"), F.lit(slices))).otherwise(F.lit(-1).cast("long")))
    dealt = sliced.repartitionByRange("h", "g", "slice").sortWithinPartitions("h", "g", "slice", "d1", "d2", "pos")

    group = Window.partitionBy("h", "g", "slice")
    in_order = group.orderBy("d1", "d2", "pos")
    before = F.lag(F.struct("d1", "d2")).over(in_order)
    streamed = dealt.withColumn("opens", F.when(before.eqNullSafe(F.struct("d1", "d2")), 0).otherwise(1)).withColumn("nth", F.row_number().over(in_order))
    streamed = streamed.withColumn("documents", F.sum("opens").over(group)).drop("opens")
    # of the others, whole keys are in one group and decided here
    wanted = (F.col("slice") >= 0) | (F.col("documents") >= options.least_documents)
    streamed = scratch.keep(streamed.where(wanted), "streamed")

    first = F.col("nth") == 1
    decided = streamed.where("slice < 0")
    if options.keep_first:
        decided = decided.where(~first)
    dropped = decided.select("d1", "d2", "pos", "n")
    if heavy:
        whole = streamed.where(F.col("slice") >= 0).where(first).groupBy("h", "g").agg(F.sum("documents").alias("all"), F.min(F.struct("d1", "d2", "pos")).alias("least"))
        whole = F.broadcast(whole.where(F.col("all") >= options.least_documents))  # no more rows than the sketch has named
        more = streamed.where(F.col("slice") >= 0).join(whole, ["h", "g"])
        if options.keep_first:
            more = more.where(F.struct("d1", "d2", "pos") != F.col("least"))
        dropped = dropped.union(more.select("d1", "d2", "pos", "n"))

    places = dropped.groupBy("d1", "d2").agg(F.max("n").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("places"))
    runs = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("places", lambda place: place + 1)).alias("start"),
        F.concat(F.col("places"), F.array("n_lines")).alias("end"),
    )
    kept = F.transform(F.filter(runs, lambda run: run["end"] > run["start"]), lambda run: F.struct(run["start"].alias("start"), (run["end"] - run["start"]).alias("lines")))
    return places.select("d1", "d2", "n_lines", F.size("places").alias("n_dropped"), kept.alias("keep"))


def drop_lines(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", options: LineOptions = LineOptions(), output: str = "lines"
) -> DataFrame:
    """``documents`` with a struct column ``output``: n_lines, n_dropped, keep (see :func:`repeated_lines`) and kept, the text that is left.

    Lines lie between line feeds; a null or empty text is one empty line. The key of a line is the
    line without blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns at both
    ends, A to Z in lower case, and is known by 128 bits of hash. ``kept`` joins what is left by line feeds; it is empty where
    nothing is, or where the text is null. Documents are told apart by id and text: rows that repeat one are one
    document, count once and lose the same lines; rows without an id are told apart by their text.
    A line that repeats in a single document counts once. With ``keep_first`` the first line by id, then by hash of text,
    then by position stays. An empty table gives an empty one. A column named ``output`` raises ValueError; other columns pass through.
    """
    if output in documents.columns:
        raise ValueError(f"there is a column {output} already")
    bitmaps = repeated_lines(documents, id_column, text_column, options)
    bitmaps = bitmaps.select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), "n_dropped", "keep").select("__d1", "__d2", F.struct("n_dropped", "keep").alias("__told"))
    d1, d2 = _document(id_column, text_column)
    marked = documents.withColumns({"__own1": d1, "__own2": d2})
    found = marked.join(bitmaps, (F.col("__own1") == F.col("__d1")) & (F.col("__own2") == F.col("__d2")), "left")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    lines = lines_of(text)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.size(lines).alias("lines")))
    left = F.array_join(F.flatten(F.transform(F.col("__told.keep"), lambda run: F.slice(lines, run["start"] + 1, run["lines"]))), "\n")
    told = F.struct(
        F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.col("__told.n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.col("__told.keep"), whole).alias("keep"), F.when(F.col("__told").isNull(), text).otherwise(left).alias("kept"),
    )
    return found.withColumn(output, told).drop("__own1", "__own2", "__d1", "__d2", "__told")
