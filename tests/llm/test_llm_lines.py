"""Repeated lines against plain Python."""

import hashlib
import re

import pytest

from stagemart.llm.lines import LineOptions, drop_lines, repeated_lines

BLANKS = " \t\n\x0b\x0c\r"


def _key(line):
    return re.sub("[A-Z]", lambda found: found[0].lower(), line.strip(BLANKS))


def _expected(rows, options):
    """(id, n_lines, kept) of each row; rows of one id and one text are one document, without an id of one text."""
    texts = sorted({(ident is None, ident or 0, text or "") for ident, text in rows})
    found, first = {}, {}
    for document in texts:
        for place, line in enumerate(document[2].split("\n")):
            found.setdefault(_key(line), set()).add(document)
    repeated = {key for key, own in found.items() if len(key) >= options.least_chars and len(own) >= options.least_documents}
    if options.keep_first:  # by id, and these tables repeat no id with another text
        for document in texts:
            for place, line in enumerate(document[2].split("\n")):
                first.setdefault(_key(line), (document, place))
    out = []
    for ident, text in rows:
        lines = (text or "").split("\n")
        document = (ident is None, ident or 0, text or "")
        kept = [line for place, line in enumerate(lines) if _key(line) not in repeated or first.get(_key(line)) == (document, place)]
        out.append((ident, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def _rows():
    rows = [(number, f"Header \n own line {number}\n\tFOOTER É\x0b\n\nHEADER\n") for number in range(30)]
    rows += [(number, "\n".join(f"shared {(number * step) % 23}" for step in range(number % 17))) for number in range(30, 80)]
    rows += [(80, None), (81, ""), (82, "\n\n\n"), (83, "header"), (84, "header\n" * 50_000 + "end"), (85, "é\nÉ"), (86, "  header"), (86, "  header")]
    return rows


@pytest.mark.parametrize("shares", [1 << 13, 4], ids=["whole keys", "sliced keys"])
@pytest.mark.parametrize("options", [(1, 10, False), (1, 2, True), (9, 3, False), (0, 5, False)], ids=str)
def test_kept_lines_equal_plain_python(spark, options, shares):
    options = LineOptions(*options, shares, slice_rows=1 if shares == 4 else 1 << 10)
    rows = _rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = drop_lines(frame, options=options)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    told = sorted(((row.doc_id, row.lines.n_lines, row.lines.n_dropped, row.lines.kept) for row in found.collect()), key=repr)
    assert told == _expected(rows, options)


def test_documents_without_an_id_are_told_apart_by_their_text(spark):
    rows = [(None, f"same\nline {number % 12}") for number in range(36)] + [(None, None), (None, None)]
    found = drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), options=LineOptions(least_documents=12)).collect()
    assert sorted(row.lines.kept for row in found) == sorted([""] * 2 + [f"line {number % 12}" for number in range(36)])
    assert all(row.lines.kept == row.text for row in drop_lines(spark.createDataFrame(rows, "doc_id long, text string"), options=LineOptions(least_documents=13)).collect() if row.text)


def test_bitmaps_are_runs_of_kept_lines(spark):
    rows = [(number, f"a\nx{number}\ny{number}\na\na\nz{number}") for number in range(3)]
    found = repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), options=LineOptions(least_documents=3)).collect()
    assert [[tuple(run) for run in row.keep] for row in found] == [[(1, 2), (5, 1)]] * 3
    assert {(row.n_lines, row.n_dropped) for row in found} == {(6, 3)}


def test_one_document_of_many_equal_lines_repeats_nothing(spark):
    frame = spark.createDataFrame([(1, "a\n" * 300)], "doc_id long, text string")
    assert drop_lines(frame, options=LineOptions(least_documents=2)).first().lines.n_dropped == 0


def test_empty_tables_and_clashing_columns(spark):
    frame = spark.createDataFrame([(number, "a\nb", "x", "y", "z", 7) for number in range(10)], "doc_id long, text string, h string, d1 string, keep string, n_lines long")
    found = drop_lines(frame)
    assert found.columns == [*frame.columns, "lines"]
    assert {(row.h, row.d1, row.keep, row.n_lines, row.lines.n_lines, row.lines.kept) for row in found.collect()} == {("x", "y", "z", 7, 2, "")}
    assert drop_lines(frame.limit(0)).collect() == []
    with pytest.raises(ValueError, match="keep"):
        drop_lines(frame, output="keep")


def test_sliced_and_whole_keys_give_the_same_digests(spark):
    frame = spark.createDataFrame([(number, f"hot\nrare {number // 9}\nrare {number // 10}") for number in range(200)], "doc_id long, text string")

    def digest(shares):
        found = drop_lines(frame, options=LineOptions(shares=shares, slice_rows=1)).select("doc_id", "lines.kept").collect()
        return hashlib.sha256(repr(sorted(map(tuple, found))).encode()).hexdigest()

    assert digest(1 << 13) == digest(2) == digest(16)
