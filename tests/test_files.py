"""File sources and sinks."""

from dataclasses import replace

import pytest
from conftest import SMALLEST, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stagemart.errors import UnsafeOverwrite
from stagemart.session import delete_path, new_folder, qualified, shared_folder
from stagemart.sinks import check_target, parse_partition, publish_copy, publish_direct, write_files
from stagemart.sinks import create_external_table, drop_external_table
from stagemart.sources import FileFormat, read_files, register_stage_view
from stagemart.sources.files import STAGED_CSV

TEXTS = st.one_of(
    st.none(),
    st.text(alphabet=st.sampled_from(list("ab \t\n\r\"'\\,;|#é中")), max_size=12),
    st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=12),
)


def file_counts(frame):
    rows = frame.groupBy(F.col("_metadata.file_path").alias("path")).count().collect()
    return {row["path"]: row["count"] for row in rows}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=60), st.sampled_from([",", "|", ";"]), st.booleans())
def test_csv_brings_back_every_value(spark, rows, separator, header):
    folder, file_format = new_folder(spark, "csv"), FileFormat("csv", separator, header=header, multi_line=True)
    numbered = [(number, *row) for number, row in enumerate(rows)]
    frame = spark.createDataFrame(numbered, "n int, a string, b string").coalesce(1)
    write_files(frame, folder, "t", file_format)
    assert rows_of(read_files(spark, folder, "t", file_format, frame.schema)) == rows_of(frame)
    publish_copy(spark, folder, f"{folder}/copy", "p", "t", file_format)
    assert rows_of(read_files(spark, f"{folder}/copy/p", "t", file_format, frame.schema)) == rows_of(frame)


def test_csv_keeps_whole_web_pages(spark, folder):
    file_format, pages = FileFormat("csv", multi_line=True), spark.read.parquet(f"{SMALLEST}/pages.parquet")
    write_files(pages, folder, "pages", file_format)
    assert rows_of(read_files(spark, folder, "pages", file_format, pages.schema)) == rows_of(pages)


def test_csv_types(spark, folder):
    frame = spark.sql(
        """SELECT 7 AS n, 1.5D AS d, TIMESTAMP_NTZ'2024-01-02 03:04:05.123456' AS t, '007' AS code,
                  TIMESTAMP'2024-01-02 03:04:05.123456' AS zoned, DATE'2024-01-02' AS day"""
    )
    write_files(frame, folder, "plain", FileFormat("csv"))
    plain = read_files(spark, folder, "plain", FileFormat("csv"))
    assert plain.dtypes == [(f"_c{number}", "string") for number in range(6)]
    assert tuple(plain.first()) == (
        "7", "1.5", "2024-01-02T03:04:05.123456", "007", "2024-01-02T03:04:05.123456Z", "2024-01-02"
    )
    headed = FileFormat("csv", separator=";", header=True, infer_schema=True)
    write_files(frame, folder, "headed", headed)
    assert read_files(spark, folder, "headed", headed).dtypes[3][1] == "string"
    delete_path(spark, f"{folder}/headed.csv/_schema")  # as files from elsewhere are
    inferred = read_files(spark, folder, "headed", headed)
    assert [kind for _, kind in inferred.dtypes] == ["int", "double", "timestamp_ntz", "int", "timestamp", "date"]
    assert rows_of(inferred.drop("code")) == rows_of(frame.drop("code"))


def test_doubled_quotes_can_be_read(spark, folder):
    spark.createDataFrame([('say "hi", you', 1)], "a string, n int").write.csv(f"{folder}/t.csv", escape='"')
    assert read_files(spark, folder, "t", FileFormat("csv", escape='"')).first()["_c0"] == 'say "hi", you'


def test_unknown_file_type_is_refused():
    with pytest.raises(ValueError):
        FileFormat("orc")


def test_overwrite_leaves_the_last_rows_only(spark, folder):
    write_files(spark.range(100), folder, "t")
    write_files(spark.range(3), folder, "t")
    assert rows_of(read_files(spark, folder, "t")) == [(0,), (1,), (2,)]


def test_file_sink_normalizes_and_publishing_does_not(spark, folder):
    frame = spark.sql("SELECT CAST(1.25 AS DECIMAL(10,2)) AS price")
    write_files(frame, folder, "t")
    publish_direct(frame, folder, "p", "t")
    assert read_files(spark, folder, "t").dtypes == [("price", "double")]
    assert read_files(spark, f"{folder}/p", "t").dtypes == [("price", "decimal(10,2)")]


def test_record_cap(spark, folder):
    write_files(spark.range(1050).coalesce(1), folder, "t", FileFormat(max_records_per_file=100))
    counts = file_counts(read_files(spark, folder, "t"))
    assert len(counts) == 11 and max(counts.values()) == 100 and sum(counts.values()) == 1050
    assert FileFormat().max_records_per_file == 1048576


def test_partition_columns_from_a_setting(spark, folder):
    assert parse_partition("a, b") == ["a", "b"]
    assert parse_partition(None) == []
    frame = spark.createDataFrame([("007", 1, "x"), ("7", 2, "y"), ("a=b/c", 2, "z"), (" ", 3, None)], "a string, b int, v string")
    path = write_files(frame, folder, "t", partition_by=parse_partition("a, b"))
    files = [row["f"] for row in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).collect()]
    assert any("/a=007/b=1/" in name for name in files)
    back = read_files(spark, folder, "t", schema=frame.schema).select(frame.columns)
    assert rows_of(back) == rows_of(frame)
    publish_copy(spark, folder, f"{folder}/copy", "p", "t", partition_by=["a", "b"])
    copied = read_files(spark, f"{folder}/copy/p", "t", schema=frame.schema).select(frame.columns)
    assert rows_of(copied) == rows_of(frame)


def test_partitioned_write_splits_a_hot_value_and_joins_small_ones(spark, folder):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5)
    rows = spark.range(0, 300_000, 1, 8).select(F.col("id"), key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_files(rows, folder, "t", partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = read_files(spark, folder, "t")
    files = [path.rsplit("/", 2)[1] for path in file_counts(written)]
    assert files.count("k=-1") > 1
    assert len(files) < 8 * 6
    assert written.agg(F.count("*"), F.sum("id")).first() == rows.agg(F.count("*"), F.sum("id")).first()


def test_compact_makes_one_file_of_little_and_several_of_much(spark, folder):
    rows = spark.range(0, 300_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    write_files(rows.filter("id < 1000"), folder, "little", compact=True)
    write_files(rows, folder, "some", compact=True)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        write_files(rows, folder, "much", compact=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(file_counts(read_files(spark, folder, "little"))) == 1
    assert len(file_counts(read_files(spark, folder, "some"))) == 1
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst", None) is None
    assert 1 < len(file_counts(read_files(spark, folder, "much"))) <= 8
    assert read_files(spark, folder, "much").count() == 300_000


@pytest.mark.parametrize("target,by_copy", [("s3a://data-lake/stage", True), ("s3://data-lake/stage", False)])
def test_wrong_target_scheme_is_refused(spark, target, by_copy):
    with pytest.raises(ValueError):
        check_target(target, by_copy)
    with pytest.raises(ValueError):
        if by_copy:
            publish_copy(spark, "/nowhere", target, "p", "t")
        else:
            publish_direct(spark.range(1), target, "p", "t")


@pytest.mark.parametrize(
    "target,by_copy",
    [(None, True), ("s3://data-lake/stage", True), ("s3a://data-lake/stage", False), ("hdfs:///marts", True), ("/x", False)],
)
def test_right_target_scheme_is_accepted(target, by_copy):
    check_target(target, by_copy)


def test_copy_onto_itself_is_refused_and_harmless(spark, folder):
    write_files(spark.range(5), f"{folder}/p", "t")
    with pytest.raises(UnsafeOverwrite):
        publish_copy(spark, f"{folder}/p", folder.replace("file:", ""), "p", "t")
    assert read_files(spark, f"{folder}/p", "t").count() == 5


def test_failed_copy_raises(spark, folder):
    with pytest.raises(AnalysisException):
        publish_copy(spark, folder, f"{folder}/copy", "p", "missing")


@pytest.mark.parametrize("file_type", ["parquet", "csv"])
@pytest.mark.parametrize("partition_by", [[], ["a"]])
def test_empty_dataset(spark, folder, file_type, partition_by):
    empty, file_format = spark.createDataFrame([], "n int, a string, b string"), FileFormat(file_type)
    write_files(empty, folder, "t", file_format, partition_by)
    assert read_files(spark, folder, "t", file_format, empty.schema).count() == 0
    publish_copy(spark, folder, f"{folder}/copy", "p", "t", file_format, partition_by, empty.schema)
    assert read_files(spark, f"{folder}/copy/p", "t", file_format, empty.schema).count() == 0


@pytest.mark.parametrize("file_type", ["parquet", "csv"])
def test_stage_view_honours_the_file_type(spark, folder, file_type):
    file_format = FileFormat(file_type, header=True)
    write_files(spark.range(4), folder, "things", file_format)
    register_stage_view(spark, folder, "lake", "things", file_format)
    assert spark.sql("SELECT sum(id) AS s FROM lake_things").first()["s"] == 6


def test_filters_and_columns_reach_the_scan(spark, folder):
    register_stage_view(spark, SMALLEST, "lake", "lineitem")
    frame = spark.sql("SELECT sum(l_tax) FROM lake_lineitem WHERE l_quantity > 49")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan


def test_external_table(spark, folder):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "y'z")], "id int, name string, kind string")
    path = write_files(frame, f"{folder}/it's here", "t", partition_by=["kind"])
    for _ in range(2):
        create_external_table(spark, "mart_test.things", frame.schema, path, ["kind"])
        assert rows_of(spark.table("mart_test.things").select(frame.columns)) == rows_of(frame)
    drop_external_table(spark, "mart_test.things")
    assert not spark.catalog.tableExists("mart_test.things")
    assert spark.read.parquet(path).count() == 2


def test_delete_removes_the_exact_path(spark, folder):
    write_files(spark.range(2), folder, "gone")
    write_files(spark.range(2), folder, "kept")
    assert delete_path(spark, f"{folder}/gone.parquet")
    assert not delete_path(spark, f"{folder}/gone.parquet")
    assert read_files(spark, folder, "kept").count() == 2
    with pytest.raises(ValueError):
        delete_path(spark, "file:///")


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")
    assert qualified(spark, "/tmp/x") == "file:/tmp/x"


def test_overwrite_is_whole_whatever_the_session_says(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for key in ("old", "new"):
            write_files(spark.range(3).withColumn("k", F.lit(key)), folder, "t", partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {row["k"] for row in read_files(spark, folder, "t").collect()} == {"new"}


def test_csv_without_line_breaks_may_be_split(spark, folder):
    file_format = FileFormat("csv", multi_line=False)
    write_files(spark.range(200_000).coalesce(1), folder, "t", file_format)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        split = read_files(spark, folder, "t", file_format, spark.range(1).schema)
        assert split.rdd.getNumPartitions() > 3
        assert split.agg(F.count("*"), F.sum("id")).first()[:] == (200_000, 200_000 * 199_999 // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_separated_csv_is_read_by_several_tasks_with_line_breaks_in_values(spark, folder):
    rows = [(number, f'line {number}\nand "more", \r\n\ttabs \\ and é', None if number % 7 else "") for number in range(20_000)]
    frame = spark.createDataFrame(rows, "id long, text string, other string")
    write_files(frame.coalesce(1), folder, "texts", STAGED_CSV)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = read_files(spark, folder, "texts", STAGED_CSV, frame.schema)
        assert back.rdd.getNumPartitions() > 5
        assert rows_of(back) == sorted(rows, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_value_with_the_record_separator_raises(spark, folder):
    frame = spark.createDataFrame([("a\x1eb",)], "text string")
    with pytest.raises(Exception, match="record separator"):
        write_files(frame, folder, "texts", STAGED_CSV)


def test_record_separators_that_cannot_work():
    for separator in ("\n", ",", "ab", ""):
        with pytest.raises(ValueError):
            FileFormat("csv", record_separator=separator)


def test_compact_shuffles_only_where_it_must(spark, folder):
    from stagemart.sinks.files import _size_of_parts

    write_files(spark.range(1000).withColumn("k", F.col("id") % 3), folder, "rows")
    rows = read_files(spark, folder, "rows")
    assert _size_of_parts(rows.select("id")) == "scan"
    assert _size_of_parts(rows.groupBy("k").count()) == "exchange"
    assert _size_of_parts(rows.where("id > 5")) == "nothing"
    assert _size_of_parts(rows.union(rows)) == "nothing"


def test_new_folders_can_be_cleared(spark):
    from stagemart.session import clear_folders, new_folder

    path = new_folder(spark, "mine")
    write_files(spark.range(3), path, "rows")
    clear_folders(spark)
    assert not delete_path(spark, path)


def test_csv_files_state_their_schema(spark, folder, monkeypatch):
    staged = replace(STAGED_CSV, header=True, infer_schema=True)
    rows = spark.sql("SELECT id, CAST(id AS DECIMAL(20,3)) AS d, IF(id = 1, NULL, concat('00', id)) AS code, id % 2 = 0 AS b, TIMESTAMP_NTZ'2024-01-01' AS t, 'p' AS p, cast(id AS int) AS n FROM range(3)")
    write_files(rows, folder, "t", staged, ["p"])
    read = read_files(spark, folder, "t", staged)
    assert read.columns == rows.columns and [f.dataType for f in read.schema if f.name != "d"] == [f.dataType for f in rows.schema if f.name != "d"]
    assert rows_of(read.select("id", "code", "n", "p")) == rows_of(rows.select("id", "code", "n", "p"))
    write_files(rows.drop("p").limit(0), folder, "none", staged)
    assert read_files(spark, folder, "none", staged).columns == ["id", "d", "code", "b", "t", "n"]
    # files under a header that names other columns
    rows.drop("p").withColumnRenamed("code", "other").write.mode("append").options(**staged.write_options).csv(f"{folder}/none.csv")
    with pytest.raises(Exception, match="other|code"):
        read_files(spark, folder, "none", staged).collect()
