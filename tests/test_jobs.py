"""The two jobs, end to end."""

from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stagemart.errors import DependencyCycle, MissingMetadata, UnsafeOverwrite
from stagemart.operators import read_script, run_script
from stagemart.plans import ExtractOptions, MartConfig, MartOptions, MartScript
from stagemart.plans import advise_stage_tables, extract_tables, load_dim_fact
from stagemart.queries.jobs import stage_metadata
from stagemart.sinks import write_files, write_table
from stagemart.sources import PARQUET, FileFormat, StageMetadata, read_files, read_table
from stagemart.sources.files import STAGED_CSV


def exists(spark, path):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


# ---- extract ---------------------------------------------------------------------------------


@pytest.fixture
def source(spark, database):
    write_table(spark.range(100).withColumn("price", (F.col("id") / 4).cast("decimal(10,2)")), database, "items")
    write_table(spark.range(0).withColumn("name", F.lit("x")), database, "nothing")
    return database, stage_metadata(spark, {"ITEMS": "ID", "nothing": "id"}, {"ITEMS": "Updated_At"})


@pytest.mark.parametrize("file_format", [PARQUET, FileFormat("csv"), FileFormat("csv", header=True, infer_schema=True)])
@pytest.mark.parametrize("by_copy", [True, False])
def test_extract(spark, source, folder, file_format, by_copy):
    options = ExtractOptions(
        f"{folder}/stage", "shop", file_format, publish_target=f"{folder}/lake", publish_by_copy=by_copy, parallel_tables=2
    )
    done = {table.table: table for table in extract_tables(spark, *source, options)}
    items = done["items"]
    assert (items.partition_column, items.num_partitions, items.date_column) == ("id", 8, "updated_at")
    assert items.staged_path == f"{folder}/stage/shop/items.{file_format.file_type}"
    assert items.published_path == f"{folder}/lake/shop/items.{file_format.file_type}"
    expected = rows_of(spark.range(100).withColumn("price", F.col("id") / 4))
    for place in (f"{folder}/stage/shop", f"{folder}/lake/shop"):
        read = read_files(spark, place, "items", file_format)
        assert rows_of(read.toDF("id", "price").select(F.col("id").cast("bigint"), F.col("price").cast("double"))) == expected
    assert done["nothing"].date_column is None
    schema = "id bigint, name string"
    reader = spark.read.schema(schema).format(file_format.file_type).option("header", file_format.header)
    assert reader.load(done["nothing"].published_path).count() == 0


def test_single_table_and_unknown_table(spark, source, folder):
    options = ExtractOptions(folder, "shop")
    lower = stage_metadata(spark, {"items": "id", "nothing": "id"}, {})
    assert [done.table for done in extract_tables(spark, source[0], lower, options, single_table="ITEMS")] == ["items"]
    with pytest.raises(MissingMetadata):
        extract_tables(spark, *source, options, single_table="unknown")


@pytest.mark.parametrize("by_copy", [True, False])
def test_published_csv_is_the_staged_text(spark, database, folder, by_copy):
    write_table(spark.sql("SELECT 1 AS id, '007' AS code, ' 1.50\n' AS v, '' AS e, CAST(NULL AS STRING) AS n"), database, "codes")
    options = ExtractOptions(
        folder, "shop", FileFormat("csv", infer_schema=True), publish_target=f"{folder}/lake", publish_by_copy=by_copy
    )
    extract_tables(spark, database, stage_metadata(spark, {"codes": "id"}, {}), options)
    published = read_files(spark, f"{folder}/lake/shop", "codes", FileFormat("csv", multi_line=True))
    assert rows_of(published) == [("1", "007", " 1.50\n", "", None)]


def test_staged_files_are_removed_where_they_were_written(spark, source, folder):
    options = ExtractOptions(f"{folder}/stage", "shop", publish_target=f"{folder}/lake", remove_staged=True)
    done = extract_tables(spark, *source, options)
    assert [table.staged_path for table in done] == [None, None]
    assert not exists(spark, f"{folder}/stage/shop/items.parquet")
    assert read_files(spark, f"{folder}/lake/shop", "items").count() == 100


def test_publish_what_an_earlier_run_staged(spark, source, folder):
    options = ExtractOptions(f"{folder}/stage", "shop")
    extract_tables(spark, *source, options)
    write_table(spark.range(1), source[0], "items")
    extract_tables(spark, *source, replace(options, save_files=False, publish_target=f"{folder}/lake"))
    assert read_files(spark, f"{folder}/lake/shop", "items").count() == 100


def test_failures_are_raised(spark, source, folder):
    database, _ = source
    missing = stage_metadata(spark, {"items": "id", "absent": "id"}, {})
    with pytest.raises(Exception, match="(?i)absent"):
        extract_tables(spark, database, missing, ExtractOptions(folder, "shop", parallel_tables=2))
    with pytest.raises(ValueError):
        extract_tables(spark, *source, ExtractOptions(folder, "shop", publish_target="s3a://lake"))
    for by_copy in (True, False):
        options = ExtractOptions(folder, "shop", publish_target=folder + "/", publish_by_copy=by_copy)
        with pytest.raises(UnsafeOverwrite):
            extract_tables(spark, *source, options)
    assert read_files(spark, f"{folder}/shop", "items").count() == 100


@pytest.mark.parametrize("basis", ["first", "largest"])
def test_advice_for_the_configured_tables(spark, source, basis):
    advice = advise_stage_tables(spark, *source, "shop", threshold=10, basis=basis)
    assert rows_of(advice) == [
        ("items", 16, "update shop.stage_table set num_partitions=16 where table_name='items';"),
        ("nothing", 2, "update shop.stage_table set num_partitions=2 where table_name='nothing';"),
    ]
    if basis == "first":
        plan = advice._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(ID,49)" in plan or "LessThanOrEqual(id,49)" in plan


def test_metadata_with_gaps(spark, source, folder):
    database, _ = source
    schema = "table_name string, partition_column string, num_partitions int, date_column_id int"
    dates = spark.createDataFrame([], "id int, date_column string")
    unset = StageMetadata(spark.createDataFrame([("items", "id", None, None)], schema), dates)
    assert extract_tables(spark, database, unset, ExtractOptions(folder, "shop"))[0].num_partitions == 8
    keyless = StageMetadata(spark.createDataFrame([("items", None, 8, None)], schema), dates)
    with pytest.raises(MissingMetadata):
        extract_tables(spark, database, keyless, ExtractOptions(folder, "shop"))


# ---- scripts ---------------------------------------------------------------------------------


def test_script_keeps_comments_and_literals(spark, tmp_path):
    (tmp_path / "p" / "br").mkdir(parents=True)
    (tmp_path / "p" / "br" / "d.sql").write_text("SELECT 1 AS a, -- first\n 'two\n lines' AS b\nFROM range(3)\n")
    result = run_script(spark, read_script(tmp_path, "p", "br", "d.sql"), "d")
    assert rows_of(result) == [(1, "two\n lines")] * 3
    assert spark.table("d").count() == 3
    assert run_script(spark, "SELECT 1 AS a;\n-- the end\n", "e").count() == 1


# ---- dimensions and facts --------------------------------------------------------------------

SCRIPTS = {
    "dim_a": "SELECT id, concat('a', id % 3) AS kind, id % 2 = 0 AS even FROM lake_items",
    "dim_b": "SELECT id, CAST(price AS DECIMAL(10,2)) AS price FROM lake_items",
    "fact_c": "SELECT a.kind, sum(b.price) AS total, count(*) AS n FROM dim_a a JOIN dim_b b ON a.id = b.id GROUP BY a.kind",
}
TOTALS = [("a0", 420.75, 34), ("a1", 404.25, 33), ("a2", 412.5, 33)]


@pytest.fixture
def mart(spark, folder, tmp_path):
    (tmp_path / "shop" / "br").mkdir(parents=True)
    for name, text in SCRIPTS.items():
        (tmp_path / "shop" / "br" / f"{name}.sql").write_text(text)
    write_files(spark.range(100).withColumn("price", F.col("id") / 4), f"{folder}/stage/lake", "items")
    config = MartConfig.from_mapping(
        {
            "dependency": {"lake": "lake"},
            "dimensions": {"dim_a": {"file": "dim_a.sql", "partition": "kind, even"}, "dim_b": None},
            "facts": {"fact_c": {"file": "fact_c.sql"}},
        }
    )
    options = MartOptions("shop", "br", f"{folder}/stage", f"{folder}/mart", str(tmp_path))
    return config, {"lake": stage_metadata(spark, {"items": "id"}, {})}, options


def test_config_defaults():
    config = MartConfig.from_mapping({"dependency": {"a": "lake"}, "dimensions": {"one": None, "two": {"partition": "x, y"}}})
    assert config.dependencies == ("lake",)
    assert config.dimensions == (MartScript("one", "one.sql"), MartScript("two", "two.sql", ("x", "y")))
    assert config.facts == ()


@pytest.mark.parametrize("compact", [False, True])
def test_files_only(spark, mart, folder, compact):
    config, metadata, options = mart
    loaded = load_dim_fact(spark, config, metadata, replace(options, compact=compact))
    assert [table.name for table in loaded] == ["dim_a", "dim_b", "fact_c"]
    assert loaded[2].staged_path == f"{folder}/mart/dw_shop_br/fact_c.parquet"
    assert rows_of(spark.read.parquet(loaded[2].staged_path)) == TOTALS
    assert spark.read.parquet(loaded[1].staged_path).dtypes == [("id", "bigint"), ("price", "double")]
    # dim_a is read from its files by later scripts; dim_b is not, its files hold other types.
    assert "dim_a.parquet" in spark.table("dim_a").inputFiles()[0]
    assert "items.parquet" in spark.table("dim_b").inputFiles()[0]
    assert dict(spark.table("dim_b").dtypes)["price"] == "decimal(10,2)"


@pytest.mark.parametrize("by_copy", [True, False])
@pytest.mark.parametrize("file_format", [PARQUET, FileFormat("csv", header=True)])
def test_all_sinks_get_the_same_rows(spark, mart, folder, database, by_copy, file_format):
    config, metadata, options = mart
    options = replace(
        options, output_format=file_format, database=database, publish_target=f"{folder}/lake", publish_by_copy=by_copy
    )
    loaded = load_dim_fact(spark, config, metadata, options)
    for table in loaded:
        from_files = read_files(spark, options.mart_folder, table.name, file_format, table.schema)
        published = read_files(spark, f"{folder}/lake/dw_shop_br", table.name, file_format, table.schema)
        stored = read_table(spark, database, table.name)
        names = table.schema.names
        assert rows_of(from_files.select(names)) == rows_of(published.select(names)) == rows_of(stored.select(names))
        assert table.database_table == f"APP.{table.name}"
    assert dict(read_table(spark, database, "dim_b").dtypes)["price"] == "double"
    assert rows_of(read_table(spark, database, "fact_c")) == TOTALS


def test_random_results_agree_between_sinks(spark, mart, folder, database):
    config, metadata, options = mart
    script = "SELECT id, CAST(rand() AS DECIMAL(12,10)) AS r, uuid() AS u FROM lake_items"
    fact = "SELECT count(*) AS n, sum(r) AS r FROM dim_r"
    root = options.script_directory + "/shop/br/"
    open(root + "dim_r.sql", "w").write(script)
    open(root + "fact_r.sql", "w").write(fact)
    config = MartConfig(("lake",), (MartScript("dim_r", "dim_r.sql"),), (MartScript("fact_r", "fact_r.sql"),))
    for file_format in (PARQUET, FileFormat("csv")):
        options = replace(options, database=database, output_format=file_format, publish_target=f"{folder}/lake")
        (table, _) = load_dim_fact(spark, config, metadata, options)
        from_files = read_files(spark, options.mart_folder, "dim_r", file_format, table.schema)
        assert rows_of(from_files) == rows_of(read_table(spark, database, "dim_r"))


def test_database_only(spark, mart, database):
    config, metadata, options = mart
    loaded = load_dim_fact(spark, config, metadata, replace(options, save_files=False, database=database))
    assert [table.staged_path for table in loaded] == [None] * 3
    assert rows_of(read_table(spark, database, "fact_c")) == TOTALS


def test_batches_and_connections_are_passed_on(spark, mart, database, monkeypatch):
    config, metadata, options = mart
    calls = []
    monkeypatch.setattr("stagemart.plans.dim_fact.write_table", lambda rows, target, *rest: calls.append(rest))
    options = replace(options, database=database, batch_size=77, database_connections=3)
    load_dim_fact(spark, config, metadata, options)
    assert calls == [("dim_a", 77, 3), ("dim_b", 77, 3), ("fact_c", 77, 3)]


def test_database_schema_defaults_to_the_project(spark, mart, database):
    config, metadata, options = mart
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(database.url)
    connection.createStatement().executeUpdate("CREATE SCHEMA dw_shop_br")
    connection.close()
    options = replace(options, save_files=False, database=replace(database, schema=None))
    loaded = load_dim_fact(spark, config, metadata, options)
    assert [table.database_table for table in loaded] == [f"dw_shop_br.{name}" for name in SCRIPTS]


def test_empty_partition_values_are_not_lost(spark, mart, database):
    config, metadata, options = mart
    root = options.script_directory + "/shop/br/"
    open(root + "dim_e.sql", "w").write("SELECT id, IF(id < 50, '', 'x') AS k FROM lake_items")
    open(root + "fact_e.sql", "w").write("SELECT k, count(*) AS n FROM dim_e GROUP BY k")
    config = MartConfig(("lake",), (MartScript("dim_e", "dim_e.sql", ("k",)),), (MartScript("fact_e", "fact_e.sql"),))
    load_dim_fact(spark, config, metadata, replace(options, database=database))
    assert rows_of(read_table(spark, database, "fact_e")) == [("", 50), ("x", 50)]
    assert [row["k"] for row in read_table(spark, database, "dim_e").collect()].count("") == 50


def test_staged_results_can_be_removed(spark, mart, folder):
    config, metadata, options = mart
    options = replace(options, publish_target=f"{folder}/lake", remove_staged=True)
    loaded = load_dim_fact(spark, config, metadata, options)
    assert [table.staged_path for table in loaded] == [None] * 3
    assert not exists(spark, f"{options.mart_folder}/dim_a.parquet")
    assert rows_of(read_files(spark, f"{folder}/lake/dw_shop_br", "fact_c")) == TOTALS
    assert not spark.catalog.tableExists("fact_c")


def test_a_second_run_starts_from_the_stage(spark, mart, folder):
    config, metadata, options = mart
    load_dim_fact(spark, config, metadata, options)
    write_files(spark.range(6).withColumn("price", F.lit(1.0)), f"{folder}/stage/lake", "items")
    load_dim_fact(spark, config, metadata, options)
    assert rows_of(read_files(spark, options.mart_folder, "fact_c")) == [("a0", 2.0, 2), ("a1", 2.0, 2), ("a2", 2.0, 2)]


def test_scripts_may_explode_the_series(spark, mart):
    config, metadata, options = mart
    call = "generate_series(DATE'2024-01-31', DATE'2024-04-30')"
    scripts = {
        "exploded": f"SELECT explode({call}) AS month FROM lake_items WHERE id = 1",
        "nested": f"SELECT explode(dates) AS month FROM (SELECT {call} AS dates FROM lake_items WHERE id = 1)",
        "both": "SELECT e.month FROM exploded e JOIN nested n ON e.month = n.month",
    }
    for name, text in scripts.items():
        open(f"{options.script_directory}/shop/br/{name}.sql", "w").write(text)
    config = MartConfig(("lake",), tuple(MartScript(name, f"{name}.sql") for name in scripts), ())
    load_dim_fact(spark, config, metadata, options)
    for name in scripts:
        months = read_files(spark, options.mart_folder, name).orderBy("month").collect()
        assert [row["month"].day for row in months] == [31, 29, 29, 29]


def test_odd_names_and_cases(spark, mart, database):
    config, metadata, options = mart
    text = "SELECT id, id % 2 AS `Odd Key`, 'v' AS `a.b`, concat('k', id % 3) AS Kind FROM lake_items"
    open(f"{options.script_directory}/shop/br/odd.sql", "w").write(text)
    config = MartConfig(("lake",), (MartScript("odd", "odd.sql", ("odd key", "KIND")),), ())
    (table,) = load_dim_fact(spark, config, metadata, replace(options, database=database))
    assert table.partition_by == ("Odd Key", "Kind")
    stored = read_table(spark, database, "odd")
    assert stored.columns == ["id", "Odd Key", "a.b", "Kind"]
    assert rows_of(stored) == rows_of(spark.table("odd")) and stored.count() == 100
    missing = MartConfig(("lake",), (MartScript("odd", "odd.sql", ("nowhere",)),), ())
    with pytest.raises(ValueError, match="nowhere"):
        load_dim_fact(spark, missing, metadata, options)


def test_a_job_may_have_its_own_time_zone(spark, mart):
    config, metadata, options = mart
    text = "SELECT CAST(TIMESTAMP'2024-01-01 12:00:00Z' AS STRING) AS noon, current_timezone() AS zone FROM range(1)"
    open(f"{options.script_directory}/shop/br/zone.sql", "w").write(text)
    config = MartConfig(("lake",), (MartScript("zone", "zone.sql"),), ())
    for zone, noon in (("America/Sao_Paulo", "2024-01-01 09:00:00"), (None, "2024-01-01 12:00:00")):
        load_dim_fact(spark, config, metadata, replace(options, session_timezone=zone))
        assert rows_of(read_files(spark, options.mart_folder, "zone")) == [(noon, zone or "UTC")]
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_mart_never_overwrites_its_stage(spark, mart, folder):
    config, metadata, options = mart
    open(f"{options.script_directory}/shop/br/items.sql", "w").write("SELECT * FROM lake_items")
    config = MartConfig(("lake",), (MartScript("items", "items.sql"),), ())
    options = replace(options, stage_folders={"lake": f"{options.mart_folder}/"})
    write_files(spark.range(9), options.mart_folder, "items")
    with pytest.raises(UnsafeOverwrite):
        load_dim_fact(spark, config, metadata, options)
    assert read_files(spark, options.mart_folder, "items").count() == 9


def test_options_that_cannot_work(mart):
    _, _, options = mart
    with pytest.raises(ValueError):
        replace(options, publish_target="s3://lake", save_files=False)
    with pytest.raises(ValueError):
        replace(options, publish_target="s3a://lake")


def test_held_results_are_columnar_and_leave_nothing_behind(spark, mart, folder):
    config, metadata, options = mart
    write = STAGED_CSV
    plans = []
    import stagemart.plans.dim_fact as job

    held = job._held

    def watched(result, name, scratch):
        out = held(result, name, scratch)
        plans.append((scratch, spark.table(name).filter("1 < 2").select(out.columns[0])._jdf.queryExecution().executedPlan().toString()))
        return out

    job._held = watched
    try:
        options = replace(options, output_format=write, publish_target=f"{folder}/lake", publish_by_copy=False)
        load_dim_fact(spark, config, metadata, options)
    finally:
        job._held = held
    assert len(plans) == 3
    for scratch, plan in plans:
        assert "FileScan parquet" in plan and not exists(spark, scratch)


def test_removing_the_only_copy_is_refused(mart):
    with pytest.raises(ValueError, match="another sink"):
        replace(mart[2], remove_staged=True)
    with pytest.raises(ValueError, match="target"):
        ExtractOptions("base", "project", remove_staged=True)


@pytest.mark.parametrize("parallel", [1, 3])
def test_scripts_run_in_order_of_what_they_read(spark, mart, parallel):
    config, metadata, options = mart
    backwards = MartConfig(config.dependencies, config.facts, config.dimensions[::-1])
    loaded = load_dim_fact(spark, backwards, metadata, replace(options, parallel_scripts=parallel))
    assert [table.name for table in loaded] == ["fact_c", "dim_b", "dim_a"]
    assert rows_of(read_files(spark, options.mart_folder, "fact_c")) == TOTALS


def test_scripts_that_read_each_other_raise_before_any_runs(spark, mart):
    config, metadata, options = mart
    root = f"{options.script_directory}/shop/br/"
    open(root + "one.sql", "w").write("SELECT * FROM lake_items WHERE id IN (SELECT id FROM Two)")
    open(root + "two.sql", "w").write("WITH c AS (SELECT * FROM one) SELECT * FROM c")
    config = MartConfig(("lake",), config.dimensions + (MartScript("one", "one.sql"), MartScript("two", "two.sql")), ())
    with pytest.raises(DependencyCycle, match="one, two"):
        load_dim_fact(spark, config, metadata, options)
    assert not exists(spark, options.mart_folder)


def test_a_run_after_a_failure_takes_over_what_was_finished(spark, mart, folder, monkeypatch):
    import stagemart.plans.dim_fact as job

    config, metadata, options = mart
    options, ran, run = replace(options, resume=True), [], job.run_script
    monkeypatch.setattr(job, "run_script", lambda session, text, name: ran.append(name) or run(session, text, name))

    def load(**changes):
        ran.clear()
        loaded = load_dim_fact(spark, config, metadata, replace(options, **changes))
        return sorted(ran), loaded

    script = f"{options.script_directory}/shop/br/{config.facts[0].file}"
    text = open(script).read()
    open(script, "w").write("SELECT raise_error('stop') AS x FROM dim_a, dim_b")
    with pytest.raises(Exception, match="stop"):
        load()
    assert sorted(ran) == ["dim_a", "dim_b", "fact_c"]
    open(script, "w").write(text)
    assert load()[0] == ["fact_c"] and rows_of(read_files(spark, options.mart_folder, "fact_c")) == TOTALS
    again, loaded = load()
    assert again == [] and [(table.name, table.staged_path) for table in loaded] == [(name, f"{options.mart_folder}/{name}.parquet") for name in ("dim_a", "dim_b", "fact_c")]
    assert rows_of(spark.table("fact_c")) == TOTALS and load(resume=False)[0] == ["dim_a", "dim_b", "fact_c"]
    assert load()[0] == ["dim_a", "dim_b", "fact_c"] and load()[0] == []  # the files are not those that were noted
    write_files(spark.range(6).withColumn("price", F.lit(1.0)), f"{folder}/stage/lake", "items")
    assert load()[0] == ["dim_a", "dim_b", "fact_c"]
    assert rows_of(read_files(spark, options.mart_folder, "fact_c")) == [("a0", 2.0, 2), ("a1", 2.0, 2), ("a2", 2.0, 2)]
    dimension = f"{options.script_directory}/shop/br/{config.dimensions[1].file}"
    open(dimension, "a").write(" -- changed")
    assert load()[0] == ["dim_b", "fact_c"]


def test_only_kept_files_can_be_taken_over(mart):
    with pytest.raises(ValueError, match="kept"):
        replace(mart[2], resume=True, save_files=False)
