"""Dimension and fact job: SQL scripts over stage views to files, a database and an object store."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructType

from stagemart.datasets import current_path, files_below, get_text, path_exists, put_text
from stagemart.errors import UnsafeOverwrite
from stagemart.functions.series import expand_series, register_series
from stagemart.names import as_spelled, quoted
from stagemart.operators.decimals import normalize_decimals, same_types
from stagemart.operators.parsed import ParsedScript, dependency_levels
from stagemart.operators.scripts import read_script, run_script
from stagemart.session import delete_path, new_folder, qualified, session_timezone
from stagemart.sinks.files import check_target, parse_partition, publish_copy, publish_direct, write_files
from stagemart.sinks.jdbc import write_table
from stagemart.sources.files import PARQUET, FileFormat, dataset_path, read_files, register_stage_view
from stagemart.sources.jdbc import DEFAULT_FETCH_SIZE, DEFAULT_NUM_PARTITIONS, Database
from stagemart.sources.metadata import StageMetadata, stage_tables

#: The folder of a mart that notes what each finished result was made of.
_RUNS = "_runs"


@dataclass(frozen=True)
class MartScript:
    name: str
    file: str
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class MartConfig:
    """Stage schemas a project depends on, and its dimensions and facts, in any order."""

    dependencies: tuple[str, ...]
    dimensions: tuple[MartScript, ...]
    facts: tuple[MartScript, ...]

    @classmethod
    def from_mapping(cls, config: Mapping[str, Mapping]) -> MartConfig:
        """From ``dependency``, ``dimensions`` and ``facts``; a script without a body runs ``{name}.sql``."""

        def scripts(section: str) -> tuple[MartScript, ...]:
            found = []
            for name, body in (config.get(section) or {}).items():
                body = body or {}
                partition_by = tuple(parse_partition(body.get("partition")))
                found.append(MartScript(name, body.get("file") or f"{name}.sql", partition_by))
            return tuple(found)

        return cls(tuple((config.get("dependency") or {}).values()), scripts("dimensions"), scripts("facts"))


@dataclass(frozen=True)
class MartOptions:
    """Where the stage files are, and which sinks get each result.

    Stage tables of a schema lie in ``{stage_directory}/{schema}``, unless ``stage_folders`` names
    another folder for it. The job runs in ``session_timezone``, or in that of the session.
    ``parallel_scripts`` scripts run at a time, each in a scheduler pool of its own. ``resume`` takes over the files that an
    earlier run has finished with the same scripts, settings and stage files.
    """

    project: str
    country: str
    stage_directory: str
    base_directory: str
    script_directory: str
    stage_folders: Mapping[str, str] = field(default_factory=dict)
    input_format: FileFormat = PARQUET
    output_format: FileFormat = PARQUET
    save_files: bool = True
    compact: bool = False
    remove_staged: bool = False
    database: Database | None = None
    batch_size: int = DEFAULT_FETCH_SIZE
    database_connections: int = DEFAULT_NUM_PARTITIONS
    publish_target: str | None = None
    publish_by_copy: bool = True
    session_timezone: str | None = None
    parallel_scripts: int = 1
    resume: bool = False

    def __post_init__(self) -> None:
        check_target(self.publish_target, self.publish_by_copy)
        if self.publish_target is not None and self.publish_by_copy and not self.save_files:
            raise ValueError("publishing by copy needs the files to be saved")
        if self.resume and (not self.save_files or self.remove_staged):
            raise ValueError("only files that are kept can be taken over")
        if self.remove_staged and self.publish_target is None and self.database is None:
            raise ValueError("removing the staged files needs another sink to keep the results")

    @property
    def project_schema(self) -> str:
        return f"dw_{self.project}_{self.country}"

    @property
    def mart_folder(self) -> str:
        return f"{self.base_directory.rstrip('/')}/{self.project_schema}"

    @property
    def publishes_directly(self) -> bool:
        return self.publish_target is not None and not self.publish_by_copy


@dataclass(frozen=True)
class MartTable:
    name: str
    schema: StructType
    partition_by: tuple[str, ...]
    staged_path: str | None
    database_table: str | None
    published_path: str | None


def load_dim_fact(
    spark: SparkSession,
    config: MartConfig,
    metadata: Mapping[str, StageMetadata],
    options: MartOptions,
) -> list[MartTable]:
    """Run all dimensions and facts, each after those whose results it reads. ``metadata`` is keyed by dependency schema.

    Scripts see the stage tables as ``{schema}_{table}`` and other results by their names. What a script reads
    is taken from its parsed plan; ``DependencyCycle`` is raised, before anything runs, if scripts read
    each other. With ``resume``, a result is taken over if a run has finished it from the same script, settings, stage files and results read.
    """
    with session_timezone(spark, options.session_timezone):
        return _load_all(spark, config, metadata, options)


def _load_all(
    spark: SparkSession,
    config: MartConfig,
    metadata: Mapping[str, StageMetadata],
    options: MartOptions,
) -> list[MartTable]:
    scripts = config.dimensions + config.facts
    for script in scripts:
        # A result of an earlier run in this session must not be read instead of a stage view.
        spark.catalog.dropTempView(script.name)
    stage_paths: dict[str, str] = {}
    for schema in config.dependencies:
        folder = options.stage_folders.get(schema, f"{options.stage_directory.rstrip('/')}/{schema}")
        for row in stage_tables(metadata[schema]).select("table_name").collect():
            register_stage_view(spark, folder, schema, row["table_name"], options.input_format)
            path = dataset_path(folder, row["table_name"], options.input_format)
            stage_paths[f"{schema}_{row['table_name']}".lower()] = qualified(spark, path)
    for script in scripts:
        path = dataset_path(options.mart_folder, script.name, options.output_format)
        if qualified(spark, path) in stage_paths.values():
            raise UnsafeOverwrite(f"{path} is a stage table")
    register_series(spark)

    by_name = {script.name: script for script in scripts}
    texts = {script.name: read_script(options.script_directory, options.project, options.country, script.file) for script in scripts}
    texts = {name: expand_series(spark, text) for name, text in texts.items()}
    reads = {name: ParsedScript(spark, text).relations() for name, text in texts.items()}
    levels = dependency_levels(reads)
    scratch = new_folder(spark, "held")
    loaded: dict[str, MartTable] = {}
    keys: dict[str, str] = {}

    def load(name: str) -> MartTable:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return _load_or_take_over(spark, by_name[name], texts[name], keys.get(name), options, f"{scratch}/{name}")

    try:
        with ThreadPoolExecutor(max_workers=options.parallel_scripts) as pool:
            for level in levels:
                if options.resume:
                    # of the results read, the keys stand for all that they were made of
                    keys |= {name: _run_key(spark, by_name[name], texts[name], reads[name], stage_paths, keys, options) for name in level}
                loaded |= zip(level, pool.map(inheritable_thread_target(spark)(load), level))
    finally:
        # Views of results that were held beside the files go with what they read.
        for script in scripts:
            if delete_path(spark, f"{scratch}/{script.name}"):
                spark.catalog.dropTempView(script.name)
        delete_path(spark, scratch)
    if options.remove_staged and options.save_files:
        for script in scripts:
            # The views read the files that go now.
            spark.catalog.dropTempView(script.name)
            delete_path(spark, dataset_path(options.mart_folder, script.name, options.output_format))
    return [loaded[script.name] for script in scripts]


def _run_key(
    spark: SparkSession, script: MartScript, text: str, reads: set[str], stage_paths: Mapping[str, str], keys: Mapping[str, str], options: MartOptions
) -> str:
    """A digest of all that a result depends on: its script, the settings, the stage files it reads, and the keys of the results it reads."""
    known = {name.lower(): key for name, key in keys.items()}
    files = {name: files_below(spark, current_path(spark, stage_paths[name])) for name in sorted(reads & stage_paths.keys())}
    held = {name: known[name] for name in sorted(reads & known.keys())}
    settings = [repr(option) for option in (options.input_format, options.output_format, options.compact, options.publish_target, options.publish_by_copy)]
    settings += [options.project_schema, spark.conf.get("spark.sql.session.timeZone"), repr(options.database)]
    return hashlib.sha256(json.dumps([text, script.partition_by, files, held, settings], sort_keys=True).encode()).hexdigest()


def _load_or_take_over(spark: SparkSession, script: MartScript, text: str, key: str | None, options: MartOptions, scratch: str) -> MartTable:
    """With a key, the result of an earlier run under the same key, if its files are there as that run left them."""
    if key is None:
        return _load_script(spark, script, text, options, scratch)
    path = dataset_path(options.mart_folder, script.name, options.output_format)
    noted = f"{options.mart_folder}/{_RUNS}/{script.name}.json"
    told = json.loads(get_text(spark, noted) or "null")
    if told and told["key"] == key and told["files"] == json.loads(json.dumps(files_below(spark, path))):
        schema = StructType.fromJson(told["schema"])
        read_files(spark, options.mart_folder, script.name, options.output_format, schema).select([quoted(name) for name in schema.names]).createOrReplaceTempView(script.name)
        return MartTable(script.name, schema, tuple(told["partition_by"]), path, told["database_table"], told["published_path"])
    mart = _load_script(spark, script, text, options, scratch)
    if _files_can_hold(mart.schema, mart.partition_by, options) and not path_exists(spark, scratch):
        held = {"database_table": mart.database_table, "published_path": mart.published_path, "partition_by": mart.partition_by}
        files = files_below(spark, path)
        put_text(spark, noted, json.dumps({"key": key, "schema": mart.schema.jsonValue(), "files": files, **held}))
    return mart


def _load_script(spark: SparkSession, script: MartScript, text: str, options: MartOptions, scratch: str) -> MartTable:
    """Run one script and send its result to every enabled sink, computing it once.

    The files of the file sink, or else a parquet dataset at ``scratch``, feed the other sinks and
    scripts. Both outlive the executors, keep their columns apart for later scans, and a few
    database connections then do not slow the query down. The job deletes its scratch.
    """
    name = script.name
    result = run_script(spark, text, name)
    partition_by = as_spelled(result.schema, script.partition_by)
    beside_files = options.database is not None or options.publishes_directly
    if beside_files and not _files_can_hold(result.schema, partition_by, options):
        result = _held(result, name, scratch)
    rows = normalize_decimals(result)

    staged = stored = published = None
    held_by_files = False
    if options.save_files:
        staged = write_files(
            rows, options.mart_folder, name, options.output_format, partition_by, options.compact
        )
        written = _read_back(spark, name, rows.schema, partition_by, options)
        held_by_files = written is not None
        if held_by_files:
            if same_types(rows.schema, result.schema):
                written.createOrReplaceTempView(name)
            rows = written
        elif beside_files and _files_can_hold(result.schema, partition_by, options):
            result = _held(result, name, scratch)
            rows = normalize_decimals(result)
    if options.database is not None:
        target = options.database
        if target.schema is None:
            target = replace(target, schema=options.project_schema)
        stored = write_table(rows, target, name, options.batch_size, options.database_connections)
    if options.publishes_directly:
        published = publish_direct(
            rows,
            options.publish_target,
            options.project_schema,
            name,
            options.output_format,
            partition_by,
            rebalance=not held_by_files,
        )
    elif options.publish_target is not None:
        published = publish_copy(
            spark,
            options.mart_folder,
            options.publish_target,
            options.project_schema,
            name,
            options.output_format,
            partition_by,
            rows.schema,
        )
    kept = None if options.remove_staged else staged
    return MartTable(name, rows.schema, partition_by, kept, stored, published)


def _held(result: DataFrame, name: str, scratch: str) -> DataFrame:
    """The rows as an unpartitioned parquet dataset, which holds every value of every type."""
    result.write.parquet(scratch)
    held = result.sparkSession.read.schema(result.schema).parquet(scratch)
    held.createOrReplaceTempView(name)
    return held


def _files_can_hold(schema: StructType, partition_by: tuple[str, ...], options: MartOptions) -> bool:
    """True if files read back can give the rows that were written.

    CSV holds text only, and the folder name of a partition does not show every digit of a
    fraction or a timestamp.
    """
    exact = (IntegralType, DateType, BooleanType, StringType)
    return (
        options.save_files
        and options.output_format.file_type == "parquet"
        and all(isinstance(schema[column].dataType, exact) for column in partition_by)
    )


def _read_back(
    spark: SparkSession, name: str, schema: StructType, partition_by: tuple[str, ...], options: MartOptions
) -> DataFrame | None:
    """The rows as the mart files hold them, None if the files do not tell all values apart.

    A partition folder shows an empty string as NULL. If no folder does, there was none of either.
    """
    if not _files_can_hold(schema, partition_by, options):
        return None
    written = read_files(spark, options.mart_folder, name, options.output_format, schema)
    for column in partition_by:
        if isinstance(schema[column].dataType, StringType):
            # Answered from the folder names: no other partition is read.
            if not written.filter(F.col(quoted(column)).isNull()).isEmpty():
                return None
    return written.select([quoted(column) for column in schema.names])
