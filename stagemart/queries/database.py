"""The database that the JDBC queries talk to.

``spark.stagemart.jdbc.url`` (with ``.user``, ``.password``, ``.driver``, ``.schema``) names one
that all executors reach; the queries replace the tables ``customer``, ``orders`` and ``part`` in its
schema. Without it, an embedded in-memory database inside the driver process
stands in; only that process sees it, so it serves local mode alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stagemart.sinks.jdbc import write_table
from stagemart.sources.jdbc import Database

_PREFIX = "spark.stagemart.jdbc"


def check_database(spark: SparkSession) -> Database:
    """The configured database, or a new embedded one."""
    setting = {key: spark.conf.get(f"{_PREFIX}.{key}", None) for key in ("url", "user", "password", "driver", "schema")}
    if setting["url"]:
        if not setting["schema"]:
            raise ValueError(f"set {_PREFIX}.schema to a schema whose tables may be replaced")
        return Database(**setting)
    master = spark.sparkContext.master
    # The executors of local-cluster[...] are processes of their own, as on any cluster.
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {_PREFIX}.url to a database that all executors reach")
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.field", "java.lang.System.err")
    return Database(
        url=f"jdbc:derby:memory:stagemart{uuid.uuid4().hex};create=true",
        schema="APP",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def load_tables(spark: SparkSession, database: Database, tables: dict[str, DataFrame]) -> None:
    for name, frame in tables.items():
        write_table(frame, database, name)
