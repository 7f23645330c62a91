"""Let the executors import this package, as ``--py-files`` would."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_NAME = "stagemart-code.zip"
_BATCH_BYTES, _DEFAULT_BATCH_BYTES, _SMALLER = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Hand the package's source to Spark once per context; Spark brings it to every executor.

    Also sets Arrow batches, which exist several times over on their way through a task, from
    Spark's default of 64 MB to 8 MB; a session that sets another size keeps it.
    """
    if spark._jsparkSession.sessionState().conf().getConfString(_BATCH_BYTES) == f"{_DEFAULT_BATCH_BYTES}b":
        spark.conf.set(_BATCH_BYTES, _SMALLER)
    context = spark.sparkContext
    if _NAME not in context._python_includes:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="stagemart-code-")) / _NAME
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
    return spark


def session_of(frame: DataFrame) -> SparkSession:
    return ship(frame.sparkSession)
