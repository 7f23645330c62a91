"""Column names as Spark SQL and as schemas spell them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_spelled(schema: StructType, names: Iterable[str]) -> tuple[str, ...]:
    """The given names, which may differ in case, as the schema has them."""
    known = {name.lower(): name for name in schema.names}
    missing = [name for name in names if name.lower() not in known]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return tuple(known[name.lower()] for name in names)
