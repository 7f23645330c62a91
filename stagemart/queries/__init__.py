from stagemart.queries import jobs, sinks, sources, transforms  # noqa: F401  (they register themselves)
from stagemart.queries.registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
