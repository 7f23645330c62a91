from stagemart.operators.advisor import advise_partitions
from stagemart.operators.ddl import external_ddl_as_written, external_ddl_oracle, external_ddl_postgres
from stagemart.operators.decimals import normalize_decimals
from stagemart.operators.scripts import read_script, run_script
from stagemart.operators.slices import cut_points, slice_predicates

__all__ = [
    "advise_partitions",
    "cut_points",
    "external_ddl_as_written",
    "external_ddl_oracle",
    "external_ddl_postgres",
    "normalize_decimals",
    "read_script",
    "run_script",
    "slice_predicates",
]
