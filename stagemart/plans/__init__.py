from stagemart.plans.advise import advise_stage_tables
from stagemart.plans.dim_fact import MartConfig, MartOptions, MartScript, MartTable, load_dim_fact
from stagemart.plans.extract import ExtractedTable, ExtractOptions, extract_tables

__all__ = [
    "ExtractOptions",
    "ExtractedTable",
    "MartConfig",
    "MartOptions",
    "MartScript",
    "MartTable",
    "advise_stage_tables",
    "extract_tables",
    "load_dim_fact",
]
