from stagemart.sinks.files import check_target, parse_partition, publish_copy, publish_direct, write_files
from stagemart.sinks.jdbc import write_table
from stagemart.sinks.tables import create_external_table, drop_external_table

__all__ = [
    "check_target",
    "create_external_table",
    "drop_external_table",
    "parse_partition",
    "publish_copy",
    "publish_direct",
    "write_files",
    "write_table",
]
