from stagemart.functions.series import (
    expand_series,
    explode_series,
    generate_series,
    register_explodable_series,
    register_series,
)

__all__ = ["expand_series", "explode_series", "generate_series", "register_explodable_series", "register_series"]
