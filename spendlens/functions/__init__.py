from spendlens.functions.arithmetic import safe_ratio
from spendlens.functions.parsing import (
    any_time,
    coerce_double,
    coerce_int,
    epoch_ms,
    iso_day,
    json_field,
    ntz_literal,
    path_safe,
    printed_date,
)

__all__ = [
    "any_time",
    "coerce_double",
    "coerce_int",
    "epoch_ms",
    "iso_day",
    "json_field",
    "ntz_literal",
    "path_safe",
    "printed_date",
    "safe_ratio",
]
