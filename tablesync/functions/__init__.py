"""Scalar building blocks: type map, conversions, row hash, time literals."""

from .casting import (  # noqa: F401
    date_text, empty_to_null, epoch_to_timestamp, iso_text, parse_timestamp,
    timestamp_to_epoch, to_boolean, to_float64, to_int64, to_numeric, to_target,
)
from .hashing import canonical_text, row_hash, with_row_hash  # noqa: F401
from .timeutil import bound_for, epoch_seconds, iso, minus, ts_lit  # noqa: F401
from .types import (  # noqa: F401
    MYSQL_TO_TARGET, base_type, map_types, target_type_py, type_map_frame,
)
