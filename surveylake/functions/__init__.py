"""Column-level functions (casts and cleansing); all built-in expressions."""

from .casts import (apply_schema, cast_bool, cast_date, cast_datetime, cast_float, cast_for,
                    cast_int, cast_numeric, is_blank, reject_count_column, resolve)
from .cleanse import (add_period, camel_name, composite_key, day_text, decode_base64_text,
                      encode_base64_text, load_timestamp, nan, null_if_text, nz, period, recode,
                      strip_offset, strip_prefixes, stringify_frame, to_numeric, upper_columns,
                      with_audit)

__all__ = [n for n in dir() if not n.startswith("_")]
