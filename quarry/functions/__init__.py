"""Column-expression helpers; all JVM-side built-ins, no Python UDF."""

from quarry.functions.columns import (
    key_bucket,
    md5_order_key,
    present,
    py_float_str,
    py_list_str,
    py_str_repr,
    py_value,
    rounded,
)

__all__ = ["key_bucket", "md5_order_key", "present", "py_float_str", "py_list_str", "py_str_repr", "py_value", "rounded"]
