"""Column expressions shared by the operators (all JVM-side built-ins)."""

from stintwise.functions.columns import (
    flag_or_false,
    is_active,
    took_part,
    year_from_path,
)

__all__ = ["flag_or_false", "is_active", "took_part", "year_from_path"]
