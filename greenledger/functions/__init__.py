from greenledger.functions.scalars import (
    OPEN_END,
    blank_to_null,
    concat_nulls,
    concat_skip_nulls,
    empty_to_null,
    is_kilogram_unit,
    lower_first,
    non_blank,
    open_end,
    round3_then_grams,
    scale_if_kilogram,
    strip_trailing_group,
    surrogate_key,
    year_end,
    year_start,
)

__all__ = [
    "OPEN_END", "blank_to_null", "concat_nulls", "concat_skip_nulls", "empty_to_null",
    "is_kilogram_unit", "lower_first", "non_blank", "open_end",
    "round3_then_grams", "scale_if_kilogram", "strip_trailing_group",
    "surrogate_key", "year_end", "year_start",
]
