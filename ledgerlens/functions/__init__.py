from ledgerlens.functions.keys import packed_key, surrogate_key, surrogate_key_sql, unpacked_key
from ledgerlens.functions.cleaning import (
    blank_to_null, norm_upper, try_date, try_money, try_rate, yn_flag,
    try_date_sql, DATE_SHAPE,
)

__all__ = [
    "surrogate_key", "surrogate_key_sql", "packed_key", "unpacked_key", "blank_to_null", "norm_upper",
    "try_date", "try_money", "try_rate", "yn_flag", "try_date_sql", "DATE_SHAPE",
]
