from lakeloom.functions.convert import as_date, as_money, as_timestamp, title_case, trimmed
from lakeloom.functions.calendar import calendar_columns
from lakeloom.functions.keys import surrogate_key
from lakeloom.functions.watermark import LOWEST_WATERMARK, high_water_mark

__all__ = [
    "LOWEST_WATERMARK",
    "as_date",
    "as_money",
    "as_timestamp",
    "calendar_columns",
    "high_water_mark",
    "surrogate_key",
    "title_case",
    "trimmed",
]
