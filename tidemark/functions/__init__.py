from tidemark.functions.dates import calendar_columns, day_name, month_start, quarter_start
from tidemark.functions.hashing import event_digest, row_hash
from tidemark.functions.numeric import cents, from_cents, revenue_sum, safe_ratio
from tidemark.functions.text import NA_TEXTS, na_to_null, strip, title_case, word_count

__all__ = [
    "NA_TEXTS",
    "calendar_columns",
    "cents",
    "day_name",
    "event_digest",
    "from_cents",
    "month_start",
    "na_to_null",
    "quarter_start",
    "revenue_sum",
    "row_hash",
    "safe_ratio",
    "strip",
    "title_case",
    "word_count",
]
