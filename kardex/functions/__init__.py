from kardex.functions.dates import date_between, days_in_month, in_day_range, month_start, year_month
from kardex.functions.joins import bounded_broadcast, fits_broadcast, sequence_number, unique_lookup
from kardex.functions.numeric import (MONEY, parse_count, round_double, round_money, safe_div,
                                      signed_by_type)

__all__ = [
    "MONEY", "bounded_broadcast", "date_between", "days_in_month", "fits_broadcast", "in_day_range",
    "month_start", "parse_count", "round_double", "round_money", "safe_div", "sequence_number",
    "signed_by_type", "unique_lookup", "year_month",
]
