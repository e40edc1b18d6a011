from tillscope.functions.calendar import month_number, week_number, year_number
from tillscope.functions.lenient import lenient_date, lenient_double, lenient_int

__all__ = [
    "lenient_date",
    "lenient_double",
    "lenient_int",
    "month_number",
    "week_number",
    "year_number",
]
