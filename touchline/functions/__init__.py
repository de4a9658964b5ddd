"""Column expressions: lenient parsing, season years, flags."""

from .parsing import lenient_int, match_date, season_start_year, two_digit_year_century
from .metrics import flag

__all__ = [
    "lenient_int", "match_date", "season_start_year", "two_digit_year_century",
    "flag",
]
