"""Column functions. Each takes and returns Columns, so it also works in SQL projections and on streams."""

from pairwright.functions.codes import area_code, region_group
from pairwright.functions.compare import gap_band, match_level, or_zero, present, ratio
from pairwright.functions.dates import age_years, date_serial, parse_moment
from pairwright.functions.numbers import parse_int, parse_number

__all__ = [
    "age_years",
    "area_code",
    "date_serial",
    "gap_band",
    "match_level",
    "or_zero",
    "parse_int",
    "parse_moment",
    "parse_number",
    "present",
    "ratio",
    "region_group",
]
