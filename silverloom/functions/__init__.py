from silverloom.functions.convert import cast_to, to_date, to_double, to_float, to_int, to_long
from silverloom.functions.json_cells import extract_value, parse_objects

__all__ = [
    "cast_to",
    "extract_value",
    "parse_objects",
    "to_date",
    "to_double",
    "to_float",
    "to_int",
    "to_long",
]
