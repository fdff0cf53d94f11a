from .numeric import (EXACT, distinct_count, else_count, exact, ms_to_minutes,
                      positive, positive_weighted, round_half_away)
from .text import (blank_kept, blank_to_null, hex_suffix_id, parse_bool_text,
                   parse_int, parse_int_default, parse_iso_ts, try_parse_iso_ts)

__all__ = [
    "EXACT", "distinct_count", "else_count", "exact", "ms_to_minutes", "positive",
    "positive_weighted", "round_half_away",
    "blank_kept", "blank_to_null", "hex_suffix_id", "parse_bool_text", "parse_int",
    "parse_int_default", "parse_iso_ts", "try_parse_iso_ts",
]
