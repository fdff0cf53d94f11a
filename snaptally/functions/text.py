"""Text-to-typed parsing used by the file sources (CSV, backup names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """'' -> NULL, other values unchanged."""
    return F.nullif(_c(c), F.lit(""))


def blank_kept(c) -> Column:
    """NULL -> '' (a missing or empty text field stays an empty string)."""
    return F.coalesce(_c(c), F.lit(""))


def parse_int(c) -> Column:
    """Blank -> NULL; surrounding spaces allowed; anything else that is not
    an integer fails the job under ANSI, like the source's ``int()``."""
    return F.nullif(F.trim(_c(c)), F.lit("")).cast("int")


def parse_int_default(c, default: int = 0) -> Column:
    """Like ``parse_int`` but a blank gives ``default`` (counters)."""
    return F.coalesce(parse_int(c), F.lit(default))


def parse_bool_text(c) -> Column:
    """'true' in any case -> True; anything else, blank or missing -> False."""
    return F.coalesce(F.lower(_c(c)) == F.lit("true"), F.lit(False))


# Fixed value: ISO-8601 date-time with an optional zone suffix
# ('Z' or +hh, +hhmm, +hh:mm); group 1 is the local part, 2 the zone.
ISO_ZONED = (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*"
             r"(Z|z|[+-]\d{2}(?::?\d{2})?)?$")
# the same in its usual form, to the second in UTC: the first 19 characters are the time
ISO_UTC = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}[Zz]?\z"


def _utc_ntz(c, parse) -> Column:
    """Shared body of the ISO parsers; ``parse`` turns local text into NTZ."""
    s = blank_to_null(F.trim(_c(c)))
    local = F.regexp_extract(s, ISO_ZONED, 1)
    zone = F.regexp_extract(s, ISO_ZONED, 2)
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    secs = F.when(F.length(digits) == 0, F.lit(0)).otherwise(
        sign * (F.substring(digits, 1, 2).cast("int") * 3600
                + F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).cast("int"), F.lit(0)) * 60))
    matched = s.rlike(ISO_ZONED)
    shifted = parse(F.regexp_replace(local, " ", "T")) - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    # date-only and other forms: parsed as they are (no zone)
    other = F.when(matched, shifted).otherwise(parse(s))
    return F.when(_c(c).rlike(ISO_UTC), parse(F.substring(_c(c), 1, 19))).otherwise(other)


def parse_iso_ts(c) -> Column:
    """ISO-8601 text with 'Z', an offset or no zone -> UTC TIMESTAMP_NTZ.

    Blank -> NULL. The offset is applied arithmetically, so the stored wall
    time never depends on the session zone. Unparsable text fails the job
    under ANSI, as the source's parser raises.
    """
    return _utc_ntz(c, lambda t: F.to_timestamp_ntz(t))


def try_parse_iso_ts(c) -> Column:
    """Like ``parse_iso_ts`` but unparsable text gives NULL."""
    return _utc_ntz(c, lambda t: F.try_to_timestamp(t).cast("timestamp_ntz"))


# Fixed value: the accepted form of a base-16 integer literal, as Python's
# int(text, 16) reads it: optional blanks and sign, optional 0x prefix,
# hex digits with single underscores between them.
HEX_INT_PATTERN = r"^\s*[+-]?(0[xX]_?)?[0-9A-Fa-f]+(_[0-9A-Fa-f]+)*\s*$"


def hex_suffix_id(pid, fallback) -> Column:
    """Integer of the last 8 characters of ``pid`` read as hex.

    A NULL/empty ``pid`` or a suffix that is not a hex literal gives
    ``fallback`` (the row's position in its file). ``conv`` alone would
    silently accept bad digits, hence the pattern guard.
    """
    p = _c(pid)
    tail = F.substring(p, -8, 8)
    ok = p.isNotNull() & (F.length(p) > 0) & tail.rlike(HEX_INT_PATTERN)
    t = F.regexp_replace(F.regexp_replace(tail, r"^\s+|\s+$", ""), "_", "")
    neg = t.startswith("-")
    digits = F.regexp_replace(t, r"^[+-]?(0[xX])?", "")
    val = F.conv(digits, 16, 10).cast("long")
    other = F.when(ok, F.when(neg, -val).otherwise(val)).otherwise(_c(fallback).cast("long"))
    # the usual suffix, digits alone, needs one pattern
    return F.when(tail.rlike(r"^[0-9A-Fa-f]+\z"), F.conv(tail, 16, 10).cast("long")).otherwise(other)
