"""Cleaning of single values: Column -> Column, no I/O."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted years and time formats.
FIRST_YEAR, LAST_YEAR = 2020, 2030
TIME_FORMATS = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd", "dd/MM/yyyy"]
DATE_AND_CLOCK_FORMATS = ["dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm"]
DATE_FORMAT = "dd/MM/yyyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The patterns of container_number, facility_code, facility_prefix, raw_facility and event_type are fixed values.


def container_number(raw: Column | str) -> Column:
    """Letters and digits only, upper case; nothing left: null."""
    return F.nullif(F.upper(F.regexp_replace(_col(raw), "[^A-Za-z0-9]", "")), F.lit(""))


def facility_code(*candidates: Column | str) -> Column:
    """The first candidate that holds CT and two digits anywhere gives the code; none: null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(F.upper(F.trim(_col(c).cast("string"))), r"(CT\d{2})", 1), F.lit("")) for c in candidates])


def facility_prefix(*candidates: Column | str) -> Column:
    """The stricter rule: only the first non-null candidate counts, and the code must stand at its start."""
    return F.nullif(F.regexp_extract(F.upper(F.trim(F.coalesce(*[_col(c).cast("string") for c in candidates]))), r"^(CT\d{2})", 1), F.lit(""))


def raw_facility(value: Column | str) -> Column:
    """Facility of a raw record: case counts, and no code is UNKNOWN."""
    return F.coalesce(F.nullif(F.regexp_extract(_col(value), r"(CT\d{2})", 1), F.lit("")), F.lit("UNKNOWN"))


def event_time(time: Column | str, date: Column | str | None = None, clock: Column | str | None = None) -> Column:
    """The format that fits, then date and clock, then the date alone; years out of range: null."""
    return in_range(read_time(time, date, clock))


def read_time(time: Column | str, date: Column | str | None = None, clock: Column | str | None = None) -> Column:
    """event_time() of any year."""
    tries = [by_shape(_col(time), TIME_FORMATS)]
    if date is not None and clock is not None:
        tries.append(by_shape(F.concat_ws(" ", _col(date), _col(clock)), DATE_AND_CLOCK_FORMATS))
        tries.append(by_shape(_col(date), [DATE_FORMAT]))
    return F.coalesce(*tries)


def by_shape(text: Column, formats: list[str]) -> Column:
    """The format whose digits and signs lie as in the text, so that only one is tried; a text fits no more than one."""
    shape, out = F.translate(text, "012345678", "9" * 9), F.lit(None).cast("timestamp")
    for f in reversed(formats):
        like = re.sub("[a-zA-Z]", "9", f.replace("'T'", "\0")).replace("\0", "T")
        out = F.when(shape == like, F.try_to_timestamp(text, F.lit(f))).otherwise(out)
    return out


def in_range(time: Column) -> Column:
    return F.when(F.year(time).between(FIRST_YEAR, LAST_YEAR), time)


def event_type(raw: Column | str, allowed: list[str]) -> Column:
    """Runs of blanks and dashes become one underscore, other symbols go; not on the list: null."""
    clean = F.upper(F.regexp_replace(F.regexp_replace(F.trim(_col(raw)), r"[\s\-]+", "_"), "[^A-Za-z0-9_]", ""))
    return F.when(clean.isin(allowed), clean)


def label(raw: Column | str) -> Column:
    return F.upper(F.trim(_col(raw)))


def text_id(*columns: Column | str) -> Column:
    """md5 of the values as text with bars between; null is empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]))


def cycle_id(container: Column | str, gate_in: Column | str, facility: Column | str) -> Column:
    """md5 of the three, nulls left out."""
    return F.md5(F.concat_ws("|", _col(container), _col(gate_in).cast("string"), _col(facility)))
