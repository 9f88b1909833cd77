"""Dates in text: found by their shape, not by a list of whole layouts.

A text is a date if it has one of four forms (year first, year last, day and
month name, month name and day), with or without a time.  Texts are read a
batch of Arrow values at a time: every distinct text of the batch is cut up by
the forms' patterns and its numbers are judged as whole arrays, so nothing
throws and a value costs one reading however many figures are taken from it.
Whether ``1/5/2024`` is January or May is settled by the column as a whole:
month first unless more of its values are dates when read day first.

Times are the text's own clock: a zone (``Z``, ``+05:30``) is accepted and
does not move the time.  Null, blank, impossible (30 February) and other texts
have no date.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.session import ship_package

# English month names.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
          "september", "october", "november", "december"]


def _either_case(word: str) -> str:
    return "".join(f"[{x.upper()}{x}]" for x in word)   # ASCII letters only


_MONTH = "(?P<name>" + "|".join(_either_case(m[:3]) + (f"(?:{_either_case(m[3:])})?" if m[3:] else "") for m in MONTHS) + ")"
_TIME = (r"(?:(?P<mark>[T ])(?P<hour>[0-9]{1,2}):(?P<minute>[0-9]{2})(?::(?P<second>[0-9]{2})(?:[.](?P<fraction>[0-9]{1,9}))?)?"
         r"(?P<zone> ?(?:Z|[+-][0-9]{2}:?[0-9]{2}))?)?")

# A form's letter and pattern; where it has two separators that must agree, the second is called ``again``.
# Only form N leaves the order of day and month open.
_FORMS = [
    ("Y", rf"^(?P<year>[0-9]{{4}})(?P<sep>[-/.])(?P<month>[0-9]{{1,2}})(?P<again>[-/.])(?P<day>[0-9]{{1,2}}){_TIME}\z"),
    ("N", rf"^(?P<month>[0-9]{{1,2}})(?P<sep>[-/.])(?P<day>[0-9]{{1,2}})(?P<again>[-/.])(?P<year>[0-9]{{4}}){_TIME}\z"),
    ("D", rf"^(?P<day>[0-9]{{1,2}})(?P<sep>[- ]){_MONTH}(?P<second_sep>[- ])(?P<year>[0-9]{{4}}){_TIME}\z"),
    ("M", rf"^{_MONTH} (?P<day>[0-9]{{1,2}})(?P<sep>,?) (?P<year>[0-9]{{4}}){_TIME}\z"),
]

# Parts of a layout's number, by place
_FORM_LETTERS, _SEPARATORS, _MARKS = [f for f, _ in _FORMS], ["", "-", "/", ".", " ", ","], ["", "T", " "]
_MONTH_DAYS = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])

#: no date is shorter or longer (in bytes: dates are ASCII); other texts are not read
_SHORTEST, _LONGEST = 8, 48


def _number(s: pa.Array) -> np.ndarray:
    return pc.cast(pc.if_else(pc.equal(s, ""), "0", s), pa.int64()).to_numpy(zero_copy_only=False)


def _place(s: pa.Array, among: list[str]) -> np.ndarray:
    return pc.index_in(s, pa.array(among)).to_numpy(zero_copy_only=False).astype(np.int64)


def _is_day(year: np.ndarray, month: np.ndarray, day: np.ndarray) -> np.ndarray:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    known = (month >= 1) & (month <= 12)
    return known & (day >= 1) & (day <= _MONTH_DAYS[np.where(known, month, 0)] + ((month == 2) & leap))


def _read(texts: pa.Array, day_first: bool | None):
    """Of each text the number of its layout (``day_first`` None) or its time in microseconds; and whether it has one."""
    out, has = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
    for letter, pattern in _FORMS:
        cut = pc.extract_regex(texts, pattern)
        at = np.flatnonzero(cut.is_valid().to_numpy(zero_copy_only=False))
        if not len(at):
            continue
        cut = cut.take(pa.array(at))
        part = {f.name: pc.struct_field(cut, f.name) for f in cut.type}
        if "again" in part:
            agree = pc.equal(part["sep"], part["again"])
            at = at[agree.to_numpy(zero_copy_only=False)]
            part = {k: v.filter(agree) for k, v in part.items()}
        year, day, hour, minute, second = (_number(part[k]) for k in ("year", "day", "hour", "minute", "second"))
        month = _number(part["month"]) if "month" in part else _place(pc.utf8_slice_codeunits(pc.ascii_lower(part["name"]), 0, 3), [m[:3] for m in MONTHS]) + 1
        timely = (hour < 24) & (minute < 60) & (second < 60)
        other = (day, month) if letter == "N" else (month, day)
        if day_first is None:
            shape = np.full(len(at), _FORM_LETTERS.index(letter))
            without = [pc.equal(part[k], "").to_numpy(zero_copy_only=False) for k in ("second", "zone")]
            second_sep = _place(part["second_sep"], _SEPARATORS) if "second_sep" in part else 0
            for place, of in ((_place(part["sep"], _SEPARATORS), 6), (second_sep, 6), (_place(part["mark"], _MARKS), 3), *((w, 2) for w in without)):
                shape = shape * of + place
            out[at] = shape * 4 + (timely & _is_day(year, month, day)) + 2 * (timely & _is_day(year, *other))
            has[at] = True
        else:
            month, day = other if day_first else (month, day)
            ok = timely & _is_day(year, month, day)
            nano = _number(pc.utf8_rpad(part["fraction"], 9, "0"))
            first = (year - 1970).astype("datetime64[Y]").astype("datetime64[M]") + (np.where(ok, month, 1) - 1)
            days = first.astype("datetime64[D]").astype(np.int64) + day - 1
            out[at] = (((days * 24 + hour) * 60 + minute) * 60 + second) * 1_000_000 + (nano + 500) // 1000
            has[at] = ok
    return out, has


def _by_distinct(texts: pa.Array, day_first: bool | None) -> pa.Array:
    coded = texts.dictionary_encode()
    out, has = _read(coded.dictionary, day_first)
    return pa.array(out, pa.int64(), mask=~has).take(coded.indices)


@F.arrow_udf(T.LongType())
def _layout_numbers(texts: pa.Array) -> pa.Array:
    return _by_distinct(texts, None)


@F.arrow_udf(T.TimestampNTZType())
def _month_first_times(texts: pa.Array) -> pa.Array:
    return _by_distinct(texts, False).cast(pa.timestamp("us"))


@F.arrow_udf(T.TimestampNTZType())
def _day_first_times(texts: pa.Array) -> pa.Array:
    return _by_distinct(texts, True).cast(pa.timestamp("us"))


def _worth_reading(c: Column) -> Column:
    ship_package(SparkSession.getActiveSession())
    return F.when(F.octet_length(c).between(_SHORTEST, _LONGEST), c)


def pieces(c: Column) -> Column:
    """The number of the text's layout and whether it is a date month first (1) and day first (2); null if it has no form.

    A layout is form, separators, and whether there is a time, seconds and a zone (fractions may be left out).
    To be put into a column of its own where several expressions read it.
    """
    return _layout_numbers(_worth_reading(c))


def is_date(p: Column, day_first: bool = False) -> Column:
    """Whether pieces are a day of the calendar and a time of the day (false, not null, without pieces)."""
    return F.coalesce(p.bitwiseAND(F.lit(2 if day_first else 1)) != 0, F.lit(False))


def wall_time(c: Column, day_first: bool = False) -> Column:
    """The text's date and time as TIMESTAMP_NTZ, else null."""
    return (_day_first_times if day_first else _month_first_times)(_worth_reading(c))


def signature(p: Column) -> Column:
    """A date's layout as a number."""
    return F.shiftright(p, 2)


def layout_counts(p: Column, tag: str) -> list[Column]:
    """Aggregates over a column of pieces: dates read month first and day first, and the ends of their signatures."""
    first, other = is_date(p), is_date(p, day_first=True)
    shape = F.when(first | other, signature(p))
    return [F.count(F.when(first, 1)).alias(f"{tag}_month_first"), F.count(F.when(other, 1)).alias(f"{tag}_day_first"),
            F.min(shape).alias(f"{tag}_shape_low"), F.max(shape).alias(f"{tag}_shape_high")]


def dates_of_one_layout(tag: str) -> Column:
    """From ``layout_counts``: how many values one layout parses; -1 if the column's dates have several layouts."""
    return (F.when(F.col(f"{tag}_shape_low") != F.col(f"{tag}_shape_high"), F.lit(-1).cast("bigint"))
            .otherwise(F.greatest(f"{tag}_month_first", f"{tag}_day_first")))


def day_first_columns(df: DataFrame, cols: list[str]) -> set[str]:
    """Text columns of which more values are dates when read day first (one scan for all columns)."""
    if not cols:
        return set()
    cut = df.select(*[pieces(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    found = cut.agg(*[x for i in range(len(cols)) for x in layout_counts(F.col(f"c{i}"), f"c{i}")[:2]]).first()
    return {c for i, c in enumerate(cols) if found[f"c{i}_day_first"] > found[f"c{i}_month_first"]}
