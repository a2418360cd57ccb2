"""Date parsing and rendering.

A text is rewritten to one ISO form by a chain of regex replacements that uses
it once, and parsed once by the cast (no format objects, no exceptions), so the
expression stays small whatever forms are accepted. A bad value gives null
(never an error under ANSI mode) and the caller decides the fallback (usually
the run time). Naive text is read as UTC; the session time zone must be UTC
(``prepare``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 8601 calendar date with optional time, fraction and offset.
_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2})?)"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?" + _OFFSET + r"?)?$"
# A clock time that ends with a zone offset.
_HAS_OFFSET = r"(?i)(?:[t ]\d{1,2}|:\d{2}(?:\.\d+)?\s*(?:[ap]m)?)\s*" + _OFFSET + r"\s*$"
_PM = r"(?i):\d{2}\s*pm"

# The rewriting of lower-case text, in order.
_WEEKDAY = r"^[a-z]{3,9}(?:,\s+(?=[a-z]{3,9} \d|\d{1,2}[ /]|\d{4}[/-])|\s+(?=\d{1,2} [a-z]{3} \d{4} \d))"
# A month's name becomes the one letter in its group, and that its number.
_MONTH = (r"\b(?:(j)an(?:uary)?|(f)eb(?:ruary)?|(m)ar(?:ch)?|ap(r)(?:il)?|ma(y)|ju(n)e?|ju(l)y?|au(g)(?:ust)?|(s)ep(?:tember)?"
          r"|(o)ct(?:ober)?|no(v)(?:ember)?|(d)ec(?:ember)?)\b")
_DATE = (r"^(?:([a-z]) (\d{1,2}), (\d{4})|(\d{1,2}) ([a-z]) (\d{4})|(\d{1,2})/(\d{1,2})/(\d{4})|(\d{4})/(\d{1,2})/(\d{1,2}))(?=$|,?\s)")
_REWRITES = (
    (_WEEKDAY, ""),
    (_MONTH, "".join(f"${i}" for i in range(1, 13))),
    (r"^([a-z]) (\d{4})$", "$2-$1"),
    (r"^(\d{1,2} [a-z]) (\d{2})(?=$|,?\s)", "$1 20$2"),
    (_DATE, "$3$6$9$10-$1$5$7$11-$2$4$8$12"),
    (r"(?<=-[a-z0-9]{1,2})(?:t|,?\s+)(?=\d)", " "),
    (r"(:\d{2}(?:\.\d{1,9})?)\s*(?:([ap])m)?\s*(?:(z)|[a-z]{1,5}|([+-]\d{2}(?::?\d{2})?))?$", "$1$2$3$4"),
    (r"(?<= )(\d{1,2}:\d{2})(?![\d:])", "$1:00"),
    (r"(?<= )12(:[\d:]+[ap])", "0$1"),
)
_ZONE = r"(?:z|[+-]\d{2}(?::?\d{2})?)?"
_CANONICAL = (r"^\d{4}(?:-(?:\d{1,2}|[jfmrynlgsovd])(?:-\d{1,2}(?: (?:\d{1,2}(?::\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?" + _ZONE
              + r"|(?:0?\d|1[01]):\d{2}(?::\d{2})?[ap]" + _ZONE + r"))?)?)?$")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def run_timestamp(value: dt.datetime | str) -> Column:
    """A literal run time (UTC) - a job argument, so reruns repeat."""
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.to_timestamp(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))


def _in_zone(ts: Column, has_offset: Column, naive_tz: str) -> Column:
    """Text without an offset is wall-clock time in ``naive_tz`` (it was read as UTC)."""
    return ts if naive_tz == "UTC" else F.when(has_offset, ts).otherwise(F.to_utc_timestamp(ts, naive_tz))


def parse_iso(c: Column | str, naive_tz: str = "UTC") -> Column:
    """ISO text only (the recall source's rule); offset -> UTC, no offset = ``naive_tz``."""
    c = F.trim(_c(c))
    return _in_zone(F.try_to_timestamp(F.regexp_extract(c, _ISO, 0)), c.rlike(_HAS_OFFSET), naive_tz)


def parse_lenient(c: Column | str, naive_tz: str = "UTC") -> Column:
    """Lenient date text -> UTC timestamp or null (registry and RSS dates).

    Accepted: ISO date / date-time, ``yyyy-MM`` and ``yyyy`` (first day),
    month-name dates, slash dates (month first unless the year leads), RFC 822
    with numeric offset, zone name or none, and any of these dates followed by
    a 12- or 24-hour clock time; a weekday may lead. Zone names but Z are
    dropped. Text without a numeric offset is wall-clock time in ``naive_tz``.
    """
    c = _c(c)
    t = F.lower(F.trim(c))
    for pattern, by in _REWRITES:
        t = F.regexp_replace(t, pattern, by)
    t = F.translate(F.regexp_extract(t, _CANONICAL, 0), "jfmrynlgszap", "123456789Z")
    for letter, number in (("o", "10"), ("v", "11"), ("d", "12")):
        t = F.replace(t, F.lit(letter), F.lit(number))
    ts = F.try_to_timestamp(t) + F.make_dt_interval(hours=F.when(c.rlike(_PM), 12).otherwise(0))
    return _in_zone(ts, c.rlike(_HAS_OFFSET), naive_tz)


def study_observed_at(dates: list[Column], run_ts: Column, naive_tz: str = "UTC") -> Column:
    """First parsable of the candidate dates, else the run time."""
    return F.coalesce(*[parse_lenient(d, naive_tz) for d in dates], run_ts)


def parse_recall_date(c: Column | str, run_ts: Column, naive_tz: str = "UTC") -> Column:
    """Eight digits = yyyyMMdd, else ISO, else the run time (the recall
    source reads naive text as UTC, hence the default)."""
    digits = F.regexp_replace(_c(c), r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return F.coalesce(parse_iso(digits, naive_tz), run_ts)


def parse_rss_date(c: Column | str, run_ts: Column, naive_tz: str = "UTC") -> Column:
    """Lenient parse, else the run time."""
    return F.coalesce(parse_lenient(c, naive_tz), run_ts)


def iso_utc(ts: Column | str, zulu: bool = True) -> Column:
    """ISO text in UTC; ``Z`` (validated form) or ``+00:00`` (raw form).

    Microseconds are written only when not zero, as Python does.
    """
    text = F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.0{6}$", ""), F.lit("Z" if zulu else "+00:00"))
