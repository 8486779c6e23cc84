"""Scalar building blocks as Column expressions (all JVM-side, codegen-able).

Nothing here is a Python UDF: each function returns a Catalyst expression so
that it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values -----------------------------------------------------------
# Channel rules of the curated media dimension, in priority order: the first
# (case-insensitive) substring found in the media URL names the channel; a URL
# matching none of them, or a null URL, has a null channel.
DEFAULT_CHANNEL_RULES: tuple[tuple[str, str], ...] = (
    ("youtube", "YouTube"),
    ("facebook", "Facebook"),
)
# Run ids are the UTC start time in this pattern; run dates are ISO dates.
RUN_ID_PATTERN = "yyyyMMdd'T'HHmmss'Z'"
RUN_DATE_PATTERN = "yyyy-MM-dd"
# Raw timestamps are ISO-8601 in UTC with milliseconds and a trailing Z.
ISO_MILLIS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Path-derived columns of landed files.
STATS_MEDIA_FROM_PATH = r"/media_stats/([^/]+)\.json$"
RUN_ID_FROM_PATH = r"run_id=([^/]+)"
RUN_DATE_FROM_PATH = r"run_date=([^/]+)"
EVENTS_MEDIA_FROM_PATH = r"media_id=([^/]+)"
# Trailing UTC offset of an ISO-8601 timestamp string.
ISO_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"
# The events API pages at this many records.
EVENT_PAGE_SIZE = 100
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: ColumnOrName) -> Column:
    """ISO-8601 string -> TIMESTAMP; malformed input gives null, never an error.

    Under ANSI mode (the default) ``to_timestamp`` raises on a bad record, so
    one corrupt event would fail a whole run; ``try_to_timestamp`` rejects the
    row instead and :func:`is_rejected_ts` lets callers count it.
    """
    return F.try_to_timestamp(_c(c))


def is_blank(c: ColumnOrName) -> Column:
    """Null or empty string (the ingestion treats both as 'no timestamp')."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def is_rejected_ts(c: ColumnOrName) -> Column:
    """A non-blank timestamp string that does not parse."""
    return ~is_blank(c) & parse_ts(c).isNull()


def event_date(ts: ColumnOrName) -> Column:
    """Calendar date of an instant in the (UTC-pinned) session zone."""
    return F.to_date(_c(ts))


def day_start(ts: ColumnOrName) -> Column:
    """Start of the (session-zone, UTC) day of an instant."""
    return F.date_trunc("day", _c(ts))


def mark_day_start(mark: ColumnOrName) -> Column:
    """Start of the calendar day of an ISO timestamp string *in its own offset*.

    ``2026-08-15T01:30:00.000+02:00`` -> ``2026-08-15T00:00:00+02:00`` (that is
    2026-08-14T22:00Z): the day the source filters on is the mark's local date.
    A string without an offset is read in the session zone.
    """
    mark = _c(mark)
    offset = F.regexp_extract(mark, ISO_OFFSET, 1)
    return parse_ts(F.concat(F.substring(mark, 1, 10), F.lit("T00:00:00"), offset))


def channel_of(url: ColumnOrName, rules: Sequence[tuple[str, str]] = DEFAULT_CHANNEL_RULES) -> Column:
    """Rule-driven CASE: first substring match of ``lower(url)`` wins."""
    lowered = F.lower(_c(url))
    expr = None
    for needle, label in rules:
        cond = lowered.contains(needle.lower())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(None).cast("string")
    return expr.otherwise(F.lit(None).cast("string"))


def visitor_hash(c: ColumnOrName) -> Column:
    """SHA-256 hex digest of the UTF-8 key (unsalted: pseudonymous, not anonymous)."""
    return F.sha2(_c(c), 256)


def watch_time(duration_seconds: ColumnOrName, percent_viewed: ColumnOrName) -> Column:
    """Seconds watched: media duration times the 0-1 fraction viewed."""
    return _c(duration_seconds) * _c(percent_viewed)


def watched_percent(percent_viewed: ColumnOrName) -> Column:
    """0-1 fraction -> percent."""
    return _c(percent_viewed).cast("double") * F.lit(100.0)


def run_id_of(ts: ColumnOrName) -> Column:
    return F.date_format(_c(ts), RUN_ID_PATTERN)


def run_date_of(ts: ColumnOrName) -> Column:
    return F.date_format(_c(ts), RUN_DATE_PATTERN)


def iso_millis(ts: ColumnOrName) -> Column:
    """Instant -> the raw ``...T..:..:..SSSZ`` string form."""
    return F.date_format(_c(ts), ISO_MILLIS_PATTERN)


def from_path(path: ColumnOrName, pattern: str) -> Column:
    """Group 1 of ``pattern`` in a file path; ``""`` when it does not match."""
    return F.regexp_extract(_c(path), pattern, 1)


def stats_media_from_path(path: ColumnOrName) -> Column:
    return from_path(path, STATS_MEDIA_FROM_PATH)


def run_id_from_path(path: ColumnOrName) -> Column:
    return from_path(path, RUN_ID_FROM_PATH)


def pages_for(fetched: ColumnOrName, page_size: int = EVENT_PAGE_SIZE) -> Column:
    """Pages the API served for ``fetched`` records (an empty last page is not counted)."""
    return F.ceil(_c(fetched) / F.lit(page_size)).cast("long")


def newer_mark(old_mark: ColumnOrName, candidate: ColumnOrName) -> Column:
    """Keep the string whose parsed instant is later; ties keep the old mark.

    An old mark that is missing or does not parse is replaced by the candidate.
    """
    old_mark, candidate = _c(old_mark), _c(candidate)
    return (
        F.when(candidate.isNull(), old_mark)
        .when(parse_ts(old_mark).isNull(), candidate)
        .when(parse_ts(candidate) > parse_ts(old_mark), candidate)
        .otherwise(old_mark)
    )


def round2(c: ColumnOrName, digits: int = 2) -> Column:
    """Plain ``round``: half up on the shortest decimal form of the double."""
    return F.round(_c(c), digits)


def exact_sum(c: ColumnOrName) -> Column:
    """Sum of doubles that does not depend on their order (nor on partitioning).

    Values are added as decimals of 12 places; a group with a value that does
    not fit (NaN, infinity, 1e16 and beyond) or whose sum overflows has the
    plain double sum.
    """
    c = _c(c)
    d = c.try_cast("decimal(28,12)")
    return F.coalesce(F.when(F.count(d) == F.count(c), F.try_sum(d).cast("double")), F.sum(c))


def to_ntz(c: ColumnOrName) -> Column:
    """TIMESTAMP (session zone, pinned UTC) -> TIMESTAMP_NTZ wall clock."""
    return _c(c).cast("timestamp_ntz")
