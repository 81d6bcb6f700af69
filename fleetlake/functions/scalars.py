"""Scalar column functions and driver-side literal helpers."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder the upstream downloader logs for a location it cannot split.
REDACTED_URL = "[redacted-url]"
# Fixed value: ISO-8601 UTC rendering with a literal Z suffix.
UTC_ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def redact_url(col: Column | str) -> Column:
    """Drop query string and fragment, keep scheme, host and path.

    A location without ``?`` or ``#`` is unchanged (the empty string stays
    empty). A location that cannot be split -- null, or an authority with an
    unbalanced IPv6 bracket -- becomes the redaction placeholder, so a raw
    location is never shown by accident.
    """
    c = F.col(col) if isinstance(col, str) else col
    stripped = F.regexp_replace(c, r"(?s)[?#].*", "")
    authority = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    unbalanced = authority.contains("[") != authority.contains("]")
    return F.when(c.isNull() | unbalanced, F.lit(REDACTED_URL)).otherwise(stripped)


def url_host(col: Column | str) -> Column:
    """Host part of a URL (lower-cased), null when there is none."""
    c = F.col(col) if isinstance(col, str) else col
    host = F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def to_utc_iso(col: Column | str) -> Column:
    """Timestamp rendered as ``YYYY-MM-DDTHH:MM:SSZ`` (session TZ is UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, UTC_ISO_FORMAT)


def as_utc(value: datetime) -> datetime:
    """Naive datetimes are UTC; aware ones are converted to UTC."""
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def utc_iso_z(value: datetime) -> str:
    """Driver-side twin of :func:`to_utc_iso` for literals (F11's timestamp)."""
    return as_utc(value).strftime("%Y-%m-%dT%H:%M:%SZ")


def since_bound(value: datetime | int | str | None, *, now: datetime | None = None) -> datetime | str | None:
    """lower time bound from the ``sinceTime`` forms.

    int = days back from ``now`` (UTC); naive datetime = UTC; aware -> UTC;
    str passed through (parsed by Spark); None -> no bound; else TypeError.
    ``now`` is a parameter so tests are deterministic.
    """
    if value is None:
        return None
    if isinstance(value, bool):
        raise TypeError(f"a time bound cannot be a {type(value).__name__}; give days back, a datetime or text")
    if isinstance(value, int):
        base = as_utc(now) if now is not None else datetime.now(tz=timezone.utc)
        return base - timedelta(days=value)
    if isinstance(value, datetime):
        return as_utc(value)
    if isinstance(value, str):
        return value
    raise TypeError(f"a time bound cannot be a {type(value).__name__}; give days back, a datetime or text")


def since_date(value: datetime | int | str | None, *, fmt: str = "%Y-%m-%d",
               regex: str | None = None, now: datetime | None = None) -> str | None:
    """F8: the bound as a date string; a string input must match ``regex`` if given."""
    if isinstance(value, str):
        if regex is not None and not re.match(regex, value):
            raise ValueError(f"time bound {value!r} is not of the form {regex}")
        return value
    b = since_bound(value, now=now)
    if b is None:
        return None
    return b.strftime(fmt)  # type: ignore[union-attr]


def since_epoch_seconds(seconds: int) -> datetime:
    """Explicit epoch-seconds form (the upstream mixes it with days-back)."""
    return datetime.fromtimestamp(seconds, tz=timezone.utc)


def ts_literal(value: datetime | date | str) -> Column:
    """A UTC timestamp literal column from a datetime or ISO string."""
    if isinstance(value, datetime):
        v = as_utc(value)
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if isinstance(value, date):
        return F.lit(value.isoformat()).cast("timestamp")
    return F.lit(value).cast("timestamp")


def first_non_empty(*cols: Column) -> Column:
    """Python ``a or b``: first value that is not null and not an empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
