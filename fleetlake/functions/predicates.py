"""Filter predicates (F1-F13) as Spark ``Column`` expressions.

Values always travel as literals, never as built filter text, so quoting and
escaping cannot go wrong. Predicates on plain columns are pushed into the
parquet scan by Catalyst (``PushedFilters`` shows ``EqualTo`` / ``In`` /
``GreaterThanOrEqual``).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import key_frame, semi_join
from .scalars import as_utc, since_bound, ts_literal


def eq(column: str, value) -> Column:
    """Equality against a string or datetime literal (datetime in UTC)."""
    if isinstance(value, datetime):
        return F.col(column) == ts_literal(value)
    return F.col(column) == F.lit(value)


def is_in(column: str, values: Iterable) -> Column:
    """set membership; an empty list matches nothing."""
    vals = list(values)
    if not vals:
        return F.lit(False)
    return F.col(column).isin(vals)


def array_has(column: str, value) -> Column:
    """Array column holds ``value``."""
    return F.array_contains(F.col(column), F.lit(value))


def array_has_any(column: str, values: Iterable) -> Column:
    """Array column shares at least one element with ``values``."""
    vals = list(values)
    if not vals:
        return F.lit(False)
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in vals]))


def all_of(preds: Iterable[Column | None]) -> Column | None:
    """F4 + F5: conjunction; ``None`` entries are omitted; nothing -> None."""
    ps = [p for p in preds if p is not None]
    if not ps:
        return None
    return reduce(lambda a, b: a & b, ps)


def since(column: str, value, *, now: datetime | None = None) -> Column | None:
    """``column >= bound`` for the ``sinceTime`` forms (None -> no predicate)."""
    bound = since_bound(value, now=now)
    if bound is None:
        return None
    return F.col(column) >= ts_literal(bound)


def since_day(column: str, day: str) -> Column:
    """F8: ``column >= day`` where ``day`` is a ``yyyy-MM-dd`` string."""
    return F.col(column) >= F.to_timestamp(F.lit(day), "yyyy-MM-dd")


def by_id(df: DataFrame, value, column: str = "id") -> DataFrame:
    """point lookup; an absent id gives an empty frame."""
    return df.filter(F.col(column) == F.lit(value))


def tag_match(tag: str, *, starts_with: bool = False, column: str = "machineTags") -> Column:
    """exact tag (default) or tag prefix search on an array column."""
    if starts_with:
        return F.exists(F.col(column), lambda t: t.startswith(tag))
    return F.array_contains(F.col(column), F.lit(tag))


def ip_near(ip: str, at: datetime, tolerance: timedelta, *,
            ip_array: str = "ipAddresses", last_ip: str = "lastIpAddress",
            seen: str = "lastSeen") -> Column:
    """machine had ``ip`` (any interface, or last IP) and was seen near ``at``.

    ``at`` is normalised to UTC (naive = UTC). ``tolerance`` is required: the
    service's own window is not published.
    """
    t = as_utc(at)
    has_ip = F.exists(F.col(ip_array), lambda x: x.getField("ipAddress") == F.lit(ip)) | (F.col(last_ip) == F.lit(ip))
    near = F.col(seen).between(ts_literal(t - tolerance), ts_literal(t + tolerance))
    return F.coalesce(has_ip, F.lit(False)) & near


def distinct_ipv4(df: DataFrame, ip_array: str = "ipAddresses") -> DataFrame:
    """distinct usable IPv4 values across all interfaces.

    explode -> struct field -> drop nulls -> distinct -> skip anything with ':'.
    The distinct is a two-phase hash aggregate (map-side dedupe first).
    """
    return (df.select(F.explode(F.col(ip_array).getField("ipAddress")).alias("ipAddress"))
              .dropna()
              .filter(~F.col("ipAddress").contains(":"))
              .distinct())


def id_list(ids) -> list[str]:
    """One id or a list of ids -> list (upstream accepts both)."""
    if isinstance(ids, (str, int)):
        return [ids]  # type: ignore[list-item]
    return list(ids)


def lookup_ids(df: DataFrame, ids, column: str = "id") -> DataFrame:
    """keep rows whose ``column`` is in ``ids``.

    ``ids`` may be a Python list (a short literal ``IN``, pushed into the scan)
    or a DataFrame of keys (a semi join that is broadcast only when the key
    frame is proven small, otherwise left to AQE).
    """
    if isinstance(ids, DataFrame):
        return semi_join(df, ids, column, key_column=ids.columns[0])
    vals = id_list(ids)
    if len(vals) <= 1000:
        return df.filter(is_in(column, vals))
    return semi_join(df, key_frame(df.sparkSession, vals, column), column)
