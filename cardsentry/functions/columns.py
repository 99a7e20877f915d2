"""Scalar building blocks of the rules and the dimension diff."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fio(last: str | Column = "last_name", first: str | Column = "first_name",
        patronymic: str | Column = "patronymic") -> Column:
    """``last first patronymic``; null as soon as one part is null (plain ``||``)."""
    return F.concat(_c(last), F.lit(" "), _c(first), F.lit(" "), _c(patronymic))


def day_start(d: str | Column) -> Column:
    """Midnight of a DATE as TIMESTAMP_NTZ."""
    return _c(d).cast("timestamp_ntz")


def is_expired(ts: str | Column, valid_to: str | Column) -> Column:
    """True from midnight of the expiry day on (the expiry day itself is invalid).

    Null ``valid_to`` (no expiry) gives null, which filters like false.
    """
    return _c(ts) >= day_start(valid_to)


def seconds(n: int) -> Column:
    """Exact day-time interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n))


def within(later: str | Column, earlier: str | Column, secs: int) -> Column:
    """``later - earlier < secs`` compared exactly on NTZ timestamps.

    Null when either side is null, so a missing predecessor never flags.
    """
    return _c(later) < _c(earlier) + seconds(secs)


def parse_amount(text: str | Column) -> Column:
    """Amount text to DECIMAL(18,2); decimal comma or point, null if malformed.

    ``12,5`` and ``12.5`` both give 12.50; ``1.234,50`` and ``abc`` give null
    (they go to quarantine).  ``try_cast`` keeps ANSI mode from failing the job.
    """
    return F.regexp_replace(F.trim(_c(text)), ",", ".").try_cast("decimal(18,2)")


def attrs_changed(left_prefix: str, right_prefix: str, attrs: Iterable[str]) -> Column:
    """Null-safe "any attribute differs" between two aliased sides of a join.

    A change from or to null counts as a change; null to null does not.
    """
    return reduce(
        lambda acc, a: acc | ~F.col(f"{left_prefix}.{a}").eqNullSafe(F.col(f"{right_prefix}.{a}")),
        list(attrs),
        F.lit(False),
    )
