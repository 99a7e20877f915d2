"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from cardsentry.functions.columns import (
    attrs_changed,
    day_start,
    fio,
    is_expired,
    parse_amount,
    seconds,
    within,
)
from cardsentry.functions.timeparts import ts_literal

__all__ = [
    "attrs_changed",
    "day_start",
    "fio",
    "is_expired",
    "parse_amount",
    "seconds",
    "ts_literal",
    "within",
]
