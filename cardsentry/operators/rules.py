"""The five fraud rules, one by one and fused into one pass.

Rules 1_1, 1_2 and 2 test single rows of the enriched chain
(:func:`cardsentry.operators.enrich.enrich`).  Rules 3 and 4 need a card's
sequence: it is built from the few columns that they compare, and the owner's
columns are joined to the hits alone.  All return report rows ``(event_dt,
passport_num, fio, phone, event_type, report_dt)``.  Same-day duplicates across rules are kept: a transaction is
reported once per rule it breaks.

* 1_1 expired passport: on or after midnight of ``passport_valid_to``.
* 1_2 blocked passport: strictly after the passport's (first) blacklisting.
* 2 invalid agreement: on or after midnight of the account's ``valid_to``.
* 3 city hop: the card's previous transaction was in another city less than
  an hour before.
* 4 amount probing: three rejected attempts with strictly falling amounts,
  then a success, the first attempt less than twenty minutes before it.

Rules 3 and 4 see only transactions whose terminal the dimension knows, so
their sequences are built over known rows only.  A card without an owner is a
sequence of its own, so owners joined afterwards give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import is_expired, ts_literal, within
from cardsentry.operators.asof import join_terminal_asof
from cardsentry.operators.enrich import blocked_since
from cardsentry.operators.sequence import longest_group, with_lags
from cardsentry.schemas import (
    CITY_HOP_SECONDS,
    EVENT_AMOUNT_PROBE,
    EVENT_BLOCKED_PASSPORT,
    EVENT_CITY_HOP,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_AGREEMENT,
    PROBE_SECONDS,
    PROBE_STEPS,
    RESULT_REJECT,
    RESULT_SUCCESS,
)

TS = "transaction_date"
# Rows of one card that a task sorts with ease; longer sequences are cut into ranges.
LONGEST_IN_TASK = 1_000_000


def report_rows(df: DataFrame, event_type: str | Column, report_dt,
                extra: tuple[str, ...] = ()) -> DataFrame:
    """Project rule hits to the report layout (plus ``extra`` columns)."""
    et = F.lit(event_type) if isinstance(event_type, str) else event_type
    rdt = report_dt if isinstance(report_dt, Column) else ts_literal(report_dt)
    return df.select(
        F.col(TS).alias("event_dt"),
        "passport_num",
        "fio",
        "phone",
        et.alias("event_type"),
        rdt.alias("report_dt"),
        *extra,
    )


# --- flag expressions -------------------------------------------------------

def expired_passport_flag() -> Column:
    return is_expired(TS, "passport_valid_to")


def invalid_agreement_flag() -> Column:
    return is_expired(TS, "account_valid_to")


def blocked_flag() -> Column:
    return F.col(TS) > F.col("blocked_since")


SEQUENCE_LAGS = {
    "terminal_city": (1,),
    TS: (1, PROBE_STEPS),
    "oper_result": tuple(range(1, PROBE_STEPS + 1)),
    "amount": tuple(range(1, PROBE_STEPS + 1)),
}
LOOKBACK_SECS = max(CITY_HOP_SECONDS, PROBE_SECONDS)


def city_hop_flag() -> Column:
    return (F.col("terminal_city_lag1") != F.col("terminal_city")) & within(
        TS, f"{TS}_lag1", CITY_HOP_SECONDS
    )


def amount_probe_flag() -> Column:
    cond = F.col("oper_result") == RESULT_SUCCESS
    for k in range(1, PROBE_STEPS + 1):
        prev_amount = F.col("amount") if k == 1 else F.col(f"amount_lag{k - 1}")
        cond = cond & (F.col(f"oper_result_lag{k}") == RESULT_REJECT) & (
            F.col(f"amount_lag{k}") > prev_amount
        )
    return cond & within(TS, f"{TS}_lag{PROBE_STEPS}", PROBE_SECONDS)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# --- single rules -----------------------------------------------------------

def expired_passport(enriched: DataFrame, report_dt) -> DataFrame:
    return report_rows(enriched.where(expired_passport_flag()), EVENT_EXPIRED_PASSPORT, report_dt)


def _with_blocked_since(enriched: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    """``blocked_since`` on every row: already there when the chain was built
    with the blacklist (preferred), else one left join on the passport."""
    if "blocked_since" in enriched.columns:
        return enriched
    return enriched.join(blocked_since(blacklist), F.col("passport_num") == F.col("bl_passport"), "left")


def blocked_passport(enriched: DataFrame, blacklist: DataFrame | None, report_dt) -> DataFrame:
    hits = _with_blocked_since(enriched, blacklist).where(blocked_flag())
    return report_rows(hits, EVENT_BLOCKED_PASSPORT, report_dt)


def invalid_agreement(enriched: DataFrame, report_dt) -> DataFrame:
    return report_rows(enriched.where(invalid_agreement_flag()), EVENT_INVALID_AGREEMENT, report_dt)


def _exploded(flagged: DataFrame, events: dict[str, Column], report_dt, *given: Column) -> DataFrame:
    """One report row per (row, flag that holds): explode, no union.  ``given``
    columns hold events found before, or null."""
    named = F.array(*[F.when(_true(flag), F.lit(e)) for e, flag in events.items()], *given)
    hits = flagged.withColumn("_event", F.explode(named)).where("_event is not null")
    return report_rows(hits, F.col("_event"), report_dt)


ROW_EVENTS = {
    EVENT_EXPIRED_PASSPORT: expired_passport_flag,
    EVENT_BLOCKED_PASSPORT: blocked_flag,
    EVENT_INVALID_AGREEMENT: invalid_agreement_flag,
}


def row_rules(enriched: DataFrame, blacklist: DataFrame | None, report_dt) -> DataFrame:
    """Rules 1_1, 1_2 and 2 in one pass over the enriched rows."""
    return _exploded(_with_blocked_since(enriched, blacklist), {e: flag() for e, flag in ROW_EVENTS.items()}, report_dt)


def known_sequence(transactions: DataFrame, hist: DataFrame, dim_mode: str = "point_in_time",
                   carry: tuple[str, ...] = (), longest: int = LONGEST_IN_TASK) -> DataFrame:
    """Transactions of known terminals with their sequence lags, in the few
    columns that the rules compare (plus ``carry``).

    ``dim_mode='all_versions'`` reproduces the original statements literally:
    every version of the terminal joins, so a transaction repeats once per
    version (ordered by version start among equal times).
    """
    narrow = transactions.select("card_num", TS, "trans_id", "terminal", "amount", "oper_result", *carry)
    joined = join_terminal_asof(narrow, hist, how="inner", mode=dim_mode)
    exact = dim_mode == "point_in_time"  # one row per transaction at most
    ties = ("trans_id",) if exact else ("trans_id", "effective_from")
    return with_lags(
        joined.select("card_num", TS, *ties, "terminal_city", "amount", "oper_result", *carry),
        SEQUENCE_LAGS, tiebreak=ties, short=exact and longest_group(transactions, ["card_num"]) <= longest)


SEQUENCE_EVENTS = {EVENT_CITY_HOP: city_hop_flag, EVENT_AMOUNT_PROBE: amount_probe_flag}


def sequence_hits(transactions: DataFrame, hist: DataFrame, events: tuple[str, ...] = tuple(SEQUENCE_EVENTS),
                  dim_mode: str = "point_in_time", context: str | None = None, longest: int = LONGEST_IN_TASK) -> DataFrame:
    """Card, time and event of every hit of rules 3 and 4 over one sequence.
    ``context`` names a boolean column of rows that take part in the sequences
    and are not reported themselves."""
    carry = (context,) if context else ()
    seq = known_sequence(transactions, hist, dim_mode, carry, longest)
    if context:
        seq = seq.where(~F.col(context))
    named = F.array(*[F.when(_true(SEQUENCE_EVENTS[e]()), F.lit(e)) for e in events])
    return seq.select("card_num", TS, F.explode(named).alias("_event")).where("_event is not null")


def sequence_rules(transactions: DataFrame, owners: DataFrame, hist: DataFrame, report_dt,
                   events: tuple[str, ...] = tuple(SEQUENCE_EVENTS),
                   dim_mode: str = "point_in_time", context: str | None = None, longest: int = LONGEST_IN_TASK) -> DataFrame:
    """Rules 3 and 4, their hits joined to the owners."""
    hits = sequence_hits(transactions, hist, events, dim_mode, context, longest)
    return report_rows(hits.join(owners, "card_num"), F.col("_event"), report_dt)


def city_hop(transactions: DataFrame, owners: DataFrame, hist: DataFrame, report_dt,
             dim_mode: str = "point_in_time") -> DataFrame:
    return sequence_rules(transactions, owners, hist, report_dt, (EVENT_CITY_HOP,), dim_mode)


def amount_probe(transactions: DataFrame, owners: DataFrame, hist: DataFrame, report_dt,
                 dim_mode: str = "point_in_time") -> DataFrame:
    return sequence_rules(transactions, owners, hist, report_dt, (EVENT_AMOUNT_PROBE,), dim_mode)


# --- all five -----------------------------------------------------------------

def fraud_mart(transactions: DataFrame, owners: DataFrame, hist: DataFrame, report_dt,
               blacklist: DataFrame | None = None, context: str | None = None, longest: int = LONGEST_IN_TASK) -> DataFrame:
    """All five rules: the fact and the hits of the narrow sequence, as cards and
    times, meet the owners in one join; the row rules run on its rows.

    ``owners`` is the stored owner table, with ``blocked_since`` or else with
    ``blacklist`` given beside it."""
    own = transactions.where(~F.col(context)) if context else transactions
    hits = sequence_hits(transactions, hist, context=context, longest=longest)
    both = own.select("card_num", TS, F.lit(None).cast("string").alias("_hit")).unionByName(hits.withColumnRenamed("_event", "_hit"))
    events = {e: F.col("_hit").isNull() & flag() for e, flag in ROW_EVENTS.items()}
    return _exploded(_with_blocked_since(both.join(owners, "card_num"), blacklist), events, report_dt, F.col("_hit"))
