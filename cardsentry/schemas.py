"""Table schemas and the constants every job shares.

Column names follow what the fraud rules query, not the dead DDL of the
original warehouse: ``transaction_date``/``amount``/``oper_result`` for the
fact, ``passport``/``date`` for the blacklist.  Ids that look numeric
(``client``, ``client_id``) are strings because real values hold text such
as ``VIP-0001``.  Date-times are ``TIMESTAMP_NTZ`` throughout: the business
clock of the files, never the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal what the original report writes.
# Report event types, one per fraud rule, in rule order 1_1, 1_2, 2, 3, 4.
EVENT_EXPIRED_PASSPORT = "Overdue passport"
EVENT_BLOCKED_PASSPORT = "Blocked passport"
EVENT_INVALID_AGREEMENT = "Bank agreement not valid"
EVENT_CITY_HOP = "Transactions in different cities in less than an hour"
EVENT_AMOUNT_PROBE = "Selection of the amount with success in 20 minutes"
# Operation results found in the transaction files.
RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
# Open end of an SCD2 version.
OPEN_END = "2999-12-31 23:59:59"
# Rule thresholds: city hop gap, probing window, rejected steps before success.
CITY_HOP_SECONDS = 3600
PROBE_SECONDS = 1200
PROBE_STEPS = 3
# ---------------------------------------------------------------------------

EVENT_TYPES = (
    EVENT_EXPIRED_PASSPORT,
    EVENT_BLOCKED_PASSPORT,
    EVENT_INVALID_AGREEMENT,
    EVENT_CITY_HOP,
    EVENT_AMOUNT_PROBE,
)

S, NTZ, D = T.StringType(), T.TimestampNTZType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Daily text file, read as text first: amount is parsed by ``parse_amount``.
TRANSACTIONS_RAW = _struct(
    ("transaction_id", S),
    ("transaction_date", S),
    ("amount", S),
    ("card_num", S),
    ("oper_type", S),
    ("oper_result", S),
    ("terminal", S),
)

# Typed fact as the rules see it.
TRANSACTIONS = _struct(
    ("trans_id", S),
    ("transaction_date", NTZ),
    ("card_num", S),
    ("amount", T.DecimalType(18, 2)),
    ("oper_type", S),
    ("oper_result", S),
    ("terminal", S),
)

TERMINALS = _struct(
    ("terminal_id", S),
    ("terminal_type", S),
    ("terminal_city", S),
    ("terminal_address", S),
)
TERMINAL_KEY = "terminal_id"
TERMINAL_ATTRS = ("terminal_type", "terminal_city", "terminal_address")

BLACKLIST = _struct(("date", NTZ), ("passport", S))

CARDS = _struct(("card_num", S), ("account", S), ("create_dt", D), ("update_dt", D))
ACCOUNTS = _struct(
    ("account", S), ("valid_to", D), ("client", S), ("create_dt", D), ("update_dt", D)
)
CLIENTS = _struct(
    ("client_id", S),
    ("last_name", S),
    ("first_name", S),
    ("patronymic", S),
    ("date_of_birth", D),
    ("passport_num", S),
    ("passport_valid_to", D),
    ("phone", S),
    ("create_dt", D),
    ("update_dt", D),
)

TERMINALS_HIST = T.StructType(
    TERMINALS.fields
    + [
        T.StructField("deleted_flg", T.IntegerType(), True),
        T.StructField("effective_from", NTZ, True),
        T.StructField("effective_to", NTZ, True),
    ]
)

REPORT = _struct(
    ("event_dt", NTZ),
    ("passport_num", S),
    ("fio", S),
    ("phone", S),
    ("event_type", S),
    ("report_dt", NTZ),
)
REPORT_COLUMNS = tuple(f.name for f in REPORT.fields)
