"""DuckDB twins of the fixture views and of every registered query.

Each query is one statement ``WITH <views> SELECT ...`` over the raw test
tables, written independently of the Spark plans: anti joins as NOT EXISTS,
the dimension history in closed form (a window over all cuts instead of the
day-by-day fold), interval tests as timestamp arithmetic.
"""

from __future__ import annotations

from cardsentry.plans.testviews import (
    EMPTY_DAY,
    E_REPORT_DT,
    E_SNAPSHOT_DAYS,
    E_SNAPSHOT_RULES,
    HOT_START,
    L_REPORT_DT,
    VERSION_SECONDS,
)
from cardsentry.schemas import (
    CITY_HOP_SECONDS,
    EVENT_AMOUNT_PROBE,
    EVENT_BLOCKED_PASSPORT,
    EVENT_CITY_HOP,
    EVENT_EXPIRED_PASSPORT,
    EVENT_INVALID_AGREEMENT,
    OPEN_END,
    PROBE_SECONDS,
)


def _ts(v) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


def _with(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes) + "\n" + body


# --- set E ------------------------------------------------------------------

def _clients(passport_base: str, passport_mod: int) -> str:
    return f"""SELECT 'C' || c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'N' || c_nationkey END AS patronymic,
  'P' || c_custkey AS passport_num,
  CASE WHEN c_custkey % 5 = 0 THEN NULL
       ELSE DATE '{passport_base}' + CAST(c_custkey % {passport_mod} AS INTEGER) END AS passport_valid_to,
  '+7 ' || c_custkey AS phone
FROM customer"""


_ACCOUNTS_E = """SELECT 'A' || c_custkey || '-0' AS account, 'C' || c_custkey AS client,
  DATE '2024-01-01' + CAST((c_custkey * 7) % 60 AS INTEGER) AS valid_to FROM customer
UNION ALL
SELECT 'A' || c_custkey || '-1', 'C' || c_custkey,
  DATE '2024-01-01' + CAST((c_custkey * 7 + 11) % 60 AS INTEGER) FROM customer"""

_CARDS_E = """SELECT 'K' || c_custkey AS card_num, 'A' || c_custkey || '-' || (c_custkey % 2) AS account
FROM customer"""

_PARAMS_E = """SELECT (SELECT max(user_id) + 1 FROM events) AS n_cards,
  (SELECT count(*) + 1 FROM supplier) AS n_terminals"""

_TRANSACTIONS_E = """SELECT CAST(event_id AS VARCHAR) AS trans_id, ts AS transaction_date,
  'K' || ((event_id // 4) % p.n_cards) AS card_num, value AS amount, event_type AS oper_type,
  CASE WHEN event_id % 4 = 3 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
  'T' || (event_id % p.n_terminals) AS terminal
FROM events JOIN params p ON TRUE"""

_BLACKLIST_E = """SELECT TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 25 AS INTEGER)) AS "date",
  'P' || c_custkey AS passport
FROM customer WHERE c_custkey % 11 = 0"""


def _snapshots_e() -> str:
    parts = []
    for day, (m, r, mv) in zip(E_SNAPSHOT_DAYS, E_SNAPSHOT_RULES):
        city = ("'N' || s_nationkey" if mv == 0 else
                f"'N' || (CASE WHEN s_suppkey % {mv} = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END)")
        parts.append(
            f"SELECT TIMESTAMP '{day:%Y-%m-%d} 00:00:00' AS as_of, 'T' || s_suppkey AS terminal_id, "
            f"'POS' AS terminal_type, {city} AS terminal_city, s_name AS terminal_address "
            f"FROM supplier WHERE s_suppkey % {m} <> {r}"
        )
    return "\nUNION ALL\n".join(parts)


# Closed form of the history: per key and cut day, present or not; a version
# starts where the key appears, changes, returns, or disappears (tombstone).
_HIST = f"""SELECT terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg,
  as_of AS effective_from,
  coalesce(lead(as_of) OVER (PARTITION BY terminal_id ORDER BY as_of) - INTERVAL 1 SECOND,
           TIMESTAMP '{OPEN_END}') AS effective_to
FROM (
  SELECT terminal_id, as_of,
    CASE WHEN present THEN terminal_type ELSE p_type END AS terminal_type,
    CASE WHEN present THEN terminal_city ELSE p_city END AS terminal_city,
    CASE WHEN present THEN terminal_address ELSE p_addr END AS terminal_address,
    CASE WHEN present THEN 0 ELSE 1 END AS deleted_flg
  FROM (
    SELECT *, lag(present) OVER w AS p_present, lag(terminal_type) OVER w AS p_type,
      lag(terminal_city) OVER w AS p_city, lag(terminal_address) OVER w AS p_addr
    FROM (
      SELECT k.terminal_id, a.as_of, s.terminal_id IS NOT NULL AS present,
        s.terminal_type, s.terminal_city, s.terminal_address
      FROM (SELECT DISTINCT terminal_id FROM snapshots) k
      JOIN (SELECT DISTINCT as_of FROM snapshots) a ON TRUE
      LEFT JOIN snapshots s ON s.terminal_id = k.terminal_id AND s.as_of = a.as_of
    ) grid
    WINDOW w AS (PARTITION BY terminal_id ORDER BY as_of)
  ) st
  WHERE (present AND (NOT coalesce(p_present, FALSE)
                      OR terminal_type IS DISTINCT FROM p_type
                      OR terminal_city IS DISTINCT FROM p_city
                      OR terminal_address IS DISTINCT FROM p_addr))
     OR (NOT present AND p_present)
) ver"""

_VERS = """SELECT h.*,
  CASE WHEN effective_from = min(effective_from) OVER (PARTITION BY terminal_id)
       THEN TIMESTAMP '0001-01-01 00:00:00' ELSE effective_from END AS lo,
  effective_to + INTERVAL 1 SECOND AS hi
FROM hist h"""

_CHAIN = """SELECT t.trans_id, t.transaction_date, t.card_num, t.amount, t.oper_result, t.terminal,
  a.account, a.valid_to AS account_valid_to, c.client_id, c.passport_num, c.passport_valid_to,
  c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone
FROM transactions t
JOIN cards k ON k.card_num = t.card_num
JOIN accounts a ON a.account = k.account
JOIN clients c ON c.client_id = a.client"""

_SEQ = """SELECT ch.*, v.terminal_city,
  lag(v.terminal_city) OVER w AS city_1,
  lag(ch.transaction_date) OVER w AS ts_1,
  lag(ch.transaction_date, 3) OVER w AS ts_3,
  lag(ch.oper_result) OVER w AS res_1, lag(ch.oper_result, 2) OVER w AS res_2,
  lag(ch.oper_result, 3) OVER w AS res_3,
  lag(ch.amount) OVER w AS amt_1, lag(ch.amount, 2) OVER w AS amt_2, lag(ch.amount, 3) OVER w AS amt_3
FROM chain ch
JOIN vers v ON v.terminal_id = ch.terminal AND ch.transaction_date >= v.lo AND ch.transaction_date < v.hi
WINDOW w AS (PARTITION BY ch.card_num ORDER BY ch.transaction_date, ch.trans_id)"""


# The original's literal join: every version of the terminal, no time test.
_SEQ_ALL = """SELECT ch.*, h.terminal_city,
  lag(h.terminal_city) OVER w AS city_1,
  lag(ch.transaction_date) OVER w AS ts_1,
  lag(ch.transaction_date, 3) OVER w AS ts_3,
  lag(ch.oper_result) OVER w AS res_1, lag(ch.oper_result, 2) OVER w AS res_2,
  lag(ch.oper_result, 3) OVER w AS res_3,
  lag(ch.amount) OVER w AS amt_1, lag(ch.amount, 2) OVER w AS amt_2, lag(ch.amount, 3) OVER w AS amt_3
FROM chain ch
JOIN hist h ON h.terminal_id = ch.terminal
WINDOW w AS (PARTITION BY ch.card_num ORDER BY ch.transaction_date, ch.trans_id, h.effective_from)"""


def _base_e() -> list[tuple[str, str]]:
    return [
        ("params", _PARAMS_E),
        ("clients", _clients("2024-01-01", 45)),
        ("accounts", _ACCOUNTS_E),
        ("cards", _CARDS_E),
        ("transactions", _TRANSACTIONS_E),
        ("blacklist", _BLACKLIST_E),
        ("snapshots", _snapshots_e()),
        ("hist", _HIST),
        ("vers", _VERS),
        ("chain", _CHAIN),
    ]


def _report(event_type: str, report_dt, where: str, source: str = "chain") -> str:
    return (
        f"SELECT transaction_date AS event_dt, passport_num, fio, phone, "
        f"'{event_type}' AS event_type, {_ts(report_dt)} AS report_dt FROM {source} WHERE {where}"
    )


_W_EXPIRED = "transaction_date >= CAST(passport_valid_to AS TIMESTAMP)"
_W_AGREEMENT = "transaction_date >= CAST(account_valid_to AS TIMESTAMP)"
_W_BLOCKED = ("EXISTS (SELECT 1 FROM blacklist b WHERE b.passport = chain.passport_num "
              "AND chain.transaction_date > b.\"date\")")
_W_CITY = f"city_1 <> terminal_city AND transaction_date < ts_1 + INTERVAL {CITY_HOP_SECONDS} SECOND"
_W_PROBE = (
    "oper_result = 'SUCCESS' AND res_1 = 'REJECT' AND res_2 = 'REJECT' AND res_3 = 'REJECT' "
    "AND amt_1 > amount AND amt_2 > amt_1 AND amt_3 > amt_2 "
    f"AND transaction_date < ts_3 + INTERVAL {PROBE_SECONDS} SECOND"
)


def _mart_e(report_dt=E_REPORT_DT) -> str:
    return "\nUNION ALL\n".join([
        _report(EVENT_EXPIRED_PASSPORT, report_dt, _W_EXPIRED),
        _report(EVENT_BLOCKED_PASSPORT, report_dt, _W_BLOCKED),
        _report(EVENT_INVALID_AGREEMENT, report_dt, _W_AGREEMENT),
        _report(EVENT_CITY_HOP, report_dt, _W_CITY, "seq"),
        _report(EVENT_AMOUNT_PROBE, report_dt, _W_PROBE, "seq"),
    ])


def _days_cte() -> tuple[str, str]:
    return ("days", "SELECT as_of, lag(as_of) OVER (ORDER BY as_of) AS prev_as_of "
                    "FROM (SELECT DISTINCT as_of FROM snapshots) d")


def _diff_sql(kind: str) -> str:
    cols = "terminal_id, terminal_type, terminal_city, terminal_address"
    if kind == "new":
        body = (f"SELECT d.as_of, {', '.join('s.' + c.strip() for c in cols.split(','))} "
                "FROM snapshots s JOIN days d ON d.as_of = s.as_of "
                "WHERE NOT EXISTS (SELECT 1 FROM snapshots p WHERE p.as_of = d.prev_as_of "
                "AND p.terminal_id = s.terminal_id)")
    elif kind == "deleted":
        body = (f"SELECT d.as_of, {', '.join('p.' + c.strip() for c in cols.split(','))} "
                "FROM days d JOIN snapshots p ON p.as_of = d.prev_as_of "
                "WHERE NOT EXISTS (SELECT 1 FROM snapshots s WHERE s.as_of = d.as_of "
                "AND s.terminal_id = p.terminal_id)")
    else:
        body = (f"SELECT d.as_of, {', '.join('s.' + c.strip() for c in cols.split(','))} "
                "FROM snapshots s JOIN days d ON d.as_of = s.as_of "
                "JOIN snapshots p ON p.as_of = d.prev_as_of AND p.terminal_id = s.terminal_id "
                "WHERE s.terminal_type IS DISTINCT FROM p.terminal_type "
                "OR s.terminal_city IS DISTINCT FROM p.terminal_city "
                "OR s.terminal_address IS DISTINCT FROM p.terminal_address")
    return _with(_base_e() + [_days_cte()], body)


# The daily cycle: one load per cut day holding the transactions up to the
# next cut; each load sees the dimension built from the cuts so far and the
# previous load's last hour as context; the report time is the load day.
_LOADS = """SELECT as_of AS load_as_of, lead(as_of) OVER (ORDER BY as_of) AS next_as_of,
  row_number() OVER (ORDER BY as_of) AS load_no
FROM (SELECT DISTINCT as_of FROM snapshots) d"""

_LHIST = f"""SELECT load_as_of, terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg,
  as_of AS effective_from,
  coalesce(lead(as_of) OVER (PARTITION BY load_as_of, terminal_id ORDER BY as_of) - INTERVAL 1 SECOND,
           TIMESTAMP '{OPEN_END}') AS effective_to
FROM (
  SELECT load_as_of, terminal_id, as_of,
    CASE WHEN present THEN terminal_type ELSE p_type END AS terminal_type,
    CASE WHEN present THEN terminal_city ELSE p_city END AS terminal_city,
    CASE WHEN present THEN terminal_address ELSE p_addr END AS terminal_address,
    CASE WHEN present THEN 0 ELSE 1 END AS deleted_flg
  FROM (
    SELECT *, lag(present) OVER w AS p_present, lag(terminal_type) OVER w AS p_type,
      lag(terminal_city) OVER w AS p_city, lag(terminal_address) OVER w AS p_addr
    FROM (
      SELECT l.load_as_of, k.terminal_id, a.as_of, s.terminal_id IS NOT NULL AS present,
        s.terminal_type, s.terminal_city, s.terminal_address
      FROM loads l
      JOIN (SELECT DISTINCT as_of FROM snapshots) a ON a.as_of <= l.load_as_of
      JOIN (SELECT DISTINCT terminal_id FROM snapshots) k ON TRUE
      LEFT JOIN snapshots s ON s.terminal_id = k.terminal_id AND s.as_of = a.as_of
    ) grid
    WINDOW w AS (PARTITION BY load_as_of, terminal_id ORDER BY as_of)
  ) st
  WHERE (present AND (NOT coalesce(p_present, FALSE)
                      OR terminal_type IS DISTINCT FROM p_type
                      OR terminal_city IS DISTINCT FROM p_city
                      OR terminal_address IS DISTINCT FROM p_addr))
     OR (NOT present AND p_present)
) ver"""

_LVERS = """SELECT h.*,
  CASE WHEN effective_from = min(effective_from) OVER (PARTITION BY load_as_of, terminal_id)
       THEN TIMESTAMP '0001-01-01 00:00:00' ELSE effective_from END AS lo,
  effective_to + INTERVAL 1 SECOND AS hi
FROM lhist h"""

_LSEQ = f"""SELECT r.*, v.terminal_city, v.terminal_id IS NOT NULL AS known,
  lag(v.terminal_city) OVER w AS city_1,
  lag(r.transaction_date) OVER w AS ts_1,
  lag(r.transaction_date, 3) OVER w AS ts_3,
  lag(r.oper_result) OVER w AS res_1, lag(r.oper_result, 2) OVER w AS res_2,
  lag(r.oper_result, 3) OVER w AS res_3,
  lag(r.amount) OVER w AS amt_1, lag(r.amount, 2) OVER w AS amt_2, lag(r.amount, 3) OVER w AS amt_3
FROM (
  SELECT l.load_as_of, l.load_no > 1 AND ch.transaction_date < l.load_as_of AS is_ctx, ch.*
  FROM chain ch JOIN loads l
    ON (l.load_no = 1 OR ch.transaction_date >= l.load_as_of - INTERVAL {CITY_HOP_SECONDS} SECOND)
   AND (l.next_as_of IS NULL OR ch.transaction_date < l.next_as_of)
) r
LEFT JOIN lvers v ON v.load_as_of = r.load_as_of AND v.terminal_id = r.terminal
  AND r.transaction_date >= v.lo AND r.transaction_date < v.hi
WINDOW w AS (PARTITION BY r.load_as_of, r.card_num, v.terminal_id IS NOT NULL
             ORDER BY r.transaction_date, r.trans_id)"""


# The hot card: nine tenths of set E on one card within an hour.
_TRANSACTIONS_HOT = f"""SELECT trans_id,
  CASE WHEN e % 10 <> 0 THEN {_ts(HOT_START)} + to_milliseconds((e * 7919) % 3600000) ELSE transaction_date END AS transaction_date,
  CASE WHEN e % 10 <> 0 THEN 'K1' ELSE card_num END AS card_num, amount, oper_type, oper_result, terminal
FROM (SELECT *, CAST(trans_id AS BIGINT) AS e FROM ({_TRANSACTIONS_E}) x) t"""


def _base_hot() -> list[tuple[str, str]]:
    return [(n, _TRANSACTIONS_HOT if n == "transactions" else q) for n, q in _base_e()]


# The hot terminal: nine tenths of set E at one terminal with a version per customer.
_TRANSACTIONS_HOT_TERMINAL = f"""SELECT trans_id, transaction_date, card_num, amount, oper_type, oper_result,
  CASE WHEN CAST(trans_id AS BIGINT) % 10 <> 0 THEN 'T1' ELSE terminal END AS terminal
FROM ({_TRANSACTIONS_E}) t"""

_MOVING_TERMINAL = f"""SELECT 'T1' AS terminal_id, 'POS' AS terminal_type, 'N' || (c_custkey % 25) AS terminal_city,
  c_name AS terminal_address, CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS deleted_flg,
  {_ts(E_SNAPSHOT_DAYS[0])} + to_seconds(c_custkey * {VERSION_SECONDS}) AS effective_from,
  {_ts(E_SNAPSHOT_DAYS[0])} + to_seconds(c_custkey * {VERSION_SECONDS} + {VERSION_SECONDS - 1}) AS effective_to
FROM customer"""


def _base_hot_terminal() -> list[tuple[str, str]]:
    other = {"transactions": _TRANSACTIONS_HOT_TERMINAL, "hist": _MOVING_TERMINAL}
    return [(n, other.get(n, q)) for n, q in _base_e()]


_ASOF = """SELECT t.trans_id, t.transaction_date, t.terminal, v.terminal_city, coalesce(v.deleted_flg = 1, FALSE) AS tombstone,
  v.effective_from, v.terminal_id IS NOT NULL AS known
FROM transactions t LEFT JOIN vers v ON v.terminal_id = t.terminal AND t.transaction_date >= v.lo AND t.transaction_date < v.hi"""

_BAD_ROWS = """SELECT 'transactions' AS drop_name, strftime(transaction_date, '%Y-%m-%d') AS load_day, trans_id AS field
FROM transactions WHERE CAST(trans_id AS BIGINT) % 10 IN (3, 7, 9)
UNION ALL
SELECT 'terminals', strftime(as_of, '%Y-%m-%d'), terminal_city FROM snapshots
WHERE CAST(substr(terminal_id, 2) AS BIGINT) % 9 = 0
UNION ALL
SELECT 'blacklist', (SELECT strftime(min(as_of), '%Y-%m-%d') FROM snapshots), passport FROM blacklist
WHERE CAST(substr(passport, 2) AS BIGINT) % 2 = 0"""


def _accumulate_sql(lookback: bool = True, base: list[tuple[str, str]] | None = None, loads: str = _LOADS) -> str:
    lseq = _LSEQ if lookback else _LSEQ.replace(f"l.load_as_of - INTERVAL {CITY_HOP_SECONDS} SECOND", "l.load_as_of")

    def rep(event_type: str, where: str) -> str:
        return (f"SELECT transaction_date AS event_dt, passport_num, fio, phone, "
                f"'{event_type}' AS event_type, load_as_of AS report_dt FROM lseq chain "
                f"WHERE NOT is_ctx AND {where}")
    body = "\nUNION ALL\n".join([
        rep(EVENT_EXPIRED_PASSPORT, _W_EXPIRED),
        rep(EVENT_BLOCKED_PASSPORT, _W_BLOCKED),
        rep(EVENT_INVALID_AGREEMENT, _W_AGREEMENT),
        rep(EVENT_CITY_HOP, "known AND " + _W_CITY),
        rep(EVENT_AMOUNT_PROBE, "known AND " + _W_PROBE),
    ])
    return _with((base or _base_e()) + [("loads", loads), ("lhist", _LHIST), ("lvers", _LVERS),
                              ("lseq", lseq)], body)


def _empty_day_sql() -> str:
    """Loads of the transaction files' days, cuts of all days but the last."""
    days = ", ".join(f"({_ts(d)})" for d in (*E_SNAPSHOT_DAYS, EMPTY_DAY))
    cuts = f"SELECT * FROM ({_snapshots_e()}) s WHERE as_of < {_ts(E_SNAPSHOT_DAYS[-1])}"
    loads = f"""SELECT as_of AS load_as_of, lead(as_of) OVER (ORDER BY as_of) AS next_as_of,
  row_number() OVER (ORDER BY as_of) AS load_no
FROM (VALUES {days}) d(as_of)"""
    return _accumulate_sql(base=[(n, cuts if n == "snapshots" else q) for n, q in _base_e()], loads=loads)


# --- set L ------------------------------------------------------------------

_ACCOUNTS_L = """SELECT 'A' || o_orderkey AS account, 'C' || o_custkey AS client,
  CAST(o_orderdate AS DATE) + 60 AS valid_to FROM orders"""

_CARDS_L = """SELECT 'K' || (o_orderkey * 10) AS card_num, 'A' || o_orderkey AS account FROM orders
UNION ALL
SELECT 'K' || (o_orderkey * 10 + 1), 'A' || o_orderkey FROM orders"""

_TRANSACTIONS_L = """SELECT l_orderkey || '-' || l_linenumber AS trans_id, l_shipdate AS transaction_date,
  'K' || (l_orderkey * 10 + l_linenumber % 2) AS card_num, l_extendedprice AS amount,
  'purchase' AS oper_type, 'SUCCESS' AS oper_result, 'T' || l_suppkey AS terminal
FROM lineitem"""

_BLACKLIST_L = """SELECT TIMESTAMP '1998-06-01' + to_days(CAST(c_custkey % 300 AS INTEGER)) AS "date",
  'P' || c_custkey AS passport
FROM customer WHERE c_custkey % 11 = 0"""


_SNAPSHOTS_L = """SELECT TIMESTAMP '1995-01-01 00:00:00' AS as_of, 'T' || s_suppkey AS terminal_id,
  'POS' AS terminal_type, 'N' || s_nationkey AS terminal_city, s_name AS terminal_address
FROM supplier"""


def _base_l() -> list[tuple[str, str]]:
    return [
        ("clients", _clients("1997-01-01", 1500)),
        ("accounts", _ACCOUNTS_L),
        ("cards", _CARDS_L),
        ("transactions", _TRANSACTIONS_L),
        ("blacklist", _BLACKLIST_L),
        ("snapshots", _SNAPSHOTS_L),
        ("hist", _HIST),
        ("vers", _VERS),
        ("chain", _CHAIN),
    ]


# --- registry ---------------------------------------------------------------

def oracle_queries() -> dict[str, str]:
    e, l_ = _base_e(), _base_l()
    rdt, ldt = E_REPORT_DT, L_REPORT_DT
    return {
        "enriched_transactions": _with(e, (
            "SELECT trans_id, transaction_date, card_num, amount, oper_result, terminal, account, "
            "client_id, passport_num, fio, phone FROM chain")),
        "fraud_expired_passport": _with(e, _report(EVENT_EXPIRED_PASSPORT, rdt, _W_EXPIRED)),
        "fraud_blocked_passport": _with(e, _report(EVENT_BLOCKED_PASSPORT, rdt, _W_BLOCKED)),
        "fraud_invalid_agreement": _with(e, _report(EVENT_INVALID_AGREEMENT, rdt, _W_AGREEMENT)),
        "fraud_city_hop": _with(e + [("seq", _SEQ)], _report(EVENT_CITY_HOP, rdt, _W_CITY, "seq")),
        "fraud_amount_probe": _with(e + [("seq", _SEQ)], _report(EVENT_AMOUNT_PROBE, rdt, _W_PROBE, "seq")),
        "fraud_city_hop_all_versions": _with(e + [("seq", _SEQ_ALL)],
                                             _report(EVENT_CITY_HOP, rdt, _W_CITY, "seq")),
        "fraud_amount_probe_all_versions": _with(e + [("seq", _SEQ_ALL)],
                                                 _report(EVENT_AMOUNT_PROBE, rdt, _W_PROBE, "seq")),
        "fraud_mart": _with(e + [("seq", _SEQ)], _mart_e()),
        "fraud_mart_hot_card": _with(_base_hot() + [("seq", _SEQ)], _mart_e()),
        "terminals_history": _with(e, (
            "SELECT terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg, "
            "effective_from, strftime(effective_to, '%Y-%m-%d %H:%M:%S') AS effective_to FROM hist")),
        "terminals_history_daily": _with(e, (
            "SELECT terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg, "
            "effective_from, strftime(effective_to, '%Y-%m-%d %H:%M:%S') AS effective_to FROM hist")),
        "terminals_current": _with(e, "SELECT * FROM snapshots"),
        "terminals_new": _diff_sql("new"),
        "terminals_deleted": _diff_sql("deleted"),
        "terminals_changed": _diff_sql("changed"),
        "transactions_asof_terminal": _with(e, _ASOF),
        "transactions_asof_hot_terminal": _with(_base_hot_terminal(), _ASOF),
        "report_accumulate": _accumulate_sql(),
        "ingest_delimited": _with(e, (
            "SELECT trans_id, transaction_date, card_num, "
            "CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, oper_type, oper_result, "
            "terminal, strftime(transaction_date, '%Y-%m-%d') AS load_day FROM transactions")),
        "report_day_only": _accumulate_sql(lookback=False),
        "report_two_files_one_day": _accumulate_sql(),
        "report_late_rows": _accumulate_sql(),
        "report_empty_day": _empty_day_sql(),
        "report_compacted": _accumulate_sql(),
        "masters_loaded": _with(e + [("cut_days", "SELECT DISTINCT as_of FROM snapshots")], (
            "SELECT strftime(d.as_of, '%Y-%m-%d') AS load_day, k.card_num, k.account, c.client_id, c.passport_num, c.phone "
            "FROM cards k JOIN accounts a ON a.account = k.account JOIN clients c ON c.client_id = a.client "
            "JOIN cut_days d ON TRUE")),
        "ingest_terminals": _with(e, "SELECT * FROM snapshots"),
        "ingest_quoted": _with(e, (
            "SELECT as_of, terminal_id, CASE WHEN terminal_city = 'N1' THEN ';' ELSE terminal_type END AS terminal_type, "
            "'\"' || terminal_city || '\" ;' AS terminal_city, "
            "terminal_address || '; \"' || terminal_city || '\" east; 2' AS terminal_address FROM snapshots")),
        "ingest_quarantine": _with(e, _BAD_ROWS),
        "ingest_blacklist": _with(e + [("cut_days", "SELECT DISTINCT as_of FROM snapshots")], (
            "SELECT d.as_of, b.\"date\", b.passport FROM blacklist b "
            "JOIN cut_days d ON b.\"date\" <= d.as_of")),
        "volume_expired_passport": _with(l_, _report(EVENT_EXPIRED_PASSPORT, ldt, _W_EXPIRED)),
        "volume_blocked_passport": _with(l_, _report(EVENT_BLOCKED_PASSPORT, ldt, _W_BLOCKED)),
        "volume_invalid_agreement": _with(l_, _report(EVENT_INVALID_AGREEMENT, ldt, _W_AGREEMENT)),
        "volume_fraud_mart": _with(l_ + [("seq", _SEQ)], _mart_e(ldt)),
    }
