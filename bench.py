"""Headline timings: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once cold, then ``BENCH_RUNS`` (default 3) warm runs; the
reported time is the warm median, with the full plan executed through the
``noop`` sink (no collect to the driver).  ``value`` is the sum over queries.
Queries that write the warehouse (the daily cycle) run once (cold = warm).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from cardsentry.plans import registry  # noqa: E402
from cardsentry.plans.testviews import set_e  # noqa: E402
from cardsentry.operators import rules  # noqa: E402
from cardsentry.operators.enrich import enrich, owners_of  # noqa: E402
from cardsentry.operators.scd2 import build_history  # noqa: E402
from cardsentry.session import build_session, drop_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def five_separate(spark, sf_dir):
    """The five rules as five separate plans (the original's shape)."""
    w = set_e(spark, sf_dir)
    hist = build_history(spark, w.snapshots, w.snapshot_days)
    chain = enrich(w.transactions, w.cards, w.accounts, w.clients)
    owners = owners_of(w.cards, w.accounts, w.clients)
    return [
        rules.expired_passport(chain, w.report_dt),
        rules.blocked_passport(chain, w.blacklist, w.report_dt),
        rules.invalid_agreement(chain, w.report_dt),
        rules.city_hop(w.transactions, owners, hist, w.report_dt),
        rules.amount_probe(w.transactions, owners, hist, w.report_dt),
    ]


HEADLINE = {
    "fraud_mart": registry.fraud_mart,
    "five_separate_rules": five_separate,
    "fraud_invalid_agreement": registry.fraud_invalid_agreement,
    "fraud_city_hop": registry.fraud_city_hop,
    "fraud_amount_probe": registry.fraud_amount_probe,
    "terminals_history": registry.terminals_history,
    "transactions_asof_terminal": registry.transactions_asof_terminal,
    "volume_invalid_agreement": registry.volume_invalid_agreement,
    "volume_expired_passport": registry.volume_expired_passport,
    "volume_blocked_passport": registry.volume_blocked_passport,
    "volume_fraud_mart": registry.volume_fraud_mart,
}
ONCE = {
    "report_accumulate": registry.report_accumulate,
    "ingest_delimited": registry.ingest_delimited,
}


def _time(fn, spark) -> float:
    t0 = time.perf_counter()
    out = fn(spark, SF_DIR)
    for df in out if isinstance(out, list) else [out]:
        _sink(df)
    return time.perf_counter() - t0


def main() -> None:
    spark = build_session(app="cardsentry-bench")
    result: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name, fn in HEADLINE.items():
        cold[name] = _time(fn, spark)
        result[name] = statistics.median(_time(fn, spark) for _ in range(max(1, RUNS)))
    for name, fn in ONCE.items():
        result[name] = cold[name] = _time(fn, spark)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of warm median seconds over headline queries",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in result.items()},
        "cold": {k: round(v, 3) for k, v in cold.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "runs": RUNS,
    }))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
