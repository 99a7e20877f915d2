"""Master tables (cards, accounts, clients): typed reads with fixed schemas.

Ids stay strings (real client ids hold text such as ``VIP-0001``); dates are
DATE.  Any Spark file format works (Parquet by default, CSV with a header).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cardsentry.schemas import ACCOUNTS, CARDS, CLIENTS


class Masters(NamedTuple):
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame


def read_masters(spark: SparkSession, cards: str, accounts: str, clients: str,
                 fmt: str = "parquet", **options: str) -> Masters:
    def load(path: str, schema) -> DataFrame:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)

    return Masters(load(cards, CARDS), load(accounts, ACCOUNTS), load(clients, CLIENTS))


def write_masters(m: Masters, root: str) -> None:
    """Store the masters as Parquet tables ``cards``, ``accounts``, ``clients``."""
    m.cards.write.mode("overwrite").parquet(f"{root}/cards")
    m.accounts.write.mode("overwrite").parquet(f"{root}/accounts")
    m.clients.write.mode("overwrite").parquet(f"{root}/clients")
