"""The client → account → card → transaction chain (one shared plan).

The three masters are joined among themselves first, giving one owner row per
card; the large fact then takes part in a single join on ``card_num``.  Store
the owner table (``owners_of``) before it meets the fact: Spark then knows its
bytes, broadcasts it below its threshold and otherwise sorts and merges (AQE
splits a hot card's partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.functions import fio
from cardsentry.session import materialize

OWNER_COLUMNS = (
    "card_num",
    "account",
    "account_valid_to",
    "client_id",
    "passport_num",
    "passport_valid_to",
    "fio",
    "phone",
)


def blocked_since(blacklist: DataFrame) -> DataFrame:
    """First blacklisting time per passport (pre-aggregated, unique key).

    Being later than any entry equals being later than the first, and the
    unique key keeps a passport listed twice from repeating reports.
    """
    return blacklist.groupBy(F.col("passport").alias("bl_passport")).agg(
        F.min("date").alias("blocked_since")
    )


def card_owners(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                blacklist: DataFrame | None = None) -> DataFrame:
    """One row per card with its account and client (inner joins upward).

    With ``blacklist``, also the passport's ``blocked_since`` (null when not
    listed), so the fact needs no join of its own for the blacklist rule.
    """
    acc = accounts.select("account", F.col("valid_to").alias("account_valid_to"), "client")
    cl = clients.select(
        "client_id", "passport_num", "passport_valid_to", fio().alias("fio"), "phone"
    )
    owners = (
        cards.select("card_num", "account")
        .join(acc, "account")
        .join(cl, F.col("client") == F.col("client_id"))
        .select(*OWNER_COLUMNS)
    )
    if blacklist is None:
        return owners
    bl = blocked_since(blacklist)
    return owners.join(bl, F.col("passport_num") == F.col("bl_passport"), "left").drop("bl_passport")


def owners_of(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
              blacklist: DataFrame | None = None) -> DataFrame:
    """The owner table, computed once and stored in the shared folder."""
    return materialize(card_owners(cards, accounts, clients, blacklist), "card-owners")


def enrich(transactions: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
           blacklist: DataFrame | None = None) -> DataFrame:
    """Transactions with their card owner; transactions of unknown cards drop out."""
    return transactions.join(owners_of(cards, accounts, clients, blacklist), "card_num")
