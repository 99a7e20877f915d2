"""Listing of a warehouse: its tables and columns, for people to read.

Metadata only: one small row per column, from the schemas of the published
folders; nothing is registered in a metastore, so nothing goes stale
and nothing needs dropping.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cardsentry.plans import daily


def list_columns(spark: SparkSession, store: daily.Store) -> list[tuple[str, int, str, str]]:
    """(table, position, column, type) of every published table."""
    tables = (daily.FACT_TX, daily.FACT_BLACKLIST, daily.STG_TERMINALS, daily.OWNERS, daily.DIM, daily.REPORT)
    found = {name: daily.table_rows(spark, store, name) for name in tables}
    return [(name, i, f.name, f.dataType.simpleString())
            for name, df in sorted(found.items()) if df is not None for i, f in enumerate(df.schema)]
