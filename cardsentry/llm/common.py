"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.session import materialize, scratch_path

__all__ = ["ascii_words", "materialize", "read_table", "scratch_path", "spread_partitions"]

# The words of the contracts: runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` cuts at exactly the six ASCII
    white-space characters of :data:`WORD`."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def spread_partitions(df: DataFrame, rows: int, target_rows: int) -> int:
    """Number of partitions for ``rows`` rows at ``target_rows`` each, at
    least the session's shuffle parallelism."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // target_rows))


def unsigned_hex(col: Column) -> Column:
    """A signed 64-bit integer as 16 lowercase hex digits of its bits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))
