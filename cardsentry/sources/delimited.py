"""Daily drops as delimited text with a header (``;`` by default): the
transactions, the terminal cut and the passport blacklist.

Records are parsed by Spark's CSV parser (``from_csv``), so a field in quotes
may hold separators and doubled quotes.  Columns bind by the name in each file's
own header, in whatever order.  The header is found by its content, so a folder
of Spark part files, each with its header, reads like one file; a file without a
header that holds all the columns asked for, or with two different ones, is an
error (``strict``) or goes to quarantine whole.

Everything is text at first and typed JVM-side.  A row with another number of
fields than its header, with an open quote, or whose key, amount or time does
not parse goes to a quarantine DataFrame with its text and the reason instead of
failing the job (ANSI mode), being misread, or silently becoming null.

The load day comes from the ``ddmmyyyy`` token of the file (or folder) name.
A line break inside quotes is not supported: both halves go to quarantine.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.functions import parse_amount
from cardsentry.schemas import TERMINAL_ATTRS, TERMINAL_KEY, TRANSACTIONS_RAW
from cardsentry.session import materialize

# Fixed value: daily files carry their date as ddmmyyyy in the name,
# e.g. transactions_01032021.txt, terminals_01032021.txt.
DATE_TOKEN = r"_(\d{8})\.[A-Za-z]+(?:/|$)"
DATE_TOKEN_FORMAT = "ddMMyyyy"
TX_NAMES = tuple(f.name for f in TRANSACTIONS_RAW.fields)
# A wider line is not a header.
MAX_COLUMNS = 1000
# Why a row is in quarantine.
FAULT_HEADER, FAULT_QUOTES, FAULT_FIELDS, FAULT_VALUES = "header", "quotes", "fields", "values"
# What the CSV parser trims around a field.
_WHITE = "".join(map(chr, range(1, 33)))
QUARANTINE_COLUMNS = ("source_file", "load_date", "row_text", "reason")


class Parsed(NamedTuple):
    good: DataFrame
    quarantine: DataFrame


def file_day(path: Column) -> Column:
    """DATE from the ``_ddmmyyyy.ext`` token of a path (null if none)."""
    token = F.regexp_extract(path, DATE_TOKEN, 1)
    return F.when(token != "", F.try_to_timestamp(token, F.lit(DATE_TOKEN_FORMAT))).cast("date")


def parse_time(text: Column, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP_NTZ; null when it does not parse.  Without a format
    ISO times and ``dd.mm.yyyy`` dates are taken."""
    if fmt is not None:
        return F.try_to_timestamp(F.trim(text), F.lit(fmt)).cast("timestamp_ntz")
    return F.coalesce(F.trim(text).try_cast("timestamp_ntz"),
                      F.try_to_timestamp(F.trim(text), F.lit("dd.MM.yyyy")).cast("timestamp_ntz"))


def _outside_quotes(value: Column) -> Column:
    """The text without its quoted stretches; what is left of a well-formed
    record holds a separator per border of two fields."""
    return F.when(F.contains(value, F.lit('"')), F.regexp_replace(value, '"[^"]*"', "")).otherwise(value)


def _n_fields(bare: Column, sep: str) -> Column:
    return ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)).cast("int") + 1


def _cells(value: Column, sep: str, width: int) -> Column:
    """The first ``width`` fields of a record, trimmed outside their quotes.  A
    record without a quote is only cut at its separators."""
    options = {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
               "maxCharsPerColumn": "-1", "maxColumns": str(width + 1)}
    record = F.from_csv(value, ", ".join(f"c{i} string" for i in range(width)), options)
    # Through a lambda, so that a record is parsed once and not once a field.
    quoted = F.transform(F.array(record), lambda r: F.array(*[F.coalesce(r[f"c{i}"], F.lit("")) for i in range(width)]))[0]
    plain = F.transform(F.slice(F.split(value, F.lit(re.escape(sep)), -1), 1, width), lambda c: F.btrim(c, F.lit(_WHITE)))
    return F.when(F.contains(value, F.lit('"')), quoted).otherwise(plain)


def bind_columns(lines: DataFrame, columns: Sequence[str], sep: str = ";", strict: bool = True) -> DataFrame:
    """``columns`` as text, by name, with ``source_file``, ``row_text`` and
    ``fault`` (why a row is not bound, or null), from raw lines (``value``,
    ``source_file``)."""
    lines = lines.where(F.trim("value") != "")
    names_it = F.lit(True)
    for c in columns:
        names_it = names_it & F.contains("value", F.lit(c))
    width = _n_fields(_outside_quotes(F.col("value")), sep)
    # One row per file and text that may be its header.
    files = materialize(lines.select("source_file", F.when(names_it & (width <= MAX_COLUMNS), F.col("value")).alias("head")).distinct(), "files")
    heads = files.where("head is not null")
    widest = heads.agg(F.max(_n_fields(_outside_quotes(F.col("head")), sep))).first()[0] or 1
    heads = heads.select("source_file", "head", F.slice(_cells(F.col("head"), sep, widest), 1, _n_fields(_outside_quotes(F.col("head")), sep)).alias("header"))
    for c in columns:
        heads = heads.where(F.array_contains("header", c))
    headers = heads.groupBy("source_file").agg(F.collect_set("header").alias("found"), F.collect_set("head").alias("head_texts")).where(
        F.size("found") == 1).select("source_file", F.col("found")[0].alias("header"), "head_texts")
    if strict:
        bad = files.join(headers, "source_file", "left_anti").select("source_file").distinct().limit(5).collect()
        if bad:
            raise ValueError(f"no single header with the columns {list(columns)} in {[r.source_file for r in bad]}")
    bare = _outside_quotes(F.col("value"))
    # A header's cells stand in no other text than those it was found by.
    body = lines.join(headers, "source_file", "left").where(F.col("header").isNull() | ~F.array_contains("head_texts", F.col("value")))
    parsed = body.select("source_file", "value", "header", _cells(F.col("value"), sep, widest).alias("cells"), bare.alias("bare"))
    fault = (F.when(F.col("header").isNull(), FAULT_HEADER)
             .when(F.col("bare").rlike('(^|' + re.escape(sep) + r')\s*"'), FAULT_QUOTES)
             .when(_n_fields(F.col("bare"), sep) != F.size("header"), FAULT_FIELDS))
    return parsed.select(
        *[F.get(F.col("cells"), F.array_position("header", c).cast("int") - 1).alias(c) for c in columns],
        "source_file", F.col("value").alias("row_text"), fault.alias("fault"))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw lines of files or folders with the file they stand in."""
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.text(paths if isinstance(paths, str) else list(paths)).select("value", F.col("_metadata.file_path").alias("source_file"))


def _blank_to_null(name: str) -> Column:
    return F.when(F.trim(name) != "", F.trim(name))


def type_transactions(named: DataFrame, ts_format: str | None = None) -> DataFrame:
    """Typed transactions with ``load_date``, ``source_file``, ``row_text`` and
    ``reason`` (null if every column that the rules need has parsed)."""
    typed = named.select(
        _blank_to_null("transaction_id").alias("trans_id"),
        parse_time(F.col("transaction_date"), ts_format).alias("transaction_date"),
        _blank_to_null("card_num").alias("card_num"),
        parse_amount(F.col("amount")).alias("amount"),
        F.trim("oper_type").alias("oper_type"),
        F.upper(F.trim("oper_result")).alias("oper_result"),
        F.trim("terminal").alias("terminal"),
        file_day(F.col("source_file")).alias("load_date"),
        "source_file", "row_text", "fault",
    )
    return _judged(typed, "trans_id", "transaction_date", "card_num", "amount", "load_date")


def _judged(typed: DataFrame, *needed: str) -> DataFrame:
    """With ``reason``: null for a row that is bound and has every needed column."""
    lacks = F.lit(False)
    for c in needed:
        lacks = lacks | F.col(c).isNull()
    return typed.withColumn("reason", F.coalesce("fault", F.when(lacks, FAULT_VALUES))).drop("fault")


def split_typed(typed: DataFrame) -> Parsed:
    return Parsed(typed.where("reason is null").drop("reason", "row_text"),
                  typed.where("reason is not null").select(*QUARANTINE_COLUMNS))


def read_transactions(spark: SparkSession, paths: str | Sequence[str], sep: str = ";",
                      ts_format: str | None = None, strict: bool = True) -> Parsed:
    """Typed transactions (+ ``load_date`` from the file name) and quarantine."""
    return split_typed(type_transactions(bind_columns(read_lines(spark, paths), TX_NAMES, sep, strict), ts_format))


def type_terminals(named: DataFrame) -> DataFrame:
    """Terminal cuts; a row without a key is not taken."""
    typed = named.select(_blank_to_null(TERMINAL_KEY).alias(TERMINAL_KEY), *TERMINAL_ATTRS,
                         file_day(F.col("source_file")).alias("load_date"), "source_file", "row_text", "fault")
    return _judged(typed, TERMINAL_KEY, "load_date")


def read_terminals(spark: SparkSession, paths: str | Sequence[str], sep: str = ";", strict: bool = True) -> Parsed:
    return split_typed(type_terminals(bind_columns(read_lines(spark, paths), (TERMINAL_KEY, *TERMINAL_ATTRS), sep, strict)))


def type_blacklist(named: DataFrame, fmt: str | None = None) -> DataFrame:
    """Passport blacklists; a row without a passport or a date that parses is
    not taken."""
    typed = named.select(parse_time(F.col("date"), fmt).alias("date"), _blank_to_null("passport").alias("passport"),
                         file_day(F.col("source_file")).alias("load_date"), "source_file", "row_text", "fault")
    return _judged(typed, "date", "passport", "load_date")


def read_blacklist(spark: SparkSession, paths: str | Sequence[str], sep: str = ";", fmt: str | None = None, strict: bool = True) -> Parsed:
    return split_typed(type_blacklist(bind_columns(read_lines(spark, paths), ("date", "passport"), sep, strict), fmt))


def write_drop(df: DataFrame, out_dir: str, prefix: str, day: Column, sep: str = ";") -> None:
    """Write text columns as one delimited file set per day, named
    ``<prefix>_ddmmyyyy.txt``."""
    name = F.concat(F.lit(f"{prefix}_"), F.date_format(day, DATE_TOKEN_FORMAT), F.lit(".txt"))
    columns = [c for c in df.columns if not c.startswith("_")]
    (df.select(*columns, name.alias("file")).write.mode("append").partitionBy("file")
     .option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(out_dir))


def transaction_text(df: DataFrame, comma_decimal: Column | None = None) -> DataFrame:
    """Typed transactions as the text columns of a drop.  ``comma_decimal`` (a
    boolean column) selects amounts written with a decimal comma."""
    amount = F.col("amount").cast("decimal(18,2)").cast("string")
    if comma_decimal is not None:
        amount = F.when(comma_decimal, F.regexp_replace(amount, r"\.", ",")).otherwise(amount)
    return df.select(
        F.col("trans_id").alias("transaction_id"),
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transaction_date"),
        amount.alias("amount"), "card_num", "oper_type", "oper_result", "terminal",
        F.col("load_date").alias("_day"),
    )


def write_transactions(df: DataFrame, out_dir: str, sep: str = ";", comma_decimal: Column | None = None) -> None:
    """Write one file set per load day, named ``transactions_ddmmyyyy.txt``."""
    write_drop(transaction_text(df, comma_decimal), out_dir, "transactions", F.col("_day"), sep)
