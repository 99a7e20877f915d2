"""Small tables with every awkward case, shared by the operator tests."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# Names that the operators use inside.
CLASHING = ["k", "t", "h", "d", "m", "r", "id", "fp", "host", "key", "path", "page", "token", "range", "n", "g", "bin", "length",
            "start", "slot", "shard", "_rank", "_bucket", "said", "root", "node", "set", "size", "virtual_slot", "l"]

TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs on into the dark wood.",
    "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den Wald.",
    None, "", "   ", "\n\t\n", "12345 !!! 678", "x", "a b", "日本語 の テキスト です", "naïve café   déjà vu", "a  b   c    d",
    "word " * 6000, "z" * 30_000, "Mail ann.lee01@mail.example.com or call +1 (555) 201-7788 about card 4111 1111 1111 1111.",
    "Mail Ann.Lee01@mail.example.com, server 10.20.30.40, token = \"deadbeefdeadbeefdeadbeefdeadbeef\" end",
    "The quick brown fox jumps over the lazy dog and runs on into the dark wood.",
]


def with_clashes(df):
    return df.select("*", *[F.lit(f"clash-{c}").alias(c) for c in CLASHING if c not in df.columns])


DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", None][i % 2], None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (0, "another text under the id of the first one", "en", "a", 1), (None, TEXTS[0], None, None, None),
             (None, None, None, None, None)]
    return with_clashes(spark.createDataFrame(rows, DOC_DDL)).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], DOC_DDL))
