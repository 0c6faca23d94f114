import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from catalith.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# Nulls, empty and blank texts, ties, repeated rows, very long words and texts.
LONG = "long " * 30_000
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (6, "é ß 日本語 😀  x"), (7, LONG),
    (8, "a" * 3000), (9, "\n" * 500), (None, "one two three four five six"), (10, "!!! ... ###"), (11, LONG + "end"),
]
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with further columns whose names the operators use themselves."""
    rows = [(d, t, "en", d, "kept") for d, t in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", lang string, n_words bigint, kept string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", lang string, n_words bigint, kept string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
