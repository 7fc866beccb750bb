import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from lodgelex.operators.listings import flatten  # noqa: E402
from lodgelex.schema import LISTING_SCHEMA  # noqa: E402
from lodgelex.session import local_session  # noqa: E402
from lodgelex.sources import samples  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, app="lodgelex-tests", **{"spark.sql.maxMetadataStringLength": "4000"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def words_of(spark):
    return {
        "stop": samples.sample_stop_words(spark),
        "afinn": samples.sample_afinn(spark),
        "bing": samples.sample_bing(spark),
        "nrc": samples.sample_nrc(spark),
    }


def listing(
    key, text=None, country="en", rating=100, reviews=10, coordinates=(1.0, 2.0), rooms=1,
    price=60.0, room_type="Private room",
):
    location = None if coordinates is None else (list(coordinates),)
    return (
        key, text, text, (country, "m", location), (rating,), reviews, rooms, price, room_type,
    )


@pytest.fixture(scope="session")
def make(spark):
    """Flattened listings from ``listing(...)`` keyword rows, spread over several partitions."""

    def build(*rows, partitions=3):
        data = [listing(i + 1, **row) if isinstance(row, dict) else row for i, row in enumerate(rows)]
        return flatten(spark.createDataFrame(data, LISTING_SCHEMA).repartition(partitions))

    return build


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
