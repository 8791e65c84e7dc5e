import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from noteloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def notes(spark, sf_dir):
    from noteloom.plans import inputs

    return inputs.notes(spark, sf_dir).persist()


@pytest.fixture
def texts(spark):
    """A table of notes from a list of texts; record ids count from 0."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "record_id long, raw_text string")

    return make
