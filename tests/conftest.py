import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from jobtide.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    return local_session(config={"spark.sql.warehouse.dir": warehouse})


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def values(spark):
    """values(f, [inputs]) -> f applied to a text column holding the inputs, in order."""

    def apply(f, inputs):
        rows = [(i, text) for i, text in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, text string")
        return [r[0] for r in df.orderBy("i").select(f("text")).collect()]

    return apply
