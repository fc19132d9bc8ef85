import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from sft_tables.session import configure

    session = configure(oracle.session())
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Row model of {dataset: [values]}; values are dumped as JSON."""
    from sft_tables.operators.rows import to_row_model

    def build(**datasets):
        data = [(name, i, json.dumps(v)) for name, values in datasets.items() for i, v in enumerate(values, 1)]
        return to_row_model(spark.createDataFrame(data, "dataset_id string, row_index bigint, raw string"))

    return build
