import pytest

from llm_cases import TEXTS
from tests.conftest import rows  # noqa: F401 (in a run of the whole suite this is the module "conftest" of the tests above, too)


@pytest.fixture(scope="session")
def edge(spark):
    """The edge cases, with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en" if k % 2 else None, None, 1, "mine", k, "id", "body") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "loc string, key long, id string, row string").repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
