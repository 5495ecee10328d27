import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from termfold.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("scratch")
    session = local_session(
        4,
        **{
            "spark.checkpoint.dir": str(folder),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def page(spark):
    """Fielded form of one page body, as a dict."""
    from termfold.operators.documents import field_documents

    def make(text, title="A title", **fielding):
        pages = spark.createDataFrame([("1", title, text)], "Id string, Title string, Text string")
        return field_documents(pages, **fielding).first().asDict()

    return make
