import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from topiclens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture
def values(spark):
    """Values of one column expression over a list of texts."""

    def run(texts, function):
        rows = [(i, text) for i, text in enumerate(texts)]
        df = spark.createDataFrame(rows, "i long, x string")
        return [row.y for row in df.select("i", function(df.x).alias("y")).orderBy("i").collect()]

    return run
