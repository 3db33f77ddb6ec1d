import pytest
from pyspark.sql import functions as F

from talklake.session import local_session

TALK = (
    "Tomatoes need warm soil, and warm soil needs time. We water tomatoes in the morning. "
    "The soil holds the water when straw covers it. Straw also keeps weeds small. "
    "You know, really, just going to say it: like, you know, straw is cheap. "
    "Prune the lower leaves of tomatoes every week. Leaves that touch wet soil rot. "
    "Feed the plants with compost from last year. Good compost smells like a forest. "
    "Pick tomatoes before the first frost, and keep the seeds of the best plants. "
    "Dry the seeds on paper. Next spring the warm soil waits for them."
)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate one column over literal inputs."""

    def run(column):
        return spark.range(1).select(column.alias("x")).first()["x"]

    return run


@pytest.fixture
def plan(spark):
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture(scope="session")
def lit():
    return F.lit
