import pytest

from tablespoon.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def lake(tmp_path):
    from tablespoon.plans.jobs import Lake

    return Lake(f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/marts", {"b1": "Central"})
