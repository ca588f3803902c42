import pytest


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The session with a folder for intermediate tables."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark
