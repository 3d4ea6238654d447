import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, **{
        "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a frame as sorted tuples."""
    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
    return collect
