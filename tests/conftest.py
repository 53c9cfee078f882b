import pytest

from tests.comparing import session


@pytest.fixture(scope="session")
def spark():
    return session(spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")


def values(df, *columns):
    """Sorted rows of a frame as tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda row: tuple((v is None, str(v)) for v in row))
