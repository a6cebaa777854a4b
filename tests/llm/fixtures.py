import pytest

import corpus


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus.rows(), corpus.SCHEMA)


@pytest.fixture(scope="session")
def pairs():
    return [(r[0], r[1]) for r in corpus.rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], corpus.SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows and repeated ids."""
    rows = corpus.rows()[:20]
    return spark.createDataFrame([(None, *r[1:]) for r in rows[:6]] + rows + rows[:4] + [(rows[7][0], *rows[9][1:])], corpus.SCHEMA)
