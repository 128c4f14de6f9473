import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from broadsheet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MINI = [(1, "Apple, banana; apple!"), (2, "banana cherry"), (3, "BANANA")]


@pytest.fixture(scope="session")
def mini(spark):
    """Three documents with hand-worked results."""
    from broadsheet.operators.lemmas import document_words

    return document_words(spark.createDataFrame(MINI, "doc_id BIGINT, text STRING"))


@pytest.fixture(scope="session")
def mini_with_empty(spark):
    from broadsheet.operators.lemmas import document_words

    return document_words(spark.createDataFrame([*MINI, (4, "")], "doc_id BIGINT, text STRING"))


@pytest.fixture(scope="session")
def fruit_vectors(spark):
    return spark.createDataFrame([("apple", [1.0, 0.0]), ("banana", [0.0, 1.0])], "word STRING, vector ARRAY<FLOAT>")
