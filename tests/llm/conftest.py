"""Small frames that every operator must survive."""

import pytest
from odd_rows import DOC_SCHEMA, odd_documents


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(odd_documents(), DOC_SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the odd documents, null as empty."""
    return [(r[0], r[1] or "") for r in odd_documents()]
