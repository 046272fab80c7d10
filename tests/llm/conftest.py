import pytest

from tidemark.session import ship_package

SCHEMA = "doc_id long, text string, lang string, n_words long, score double, block int, shard string, cid int, state int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, lang]) tuples, with columns whose names the operators use themselves."""
    ship_package(spark)

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", 7, 0.5, 1, "x", 2, 3) for r in rows], SCHEMA)

    return make
