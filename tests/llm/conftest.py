import pytest

from airway.sources.staging import release

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def cleaned(spark):
    yield
    release(spark)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text), with columns whose names operators use inside."""

    def make(rows, source="s"):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "id long, node string, size long, _id long, _print long, _rate double, key string, hits string"
        )
        full = [(i, t, "en", source, None if t is None else len(t), 7, "n", 1, 2, 3, 0.5, "k", "h") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make
