import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: an extra column whose name clashes in all but case, and one with a result's name
CLASH = "doc_id long, TEXT string, text string, score string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs."""
    def make(rows, partitions=3):
        full = [(i, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS).repartition(partitions)
    return make


@pytest.fixture(scope="session")
def clashing(spark):
    """The same with columns whose names clash."""
    def make(rows):
        return spark.createDataFrame([(i, "other", t, "x") for i, t in rows], CLASH)
    return make


@pytest.fixture(scope="session")
def sf_of(tmp_path_factory):
    """A folder of tables for the queries and stages."""
    def make(**tables):
        path = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return str(path)
    return make


@pytest.fixture(scope="session")
def words():
    """A seeded source of made-up words."""
    import random

    rng = random.Random(5)

    def make(n, size=200):
        return " ".join(f"w{rng.randrange(size)}{'é' * (rng.random() < 0.05)}" for _ in range(n))
    return make
