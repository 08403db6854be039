import pytest

from assayline.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def values(spark):
    """Evaluates columns over one column `c` of text values and returns the lists."""
    def run(texts, *columns, dtype="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {dtype}")
        rows = df.select("i", *[c.alias(f"r{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
        out = [[r[f"r{k}"] for r in rows] for k in range(len(columns))]
        return out[0] if len(columns) == 1 else out
    return run
