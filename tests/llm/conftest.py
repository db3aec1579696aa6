import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """Tables that operators stage go to a folder of the test run."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


#: Nulls, empty and long texts, ties, repeated rows.
HARD = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, ""),
        (4, "   \n\t "), (None, "no id here at all, none"), (5, "one two three four five six seven "
        "eight nine ten eleven"), (5, "one two three four five six seven eight nine ten eleven"),
        (6, "word " * 30_000), (7, "É ß 日本 　x " * 50), (8, "Lone")]


@pytest.fixture(scope="session")
def hard(spark):
    """Documents with every hard case, and extra columns whose names clash with inner ones."""
    rows = [(i, t, "en", "src", 0.5, 3, "x", 1) for i, t in HARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score double, n long, "
              "node string, _shard int")


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)
