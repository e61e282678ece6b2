import pytest

from clickweir.llm import common


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    common.ship(spark)


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: NULL, empty, white space, very long, repeated."""
    return [None, "", " \n\t ", "word", "word", "a. b.\nc! " * 4000, "Énd of ligne.\r\nzwei　drei \U0001f600"]


DOCUMENT = "doc_id long, text string, score double, fp string, row int, length string"


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Documents with columns that clash with those operators add; the last row repeats one, one id is NULL."""
    rows = [(i if i != 2 else None, t, 9.0, "fp", 1, None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4]], DOCUMENT)
