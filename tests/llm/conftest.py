"""Small tables with the awkward rows every operator must take."""

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, h string, fp long, label string, "
           "spans string, size long, start long, doc string")


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids, clashing extra columns."""
    words = " ".join(f"word{k % 977}x" for k in range(20_000))
    texts = [(1, "one two three"), (1, "one two three"), (1, "another text of the same id"), (None, "no id here"),
             (None, None), (2, None), (3, ""), (4, " \n\t "), (5, words), (6, words + " end"), (7, "a" * 50_000),
             (8, "Ünïcödé — 日本語   text\n\nwith  gaps "), (9, "x\x00y\x1fz"), (10, "one two three")]
    extra = [None if k % 3 else str(k) for k in range(len(texts))]
    return [(i, t, extra[k], None if k == 4 else f"s{k % 3}", k, "clash", k, "clash", "clash", k, k, "clash")
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), COLUMNS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def nothing_but_nulls(spark):
    return spark.createDataFrame([(None,) * 12] * 3, COLUMNS)
