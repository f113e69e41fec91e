import random

import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, part int, text_id long, h long, n string"


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "stone", "river", "light", "Été", "ñandú", "groß", "walks", "42"]) + rng.choice(["", "", ",", ".", "!"]) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in any column, empty and very long texts, ties, repeated rows, and columns named like internal ones."""
    rng = random.Random(5)
    long = sentence(rng, 30_000)
    texts = [None, "", " \n\t ", "!!! ???", "one", "two words", "a b c d", long, long, "x" * 200_000, "line\n" * 3000, "　wide space", "nul\0inside", "<|endoftext|> said"]
    texts += [sentence(rng, rng.randint(5, 80)) for _ in range(20)]
    texts += texts[-3:]
    rows = [(i, t, rng.choice(["en", None, "fr"]), None if i % 3 else "s", None, 0.5, i, 7, 8, "n") for i, t in enumerate(texts)]
    rows += [rows[20], rows[0], (None, "no id here at all", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(30)] + [(None, 1, 1), (31, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
