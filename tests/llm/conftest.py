import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows
    and extra columns whose names the operators use themselves."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(20_000))
    prose = "\n".join(" ".join(word() for _ in range(12)) for _ in range(12))
    rows = [(1, prose), (2, prose), (2, prose), (3, prose + " end"), (4, None), (5, ""), (6, " \n\t "), (7, long), (None, prose),
            (None, None), (8, "one"), (9, "one two"), (10, "x" * 5000), (11, "ab\n" * 600), (12, "A  b\r\n<|endoftext|> c d  "), (13, "日本語 テキスト")]
    rows = [(i, t, None if k % 3 == 0 else "en", None, k, f"n{k}", k * 0.5, True) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, h double, kept boolean")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 0), (7, 0, 0), (8, 1, 1), (9, None, 0), (None, 1, 0), (10, 0, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
