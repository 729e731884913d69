import random

import pytest

DOCS = "doc_id bigint, text string, lang string, score double, shard int, _text string"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "ki", "lo") for b in ("r", "st", "nt", "l", "mp")]


def prose(rnd: random.Random, n: int) -> str:
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing column names."""
    rnd = random.Random(3)
    long = prose(rnd, 30_000)
    rows = [(1, "A line.\nAnother  line,\twith é and <|endoftext|> </s>\n\n", "en", 0.1, 3, "x"),
            (2, None, None, None, None, None), (3, "", "en", 0.2, 1, "y"), (None, "no id here", "en", 0.3, 2, "z"),
            (4, long, "en", 0.4, 4, ""), (5, "same text", "en", 0.5, 5, "a"), (5, "same text", "en", 0.5, 5, "a"),
            (5, "another text", "en", 0.5, 5, "a"), (6, "▁ two  spaces   three ", "en", 0.5, 5, "a"), (None, None, None, None, None, None)]
    rows += [(i, prose(rnd, rnd.randint(1, 300)), "en", 0.0, 0, None) for i in range(10, 60)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
