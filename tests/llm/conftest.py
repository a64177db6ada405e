import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LINE = "The same line in many documents."
PROSE = " ".join(f"word{i % 37}x{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, ties, repeated rows, a very long text, a null id and a null source."""
    return [
        (1, None, None, "b"), (2, "", "en", "b"), (3, " \n\t\n", "en", None), (4, "!!! ...", "fr", "a"),
        (5, "one", "en", "a"), (6, "one", "en", "a"), (6, "one", "en", "a"),
        (7, f"{PROSE}\n{LINE}", "en", "a"), (8, f"{PROSE}\n {LINE.upper()}\r", "en", "a"),
        (9, f"{PROSE} end\n{LINE}\n{LINE}", "en", "c"), (10, f"other {LINE}", None, "c"),
        (11, f"{LINE}\n" * 300 + "long " * 60_000, "en", "b"), (None, f"no id\n{LINE}", "de", "b"),
        (12, "É" * 25 + "\nÄäß 日本語 \U0001f600", "de", "c"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows among columns whose names operators use for themselves."""
    schema = "doc_id long, text string, lang string, source string, row long, node string, score string, size string, " \
        "n_words string, key string, bucket int, copies int, unit string, number int, start string, hash string"
    return spark.createDataFrame([(*r, 1, "x", "s", "z", "w", "k", 0, 9, "u", 7, "t", "h") for r in odd_rows], schema).repartition(3)
