import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "key", "t", "n", "slot", "pos", "cls", "root", "size", "u", "chunk", "score", "kept", "word"]


def _prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "in", "is"]) if rng.random() < 0.4 else "".join(rng.choice(["er", "tion", "ou", "re", "th", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, copies, near copies, shared passages, ties and repeated rows."""
    rng = random.Random(4)
    passage, base = _prose(rng, 70), _prose(rng, 160)
    rows = [(None, "no id here " + passage, "en", "a", 1), (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "b", 0), (3, " \n\t ", "en", None, 3), (4, "word", "en", "b", 4)]
    rows += [(10 + k, base, "en", "a", 1) for k in range(4)]
    for k in range(4):
        words = base.split()
        words[20 * k + 7] = "changed"
        rows.append((20 + k, " ".join(words), "en", "b", 1))
    rows += [(30 + k, f"{_prose(rng, 30)} {passage} {_prose(rng, 25)}", "de", "a", 1) for k in range(5)]
    rows += [(40 + k, _prose(rng, 120), "fr", "c", 1) for k in range(10)]
    rows += [(60, "ab" * 60_000, "en", "a", 1), (61, "same line of text again\n" * 900, "en", "c", 1), (62, "été — 漢字 \U0001f600  \x1c" * 40, "fr", "c", 1)]
    return [*rows, rows[6], rows[6], rows[-1]]  # whole rows again


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("other") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, odd_rows):
    ids = sorted({r[0] for r in odd_rows if r[0] is not None})
    return spark.createDataFrame([(i, int(i % 5 > 0), int(i % 4 == 1)) for i in ids], "doc_id long, quality int, toxic int")
