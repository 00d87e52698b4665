import random

import pandas as pd
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string"


@pytest.fixture(scope="session")
def words():
    """Sentences of invented words, the same in each run."""
    source = random.Random(5)
    syllables = ["ka", "lo", "mi", "ter", "un", "sha", "bre", "no", "vi", "der"]
    vocabulary = ["".join(source.choices(syllables, k=source.randint(1, 4))) for _ in range(400)]
    return lambda n, seed: " ".join(random.Random(seed).choices(vocabulary, k=n))


@pytest.fixture(scope="session")
def awkward(spark, words):
    """NULLs, empty and long texts, copies, repeated rows, and columns with clashing names."""
    base = words(120, 1)
    near = base.split()
    near[3] = "changed"
    texts = [
        (1, base),
        (2, base),
        (2, base),
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, "   \n\t "),
        (None, words(40, 2)),
        (None, None),
        (7, words(6000, 3)),
        (8, words(4, 4)),
        (9, "1234 5678 +++ !!!"),
        (10, f"{words(30, 6)} {words(60, 7)}"),
        (11, f"{words(60, 7)} {words(30, 8)}"),
        (12, "a  b \n c\r\n" + words(20, 9) + "  "),
        (13, "é ñ ü 中文 😀   x"),
        (14, "ab" * 400),
        (7, words(10, 10)),
    ]
    rows = [(i, t, None if k % 4 == 0 else ("en", "de")[k % 2], "s", None, "x", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def plain():
    """A frame as pandas rows with NULL ids as None."""

    def rows(frame) -> pd.DataFrame:
        found = [tuple(r) for r in frame.collect()]
        rows = pd.DataFrame(found, columns=frame.columns, dtype=object)
        whole = [c for c in rows.columns if all(x is not None for x in rows[c])]
        return rows.assign(**{c: rows[c].infer_objects() for c in whole})

    return rows
