import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, Score double, _key string, sums binary"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Plain texts, near and exact copies, ties, nulls, empty, blank and very long ones."""
    rng = random.Random(7)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    out = list(base)
    for t in base[:30]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            for _ in range(max(1, len(v) // rng.choice((12, 25, 60)))):
                v[rng.randrange(len(v))] = f"x{rng.randrange(50)}"
            out.append(" ".join(v))
        out.append(t.upper())
    out += [None, "", "   \n\t ", "ä", "one two three four", "one two three four", prose(rng, 30_000), "\n".join([base[3]] * 4)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with clashing extra columns, a null id and a row that comes twice."""
    rows = [(i, t, None, None if i % 11 == 0 else f"s{i % 3}", None, "taken", 0.5, "k", b"x") for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[2], "en", "s1", 3, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
