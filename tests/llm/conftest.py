import random

import pytest

SYLLABLES = "ta ro mi ke su no la vi der ung ein ze pa lo qui".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty, very long, repeated and near-repeated texts, and extra columns with names used inside operators."""
    rng = random.Random(3)
    base = prose(rng, 120)
    rows = [
        (1, base), (2, base), (2, base), (3, base.replace(" ", "  ", 3)), (4, base + " extra"), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "one two"), (None, "a null id here"), (None, None),
        (10, prose(rng, 40_000)), (11, "x" * 50_000), (12, "İstanbul ΣΑΣ naïve 😀 <|endoftext|> <s>"), (13, prose(rng, 60)), (-4, prose(rng, 60)),
    ]
    return spark.createDataFrame([(i, t, 1, "x", 0.5, 7, "en", "s", 3) for i, t in rows], "doc_id long, text string, k long, h string, score double, n long, lang string, source string, u long")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
