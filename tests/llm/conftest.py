import random

import pytest

from lakestrata.llm.shipping import ship

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use themselves
    "score double, n_tokens long, digest string, node long, label int, kept boolean, topic string"
)


@pytest.fixture(scope="session", autouse=True)
def code_on_workers(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text, lang, source); the rest is null."""
        return spark.createDataFrame([(*r, *[None] * 8) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["the", "of", "der", "die", "les", "été", "größe", "x=1", "A", "日本語"]
    long_text = " ".join(rng.choices(words, k=30_000))
    return [
        (1, "one two three four five six", "en", "a"),
        (1, "one two three four five six", "en", "a"),
        (2, "One  two\tthree four\nfive six", "en", None),
        (3, None, None, "b"),
        (4, "", "en", "b"),
        (5, " \n\t ", None, None),
        (6, "x" * 60_000, "de", "c"),
        (7, long_text, "de", "c"),
        (8, long_text + " end", "de", "c"),
        (9, "12345 !!! 678", "fr", "a"),
        (None, "one two three four five six", None, "a"),
        (None, None, None, None),
        (10, "l'été d'une 'tis they're   end ", "fr", "d"),
    ]


@pytest.fixture(scope="session")
def random_docs():
    """Families of near copies beside texts of their own, and a passage many share."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=25)
    rows, at = [], 0
    for family in range(25):
        base = rng.choices(vocabulary, k=rng.choice([3, 12, 40, 90, 200]))
        if family % 3 == 0:
            base = passage + base
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((at, " ".join(copy), "en", f"s{at % 4}"))
            at += 1
    return rows
