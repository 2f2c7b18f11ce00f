import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, id long, size long, node long, votes int, sig int, copies string"


def odd_rows():
    """Nulls, empty, blank and long texts, ties, repeated rows; columns named like internal ones."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, long, short = text(200), text(6000), text(9)
    words = base.split()
    near = [" ".join(words[:i] + ["zz"] + words[i + 1 :]) for i in (3, 50, 120, 199)]
    far = " ".join(words[:120]) + " " + text(120)
    texts = [base, base, base.upper(), " " + base + "\n", *near, far, long, long + " tail", long[: len(long) // 2], short, short + " x", "one two three", "One Two Three", "one", "", "", None, None, " \t\n ", "é" * 90 + " ü x", "a b c d", "a b c d e", "x " * 300, "w1 w2 w3 " * 100, "line one here\nline one here\n\nline one here", "naïve 1 😀 text <|endoftext|> more", "don't  stop now 's", "tab\tsep\x0bvt\x0cff\rcr"]
    texts += [text(60) for _ in range(30)] + [text(n) for n in (4, 5, 6, 7, 49, 50, 51, 99)]
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 5}", None if t is None else len(t), "w", i, 1, 2, 3, 4, "c") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
