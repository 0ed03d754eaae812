import random

import pytest

SYLLABLES = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti", "vu", "zen"]


def prose(seed, n):
    """Invented words."""
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def edited(text, seed, n):
    """The text with n words replaced."""
    r, words = random.Random(seed), text.split()
    for i in r.sample(range(len(words)), n):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with every awkward case, and column names that operators use inside."""
    base = prose(1, 120)
    texts = [(1, base), (2, base), (3, edited(base, 3, 2)), (4, edited(base, 4, 3)), (5, edited(base, 5, 30)), (6, None), (7, ""), (8, " \n\t "),
             (9, "one two"), (10, "ONE\tTwo"), (11, "É one two three four"), (12, prose(12, 6000)), (None, base), (None, None), (2, base),
             (13, prose(13, 50)), (13, prose(14, 50)), (14, "Ünï " * 40), (15, "x" * 5000), (16, "tie\ntie\ntie one two"), (17, prose(17, 10))]
    rows = [(i, t, "en", "src", "clash", "clash", 1.0, True) for i, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, node string, th string, score double, kept boolean") \
        .repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
