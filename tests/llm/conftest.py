import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, score double, size int, ids string"


def words(random_words, n, vocabulary):
    return " ".join(random_words.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, repeated rows, copies and near copies."""
    pick = random.Random(5)
    english = [f"{a}{b}" for a in ("th", "er", "in", "sh") for b in ("ing", "ed", "an", "e", "ou", "ly")]
    french = [f"{a}{b}" for a in ("qu", "é", "le", "vi") for b in ("eau", "oi", "eux", "er", "ai", "on")]
    out = []
    for i in range(60):
        vocabulary, lang = (english, "en") if i % 3 else (french, "fr")
        out.append((i, words(pick, pick.randint(30, 120), vocabulary), lang))
    base = words(pick, 200, [f"w{k}" for k in range(500)])
    near = base.split()
    near[100] = "changed"
    out += [(100, base, "en"), (101, base, "en"), (102, " ".join(near), "en"), (103, " ".join(near[:150]), None)]
    out += [(104, None, "en"), (105, "", None), (106, "12 !! 34", "en"), (107, "  a  b ▁ \t\n é漢🙂 </s> ", "fr")]
    out += [(108, words(pick, 20_000, english), "en"), (109, "x" * 5_000, "en"), (None, base, None), (100, base, "en")]
    return [(i, text, lang, "s", 1.0, 2, "other") for i, text, lang in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
