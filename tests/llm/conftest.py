import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, k2 long, shard int, score string"


def _words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in every column, empty and long texts, near and exact copies, repeated rows and clashing names."""
    rnd = random.Random(7)
    base = _words(rnd, 120)
    passage = _words(rnd, 70)
    rows = []
    for i in range(60):
        text = _words(rnd, rnd.randint(0, 40))
        if i % 6 == 0:
            words = base.split()
            for _ in range(i // 12):
                words[rnd.randrange(len(words))] = "zz"
            text = " ".join(words)
        if i % 7 == 0:
            text = f"{text}\n{passage}\n{_words(rnd, 3)}"
        if i % 4 == 0:
            text += "\n  Same LINE \t"
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None]), len(text), "x", i, 3, "y"))
    long = _words(rnd, 6000)
    rows += [(100, None, "en", "a", None, None, None, None, None), (101, "", None, None, 0, None, None, None, None),
             (102, "   \n\t", "fr", "b", 5, None, None, None, None), (103, long, "en", "a", 1, None, None, None, None),
             (104, "aaaa" * 300, "en", "c", 1, None, None, None, None), (105, "Ünïcode ÄÖ éèñ 日本 ABC\x00def", None, "é", 1, None, None, None, None),
             (None, base, "en", "a", 2, None, None, None, None), (None, None, None, None, None, None, None, None, None),
             (None, base, "en", "a", 2, None, None, None, None), (7, rows[7][1], "en", "b", 3, "x", 1, 2, "z"),
             rows[3], rows[3], (106, "one two", "en", "a", 1, None, None, None, None), (107, "ONE two", "en", "b", 1, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
