import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in a is that it was river stone market winter garden letter bridge paper window music silver harbour valley engine kitchen teacher doctor forest planet number question answer weather history".split()


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) + str(r.randrange(50)) * (r.random() < 0.2) for _ in range(n))


@pytest.fixture(scope="session")
def make_prose():
    return prose


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: null, empty, blank, copies, near copies, a long one, periodic ones, other scripts."""
    base = prose(1, 400)
    near = base.split(" ")
    near[50] = "changed"
    return [
        None, "", "   \n\t ", "one", "two words", base, base, " ".join(near), base.upper(), prose(2, 300) + " " + base[200:1400] + prose(3, 100), prose(4, 20000), "abc" * 400, "x" * 1500,
        "日本語のテキスト ñandú Größe é́ " * 20, "a\n\n b\t\tc  d", "<|endoftext|> don't", prose(5, 60), prose(6, 60), "\x00\x1c odd \x85 signs", "1234 5678 ...",
    ]


@pytest.fixture
def docs(spark, texts):
    """The texts as documents: a null id, a repeated row, and columns whose names clash with internal ones."""
    rows = [(i if i != 3 else None, t, None if i % 7 == 6 else ("en" if i % 2 else "de"), f"s{i % 2}", len(t) if t else 0) for i, t in enumerate(texts)]
    rows.append(rows[5])
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("own") for c in ("th", "did", "label", "words", "score", "node", "kept", "_th")})


@pytest.fixture
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)
