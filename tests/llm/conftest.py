import random

import pytest
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

COLUMNS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # columns that clash with names used inside the operators
    *[StructField(c, StringType()) for c in ("id", "size", "key", "n", "shard", "rank", "component", "tag", "lang_pred", "kind")],
    StructField("score", DoubleType()),
])

SYLLABLES = {"en": "the of and ing er on th an re he in at".split(), "de": "der die und ein sch ach en ge ver be ich auf".split()}


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


def edge_rows():
    """Documents with nulls, empty, short and very long texts, exact and near copies, repeated rows and odd bytes."""
    rng = random.Random(5)
    base = [prose(rng, "en" if i % 2 else "de", rng.randint(30, 120)) for i in range(30)]
    rows = [(10 + i, t, "en" if i % 2 else "de", f"s{i % 3}") for i, t in enumerate(base)]
    near = base[3].split()
    near[len(near) // 2] = "changed"
    passage = prose(rng, "en", 40)
    rows += [
        (1, None, "en", "s0"), (2, "", "en", "s0"), (3, " \t\n", None, None), (4, "one", "en", None), (5, "two words", "de", "s1"),
        (6, base[0], "de", "s1"), (7, base[0], "de", None), (8, " ".join(near), "en", "s2"), (9, base[3].upper(), "en", "s2"),
        (100, prose(rng, "en", 30) + " " + passage + " " + prose(rng, "en", 25), "en", "s0"),
        (101, passage, "en", "s0"), (102, passage + "\n" + passage, "en", "s1"),
        (103, "x" * 300, None, "s1"), (104, "ab" * 400, None, "s1"), (105, "x" * 180 + " tail", None, "s1"),
        (106, "12 34 !!", None, "s0"), (107, "Ünïcödé \U0001f600 text with spaces\x01and\x1fcontrols <|endoftext|> it's 12", "de", "s9"),
        (108, "\n".join(prose(rng, "de", 2500) for _ in range(3)), "de", "s0"),
        (12, base[2], "de", "s2"), (12, base[2], "de", "s2"),                    # a repeated row
        (13, "another text under an id that is taken already, long enough to hold a fifty byte string", "en", "s1"),
        (None, base[4], "de", "s1"), (None, None, None, None),
        (-5, prose(rng, "en", 60), "en", "a"), (2**40, prose(rng, "en", 60), "en", "Z"),
    ]
    return [(d, t, lang, s, None if t is None else len(t), *["clash"] * 10, 0.5) for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(5).cache()


@pytest.fixture(scope="session")
def edge_list():
    return [(r[0], r[1], r[2], r[3]) for r in edge_rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
