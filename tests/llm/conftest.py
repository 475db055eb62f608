"""Documents with every odd case the operators must take; extra columns carry names the operators use themselves."""

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

PROSE = ("the quick brown fox went over the hill and saw a small house near the river where an old man was reading "
         "a long letter from his daughter who had moved to the city in the spring of that year and never came back ")
OTHER = ("meanwhile several engineers measured every bridge between both harbours because winter storms damage bolts "
         "which nobody had inspected since summer although reports described rust along most of the northern beams ")


def odd_rows():
    unit = [f"w{i}x" for i in range(400)]
    rows = [
        (1, PROSE * 2, "en"), (2, PROSE * 2, "en"), (3, PROSE * 2 + "tail", None), (4, None, "fr"), (5, "", None),
        (6, " \t\n ", "de"), (7, "one", "en"), (8, "ONE", "en"), (9, "éß 中文 \U0001F600 café\n\nx", "es"),
        (10, " ".join(unit[i * 7 % 400] for i in range(20000)), "en"), (11, "x" * 150_000, "en"), (12, OTHER, "en"),
        (12, OTHER, "en"), (13, OTHER + PROSE, "en"), (14, "a\x00b \x1c c d  e", None), (None, PROSE * 2, "en"), (None, None, None),
        (15, "### !!! ... 123", "en"), (16, OTHER.upper(), "en"), (-3, PROSE[:60], "en"), (2**40, OTHER[20:140], "fr"),
    ]
    return [(d, t, lang, None if d == 3 else "src", None if t is None else len(t), True, 1.5, "k", 7, "lab", 0, b"r") for d, t, lang in rows]


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, key string, "
          "rep long, label string, block int, row binary")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(d, int(d % 3 != 0) if d is not None else 1, int(d % 2) if d is not None else None, "x") for d in [*range(1, 17), None]]
    return spark.createDataFrame([*rows, (1, None, None, "x"), (2, 0, 1, "x"), (999, 1, 1, "x")], "doc_id long, quality int, toxic int, score string")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
