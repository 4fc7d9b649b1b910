from __future__ import annotations

import pytest

#: Columns that operators use inside must not clash with those of the input.
CLASHING = (
    "row size name bucket place rank start copies doc fp anchor part key n_words hits digest score label "
    "v base assign hex random hashes keys canon raw slots source_size target "
    "copy n hit kind tree block position witness root part at norm run word gram best size changed"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, long, "b"), (4, long, "b"), (5, "one", "b"),
        (None, "some text here without a number", None), (None, None, None), (7, "ünï cødé 😀 text", "é"),
        (8, "x" * 100_000, "a"), (9, "1" * 50_000 + " " + "a@" * 5_000, "a"), (10, "one", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long")})
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def judged(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (9, None, 3)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "Tom has 3 apples and gives 3 apples to Ann who then walks 5km to the big market in town."), (2, None),
            (3, "ab"), (4, "walk the red line now")]
    return spark.createDataFrame(rows, "item_id long, text string")
