"""Fixtures that the tests of the subpackage import by name."""

import pytest

LONG = " ".join(f"word{i % 977} token{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, None, "en"),
        (2, "", None),
        (3, " \n\t ", "en"),
        (4, LONG, "en"),
        (None, "no id here at all", "de"),
        (None, None, None),
        (5, "short", "en"),
        (6, "the same text is here twice for all", "en"),
        (6, "the same text is here twice for all", "en"),
        (7, "the same text is here twice for all", "en"),
        (8, "?!... 123 ###", "fr"),
        (9, "Ünïcödé 中文 😀 été <|endoftext|> it's", "fr"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = "__text __key __rank copy_key copy_rank whole_text row node segment section spans items kept component_id row_key key score label bag quality_score n_words"
    for name in clash.split():
        df = df.selectExpr("*", f"'x' as {name}")
    return df.selectExpr("*", "length(text) as n_chars", "'s' as source").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
