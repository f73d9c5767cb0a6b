import pytest

from tessera.llm.queries import PACKAGE_ROOT

LONG = " ".join(f"wort{i % 977} and{i % 13}." for i in range(60_000))
ROWS = [(1, "One two three four five six. Seven eight!\nNine ten.", "en", "a"), (2, "One two three four five six. Seven eight!\nNine ten.", "en", "a"),
        (2, "One two three four five six. Seven eight!\nNine ten.", "en", "a"), (3, None, "en", "b"), (4, "", None, None), (5, " \t\n", "de", None),
        (None, "Der und die das ist ein Satz mit vielen Wörtern hier.", "de", "b"), (None, None, None, "b"), (7, LONG, "en", "ä"),
        (8, "123 456 !!", "en", "a"), (9, "İstanbul Σ x\x1cy <|endoftext|> z", "de", "b")]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("size", "row", "key", "node", "shard", "bucket", "held_out", "score", "stats", "h", "sr", "digest", "item", "n_chars", "edited", "start", "length"):
        df = df.selectExpr("*", f"'clash' as {c}")
    return df


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, names that clash."""
    return _frame(spark, ROWS)


@pytest.fixture(scope="session")
def empty(spark):
    return _frame(spark, [])
