import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows, extra=""):
    """Documents from (doc_id, text[, source]) tuples; ``extra`` appends columns of null."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, COLUMNS)
    for name in extra.split():
        df = df.selectExpr("*", f"cast(null as string) as {name}")
    return df


@pytest.fixture(scope="session")
def docs(spark):
    """make(rows, extra) on the session's Spark."""
    return lambda rows, extra="": make(spark, rows, extra)


LONG = " ".join(f"w{i}" for i in range(30_000))

#: Null and empty texts, null id, white space only, ties, repeated rows, a very long text.
EDGES = [(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, None), (4, ""), (None, "a b c"), (5, " \t\n "),
         (6, LONG), (7, "é漢\U0001f600 ▁x"), (None, None), (8, "a b d")]
