"""Documents that operators must not stumble over."""

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, clashing extra columns."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30000))
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, "one two"), (6, "One TWO"), (7, "alpha beta gamma delta epsilon zeta eta theta"),
        (7, "alpha beta gamma delta epsilon zeta eta theta"), (8, "Ünïcode ñandú größe — 漢字 　 end"), (9, long), (10, long + " tail"),
        (None, "a row without an id"), (11, "x"),
    ]
    df = spark.createDataFrame([(i, t, None if i == 3 else "en", "s", None if t is None else len(t)) for i, t in rows], DOC)
    from pyspark.sql import functions as F

    return df.withColumn("score", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("shard", F.lit(None).cast("int")).withColumn("n", F.lit("x"))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
