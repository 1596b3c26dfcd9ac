import pytest


@pytest.fixture(autouse=True)
def _package_for_workers(spark):
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = root


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    long = "alpha beta gamma delta epsilon zeta " * 4000
    near = " ".join(f"w{i}" for i in range(300))
    rows = [
        (1, None, "en", "h", 0), (2, "", "en", "h", 0), (3, "Same Text", "en", None, 9),
        (4, "same text", None, "h", 9), (4, "same text", None, "h", 9), (None, "same text", "fr", "h", 9),
        (5, long, "en", "h", len(long)), (6, near, "en", "h", len(near)), (7, near + " x", "en", "h", 5),
        (8, "…!?", "de", "h", 3), (9, "mit license MIT License", "en", "h", 23),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 as kept", "2 as shard", "3 as slot", "4 as id", "5 as digest")
