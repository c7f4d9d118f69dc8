"""Small tables with everything that is odd."""

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))


def clashing(df, *names):
    """``df`` with further columns that are called like those the operators add."""
    return df.withColumns({n: F.lit("taken") for n in names if n not in df.columns})


def odd_docs(spark):
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "a", 4),
        (4, "...!!! 123", "en", None, 10),
        (5, "one two", "en", "a", 7),
        (6, "One  TWO", "fr", "a", 8),
        (7, LONG, "en", "a", len(LONG)),
        (7, LONG, "en", "a", len(LONG)),
        (8, "Ünïcödé wörds ärë hérè ça va", "fr", "b", 28),
        (None, "no id at all here", None, None, None),
        (9, "no id at all here", "en", "b", 17),
    ]
    return spark.createDataFrame(rows, DOCS)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def none_of(df):
    return df.where("false")
