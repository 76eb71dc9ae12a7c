import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd_docs():
    """Nulls in every column, empty and blank texts, a very long one, copies, repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 9000)
    return [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 3), (4, "one two", "en", "a", 7),
            (5, "one two", "en", "b", 7), (5, "one two", "en", "b", 7), (6, long, "de", "b", len(long)), (7, long + " x", "de", "c", 0),
            (None, "three four five six seven", "fr", "a", 1), (9, "ONE two", None, "a", 7), (10, "naïve Ünïcode \U0001F600 text", "fr", "c", 4)]


def clashing(df):
    """Extra columns named like working and result columns."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in ("kept", "size", "score", "id", "keep_id", "evidence", "n_entities", "lang_pred", "c0_", "sha_")})
