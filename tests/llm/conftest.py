import pytest

#: Rows with nulls in each column, empty and repeated texts, repeated rows, and ties.
ODD = [
    (1, "a b c " * 40, "en", "s1", 240),
    (1, "a b c " * 40, "en", "s1", 240),
    (2, "a b c " * 40, "en", "s1", 240),
    (None, "a b c " * 40, None, None, None),
    (3, None, "en", None, 0),
    (4, "", None, "s2", 0),
    (5, " \n\t ", "fr", "s2", 4),
    (6, "x" * 5000, "fr", "s2", 5000),
    (7, "Straße   naïve 42 <|im_end|> \x1c sep", "de", "s3", 30),
    (None, None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with further columns that are named like results and working columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    names = ["n_words", "rk", "spans", "kept", "need", "found", "exact", "items", "score", "fp", "s_upper", "label", "a", "u", "component_id", "n_hit", "start", "ids", "span_doc", "near", "n_bytes", "n_repeated", "doc_tokens", "sequence_id", "offset", "length", "gone", "held_out"]
    return df.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
