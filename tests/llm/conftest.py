import pytest

LONG = ("word " * 30 + "stop.\n") * 200

# Null ids, null, empty, blank and long texts, repeated rows, one id with two texts.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", None),
    (4, " \n\t ", None, "b"),
    (5, LONG, "en", "b"),
    (6, "El zorro marrón salta sobre el perro perezoso cerca del viejo río.", "es", "b"),
    (6, "El zorro marrón salta sobre el perro perezoso cerca del viejo río.", "es", "b"),
    (7, "one text", "en", "c"),
    (7, "another text of the same id", "en", "c"),
    (None, "a row without an id, and some more words in it", "en", "c"),
    (None, None, None, None),
    (8, "12345 67890 !!!", None, "c"),
]
# Extra columns named as operators name their own.
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"
CLASHING = ["size", "row", "doc", "band", "rep", "key", "kept", "n", "score", "failed", "spans", "n_lines", "token_ids", "label", "h", "rank", "_removed", "_doc", "_row", "_part", "_shift"]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
