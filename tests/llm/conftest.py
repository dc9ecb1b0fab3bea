import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

PROSE = ("The river was wide and the old bridge had fallen in the spring so that nobody could cross it with a cart and "
         "people from the village took a boat which the miller kept for them on the far bank near his house.")

#: Null ids and texts, empty and blank texts, repeats, one very long text, one without blanks.
AWKWARD = [
    (1, PROSE, "en", "b"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "en", "a"),
    (5, " \n\t ", "en", None), (6, "x" * 30_000, "en", "é"), (7, (PROSE + " ") * 400, "en", "a"), (None, PROSE, "en", "a"),
    (None, None, None, None), (8, "one", "en", "Z"), (9, "# $ % | <a> 1.2.3 \u0000   🙂 Σ ﬁ", "xx", "b"),
]


@pytest.fixture
def awkward(spark):
    """Rows that are hard to handle, with further columns named as the operators name theirs."""
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, lang string, source string").withColumn(
        "n_chars", F.char_length("text").cast("bigint"))
    clashing = ("id", "row", "key", "size", "taken", "probes", "code", "point", "bucket", "part", "guest", "words",
                "features", "label", "score", "kinds", "kept", "target", "source_key", "order_key", "prefix", "start")
    return docs.withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()
