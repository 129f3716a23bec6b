"""What the tests of this folder share."""

from starloom.llm.queries import ship

SMALL = "/root/testdata/sf0.001"


def make_docs(spark, rows):
    """Documents with extra columns from (doc_id, text) pairs or (doc_id, text, source) triples."""
    ship(spark)
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, "x") for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, ids string")


def bag(df):
    """The rows of ``df`` in one order, nulls included."""
    return sorted((tuple(r) for r in df.collect()), key=str)
