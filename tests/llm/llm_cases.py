"""Rows and helpers shared by the tests of the training-data operators."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

#: Columns that the operators use inside, to clash with them.
CLASHING = ["size", "target", "fp", "row", "block", "words", "score", "component_id", "copies"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     *[T.StructField(c, T.StringType()) for c in CLASHING]])


def docs_frame(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *CLASHING) for i, t, s in rows], DOCS)


PROSE = "the quick brown fox jumps over the lazy dog near the old river bank while seven small birds watch quietly. "


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    return [(1, PROSE * 3, "a"), (2, PROSE * 3, "a"), (2, PROSE * 3, "a"), (3, None, "b"), (4, "", None),
            (None, "orphan text of no one " + PROSE, "b"), (None, None, None), (5, long, "c"), (6, " \n\t ", "c"),
            (7, "Ünïcode — ﬂoats ÀÉ 漢字 password: hunter22 " + PROSE, "a"), (8, PROSE[:60], "b"),
            (9, "x", "b"), (9, "x", "b"), (9, "y other text with the same id", "b")]


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(w in plan for w in ("Python", "Pandas", "Arrow"))
