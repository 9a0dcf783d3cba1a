"""Small tables with the cases that every operator must bear."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns that share names with what operators add on their way.
CLASHING = ["row", "n", "digest", "key", "label", "node", "size", "kept", "score", "length", "rank", "hit", "id", "sha", "whole"]


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text); other columns are filled, null for null texts."""
    data = [(i, t, None if t is None else "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, DOCS).repartition(3)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
