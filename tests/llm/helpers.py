"""Small tables shared by the tests of the llm operators."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


def docs(spark, texts, lang="en", source="s"):
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def put(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
