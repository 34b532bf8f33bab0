"""Small frames and columns for the tests."""

from pyspark.sql import types as T


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, T.StringType(), True)]))


def column(df, name=None):
    name = name or df.columns[-1]
    return [r[name] for r in df.collect()]
