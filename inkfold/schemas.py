"""Table layouts shared by sources and operators."""

from pyspark.sql import types as T

from inkfold.functions.fixed_values import FIELDS

RECORD = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])

KEYED_RECORD = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + RECORD.fields
    + [T.StructField("error", T.StringType())]
)

PIXEL = T.StructType([
    T.StructField("img_id", T.LongType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("v", T.IntegerType()),
])

IMAGE = T.StructType([
    T.StructField("img_id", T.LongType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

MESSAGE = "array<struct<role:string,content:string>>"
SPAN = "struct<start:int,end:int,label:string>"
