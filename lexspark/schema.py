"""Schemas of the engine's tables."""

from pyspark.sql import types as T

RAW_DOCUMENT = T.StructType(
    [
        T.StructField("ord", T.LongType(), False),
        T.StructField("filename", T.StringType()),
        T.StructField("filedata", T.StringType()),
    ]
)

LAW_FIELDS = ["filename", "number", "date", "year", "title", "urn", "original_content"]
LAW_DOCUMENT = T.StructType([T.StructField("ord", T.LongType(), False)] + [T.StructField(c, T.StringType()) for c in LAW_FIELDS])

URL_LINE = T.StructType([T.StructField("ord", T.LongType(), False), T.StructField("url", T.StringType())])

FETCH_RESULT = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("batch", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("law_number", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("fetch_time", T.DoubleType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def require_columns(df, schema: T.StructType, name: str = "input"):
    """Raise ValueError unless df has every column of schema with its type; returns df."""
    have = {f.name: f.dataType for f in df.schema}
    for f in schema:
        if f.name not in have:
            raise ValueError(f"{name} lacks column {f.name}")
        if have[f.name] != f.dataType:
            raise ValueError(f"{name}.{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return df
