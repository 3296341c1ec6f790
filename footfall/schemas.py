"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_long, _int, _str, _dbl = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

MAIN_USER = _schema(guid=_str, userid=_long)
PAIR_COUNTS = _schema(guid=_str, userid=_long, cnt=_long)
VISITS = _schema(deviceid=_str, userid=_long, shopid=_long, cnt=_int)
DEVICE_RECS = _schema(deviceid=_str, cityid=_int, shopid=_long, rank=_dbl)
USER_TAGS = _schema(userid=_long, cityid=_int, tagtype=_str, tag=_str, score=_dbl)
DICTIONARY = _schema(entry=_str)
MENTIONS = _schema(shopid=_long, dish=_str, c=_long)
REGION_SCORES = _schema(cityid=_int, regionid=_int, shopid=_long, score=_dbl)
KEYWORD_SCORES = _schema(cityid=_int, keyword=_str, score=_dbl)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema by name. A double stored as int loses its fraction."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
