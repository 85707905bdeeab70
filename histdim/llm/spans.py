"""Spans of kinds found in texts: their Arrow type and their digest columns."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (kind, start, end): code points, end exclusive; base: found by the base expressions.
SPARK_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def span_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), T.StructField("spans", SPARK_SPANS)])


def digest_spans(found: DataFrame, id_col: str, base_kinds: Sequence[str]) -> DataFrame:
    """The number of base spans of each kind, the digest of the base spans, and
    all spans as text: kind:start:end, comma-joined in the order of the array."""
    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))

    return found.select(
        id_col, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base_kinds],
        F.sha2(text(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"))
