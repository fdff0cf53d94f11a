"""Small helpers for Arrow tasks: text as bytes, a result column beside the given ones."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(batch.schema.names.index(name)).cast(pa.binary()).to_pylist()]


def with_result(df: DataFrame, text_col: str, out: str, kind: T.StructType,
                per_text: Callable[..., list[dict]], also: str | None = None) -> DataFrame:
    """df with a struct column ``out`` = per_text(texts); a given column of that name is replaced.

    With ``also``, per_text(texts, the values of that column).

    One batch is in memory at a time (spark.sql.execution.arrow.maxRecordsPerBatch rows)."""
    base = df.drop(out)
    at = base.columns.index(text_col)
    beside = [] if also is None else [base.columns.index(also)]
    arrow_kind = to_arrow_type(kind)
    if base.schema[at].dataType != T.StringType():
        base = base.withColumn(text_col, F.col(text_col).cast("string"))

    def run(batches):
        for b in batches:
            got = per_text([x or b"" for x in b.column(at).cast(pa.binary()).to_pylist()],
                           *[b.column(i).to_pylist() for i in beside])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, arrow_kind)], names=[*b.schema.names, out])
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, kind)]))
