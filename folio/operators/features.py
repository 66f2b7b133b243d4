"""Feature table and nested-field helpers (P11-P13, S3; job X5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from folio.constants import FEATURE_COLUMNS, LIST_COLUMNS
from folio.functions import join_list


def ensure_columns(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """S3: add absent columns as typed NULLs (default type: string)."""
    spec = dict(columns) if isinstance(columns, Mapping) else {c: "string" for c in columns}
    missing = {c: F.lit(None).cast(t) for c, t in spec.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def select_frozen(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Exactly ``columns``, in order; absent ones are NULL."""
    return ensure_columns(df, list(columns)).select(*columns)


def join_lists(df: DataFrame, cols: Sequence[str] = LIST_COLUMNS) -> DataFrame:
    """Array columns -> ', '-joined text; non-arrays become NULL."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        if df.schema[c].dataType.typeName() == "array":
            out[c] = join_list(c)
        else:
            out[c] = F.lit(None).cast(StringType())
    return df.withColumns(out) if out else df


def struct_field(df: DataFrame, column: str, field: str, dtype: str = "string") -> Column:
    """``column.field`` for a struct column, ``$.field`` of JSON text,
    NULL when the column is absent."""
    if column not in df.columns:
        return F.lit(None).cast(dtype)
    dt = df.schema[column].dataType
    if isinstance(dt, StructType):
        if field in dt.fieldNames():
            return F.col(column)[field].cast(dtype)
        return F.lit(None).cast(dtype)
    return F.get_json_object(F.col(column).cast("string"), f"$.{field}").try_cast(dtype)


def flatten_struct(df: DataFrame, column: str, fields: Sequence[str], dtype: str = "string") -> DataFrame:
    """P12 over several fields: adds one column per field."""
    return df.withColumns({f: struct_field(df, column, f, dtype) for f in fields})


def features(enriched: DataFrame) -> DataFrame:
    """Flatten lists and signals, then freeze the feature columns."""
    flat = flatten_struct(join_lists(enriched), "signals", ["intent", "depth"])
    return select_frozen(flat)
