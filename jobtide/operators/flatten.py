"""Semi-structured records to typed rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.parsing import strict_id

ELEMENT = "value"


def explode_elements(df: DataFrame, column: str = "data") -> DataFrame:
    """One row per element of the variant in ``column``; NULL, empty and scalar values give none.

    The element is in ``value``; the other columns of ``df`` are kept.
    """
    exploded = df.sparkSession.tvf.variant_explode(F.col(column).outer()).select(ELEMENT)
    return df.lateralJoin(exploded).drop(column)


def variant_field(
    element: Column | str, name: str | None, kind: str, on_bad: str = "fail"
) -> Column:
    """A field of a variant object, without ``name`` the variant itself; missing or null is NULL.

    ``kind`` is ``"id"`` (BIGINT), ``"int"`` or ``"text"``. Numbers go through an exact decimal,
    so a fraction is rounded instead of cut. Text that is no number fails the job, or is NULL
    with ``on_bad="null"``.
    """
    get = F.variant_get if on_bad == "fail" else F.try_variant_get
    path = f"$.{name}" if name else "$"
    if kind == "text":
        return get(element, path, "string")
    number = get(element, path, "decimal(38,0)")
    target = {"id": "bigint", "int": "int"}[kind]
    return number.cast(target) if on_bad == "fail" else number.try_cast(target)


def _column_field(name: str, kind: str, data_type: T.DataType, on_bad: str) -> Column:
    if isinstance(data_type, T.VariantType):
        return variant_field(name, None, kind, on_bad)
    if kind == "text":
        return F.col(name).cast("string")
    number = strict_id(F.col(name).cast("string"), on_bad)
    if kind == "id":
        return number
    return number.cast("int") if on_bad == "fail" else number.try_cast("int")


def flatten_records(
    bronze: DataFrame, fields: Mapping[str, str], on_bad: str = "fail", column: str = "data"
) -> DataFrame:
    """Typed columns from either bronze layout of a JSON input.

    Whole documents (one variant ``column`` holding an array) are exploded first; a bronze table
    that already has one row per record, in text or variant columns, is only cast. ``fields``
    maps name to kind.
    """
    types = {f.name: f.dataType for f in bronze.schema.fields}
    if isinstance(types.get(column), T.VariantType):
        rows = explode_elements(bronze.select(column), column)
        picked = [variant_field(ELEMENT, n, k, on_bad).alias(n) for n, k in fields.items()]
    else:
        rows = bronze
        picked = [_column_field(n, k, types[n], on_bad).alias(n) for n, k in fields.items()]
    return rows.select(*picked)
