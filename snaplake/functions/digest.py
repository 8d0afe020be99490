"""A digest of a table's rows that doesn't depend on their order."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Room for the sum of any number of 64-bit hashes.
_WIDE = "decimal(28,0)"


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _value(field: T.StructField) -> Column:
    """Maps have no order of their own: the entries are sorted."""
    column = F.col("`" + field.name.replace("`", "``") + "`")
    if _hashable(field.dataType):
        return column
    if isinstance(field.dataType, T.MapType) and _hashable(field.dataType.keyType) and _hashable(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(F.struct(column))


def row_hash(schema: T.StructType) -> Column:
    """A 64-bit hash of a row: of its values by place, and of which of them are null, which the hash itself skips."""
    values = [_value(f) for f in schema]
    masks = []
    for k in range(0, len(values), 62):
        bits = [F.when(v.isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, v in enumerate(values[k : k + 62])]
        masks.append(functools.reduce(Column.bitwiseOR, bits))
    return F.xxhash64(*values, *masks)


def rows_digest(schema: T.StructType) -> Column:
    """The sum of the rows' hashes, 0 of no rows: an aggregate that is the same for the same rows in any order and cut,
    and differs where a row is missing, doubled or changed."""
    return F.coalesce(F.sum(row_hash(schema).cast(_WIDE)), F.lit(0).cast("decimal(38,0)"))
