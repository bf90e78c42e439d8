"""Values of any type as text and as JSON (H1, H3, T12). The Column is built from the type, so nothing runs outside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as D

from . import text as T


def to_text(c: Column, kind: D.DataType) -> Column:
    """NULL ''; texts stripped; Booleans True or False; numbers as they print; lists their non-empty items joined by ' | ', at any
    depth; maps and structs as JSON (H1, T12)."""
    if isinstance(kind, D.StringType):
        return T.strip(c)
    if isinstance(kind, D.BooleanType):
        return F.when(c, "True").when(~c, "False").otherwise("")
    if isinstance(kind, D.ArrayType):
        items = F.filter(F.transform(c, lambda x: to_text(x, kind.elementType)), lambda x: x != "")
        return F.coalesce(F.array_join(items, " | "), F.lit(""))
    if isinstance(kind, (D.MapType, D.StructType, D.VariantType)):
        return F.coalesce(F.to_json(json_safe(c, kind)), F.lit(""))
    return T.filled(c)


def json_safe(c: Column, kind: D.DataType) -> Column:
    """c with what JSON cannot hold made text, at any depth (H3): map keys, times, dates, decimals, bytes (base64); a VARIANT is
    JSON already."""
    if isinstance(kind, D.ArrayType):
        return F.transform(c, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, D.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.struct(to_text(e["key"], kind.keyType).alias("key"), json_safe(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(pairs)
    if isinstance(kind, D.StructType):
        return F.when(c.isNotNull(), F.struct(*(json_safe(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, D.BinaryType):
        return F.base64(c)
    if isinstance(kind, (D.TimestampType, D.TimestampNTZType, D.DateType, D.DecimalType)):
        return c.cast("string")
    return c
