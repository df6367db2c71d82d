"""Schemas that grow: merging two schemas field by field, at any depth."""

from __future__ import annotations

from pyspark.sql import types as T

# Types that a value can take on without loss, and that Parquet files of the narrower type can be read as.
_WIDER: dict[type, tuple[type, ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


class SchemaConflict(ValueError):
    """Two types of one field that no common type holds; ``path`` names the field."""

    def __init__(self, path: str, known: T.DataType, given: T.DataType):
        super().__init__(f"{path}: {given.simpleString()} does not fit {known.simpleString()}")
        self.path = path


def merge_types(known: T.DataType, given: T.DataType, path: str = "") -> T.DataType:
    """A type that holds the values of both.

    Structs take the fields of both, the known ones first, matched without regard to case as Spark
    does; arrays and map values are merged inside; of two numbers the wider type counts. Everything
    becomes nullable, since the rows of one side lack what only the other has.
    """
    if isinstance(known, T.StructType) and isinstance(given, T.StructType):
        return merge_schemas(known, given, f"{path}." if path else "")
    if isinstance(known, T.ArrayType) and isinstance(given, T.ArrayType):
        return T.ArrayType(merge_types(known.elementType, given.elementType, f"{path}[]"), True)
    if isinstance(known, T.MapType) and isinstance(given, T.MapType):
        if known.keyType != given.keyType:
            raise SchemaConflict(f"{path}{{key}}", known.keyType, given.keyType)
        return T.MapType(known.keyType, merge_types(known.valueType, given.valueType, f"{path}{{}}"), True)
    if known == given or isinstance(given, T.NullType):
        return known
    if isinstance(known, T.NullType) or isinstance(given, _WIDER.get(type(known), ())):
        return given
    if isinstance(known, _WIDER.get(type(given), ())):
        return known
    raise SchemaConflict(path, known, given)


def merge_schemas(known: T.StructType, given: T.StructType, prefix: str = "") -> T.StructType:
    """The fields of both schemas; raises :class:`SchemaConflict` with the path of the first field that does not fit."""
    incoming = {f.name.lower(): f for f in given.fields}
    merged = []
    for field in known.fields:
        other = incoming.pop(field.name.lower(), None)
        kind = field.dataType if other is None else merge_types(field.dataType, other.dataType, f"{prefix}{field.name}")
        merged.append(T.StructField(field.name, kind, True))
    merged += [T.StructField(f.name, f.dataType, True) for f in given.fields if f.name.lower() in incoming]
    return T.StructType(merged)


def same_types(a: T.DataType, b: T.DataType) -> bool:
    """Equality that leaves nullability aside."""
    return a.simpleString() == b.simpleString()


def type_ddl(kind: T.DataType) -> str:
    """SQL text of a type, with every name quoted."""
    if isinstance(kind, T.StructType):
        return f"STRUCT<{', '.join(f'{_quoted(f.name)}: {type_ddl(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{type_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"MAP<{type_ddl(kind.keyType)}, {type_ddl(kind.valueType)}>"
    return kind.simpleString()


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {type_ddl(f.dataType)}" for f in schema.fields)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
