"""Reading fields of the polymorphic ``properties`` payload.

``properties`` arrives as JSON text, a struct (when JSON inference saw an
object) or a map<string,string>.  Fields are returned as strings with the
same text JSON-path extraction would give: booleans as ``true``/``false``,
numbers as written, nested values as JSON text, missing or malformed as NULL.

JSON text is parsed once per row with ``json_tuple`` (a generator that yields
every requested top-level field as the same text JSON-path extraction gives);
``from_json`` into a struct would be split by the optimizer into one parse per
field read.  Maps and simple struct fields are read directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIRECT_STRUCT_TYPES = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class PropertyReader:
    """Builds per-field Column expressions for one input DataFrame's ``properties``."""

    def __init__(self, df: DataFrame, fields: list[str], column: str = "properties",
                 parsed_alias: str = "_props"):
        self.column = column
        self.fields = list(dict.fromkeys(fields))
        self.parsed_alias = parsed_alias
        self.dtype = df.schema[column].dataType if column in df.columns else None

    @property
    def needs_parse(self) -> bool:
        return isinstance(self.dtype, T.StringType)

    def parsed_name(self, field: str) -> str:
        return f"{self.parsed_alias}_{field}"

    def with_parsed(self, df: DataFrame) -> DataFrame:
        """``df`` plus one string column per field, from a single parse of the JSON text."""
        if not self.needs_parse:
            return df
        return df.select("*", F.json_tuple(F.col(self.column), *self.fields)
                         .alias(*[self.parsed_name(f) for f in self.fields]))

    def json_text(self) -> Column:
        """The payload as JSON text (struct/map -> to_json, text passes through)."""
        if self.dtype is None:
            return F.lit(None).cast("string")
        if isinstance(self.dtype, T.StringType):
            return F.col(self.column)
        return F.to_json(F.col(self.column))

    def get(self, name: str) -> Column:
        """One field as string."""
        dt = self.dtype
        if dt is None:
            return F.lit(None).cast("string")
        if isinstance(dt, T.StringType):
            if name in self.fields:
                return F.col(self.parsed_name(name))
            return F.get_json_object(F.col(self.column), f"$.{name}")
        if isinstance(dt, T.MapType) and isinstance(dt.keyType, T.StringType):
            value = F.col(self.column).getItem(name)
            if isinstance(dt.valueType, _DIRECT_STRUCT_TYPES):
                return value.cast("string")
            return F.get_json_object(F.to_json(F.col(self.column)), f"$.{name}")
        if isinstance(dt, T.StructType):
            if name not in dt.fieldNames():
                return F.lit(None).cast("string")
            ftype = dt[name].dataType
            if isinstance(ftype, _DIRECT_STRUCT_TYPES):
                return F.col(self.column).getField(name).cast("string")
            return F.get_json_object(F.to_json(F.col(self.column)), f"$.{name}")
        return F.get_json_object(self.json_text(), f"$.{name}")

    def first(self, *names: str) -> Column:
        cols = [self.get(n) for n in names]
        return cols[0] if len(cols) == 1 else F.coalesce(*cols)
