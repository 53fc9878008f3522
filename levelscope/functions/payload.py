"""Reading fields out of ``event_params`` / ``user_properties``.

A payload is a JSON string, a variant, a map or a struct. JSON text is decoded once per row whatever the
number of fields; the others are read in place, without a detour through JSON. A variant is JSON that
was parsed when it was written (:func:`parsed_payloads`), so that readers do not parse it again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING_MAP = "map<string,string>"


def check_payload_type(df: DataFrame, column: str) -> T.DataType:
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.StringType, T.VariantType, T.MapType, T.StructType)):
        raise ValueError(
            f"{column} must be a JSON string, a variant, a map or a struct, not {kind.simpleString()}; "
            "turn key/value arrays into a map first"
        )
    return kind


def payload_field(df: DataFrame, column: str, key: str) -> Column:
    """One field as text. Malformed JSON and absent keys give NULL. In JSON text keys are literal, and
    the last of a repeated key counts, as in :func:`with_payload_fields`."""
    kind = check_payload_type(df, column)
    if isinstance(kind, T.MapType):
        return F.try_element_at(F.col(column), F.lit(key)).cast("string")
    if isinstance(kind, T.StructType):
        if key not in kind.fieldNames():
            return F.lit(None).cast("string")
        return F.col(column).getField(key).cast("string")
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(F.col(column), _variant_path(key), "string")
    wanted = T.StructType([T.StructField(key, T.StringType())])
    return F.from_json(F.col(column), wanted).getField(key)


def _variant_path(key: str) -> str:
    quote = "'" if '"' in key else '"'
    return f"$[{quote}{key}{quote}]"


def with_payload_fields(
    df: DataFrame,
    column: str,
    fields: Mapping[str, str],
    readers: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add text columns ``{output name: payload key}``.

    For JSON text this is a single ``json_tuple``. Being a generator it also keeps later filters on
    the fields from being rewritten into further parses of the same text. ``readers`` names, per
    key, the events whose field is ever read: the others are not even extracted, and text no field
    of which is read is not parsed. Maps and structs cost nothing to read and ignore it.
    """
    if not isinstance(check_payload_type(df, column), T.StringType):
        return df.withColumns({out: payload_field(df, column, key) for out, key in fields.items()})
    if readers is None:
        return df.select("*", F.json_tuple(column, *fields.values()).alias(*fields.keys()))

    def one_of(events) -> str:
        return "event_name IN (" + ", ".join(f"'{name}'" for name in sorted(events)) + ")"

    text = f"if({one_of(set().union(*readers.values()))}, {column}, NULL)"
    keys = [f"if({one_of(readers[key])}, '{key}', NULL)" for key in fields.values()]
    decoded = F.expr(f"json_tuple({text}, {', '.join(keys)})").alias(*fields.keys())
    return df.select("*", decoded)


def payload_map(df: DataFrame, column: str) -> Column:
    """The whole payload as ``map<string,string>``."""
    kind = check_payload_type(df, column)
    if isinstance(kind, T.MapType):
        return F.col(column).cast(STRING_MAP)
    if isinstance(kind, T.StructType):
        pairs = [
            part
            for name in kind.fieldNames()
            for part in (F.lit(name), F.col(column).getField(name).cast("string"))
        ]
        return F.when(F.col(column).isNotNull(), F.create_map(*pairs))
    if isinstance(kind, T.VariantType):
        return F.try_variant_get(F.col(column), "$", STRING_MAP)
    return F.from_json(F.col(column), STRING_MAP)


def payload_text(df: DataFrame) -> DataFrame:
    """Both payload columns as JSON text, for sinks and tools that need strings."""
    from levelscope.config import PAYLOAD_COLUMNS

    changed = {
        name: F.to_json(name)
        for name in PAYLOAD_COLUMNS
        if not isinstance(check_payload_type(df, name), T.StringType)
    }
    return df.withColumns(changed) if changed else df


def parsed_payloads(df: DataFrame) -> DataFrame:
    """Payload columns of JSON text as variants. Text that is no JSON, or repeats a key in an object, becomes NULL."""
    from levelscope.config import PAYLOAD_COLUMNS

    changed = {
        name: F.try_parse_json(name)
        for name in PAYLOAD_COLUMNS
        if isinstance(check_payload_type(df, name), T.StringType)
    }
    return df.withColumns(changed) if changed else df


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def whole(column: str, kind: str = "int", rounded: bool = False) -> str:
    """SQL text: whole number; fractions are rounded or cut off, anything unreadable is NULL.

    A string cast to a whole number cuts fractions off itself, so it is asked last if at all.
    """
    number = f"try_cast({column} AS double)"
    if rounded:
        near = f"try_cast(round({number}) AS {kind})"
        return f"if({column} RLIKE '^[ ]*[+-]?[0-9]+[ ]*$', try_cast({column} AS {kind}), {near})"
    return f"coalesce(try_cast({column} AS {kind}), try_cast({number} AS {kind}))"


def to_utc_timestamp(column: Column, kind: T.DataType) -> Column:
    """Timestamps pass through; text is read as UTC (session time zone), unreadable text is NULL."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return column
    return column.try_cast("timestamp")
