"""Column functions for decoding, JSON and time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.constants import DISPLAY_FORMAT, ISO_PARSE_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bytes_to_string(col: Column | str, repair: bool = False) -> Column:
    """Record key/value bytes as UTF-8 text.

    P6: with ``repair`` invalid byte sequences are replaced instead of being
    passed through (decode-and-ignore for byte payloads).
    """
    text = _c(col).cast("string")
    return F.make_valid_utf8(text) if repair else text


def parse_json(col: Column | str, schema: T.StructType) -> Column:
    """Permissive parse; malformed text gives an all-null struct."""
    return F.from_json(_c(col), schema, {"mode": "PERMISSIVE"})


def field_violations(value: Column | str, schema: T.StructType) -> Column:
    """The fields that a permissive parse has nulled, as an array of (field, expected, found, value).

    A field is one if the message has a value for it and the parsed struct
    has none.  The message is parsed once more as VARIANT, which keeps its
    own types: ``found`` is string, number, boolean, object or array, and
    ``value`` the field's original text.  Text that is no JSON object has no
    fields (it is quarantined as a whole).
    """
    text = _c(value)
    parsed, raw = parse_json(text, schema), F.try_parse_json(text)
    entries = []
    for f in schema.fields:
        own = F.try_variant_get(raw, f"$['{f.name}']", "variant")
        kind = F.schema_of_variant(own)
        found = (F.when(kind.startswith("STRING"), F.lit("string")).when(kind.startswith("BOOLEAN"), F.lit("boolean"))
                 .when(kind.startswith("OBJECT"), F.lit("object")).when(kind.startswith("ARRAY"), F.lit("array"))
                 .otherwise(F.lit("number")))
        original = F.when(found == "string", F.try_variant_get(raw, f"$['{f.name}']", "string")).otherwise(F.to_json(own))
        nulled = parsed.getField(f.name).isNull() & own.isNotNull() & (kind != "VOID")
        entries.append(F.when(nulled, F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("expected"),
                                               found.alias("found"), original.alias("value"))))
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def conditional_parse(col: Column | str, schema: T.StructType) -> Column:
    """Null or empty text gives a null struct, anything else is parsed."""
    c = _c(col)
    return F.when(c.isNotNull() & (c != ""), F.from_json(c, schema))


def is_all_null(struct_col: Column | str, schema: T.StructType) -> Column:
    """True when every field of a parsed struct is null (probe or junk record)."""
    s = _c(struct_col)
    checks = [s.getField(f.name).isNull() for f in schema.fields]
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return out


# Epoch seconds of the years 1 to 9999; anything outside is no event time.
EPOCH_MIN, EPOCH_MAX = -62135596800, 253402300799


def epoch_to_timestamp(col: Column | str) -> Column:
    """Epoch seconds to timestamp, whole seconds (fraction dropped).

    A value outside the years 1 to 9999 (or not a number) gives null.
    """
    c = _c(col).cast("double")
    inside = c.between(F.lit(float(EPOCH_MIN)), F.lit(float(EPOCH_MAX)))
    return F.timestamp_seconds(F.when(inside, c).cast("long"))


def epoch_to_timestamp_exact(col: Column | str) -> Column:
    """P3 variant keeping sub-second precision."""
    return F.timestamp_seconds(_c(col))


def iso_to_display(col: Column | str) -> Column:
    """Strict ``yyyy-MM-ddTHH:mm:ssZ`` to ``yyyy-MM-dd HH:mm:ss``; bad -> null."""
    parsed = F.try_to_timestamp(_c(col), F.lit(ISO_PARSE_PATTERN))
    return F.date_format(parsed, DISPLAY_FORMAT)


def lenient_timestamp(col: Column | str) -> Column:
    """Parse what can be parsed, null for the rest (never throws)."""
    return F.try_to_timestamp(_c(col))


def wall_clock_epoch() -> Column:
    """Ingestion time as epoch seconds with microseconds."""
    return F.unix_micros(F.current_timestamp()) / F.lit(1_000_000.0)
