"""JSON records to typed rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.tables import REMOVED
from wayfare.schemas import ROUTE_FIELDS, ROUTE_PAYLOAD, TRIP_FIELDS, TRIP_PAYLOAD

BAD_RECORD = "bad_record"
UNKNOWN_FIELDS = "unknown_fields"
TOMBSTONES = ("skip", "keep", "refuse")
UNKNOWN = ("ignore", "refuse")


def _wire(payload: T.StructType, names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, payload.fields)])


TRIP_WIRE = _wire(TRIP_PAYLOAD, TRIP_FIELDS)
ROUTE_WIRE = _wire(ROUTE_PAYLOAD, ROUTE_FIELDS)


def _decode(
    df: DataFrame, value: str, payload: T.StructType, wire: T.StructType, mode: str, tombstones: str = "skip",
    unknown: str = "ignore",
) -> DataFrame:
    """Columns of ``df`` without ``value``, plus the typed fields. A number missing in a record becomes 0.

    A null value is a tombstone, which a compacted topic holds for a removed key. Log readers ``skip`` it, as
    it is no record; a table reader must ``keep`` it as a row without fields; ``refuse`` stops the query.
    ``FAILFAST`` stops at the first bad record. ``PERMISSIVE`` keeps it: the text goes
    to the column ``bad_record``, which is null on every good row. Fields that the type does not have are
    ignored, or ``refuse`` makes such a record a bad one; a column ``unknown_fields`` then names them.
    """
    if tombstones not in TOMBSTONES:
        raise ValueError(f"tombstones is one of {TOMBSTONES}, not {tombstones!r}")
    if unknown not in UNKNOWN:
        raise ValueError(f"unknown is one of {UNKNOWN}, not {unknown!r}")
    schema = wire
    if mode == "PERMISSIVE":
        schema = T.StructType(wire.fields + [T.StructField(BAD_RECORD, T.StringType())])
    options = {"mode": mode, "columnNameOfCorruptRecord": BAD_RECORD}
    records = df.filter(F.col(value).isNotNull()) if tombstones == "skip" else df
    if tombstones == "refuse":
        records = df.withColumn(value, F.coalesce(value, F.raise_error(F.lit("a record without a value"))))
    strange = unknown_fields(F.col(value), wire.names)
    if unknown == "refuse" and mode == "FAILFAST":
        names = F.concat(F.lit("unknown fields: "), F.array_join(strange, ", "))
        records = records.withColumn(value, F.when(F.size(strange) > 0, F.raise_error(names)).otherwise(F.col(value)))
    rows = records.withColumn("_row", F.from_json(value, schema, options))
    if unknown == "refuse" and mode == "PERMISSIVE":
        # the same form as a record that cannot be parsed: the text, and no fields
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in wire.fields]
        bad = F.struct(*none, F.col(value).alias(BAD_RECORD))
        found = F.when(F.size(strange) > 0, strange)
        rows = rows.withColumn(UNKNOWN_FIELDS, found).withColumn(
            "_row", F.when(F.col(UNKNOWN_FIELDS).isNotNull(), bad).otherwise(F.col("_row"))
        )

    def typed(field: T.StructField, name: str) -> Column:
        column = F.col("_row")[name]
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            found = F.col("_row").isNotNull()
            if mode == "PERMISSIVE":
                found &= F.col("_row")[BAD_RECORD].isNull()
            column = F.when(found, F.coalesce(column, F.lit(0).cast(field.dataType)))
        return column.alias(field.name)

    fields = [typed(f, w.name) for f, w in zip(payload.fields, wire.fields)]
    if mode == "PERMISSIVE":
        fields.append(F.col("_row")[BAD_RECORD].alias(BAD_RECORD))
        if unknown == "refuse":
            fields.append(F.col(UNKNOWN_FIELDS))
    return rows.select(*[c for c in df.columns if c != value], *fields)


def unknown_fields(value: Column, known: list[str]) -> Column:
    """Names in JSON records that are none of ``known``, in their order; null where a value is no JSON object."""
    return F.array_except(F.json_object_keys(value), F.array(*map(F.lit, known)))


def decode_trips(
    df: DataFrame, value: str = "value", mode: str = "FAILFAST", unknown: str = "ignore"
) -> DataFrame:
    return _decode(df, value, TRIP_PAYLOAD, TRIP_WIRE, mode, unknown=unknown)


def decode_routes(
    df: DataFrame, value: str = "value", mode: str = "FAILFAST", tombstones: str = "skip", unknown: str = "ignore"
) -> DataFrame:
    return _decode(df, value, ROUTE_PAYLOAD, ROUTE_WIRE, mode, tombstones, unknown)


def decode_route_changes(df: DataFrame, key: str = "key", value: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Route versions and removals: a null value removes the route that the record's key names.

    A removal has that route_id, no other field, and ``removed`` set. A key that is no number stops the query.
    """
    marked = df.withColumn(REMOVED, F.col(value).isNull()).withColumn("_key", F.col(key).cast("bigint"))
    decoded = _decode(marked, value, ROUTE_PAYLOAD, ROUTE_WIRE, mode, "keep")
    route_id = F.when(F.col(REMOVED), F.col("_key")).otherwise(F.col("route_id"))
    return decoded.withColumn("route_id", route_id).drop("_key", key)


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a ``PERMISSIVE`` decode."""
    good = decoded.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    return good, decoded.filter(F.col(BAD_RECORD).isNotNull())


def json_number(text: str, name: str) -> Column:
    """The integer field ``name`` of JSON records, 0 where a record lacks it.

    A record that is nothing but this field is read by a pattern, which takes a quarter
    of the time of the JSON parser; any other record goes to the parser. No record at all
    stops the query, as a bad one does.
    """
    prefix = f'{{"{name}":'
    alone = F.col(text).rlike(rf'^\{{"{name}": ?(0|[1-9][0-9]{{0,17}})\}}$')
    digits = F.substring(F.col(text), F.lit(len(prefix) + 1), F.length(text) - len(prefix) - 1)
    parsed = F.from_json(text, f"{name} BIGINT", {"mode": "FAILFAST"})[name]
    missing = F.when(F.col(text).isNull(), F.raise_error(F.lit(f"no record in {text}")).cast("bigint"))
    # the default comes last, so that Spark knows the result is never null and drops such filters
    return F.coalesce(F.when(alone, digits.cast("bigint")).otherwise(parsed), missing, F.lit(0).cast("bigint"))


def _encode(df: DataFrame, payload: T.StructType, names: list[str], keep: list[str]) -> DataFrame:
    fields = [F.col(f.name).alias(n) for f, n in zip(payload.fields, names)]
    return df.select(
        *keep,
        F.col("route_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def encode_trips(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(key, value) records, the key being the route id as text; ``keep`` passes columns through."""
    return _encode(df, TRIP_PAYLOAD, TRIP_FIELDS, keep or [])


def encode_routes(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _encode(df, ROUTE_PAYLOAD, ROUTE_FIELDS, keep or [])
