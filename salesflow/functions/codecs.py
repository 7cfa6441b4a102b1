"""Message codecs. Every codec works on ``key``/``value`` binary columns, whatever the transport."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.functions.cleaning import nan_to_null
from salesflow.schema import EVENT, FIELDS, MONEY, MONEY_BOUND, MONEY_FIELDS, avro_schema

CORRUPT = "_corrupt_record"
REASON = "reject_reason"
# What is kept of a refused message: the text that did not parse, why, and the fields that were decoded.
REJECTED = f"{CORRUPT} string, {REASON} string, event string"


def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> UTF-8 JSON messages; missing fields are written as explicit nulls."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    value = F.encode(body, "UTF-8").alias("value")
    return df.select(F.encode(F.col(key), "UTF-8").alias("key"), value) if key else df.select(value)


def encode_json_with_id(df: DataFrame) -> DataFrame:
    """Records without an id -> the messages of ``encode_json`` once ``content_key`` of all columns is their first field, ``id``.

    Each record becomes text once: the id is the digest of the text that it is put in front of.
    """
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    keyed = df.select(rest.alias("rest")).select("rest", F.sha2("rest", 256).cast("binary").alias("key"))
    behind = F.substring(F.col("rest").cast("binary"), F.lit(2), F.lit(2**31 - 1))
    value = F.concat(F.lit(bytearray(b'{"id":"')), "key", F.lit(bytearray(b'",')), behind)
    return keyed.select("key", value.alias("value"))


def decode_json(messages: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Messages -> flat record columns plus ``_corrupt_record``.

    Only the named fields are converted; the parser skips over the others.
    ``inline`` flattens the struct in one generator step. A plain
    ``data.*`` projection lets a later filter be pushed below it, which
    parses each message twice.
    """
    target = T.StructType([*[EVENT[f] for f in fields], T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), target, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return messages.select(F.inline(F.array(parsed)))


def as_events(decoded: DataFrame, needed: tuple[str, ...] = ()) -> DataFrame:
    """Decoded messages -> clean events: NaN is missing, amounts are decimals.

    Messages without an id, with an amount that does not fit, or without a
    ``needed`` field are left to ``rejected_events``.
    """
    clean = nan_to_null(decoded)
    faults = [F.col("id").isNull(), *_unfit(clean).values(), *[F.col(f).isNull() for f in needed]]
    return _with_amounts(clean.where(~reduce(Column.__or__, faults)).drop(CORRUPT))


def rejected_events(decoded: DataFrame, needed: tuple[str, ...] = ()) -> DataFrame:
    """The messages that ``as_events`` leaves out, with the reason."""
    clean = nan_to_null(decoded)
    malformed = F.col("id").isNull() & F.col(CORRUPT).isNotNull()
    unfit = [F.when(fault, f"{field} does not fit") for field, fault in _unfit(clean).items()]
    missing = [F.when(F.col(field).isNull(), f"{field} missing") for field in dict.fromkeys(("id", *needed))]
    reason = F.when(malformed, "malformed message").otherwise(F.nullif(F.concat_ws("; ", *missing, *unfit), F.lit("")))
    event = F.to_json(F.struct(*[F.col(f) for f in clean.columns if f != CORRUPT]))
    return clean.select(CORRUPT, reason.alias(REASON), event.alias("event")).where(F.col(REASON).isNotNull())


def _unfit(records: DataFrame) -> dict[str, Column]:
    """Per amount, whether it is there and too large for the stored type."""
    present = [f for f in MONEY_FIELDS if f in records.columns]
    return {f: F.coalesce(F.abs(F.col(f)) >= F.lit(MONEY_BOUND), F.lit(False)) for f in present}


def normalise(records: DataFrame) -> DataFrame:
    """NaN -> NULL, amounts -> decimals."""
    return _with_amounts(nan_to_null(records))


def _with_amounts(clean: DataFrame) -> DataFrame:
    amounts = {f: F.expr(f"try_cast({f} AS {MONEY.simpleString()})") for f in MONEY_FIELDS if f in clean.columns}
    return clean.withColumns(amounts)


def frame(payload: Column, schema_id: int) -> Column:
    """Registry framing: a zero byte, a four-byte big-endian schema id, the payload."""
    header = F.lit(bytearray(b"\x00" + schema_id.to_bytes(4, "big")))
    return F.concat(header, payload)


def frame_magic(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")


def frame_schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def unframe(value: Column) -> Column:
    """The payload behind the five header bytes; NULL where the header is short or does not start with a zero byte."""
    return F.when((F.length(value) >= 5) & (frame_magic(value) == 0), F.substring(value, F.lit(6), F.length(value)))


def encode_avro(df: DataFrame, schema_id: int, schema: str | None = None, key: str = "id") -> DataFrame:
    """Rows -> framed Avro messages keyed by ``id``; needs the spark-avro package on the class path."""
    from pyspark.sql.avro.functions import to_avro

    body = to_avro(F.struct(*[F.col(f"`{c}`") for c in df.columns]), schema or avro_schema())
    return df.select(F.encode(F.col(key), "UTF-8").alias("key"), frame(body, schema_id).alias("value"))


def decode_avro(messages: DataFrame, schema: str | None = None) -> DataFrame:
    """Framed Avro messages -> flat record columns, with the bytes of a message that does not decode.

    Needs the spark-avro package on the class path.
    """
    from pyspark.sql.avro.functions import from_avro

    parsed = from_avro(unframe(F.col("value")), schema or avro_schema(), {"mode": "PERMISSIVE"})
    decoded = messages.select("value", F.inline(F.array(parsed)))
    return decoded.withColumn(CORRUPT, F.when(F.col("id").isNull(), F.hex("value"))).drop("value")
