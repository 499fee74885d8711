"""JSON events and epoch times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starledger.schemas import EVENT_SCHEMA, WIRE_NAMES, wire_schema


def parse_event(payload: Column) -> Column:
    """JSON payload (string or bytes) to a struct of wire-named fields.

    Text that is not JSON, and fields of the wrong type, give null fields.
    """
    return F.from_json(payload.cast("string"), wire_schema(EVENT_SCHEMA))


def encode_event() -> Column:
    """The JSON text of an event row."""
    return F.to_json(
        F.struct(*[F.col(f.name).cast(f.dataType).alias(WIRE_NAMES.get(f.name, f.name)) for f in EVENT_SCHEMA])
    )


def epoch_to_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in the session time zone."""
    return F.from_unixtime(seconds)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a timestamp, without going through text."""
    return F.timestamp_seconds(seconds)


def time_parts(at: Column) -> dict[str, Column]:
    """Calendar parts of a timestamp; weekdays run from 1 (Sunday) to 7."""
    return {
        "rating_year": F.year(at),
        "rating_month": F.month(at),
        "rating_dayofweek": F.dayofweek(at),
        "rating_hour": F.hour(at),
    }
