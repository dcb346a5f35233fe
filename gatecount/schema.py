"""Logical tables of the attendance model: types, and the rules that their columns keep.

A field's metadata hold its rules: ``key``; ``values`` it may take; ``low`` and ``high``; a ``pattern`` of what is not a
sentinel; ``upper`` for text in capitals; ``refers``, a table whose key it repeats; ``sentinels`` that stand for a missing
value. Spark does not enforce them: ``operators.cleaning`` shapes tables to them, and ``operators.verify`` compiles them to checks.
"""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

#: The domain's words, as they stand in the data.
NO_DATA, NOT_APPLICABLE, NOT_OBSERVED, NO_MATCH = "SIN_DATO", "NO_APLICA", "NO_OBSERVADO", "SIN_MATCH"
MEMBER_TICKET_TYPES = ("MEMBRESIA", "CONSUMO_MINIMO")
MEMBER_TICKET_SOURCES = ("APP", "WEB", "REFERRAL", "BOX_OFFICE")
CHANNELS = ("WEB", "BOX_OFFICE", "ADMIN", "RRPP")
TICKET_TYPES = ("GENERAL", "PREFERENCIAL", "VIP", "CORTESÍA")
WEEKDAYS = ("LUNES", "MARTES", "MIÉRCOLES", "JUEVES", "VIERNES", "SÁBADO", "DOMINGO")
PAST_MONTH, NEXT_MONTH = "JULIO", "AGOSTO"
YES, NO = "TRUE", "FALSE"

#: What a cleaned address, number and time look like.
EMAIL = r"^[^@+A-Z\s]+@[^@A-Z\s]+\.[^@A-Z\s]+$"
PHONE = r"^3[0-9]{9}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def _text(name: str, **rules: object) -> StructField:
    return StructField(name, StringType(), False, {"sentinels": [NO_DATA], **rules})


def _whole(name: str, **rules: object) -> StructField:
    return StructField(name, LongType(), False, {"low": 0, **rules})


def _share(name: str) -> StructField:
    return StructField(name, DoubleType(), False, {"low": 0, "high": 1})


def _flag(name: str, *more: str) -> StructField:
    return _text(name, values=[YES, NO, *more])


TABLES = {
    "member": StructType(
        [
            _text("member_id", key=True),
            _text("first_name", upper=True),
            _text("last_name", upper=True),
            _text("full_name", upper=True),
            _text("name_match_key", pattern="^[A-Z0-9]+$"),
            _text("name_tokens_key", pattern="^[A-Z0-9 ]+$"),
            _text("email", pattern=EMAIL),
            _flag("email_valid"),
            _text("phone", pattern=PHONE),
            _flag("phone_valid"),
            _text("city", upper=True),
            _text("created_at", pattern=TIME),
            _flag("has_membership", NO_DATA),
            _text("membership_since", pattern=TIME, sentinels=[NO_DATA, NOT_APPLICABLE]),
            _whole("points"),
            _whole("identity_fields", low=2, high=4),
        ]
    ),
    "history": StructType(
        [
            _text("member_ticket_id", key=True),
            _text("member_id", refers="member"),
            _text("type", values=list(MEMBER_TICKET_TYPES)),
            _text("source", values=list(MEMBER_TICKET_SOURCES)),
            _text("created_at", pattern=TIME),
            _flag("used"),
            _text("date_used", pattern=TIME, sentinels=[NOT_APPLICABLE]),
            _flag("future_use"),
            _flag("eligible"),
        ]
    ),
    "social": StructType([_text("member_id", key=True, refers="member"), _whole("friends_count")]),
    "artist": StructType(
        [
            _text("artist_id", key=True),
            _text("name", upper=True),
            _text("home_city", upper=True),
            _flag("has_residency", NO_DATA),
            _text("residency_venue", upper=True, sentinels=[NO_DATA, NOT_APPLICABLE]),
            _text("residency_weekday", upper=True, sentinels=[NO_DATA, NOT_APPLICABLE]),
            _whole("tickets_sold"),
            _share("attendance_rate"),
        ]
    ),
    "event": StructType(
        [
            _text("event_id", key=True),
            _text("title", upper=True),
            _text("artist_id", refers="artist"),
            _text("city", upper=True),
            _text("venue", upper=True),
            _text("weekday", values=[*WEEKDAYS, NO_DATA]),
            _text("month", values=[PAST_MONTH, NEXT_MONTH, NO_DATA]),
            _flag("is_residency", NO_DATA),
            _text("residency_venue", upper=True, sentinels=[NO_DATA, NOT_APPLICABLE]),
            _text("starts_at", pattern=TIME),
            _whole("capacity"),
            _text("checked_in_count", pattern="^[0-9]+$", sentinels=[NOT_OBSERVED]),
        ]
    ),
    "sale": StructType(
        [
            _text("sale_id", key=True),
            _text("event_id", refers="event"),
            _text("buyer_name", upper=True),
            _text("name_match_key", pattern="^[A-Z0-9]+$"),
            _text("name_tokens_key", pattern="^[A-Z0-9 ]+$"),
            _text("email", pattern=EMAIL),
            _flag("email_valid"),
            _text("phone", pattern=PHONE),
            _flag("phone_valid"),
            _whole("qty", low=1),
            _whole("subtotal"),
            _text("channel", values=list(CHANNELS)),
            _text("purchased_at", pattern=TIME, sentinels=[]),
            _whole("identity_fields", low=1, high=3),
        ]
    ),
    "ticket": StructType(
        [
            _text("ticket_id", key=True),
            _text("sale_id", refers="sale"),
            _text("event_id", refers="event"),
            _text("ticket_type", values=list(TICKET_TYPES)),
            _whole("price"),
            _flag("checked_in", NOT_OBSERVED),
            _text("checked_in_at", pattern=TIME, sentinels=[NO_DATA, NOT_APPLICABLE, NOT_OBSERVED]),
        ]
    ),
}


def key_of(table: str) -> str:
    return next(f.name for f in TABLES[table] if f.metadata.get("key"))


def references() -> list[tuple[str, str, str]]:
    """(table, column, parent) of all columns that repeat another table's key."""
    return [(t, f.name, f.metadata["refers"]) for t, schema in TABLES.items() for f in schema if "refers" in f.metadata]


def is_number(field: StructField) -> bool:
    return isinstance(field.dataType, (LongType, IntegerType, DoubleType, BooleanType))
