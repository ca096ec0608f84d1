"""Reading the answers of the delivery services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts by which an answer is recognised.
UNSUBSCRIBED_TEXT = "This e-mail address is unsubscribed and cannot be delivered to"
INVALID_TEXT = "Must be a valid e-mail address"
ALREADY_DELIVERED_TEXT = "The requested deferred result has already been delivered"
RATE_LIMIT_TEXT = "Rate limit exceeded"
EXISTING_GROUP_PATTERN = r"already exists with id: (\d+)"

# Shape of the XML answers about recipient groups; ``_id`` is an attribute.
GROUP_XML_SCHEMA = (
    "cons_group struct<_id: string, id: string>,"
    " errors struct<error: struct<message: string>>"
)


def says(body: Column, text: str) -> Column:
    return F.coalesce(body.contains(text), F.lit(False))


# JSON values that say nothing, as Spark writes them.
_EMPTY_JSON = ("", "{}", "[]", "0", "0.0", "-0", "-0.0", "false", "null")


def json_document(body: Column) -> Column:
    """The text if it is exactly one JSON value, else null.

    Reading a field accepts text after a value, and several values in a row;
    counting what an array of the text holds does not.
    """
    return F.when(F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1, body)


def json_field(body: Column, name: str) -> Column:
    """Field of a JSON object; null if the text is no JSON or lacks the field."""
    return F.get_json_object(json_document(body), f"$.{name}")


def says_something(body: Column) -> Column:
    """Whether the text is a JSON value that isn't empty."""
    value = F.get_json_object(json_document(body), "$")
    return F.coalesce(~value.isin(*_EMPTY_JSON), F.lit(False))


def group_xml(body: Column) -> Column:
    """Parsed XML answer; all fields null if the text is no XML."""
    return F.from_xml(body, GROUP_XML_SCHEMA, {"rowTag": "api"})


def existing_group_id(body: Column) -> Column:
    found = F.regexp_extract(body, EXISTING_GROUP_PATTERN, 1)
    return F.nullif(found, F.lit(""))
