"""Property (JSON object) expressions.

Objects travel as JSON text.  Typed access goes through ``parse_json`` and
``variant_get`` (binary VARIANT, parsed once per row); malformed text becomes a
null with ``try_parse_json`` so bad rows can be split off instead of failing
a whole task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def props_variant(c: Column | str) -> Column:
    """JSON text -> VARIANT; null on malformed input."""
    return F.try_parse_json(_col(c))


def json_field(c: Column | str, field: str, type_name: str) -> Column:
    """Typed top-level field of a JSON object (null when absent or not castable)."""
    return F.try_variant_get(props_variant(c), f"$.{field}", type_name)


def json_int(c: Column | str, field: str) -> Column:
    return json_field(c, field, "int")


def malformed(c: Column | str) -> Column:
    """True for non-null text that is not valid JSON (reject frame filter)."""
    v = _col(c)
    return v.isNotNull() & F.try_parse_json(v).isNull()
