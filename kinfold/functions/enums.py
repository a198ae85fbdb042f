"""Enum symbol codec as built-in column expressions.

Avro enum symbols may only hold ``[A-Za-z0-9_]`` and may not start with a
digit; any other character (and a leading digit) is written as
``_<code point in lower-case hex, at least two digits>_``.  Both
directions are plain Spark SQL expressions, so they stay inside whole-stage
code generation; no Python UDF is involved.

Fixed values (must match the container format): the kept character classes
``[A-Za-z_]`` first and ``[A-Za-z0-9_]`` after, the escape ``_`` + hex + ``_``,
hex of 2 to 6 digits.  A ``_`` that an escape could be read from (hex digits and
then ``_`` or an escaped character follow) is itself written ``_5f_``, so that
``decode_enum(encode_enum(x)) = x`` for every text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the symbol convention
KEEP_CLASS = "^[A-Za-z0-9_]$"
KEEP_FIRST = "^[A-Za-z_]$"
KEPT_RUN = "[A-Za-z0-9_]+"
ESCAPE_RE = "_([0-9a-f]{2,6})_"
SPLIT_RE = "_[0-9a-f]{2,6}_"
LOOKS_ESCAPED = "[0-9a-f]{2,6}[^A-Za-z0-9]"
ESCAPED_UNDERSCORE = "_5f_"

#: different escaped characters of a text that get a pass each
MAX_PASSES = 64


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_enum(c: Column | str) -> Column:
    """Text -> enum symbol; null stays null, '' stays ''.

    The cost of a text is one pass for each different character that it must escape; a text with more than
    ``MAX_PASSES`` of them is escaped character by character.
    """
    v = _col(c)
    safe = F.regexp_replace(v, f"_(?={LOOKS_ESCAPED})", ESCAPED_UNDERSCORE)
    # code point from the UTF-32 bytes (ascii() is wrong above the BMP); at
    # least two hex digits (lpad would cut longer values, so pad by hand)
    def escape(ch: Column) -> Column:
        h = F.lower(F.regexp_replace(F.hex(F.encode(ch, "UTF-32")), "^0+", ""))
        return F.concat(F.lit("_"), F.when(F.length(h) < 2, F.lpad(h, 2, "0")).otherwise(h), F.lit("_"))

    def characters(text: Column) -> Column:
        return F.filter(F.split(text, ""), lambda ch: ch != "")  # split('', '') gives ['']

    def one_by_one() -> Column:
        return F.array_join(F.transform(characters(safe), lambda ch, i: F.when(
            F.when(i == 0, ch.rlike(KEEP_FIRST)).otherwise(ch.rlike(KEEP_CLASS)), ch).otherwise(escape(ch))), "")

    def by_character(found: Column) -> Column:
        # an escape holds no character that is escaped, so the order of the passes is free
        first = F.regexp_replace(safe, "^([0-9])", "_3$1_")
        return F.aggregate(found, first, lambda text, ch: F.replace(text, ch, escape(ch)))

    escaped = F.array_distinct(characters(F.regexp_replace(v, KEPT_RUN, "")))
    symbol = F.transform(F.array(escaped), lambda found: F.when(  # a lambda, so that ``escaped`` is found once
        F.size(found) <= MAX_PASSES, by_character(found)).otherwise(one_by_one()))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(symbol[0])


def decode_enum(c: Column | str) -> Column:
    """Enum symbol -> text; null and '' pass through unchanged."""
    e = _col(c)
    pieces = F.split(e, SPLIT_RE, -1)
    codes = F.regexp_extract_all(e, F.lit(ESCAPE_RE), 1)
    joined = F.zip_with(pieces, codes, lambda p, h: F.concat(
        F.coalesce(p, F.lit("")),
        F.coalesce(F.decode(F.unhex(F.lpad(h, 8, "0")), "UTF-32"), F.lit(""))))
    # only values that hold an escape need the rewrite
    return F.when(e.isNull() | ~e.rlike(SPLIT_RE), e).otherwise(F.array_join(joined, ""))


def encode_value(c: Column | str, is_array: bool = False) -> Column:
    """Encode a field holding one enum value or an array of them."""
    c = _col(c)
    return F.transform(c, encode_enum) if is_array else encode_enum(c)


def decode_value(c: Column | str, is_array: bool = False) -> Column:
    """Decode a field holding one enum symbol or an array of them."""
    c = _col(c)
    return F.transform(c, decode_enum) if is_array else decode_enum(c)


def encode_symbol_sql(v: str) -> str:
    """DuckDB SQL of :func:`encode_enum` for the oracle."""
    return (f"case when {v} is null then null else array_to_string(list_transform("
            f"string_split({v}, ''), lambda ch, i: case when ch = '_' and regexp_matches("
            f"substr({v}, i + 1, 7), '^{LOOKS_ESCAPED}') then '{ESCAPED_UNDERSCORE}' "
            f"when regexp_matches(ch, case when i = 1 then '{KEEP_FIRST}' else '{KEEP_CLASS}' end) then ch "
            f"else '_' || printf('%02x', unicode(ch)) || '_' end), '') end")


def encode_symbol(text: str) -> str:
    """Python form of :func:`encode_enum` for schema metadata (symbol lists)."""
    out = []
    for i, ch in enumerate(text):
        if ch == "_" and re.match(LOOKS_ESCAPED, text[i + 1:]):
            out.append(ESCAPED_UNDERSCORE)
        elif ch.isascii() and (ch.isalpha() or ch == "_" or (i > 0 and ch.isdigit())):
            out.append(ch)
        else:
            out.append(f"_{ord(ch):02x}_")
    return "".join(out)
