"""Order keys for text cursors of mixed renderings, and keys inside entity references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: extended ISO-8601 date-time, decimal number.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}"
FRACTION = r"[T ]\d{2}:\d{2}:\d{2}\.(\d+)"
NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"


RAW, NUMERIC, TIME = b"\x00", b"\x01", b"\x02"
_MOST_NEGATIVE = -(1 << 63)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _big_endian(n: Column) -> Column:
    """A bigint as 8 bytes whose order is that of the numbers."""
    return F.unhex(F.lpad(F.hex(n.cast("bigint").bitwiseXOR(F.lit(_MOST_NEGATIVE))), 16, "0"))


def _number(pieces: Column) -> Column:
    """Bytes in the order of exact decimal values of any length, from the pieces of a number; null if they are of none.

    Sign, then the place of the leading digit, then all significant digits. For negative numbers place and digits are
    turned round, with an end mark above all digits.
    """
    sign, whole, part, power = (F.get(pieces, F.lit(i)) for i in range(1, 5))

    def of(n: Column) -> Column:
        minus, place, digits = n["minus"], n["place"], n["digits"]
        low = F.concat(F.lit(b"\x00"), _big_endian(-place), F.translate(digits, "0123456789", "9876543210").cast("binary"), F.lit(b"~"))
        high = F.concat(F.lit(b"\x02"), _big_endian(place), digits.cast("binary"))
        return F.when(digits == "", F.lit(b"\x01")).when(minus, low).otherwise(high)

    digits = F.concat(whole, part)
    leading = F.ltrim(digits, F.lit("0"))
    place = F.length(whole) - (F.length(digits) - F.length(leading)) + F.coalesce(F.nullif(power, F.lit("")).try_cast("bigint"), F.lit(0))
    value = _let(
        F.struct((sign == "-").alias("minus"), place.cast("bigint").alias("place"), F.rtrim(leading, F.lit("0")).alias("digits")), of
    )
    return F.when((F.size(pieces) == 5) & (digits != "") & (F.length(power) <= 17), value)


def cursor_key(c: Column) -> Column:
    """Binary key that compares as bytes: time order for ISO texts, exact value for numbers, else raw order.

    The first byte is the family (0 raw, 1 number, 2 time), see ``key_family``; null is the empty key, before all others. A time is its
    microseconds and the fraction's digits without trailing zeros, so sub-microsecond digits of any length still order. Two
    renderings of one instant or number are equal. Numbers whose exponent has more than 17 characters are raw.
    """
    text = c.cast("string")
    ts = F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(text))
    frac = F.rtrim(F.regexp_extract(text, FRACTION, 1), F.lit("0"))
    # a number never starts with the mark, so a text that is none stays in one piece or isn't changed
    pieces = F.regexp_replace(text, NUMBER, "#$1#$2#$3#$4")
    number = F.when(pieces != text, _let(F.split(pieces, "#"), _number))
    raw = F.concat(F.lit(RAW), text.cast("binary"))

    def of(parts: Column) -> Column:
        time = F.concat(F.lit(TIME), _big_endian(F.unix_micros(parts["ts"])), parts["frac"].cast("binary"))
        return F.when(parts["ts"].isNotNull(), time).otherwise(parts["other"])

    other = F.when(ts.isNull(), _let(number, lambda n: F.when(n.isNotNull(), F.concat(F.lit(NUMERIC), n)).otherwise(raw)))
    key = _let(F.struct(ts.alias("ts"), F.when(ts.isNotNull(), frac).alias("frac"), other.alias("other")), of)
    return F.when(text.isNull(), F.lit(b"")).otherwise(key)


def key_family(key: Column) -> Column:
    """0 raw, 1 number, 2 time; null for the key of null."""
    return F.nullif(F.hex(F.substring(key, 1, 1)), F.lit("")).cast("int")


def key_sign(key: Column) -> Column:
    """-1, 0 or 1 for the key of a number, else null."""
    return F.when(key_family(key) == 1, F.hex(F.substring(key, 2, 1)).cast("int") - 1)


def entity_key_value(ref: Column, name: str, single: bool) -> Column:
    """Value of key ``name`` in a reference such as ``Set('A')`` or ``.../Set(a=1,b='x')``.

    Percent-encoding is undone, quotes are stripped and doubled quotes restored. A bare
    value is accepted only for a single key. No match is null.
    """
    path = F.regexp_replace(ref, r"[?#].*$", "")
    seg = F.try_url_decode(F.regexp_replace(F.regexp_extract(path, r"([^/]*)/*$", 1), r"\+", "%2B"))
    inner = F.regexp_extract(seg, r"^[^(]+\((.*)\)$", 1)
    value = r"('(?:[^']|'')*'|[^,'()=]+)"
    named = F.regexp_extract(inner, rf"(?:^|,)\s*{name}\s*=\s*{value}\s*(?=,|$)", 1)
    found = F.nullif(named, F.lit(""))
    if single:
        bare = F.regexp_extract(inner, rf"^\s*{value}\s*$", 1)
        found = F.coalesce(found, F.nullif(bare, F.lit("")))
    unquoted = F.regexp_replace(F.regexp_extract(found, r"^'(.*)'$", 1), "''", "'")
    return F.when(found.startswith("'"), unquoted).otherwise(F.trim(found))


def format_entity_ref(entity_set: str, keys: dict[str, Column], text_keys: set[str]) -> Column:
    """``Set(a=1,b='x')``: the text form that ``entity_key_value`` reads."""
    parts = []
    for k, c in keys.items():
        v = c.cast("string")
        if k in text_keys:
            v = F.concat(F.lit("'"), F.regexp_replace(v, "'", "''"), F.lit("'"))
        parts.append(F.concat(F.lit(f"{k}="), v))
    return F.concat(F.lit(f"{entity_set}("), F.concat_ws(",", *parts), F.lit(")"))
