"""Lenient conversions: bad input becomes null and the row survives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A time of day that ends in a zone, and the fraction of a second in a time.
HAS_ZONE = r":[0-9]{2}.*(Z|z|UTC|GMT|[+-][0-9]{2}(:?[0-9]{2})?)$"
FRACTION = r"\.[0-9]+$"
# The five groups of a UUID and the hyphenated form.
UUID_GROUPS = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"
UUID_LAYOUT = "$1-$2-$3-$4-$5"


def to_number(value: Column) -> Column:
    """Number in double precision, or null; a type letter as in ``1d`` is no number."""
    text = F.trim(value.cast("string"))
    return F.when(~text.rlike("[0-9.][dDfF]$"), text.try_cast("double"))


def to_exact_number(value: Column) -> Column:
    """Number of either kind in one column: whole ones exact, up to 38 digits, others as double.

    The column is a variant. Beyond 38 digits a whole number is a double too.
    A text that is no number gives null.
    """
    text = F.regexp_replace(F.trim(value.cast("string")), "^[+]", "")
    whole, digits = text.rlike("^-?[0-9]+$"), F.length(F.regexp_replace(text, "^-?0*", ""))
    # A cast that fails is slow, so the form and the length say which one will do.
    return (
        F.when(whole & (digits <= 18), text.try_cast("bigint").cast("variant"))
        .when(whole & (digits <= 38), F.coalesce(text.try_cast("bigint").cast("variant"), text.try_cast("decimal(38,0)").cast("variant")))
        .otherwise(to_number(text).cast("variant")))


def to_integer(value: Column) -> Column:
    """Whole number, or null where the text is not one."""
    return F.trim(value.cast("string")).try_cast("bigint")


def to_datetime(value: Column, *formats: str) -> Column:
    """Time without zone, whole seconds; a stated zone is turned into UTC.

    ISO texts are read first, then each of ``formats``. Text that fits none
    is null. A zone is stated in every parse that needs one, so nothing here
    depends on the session time zone.
    """
    text = F.trim(value.cast("string"))
    local = F.regexp_replace(text, FRACTION, "").try_cast("timestamp_ntz")
    parsed = F.when(text.rlike(HAS_ZONE), _utc_clock(text.try_cast("timestamp"))).otherwise(local)
    attempts = [
        _utc_clock(F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{pattern} Z")))
        for pattern in formats
    ]
    return F.coalesce(parsed, *attempts)


def _utc_clock(instant: Column) -> Column:
    """The UTC reading of an instant as a zone-free time, in whole seconds."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch)


def to_json_text(value: Column, dtype: T.DataType | None = None) -> Column:
    """Text stays as it is, anything else becomes compact JSON."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def format_uuid(value: Column) -> Column:
    """Hyphenated lower-case form of 32 hexadecimal digits, or null."""
    digits = F.lower(F.regexp_replace(value.cast("string"), "-|^urn:uuid:|[{}]", ""))
    shaped = F.regexp_replace(digits, UUID_GROUPS, UUID_LAYOUT)
    return F.when(digits.rlike("^[0-9a-f]{32}$"), shaped)


def sha1_text(value: Column) -> Column:
    """Hex digest of the UTF-8 text of the value; null stays null."""
    return F.sha1(value.cast("string"))
