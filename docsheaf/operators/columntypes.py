"""Column types: inference, compatibility, widening, declared types and rejects."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a spec may declare.
DECLARED = {
    "text": "string",
    "boolean": "boolean",
    "datetime": "timestamp_ntz",
    "date": "date",
    "integer": "bigint",
    "json": "variant",
}

INTEGERS = ("byte", "short", "integer", "long")

# Kinds of column a value of a kind fits into without widening.
# Fractions are an addition; whole numbers fit a column of them.
FITS = {
    "text": ("text",),
    "integer": ("integer", "text", "double"),
    "boolean": ("boolean", "text", "integer"),
    "datetime": ("datetime", "text", "date"),
    "date": ("date", "text"),
    "json": ("json",),
    "double": ("double", "text"),
}


def spark_type(declared: str | None) -> str:
    """Spark's name for a declared type; an unknown one is text."""
    if declared in DECLARED:
        return DECLARED[declared]
    if declared:
        warnings.warn(f"unknown data type {declared!r}, using text", stacklevel=2)
    return "string"


def kind_of(dtype: T.DataType) -> str:
    """The kind a Spark type belongs to; types without a kind are text."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return "datetime"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "double"
    if isinstance(dtype, T.VariantType):
        return "json"
    return "text"


def fits(value: T.DataType, column: T.DataType) -> bool:
    """Whether values of one type go into a column of another as it is."""
    return kind_of(column) in FITS[kind_of(value)]


def common_type(value: T.DataType, column: T.DataType) -> T.DataType:
    """The column's type if the value fits, else text.

    Of two integer types the wider holds both; different fractions meet as
    double.
    """
    if value == column:
        return column
    if isinstance(value, T.IntegralType) and isinstance(column, T.IntegralType):
        return max(value, column, key=lambda t: INTEGERS.index(t.typeName()))
    if kind_of(value) == kind_of(column) == "double":
        return T.DoubleType()
    return column if fits(value, column) else T.StringType()


def as_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a cell: ISO date, time of day without fraction, true/false."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.regexp_replace(value.cast("string"), r"\.\d+$", "")
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def convert(value: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """A value in the type of its column."""
    if dtype == target:
        return value
    if isinstance(target, T.StringType):
        return as_text(value, dtype)
    return value.cast(target)


def align(target: DataFrame, batch: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Give both sides the same columns and types.

    A column only one side has is null on the other. A column whose new values
    do not fit becomes text on both, unless ``strict``: then the column keeps
    its type and values that cannot be cast fail the write.
    """
    held, new = dict(_types(target)), dict(_types(batch))
    names = list(held) + [n for n in new if n not in held]
    left, right = [], []
    for name in names:
        if name not in held:
            goal = new[name]
        elif name not in new or strict:
            goal = held[name]
        else:
            goal = common_type(new[name], held[name])
        left.append(_cell(held, name, goal))
        right.append(_cell(new, name, goal))
    return target.select(*left), batch.select(*right)


def _types(df: DataFrame):
    return [(f.name, f.dataType) for f in df.schema.fields]


def _cell(types: dict, name: str, goal: T.DataType) -> Column:
    if name not in types:
        return F.lit(None).cast(goal).alias(name)
    return convert(F.col(f"`{name}`"), types[name], goal).alias(name)


def declared_columns(df: DataFrame, declared: dict[str, str | None], lenient: bool = True) -> DataFrame:
    """Cast the declared columns; others keep their type."""
    out = []
    for name, dtype in _types(df):
        value = F.col(f"`{name}`")
        if declared.get(name):
            goal = spark_type(declared[name])
            if goal == "variant":
                text = isinstance(dtype, T.StringType)
                value = F.try_parse_json(value) if text else value.cast("variant")
            elif goal == "string":
                value = as_text(value, dtype)
            else:
                value = value.try_cast(goal) if lenient else value.cast(goal)
        out.append(value.alias(name))
    return df.select(*out)


# The kinds a text may be read as, narrowest first; each has a bit.
KINDS = ("bigint", "double", "date", "timestamp_ntz", "boolean")
BITS = {kind: 1 << n for n, kind in enumerate(KINDS)}
# Forms that a cast gives back; other digits, signs or zones would be lost.
WHOLE_FORM = r"^(0|-?[1-9][0-9]*)$"
FRACTION_FORM = r"^-?(0|[1-9][0-9]*)\.([0-9]*[1-9]|0)$"
DATE_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
EXACT = 1 << 53  # a double holds whole numbers up to here
# Characters that any number fits in a double with, in a bigint with, and fractions are compared exactly with.
SURE, FITTING, COMPARED = 15, 18, 19


def kind_mask(text: Column) -> Column:
    """The kinds a text can be read as without loss, as bits; 0 is text only, null for a null.

    Its first character and its length decide what is tried, so most cells meet
    one test; a cast that may fail is the last resort, as failing is slow. A whole number must be written as the number is ('007', '+1' are
    texts), a fraction as well ('1.10', '1e5'), and a double must hold it. Whole
    numbers up to 2^53 are fractions too.
    """
    first, size, both = F.substring(text, 1, 1), F.length(text), BITS["bigint"] | BITS["double"]
    whole = (
        F.when(size <= SURE, both)
        .when(size <= FITTING, F.when(text.try_cast("bigint").between(-EXACT, EXACT), both).otherwise(BITS["bigint"]))
        .when((size <= FITTING + 2) & text.try_cast("bigint").isNotNull(), BITS["bigint"]).otherwise(0))
    held = text.try_cast("double").try_cast("decimal(38,18)") == text.try_cast("decimal(38,18)")
    fraction = F.when(size <= SURE, BITS["double"]).when((size <= COMPARED) & held, BITS["double"]).otherwise(0)
    number = F.when(text.rlike(WHOLE_FORM), whole).when(text.rlike(FRACTION_FORM), fraction).otherwise(0)
    day = F.when(text.rlike(DATE_FORM) & text.try_cast("date").isNotNull(), BITS["date"]).otherwise(0)
    time = F.when(text.rlike(TIME_FORM) & text.try_cast("timestamp_ntz").isNotNull(), BITS["timestamp_ntz"]).otherwise(0)
    return (
        F.when(text.isNull(), F.lit(None))
        .when((F.substring(text, 5, 1) == "-") & (size == 10), day)
        .when((F.substring(text, 5, 1) == "-") & (size > 10), time)
        .when(first.between("0", "9") | (first == "-"), number)
        .otherwise(F.when(F.lower(text).isin("true", "false"), BITS["boolean"]).otherwise(0))
    )


def _masks(df: DataFrame, columns: list[str]) -> DataFrame:
    """The masks of all columns. One function over an array of cells stays small; as many copies
    of it as there are columns would make a method too large for the JVM to compile."""
    texts = F.array(*[F.trim(F.col(f"`{c}`").cast("string")) for c in columns])
    masks = df.select(F.transform(texts, kind_mask).alias("m"))
    return masks.select(*[F.get("m", F.lit(k)).alias(c) for k, c in enumerate(columns)])


def type_evidence(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: per text column the number of values, and of those whose narrowest kind is each.

    Every row is looked at, in one pass and one aggregate row per task.
    """
    columns = columns or df.columns
    aggs = []
    for name in columns:
        at = F.col(f"`{name}`")
        lowest = at.bitwiseAND(-at)
        aggs.append(F.count(at).alias(f"{name}|n"))
        aggs += [F.count_if(lowest == bit).alias(f"{name}|{kind}") for kind, bit in BITS.items()]
    return _masks(df, columns).agg(*aggs)


def choose_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str | None]:
    """Narrowest type that holds every value; None for a column without values.

    The kinds that all values share: one bit mask a cell, one ``and`` a column.
    Whole numbers also fit a column of fractions; other mixtures are text.
    """
    columns = columns or df.columns
    shared = _masks(df, columns).agg(*[F.bit_and(F.col(f"`{c}`")).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    return {c: None if shared[k] is None else next((kind for kind, bit in BITS.items() if shared[k] & bit), "string") for k, c in enumerate(columns)}


def infer_columns(df: DataFrame, drop_empty: bool = False, keep: list[str] = ()) -> DataFrame:
    """Text columns in the narrowest type all their values have.

    With ``drop_empty`` a text column without any value is left out, unless it
    is in ``keep`` because its type was declared.
    """
    texts = [n for n, t in _types(df) if isinstance(t, T.StringType) and n not in keep]
    if not texts:
        return df
    chosen = choose_types(df, texts)
    out = []
    for name in df.columns:
        goal = chosen.get(name, "string")
        if goal is None and drop_empty:
            continue
        value = F.col(f"`{name}`")
        typed = goal not in (None, "string")
        out.append(F.trim(value).cast(goal).alias(name) if typed else value)
    return df.select(*out)


def without_empty_columns(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Leave out columns that are null in every row and not declared."""
    asked = [c for c in df.columns if c not in keep]
    if not asked:
        return df
    seen = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in asked]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep or seen[c]])


def rejects(df: DataFrame, id_column: str, conversions: dict[str, Column]) -> DataFrame:
    """(id, column, value) of every cell whose conversion failed.

    All columns are checked in the same pass; one row per failed cell.
    """
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"),
                 (F.col(name).isNotNull() & converted.isNull()).alias("failed"))
        for name, converted in conversions.items()
    ]
    listed = df.select(F.col(id_column).alias("id"), F.explode(F.filter(
        F.array(*cells), lambda c: c.getField("failed"))).alias("c"))
    return listed.select("id", "c.column", "c.value")
