"""Column-expression helpers (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)

# Column-name tokens whose numeric columns are rounded for display.
METRIC_TOKENS = (
    "score",
    "accuracy",
    "precision",
    "recall",
    "specificity",
    "f1",
    "auc",
    "mcc",
    "brier",
    "gain",
    "entropy",
    "probability",
    "std",
)


def quote(name: str) -> str:
    """Back-quote a column name (names may contain spaces or dots)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def is_numeric_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, NUMERIC_TYPES)


def strip_text(c: Column) -> Column:
    """String form with all leading/trailing whitespace removed (tabs and newlines too)."""
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


def nan_to_null(c: Column) -> Column:
    """Treat NaN as missing, like the pandas data model."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def is_missing(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num/den, 0 when den is 0 (zero-division rule of precision/recall/F1)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def ratio_or_null(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def entropy_term(n: Column, total: Column) -> Column:
    """n * log2(n / total), 0 for empty cells."""
    return F.when(n > 0, n.cast("double") * F.log2(n.cast("double") / total.cast("double"))).otherwise(F.lit(0.0))


def format_decimal(c: Column, decimals: int = 4) -> Column:
    """Number as text with at most ``decimals`` places, no trailing zeros, -0 shown as 0."""
    rounded = F.round(c.cast("double"), decimals)
    rounded = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
    text = F.format_string(f"%.{decimals}f", rounded)
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")


def round_metric_columns(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Round columns whose lower-cased name contains a metric token: numeric ones, and text
    ones of which every value that is there is a number; other text stays as it is."""
    named = [f for f in df.schema.fields if any(tok in f.name.lower() for tok in METRIC_TOKENS)]
    numeric = {f.name: col(f.name).cast("double") for f in named if is_numeric_type(f.dataType)}
    text = {f.name: nan_to_null(F.trim(col(f.name)).try_cast("double")) for f in named if isinstance(f.dataType, T.StringType)}
    if text:
        held = df.agg(*[(F.count(number) == F.count(col(name))).alias(f"t{i}") for i, (name, number) in enumerate(text.items())]).first()
        numeric |= {name: number for i, (name, number) in enumerate(text.items()) if held[f"t{i}"]}
    return df.select(*[F.round(numeric[c], decimals).alias(c) if c in numeric else col(c) for c in df.columns])


def top_k_label(top_k: Column) -> Column:
    """Text label of a feature count: 'all' for NULL."""
    return F.coalesce(top_k.cast("string"), F.lit("all"))
