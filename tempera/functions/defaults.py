"""Missing-value rules: empty text counts as missing, like NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def or_default(text: Column, *fallbacks: Column | str) -> Column:
    """``text`` unless NULL or empty, else the first fallback that is not NULL."""
    return F.coalesce(F.nullif(text, F.lit("")), *[F.lit(f) if isinstance(f, str) else f for f in fallbacks])
