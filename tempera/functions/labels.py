"""Texts that a user sees of a mood."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempera import dims


def mood_emoji(mood: Column) -> Column:
    return F.coalesce(dims.lookup(dims.MOOD_EMOJI, mood), F.lit(dims.DEFAULT_EMOJI))


def mood_label(mood: Column) -> Column:
    """The mood in capitals after its emoji, NULL without a mood."""
    return F.concat(mood_emoji(mood), F.lit(" "), F.upper(mood))


def detection_text(mood: Column, confidence: Column) -> Column:
    """A detection with its confidence in whole per cent; a half goes to the even number."""
    whole = F.bround(confidence.cast("double"), F.lit(0)).cast("bigint")
    return F.concat(F.lit("Detected: "), mood, F.lit(" ("), whole, F.lit("% confidence)"))
