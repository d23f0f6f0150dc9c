"""Column expressions for decisions and their presentation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def risk_level(probability: Column) -> Column:
    """HIGH above 0.70, MEDIUM above 0.30, else LOW."""
    return (
        F.when(probability > 0.70, "HIGH").when(probability > 0.30, "MEDIUM").otherwise("LOW")
    )


def short_id(identifier: Column) -> Column:
    """Identifiers longer than ten characters are shown by their last eight."""
    text = identifier.cast("string")
    return F.when(F.length(text) > 10, F.right(text, F.lit(8))).otherwise(text)


def padded_id(identifier: Column, prefix: str = "TX-", width: int = 6) -> Column:
    """Prefix and zero-padded number; a longer number is kept whole."""
    text = identifier.cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    )


def percent_text(probability: Column) -> Column:
    return F.format_string("%.1f%%", probability * 100)


def decision_text(is_fraud: Column) -> Column:
    return F.when(is_fraud, "FRAUDE").otherwise("LÉGIT")
