"""Small column expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.schemas import MONEY


def money(amount: Column) -> Column:
    """Money is decimal before any sum; text that is no number becomes null."""
    return amount.try_cast(MONEY)


def ds_text(at: Column) -> Column:
    """Partition value of a snapshot day."""
    return F.date_format(at, "yyyy-MM-dd")


def to_second(at: Column) -> Column:
    """Round (not truncate) a timestamp to whole seconds."""
    return F.date_trunc("second", at + F.expr("interval 500 milliseconds"))


def micros(at: Column) -> Column:
    return F.unix_micros(at)


def prop(name: str, properties: str = "properties") -> Column:
    """Value of one key in the properties map; null when the key is missing."""
    return F.col(properties).getItem(name)


def sku(category: Column, label: Column, number: Column, width: int = 4) -> Column:
    """``CAT-LAB-0001``: two three-letter prefixes and a zero-padded number.

    Numbers wider than ``width`` keep all their digits.
    """
    digits = number.cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat_ws(
        "-", F.upper(F.left(category, F.lit(3))), F.upper(F.left(label, F.lit(3))), padded
    )


def masked_email(email: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), email), 256)


def initial(name: Column) -> Column:
    return F.concat(F.left(name, F.lit(1)), F.lit("."))
