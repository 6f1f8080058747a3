"""Digital numbers, temperatures and masks as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framespan.constants import GAIN, HOT_DN, OFFSET


def celsius(dn: Column) -> Column:
    return dn * F.lit(GAIN) - F.lit(OFFSET)


def threshold_dn(temperature: Column, gain: Column) -> Column:
    """Least DN that reaches the temperature; null when it is not finite or the gain not positive."""
    usable = ~F.isnan(temperature) & (F.abs(temperature) < float("inf")) & ~F.isnan(gain) & (gain > 0) & (gain < float("inf"))
    return F.when(usable, F.ceil((temperature + OFFSET) / gain))


def mask(dn: Column, threshold: int = HOT_DN) -> Column:
    """0/1 array of an array of DN."""
    return F.transform(dn, lambda x: (x >= threshold).cast("int"))


def xmp_number(xmp: Column, field: str) -> Column:
    """Number of `<namespace:field>` in XMP text; null when missing or not a number."""
    return F.regexp_extract(xmp, rf"<\w+:{field}>\s*([^<]*?)\s*</", 1).try_cast("double")


def general_12(value: Column) -> Column:
    """A fraction below one with 12 significant digits and no trailing zeros."""
    digits = F.when(value > 0, F.lit(11) - F.floor(F.log10(value))).otherwise(F.lit(12)).cast("int")
    text = F.format_string("%.20f", F.round(value * F.pow(F.lit(10.0), digits), 0) / F.pow(F.lit(10.0), digits))
    return F.when(value == 0, "0").otherwise(F.regexp_replace(F.regexp_replace(F.substring(text, F.lit(1), digits + 2), "0+$", ""), r"\.$", ""))
