"""Text forms for report tables.

format_number rounds the exact binary value half to even, as the reports do;
format_string would round the shortest decimal form half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_text(amount: Column, grouped: bool = True) -> Column:
    digits = F.lit(2) if grouped else F.lit("0.00")
    return F.concat(F.lit("$"), F.call_function("format_number", amount, digits))


def percent_text(share: Column, digits: int = 1) -> Column:
    """A share in [0, 1] printed as a percentage."""
    return percentage_text(share * 100, digits)


def percentage_text(percentage: Column, digits: int) -> Column:
    pattern = F.lit("0." + "0" * digits)
    return F.concat(F.call_function("format_number", percentage, pattern), F.lit("%"))


def count_text(count: Column) -> Column:
    return F.format_number(count, 0)
