"""Decoding of signed amounts, all inside whole-stage codegen.

A field that cannot be decoded gives NULL; the row itself is kept, so that it
still counts as a transaction and can be listed as a reject.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.types import AMOUNT, FEED_AMOUNT

# The last character of a negative amount, for digits 0 to 9.
NEGATIVE_LAST_CHARS = "pqrstuvwxy"
DIGITS = "0123456789"


def overpunch_sign(last: Column) -> Column:
    """-1 for p..y, 1 for 0..9, NULL for anything else."""
    return F.when(last.between("p", "y"), F.lit(-1)).when(
        last.between("0", "9"), F.lit(1)
    )


def overpunch_digit(last: Column) -> Column:
    return F.when(
        last.between("p", "y"), F.translate(last, NEGATIVE_LAST_CHARS, DIGITS)
    ).when(last.between("0", "9"), last)


def overpunch_amount(field: Column, length: int = 17, decimals: int = 3) -> Column:
    """An amount of ``length`` characters, at most 18, whose last one has the sign, with
    ``decimals`` implied decimal places, at most 3.

    The digits are read as a bigint, which is about twice as fast as a string to
    decimal cast; 18 digits always fit.
    """
    last = F.substring(field, length, 1)
    digits = F.concat(F.substring(field, 1, length - 1), overpunch_digit(last))
    whole = digits.try_cast("bigint") * overpunch_sign(last)
    unit = F.expr(f"{10.0**-decimals:.{decimals}f}BD")
    return (whole.cast("decimal(18,0)") * unit).cast(AMOUNT)


def overpunch_field(thousandths: Column) -> Column:
    """The inverse: a bigint number of thousandths as a 17-character field."""
    digits = F.lpad(F.abs(thousandths).cast("string"), 17, "0")
    last = F.substring(digits, 17, 1)
    return F.concat(
        F.substring(digits, 1, 16),
        F.when(thousandths < 0, F.translate(last, DIGITS, NEGATIVE_LAST_CHARS)).otherwise(last),
    )


def trailing_sign_amount(amount: Column, sign: Column, decimals: int) -> Column:
    """An amount with its sign in a character of its own; 0 for any other sign.

    ``decimals`` is 3 for a field in thousandths, 4 for ten-thousandths.
    """
    number = F.trim(amount).try_cast("decimal(22,4)")
    scaled = (number * F.expr(f"{10.0**-decimals:.{decimals}f}BD")).cast(FEED_AMOUNT)
    return (
        F.when(sign == "+", scaled)
        .when(sign == "-", -scaled)
        .otherwise(F.lit(0).cast(FEED_AMOUNT))
    )


def _keep_if(amount: Column, test: Column) -> Column:
    # CASE, not greatest(): an undecodable amount must become 0 on both sides.
    return F.when(test, amount).otherwise(F.lit(0).cast(AMOUNT))


def debit_of(amount: Column) -> Column:
    return _keep_if(amount, amount > 0)


def credit_of(amount: Column) -> Column:
    """Credits stay negative."""
    return _keep_if(amount, amount < 0)


def null_safe_difference(left: Column, right: Column) -> Column:
    """``left - right`` with NULL as 0."""
    zero = F.lit(0)
    return F.coalesce(left, zero) - F.coalesce(right, zero)
