"""Fixed-position fields of a text line."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """``length`` characters from 1-based ``start``; a negative ``start`` counts
    from the end of the line, a negative ``length`` stops that many short of it."""

    name: str
    start: int
    length: int

    def of(self, line: Column) -> Column:
        if self.length >= 0:
            return F.substring(line, self.start, self.length)
        # The field ends at character len + length.
        kept = F.length(line) + F.lit(self.length) - F.lit(self.start - 1)
        return F.substring(line, F.lit(self.start), F.greatest(kept, F.lit(0)))


@dataclass(frozen=True)
class SignedField:
    """An amount whose last character, the one with the sign, stands elsewhere."""

    amount: Field
    sign: Field

    def of(self, line: Column) -> Column:
        leading = F.substring(line, self.amount.start, self.amount.length - 1)
        return F.concat(leading, self.sign.of(line))


def slice_fields(fields: list[Field], line: Column | None = None) -> list[Column]:
    """One column per field, for a single ``select``."""
    line = F.col("value") if line is None else line
    return [f.of(line).alias(f.name) for f in fields]


def currency_slice(
    line: Column,
    currency: Field,
    local: Field | SignedField,
    foreign: Field | SignedField,
    local_currency: str,
) -> Column:
    """The amount slot that the line's currency selects."""
    return F.when(currency.of(line) == local_currency, local.of(line)).otherwise(
        foreign.of(line)
    )


def split_key(key: Column, fields: list[Field]) -> list[Column]:
    """Branch, currency and account out of the composite Id."""
    return slice_fields(fields, key)
