"""Sums of doubles that no order of adding can change.

A double is a whole number of at most 53 bits times a power of two. ``limb_columns`` writes it as
a ``bin``, the power of 2**32 it lies at, and four whole numbers of 21 bits. Bins and limbs are
added up as whole numbers on Spark, in any order and in parts, and ``ExactSum`` puts the limbs of
all bins together as one Python integer. Only the result is rounded, once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that hold a value, or a sum of values of one bin.
LIMBS = ("_bin", "_limb3", "_limb2", "_limb1", "_limb0", "_nans", "_highs", "_lows")

_LEAST_BIN = -34
_BITS = 21
# A limb's sum stays below 2**63 for 2**42 values.
_UNIT = 52 - 32 * _LEAST_BIN


def limb_columns(value: Column) -> list[Column]:
    """``value`` as the columns of ``LIMBS``: whole numbers that may be summed per bin.

    NaN and the infinities are counted apart and lie, like zero, in bin 0. NULL gives NULL limbs,
    which sums skip.
    """
    number = value.cast("double")
    # Also false for NaN, which Spark holds greater than all.
    plain = (F.abs(number) < F.lit(math.inf)) & (number != 0)
    size = F.when(plain, F.abs(number)).otherwise(F.lit(1.0))
    near = F.floor(F.log2(size) / 32).cast("int")
    # The logarithm may be off by its last bit, at a bin's border by one bin.
    at = _scaled(size, near)
    bin_ = near - (at < 1).cast("int") + (at >= 2.0**32).cast("int")
    rest = F.when(plain, _scaled(number, bin_)).otherwise(F.when(number.isNotNull(), F.lit(0.0)))
    columns = [bin_]
    for k in range(4):
        # Towards zero, so that what remains has fewer bits than before.
        limb = (rest * F.lit(2.0 ** (_BITS * k - 11))).cast("bigint")
        columns.append(limb)
        rest = rest - limb.cast("double") * F.lit(2.0 ** (11 - _BITS * k))
    kinds = (F.isnan(number), number == F.lit(math.inf), number == F.lit(-math.inf))
    columns += [F.when(kind, F.lit(1)).otherwise(F.lit(0)).cast("bigint") for kind in kinds]
    return [column.alias(name) for column, name in zip(columns, LIMBS, strict=True)]


def _scaled(number: Column, bin_: Column) -> Column:
    """``number * 2**(-32 * bin_)``, in two steps that neither overflow nor round."""
    bins = range(_LEAST_BIN - 1, -_LEAST_BIN + 1)
    step = F.get(F.array(*(F.lit(2.0 ** (-16 * b)) for b in bins)), bin_ - F.lit(bins[0]))
    return number * step * step


class ExactSum:
    """A sum of doubles, by the limbs of their bins, or of decimals with ``scale`` places, as whole
    numbers of the last one."""

    def __init__(self, scale: int | None = None) -> None:
        self._unit = 1 << (_UNIT + 32) if scale is None else 10**scale
        self._whole = self._nans = self._highs = self._lows = 0

    def add(self, limbs: tuple, times: int = 1) -> None:
        """Add (or with ``times=-1`` take back) the sum of a bin, in the order of ``LIMBS``."""
        bin_, *parts, nans, highs, lows = limbs
        whole = 0
        for part in parts:
            whole = (whole << _BITS) + (part or 0)
        self._whole += times * whole << (32 * (bin_ - _LEAST_BIN + 1))
        self._nans += times * nans
        self._highs += times * highs
        self._lows += times * lows

    def add_whole(self, whole: int) -> None:
        """Add a whole number of the last decimal place."""
        self._whole += whole

    def merge(self, other: ExactSum, times: int = 1) -> None:
        """Add (or take back) another sum of the same kind."""
        self._whole += times * other._whole
        self._nans += times * other._nans
        self._highs += times * other._highs
        self._lows += times * other._lows

    def value(self) -> float:
        """The double next to the sum; an infinity where that lies beyond all doubles."""
        if self._nans or (self._highs and self._lows):
            return math.nan
        if self._highs or self._lows:
            return math.inf if self._highs else -math.inf
        try:
            # Python rounds the quotient of whole numbers once, to the nearest double.
            return self._whole / self._unit
        except OverflowError:
            return math.copysign(math.inf, self._whole)

    def text(self) -> str:
        """The sum as text that ``of_text`` reads: hexadecimal digits, the number of zeros that
        follow them, and the three counts where they aren't zero."""
        digits = f"{self._whole:x}"
        short = digits.rstrip("0")
        counts = (self._nans, self._highs, self._lows)
        return ",".join(map(str, (short, len(digits) - len(short), *(counts if any(counts) else ()))))

    @classmethod
    def of_text(cls, text: str | None, scale: int | None = None) -> ExactSum:
        """What ``text`` gave; without one, nothing."""
        made = cls(scale)
        if text is not None:
            digits, zeros, *counts = text.split(",")
            made._whole = int(digits + "0" * int(zeros) or "0", 16)
            made._nans, made._highs, made._lows = map(int, counts or (0, 0, 0))
        return made
