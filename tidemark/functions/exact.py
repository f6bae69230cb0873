"""Sums and means that do not depend on the order in which rows arrive.

Adding doubles gives last digits that change with partitioning and with retried
tasks. Where values carry a fixed number of decimals, adding them as scaled
integers is exact and stays in primitive aggregation buffers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the lower limbs of a sum.
LIMB_BITS = 22


def fixed_point(value: Column | str, scale: int) -> Column:
    """``value`` as BIGINT units of ``10**-scale``; NaN and infinity have none and raise an error."""
    value = F.col(value) if isinstance(value, str) else value
    return F.rint(value * F.lit(float(10**scale))).cast("bigint")


def exact_sum(value: Column | str, scale: int) -> Column:
    """Sum aggregate in DECIMAL(38, 0) units of ``10**-scale``.

    The units are cut into limbs of 22, 22 and 20 bits, each summed as BIGINT, which 2**41 rows of any size can't
    exceed; only the three results become decimals. Digits beyond ``scale`` are rounded in each value.
    """
    units = fixed_point(value, scale)
    mask = F.lit((1 << LIMB_BITS) - 1).cast("bigint")
    limbs = [units.bitwiseAND(mask), F.shiftright(units, LIMB_BITS).bitwiseAND(mask), F.shiftright(units, 2 * LIMB_BITS)]
    low, middle, high = (F.sum(limb).cast("decimal(38,0)") for limb in limbs)
    step = F.lit(1 << LIMB_BITS).cast("decimal(8,0)")
    return ((high * step + middle).cast("decimal(38,0)") * step + low).cast("decimal(38,0)")


def exact_mean(value: Column | str, scale: int | None = None) -> Column:
    """Mean aggregate: exact for values with ``scale`` decimals, ``avg`` when ``scale`` is None."""
    value = F.col(value) if isinstance(value, str) else value
    if scale is None:
        return F.avg(value)
    units = F.count(value).cast("double") * F.lit(float(10**scale))
    return exact_sum(value, scale).cast("double") / F.nullif(units, F.lit(0.0))
