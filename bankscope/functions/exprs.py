"""Scalar column expressions (all JVM-side, inside whole-stage codegen).

Numeric rules that keep results independent of partitioning and engine:

* rounding is half-even (``bround``) as in numpy/pandas;
* sums of money and of fixed-precision scores are taken as DECIMAL so the
  total does not depend on the order partitions are merged in; the exact
  total is then converted once to DOUBLE;
* quantities that are exact decimals before rounding (money x probability,
  probability x constant) are rounded in DECIMAL, so ties round half-even
  on the true value rather than on a binary approximation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c: str | Column, scale: int, precision: int = 18) -> Column:
    return col(c).cast(DecimalType(precision, scale))


def dlit(value: str | float, precision: int, scale: int) -> Column:
    """A DECIMAL literal with an explicit type (keeps products exact)."""
    return F.lit(str(value)).cast(DecimalType(precision, scale))


def to_double(c: str | Column) -> Column:
    return col(c).cast("double")


def bround(c: str | Column, scale: int) -> Column:
    """Half-even rounding (numpy/pandas ``round``)."""
    return F.bround(col(c), scale)


def dround(c: Column, scale: int) -> Column:
    """Half-even rounding of an exact DECIMAL expression, returned as DOUBLE."""
    return F.bround(c, scale).cast("double")


def exact_sum(c: str | Column, scale: int) -> Column:
    """Order-independent sum: values cast to DECIMAL(18, scale) first."""
    return F.sum(dec(c, scale))


def exact_sum_double(c: str | Column, scale: int) -> Column:
    return exact_sum(c, scale).cast("double")


def exact_avg(c: str | Column, scale: int) -> Column:
    """Mean from an exact DECIMAL sum (null when no non-null value)."""
    return F.try_divide(exact_sum(c, scale).cast("double"), F.count(col(c)).cast("double"))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def clip(c: str | Column, lo: float | Column | None = None, hi: float | Column | None = None) -> Column:
    """Bound a column; a null stays null (``greatest``/``least`` skip nulls)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def safe_ratio(n: str | Column, d: str | Column, default: float | None = None) -> Column:
    """n / d with a zero or null denominator giving ``default`` (or null)."""
    r = F.try_divide(col(n).cast("double"), col(d).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def seconds(ts: str | Column) -> Column:
    return F.unix_seconds(col(ts).cast("timestamp"))


def floor_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days between two timestamps, floored (may be negative).

    Unlike ``datediff`` (calendar-day difference) this is the floor of the
    elapsed time, so 23 hours gives 0 days.
    """
    return F.floor((seconds(later) - seconds(earlier)) / F.lit(86400)).cast("bigint")


def ts_lit(d: _dt.date | _dt.datetime) -> Column:
    if isinstance(d, _dt.datetime):
        return F.lit(d).cast("timestamp")
    return F.lit(_dt.datetime(d.year, d.month, d.day)).cast("timestamp")


def day_of(ts: str | Column) -> Column:
    """Midnight truncation of a timestamp (calendar day)."""
    return F.to_date(col(ts))


def month_label(month_index: str | Column, start: _dt.date) -> Column:
    """Month index 0..n-1 -> 'yyyy-MM' counted from the calendar start."""
    return F.date_format(F.add_months(F.lit(start), col(month_index).cast("int")), "yyyy-MM")


def month_index(ts: str | Column, start: _dt.date) -> Column:
    """Calendar month of a timestamp as an index from ``start``'s month."""
    t = col(ts)
    return ((F.year(t) - start.year) * 12 + F.month(t) - start.month).cast("int")


def map_values(c: str | Column, mapping: Mapping, default=None, keep: bool = False) -> Column:
    """Literal lookup; unknown keys -> ``default`` (or the input if ``keep``)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    x = F.try_element_at(F.create_map(*pairs), col(c)) if pairs else F.lit(None)
    if keep:
        return F.coalesce(x, col(c))
    if default is None:
        return x
    return F.coalesce(x, F.lit(default))


def cut_right(c: str | Column, edges: Sequence[Column | float], labels: Sequence[str],
              open_ends: bool = True) -> Column:
    """Right-closed binning like ``pd.cut``.

    With ``open_ends`` the outer bins are ``(-inf, e0]`` ... ``(e_k, inf)`` and
    ``len(labels) == len(edges) + 1``; otherwise bins are ``(e_i, e_{i+1}]``
    and values outside all bins are null.  Zero-width bins stay empty.
    """
    x = col(c)

    def _e(e):
        return e if isinstance(e, Column) else F.lit(e)

    if open_ends:
        assert len(labels) == len(edges) + 1
        expr = F.when(x.isNull(), F.lit(None).cast("string"))
        for e, lab in zip(edges, labels[:-1]):
            expr = expr.when(x <= _e(e), F.lit(lab))
        return expr.otherwise(F.lit(labels[-1]))
    assert len(labels) == len(edges) - 1
    expr = F.when(x.isNull() | (x <= _e(edges[0])) | (x > _e(edges[-1])), F.lit(None).cast("string"))
    for e, lab in zip(edges[1:], labels):
        expr = expr.when(x <= _e(e), F.lit(lab))
    return expr


def level_at_least(c: str | Column, high: Column, low: Column) -> Column:
    """'High' if c >= high, 'Medium' if c >= low, else 'Low' (edge -> upper)."""
    x = col(c)
    return F.when(x >= high, "High").when(x >= low, "Medium").otherwise("Low")


def level_weight(c: str | Column) -> Column:
    return F.when(col(c) == "High", 3).when(col(c) == "Medium", 2).otherwise(1)


def one_hot(c: str | Column, values: Iterable[str], names: Iterable[str]) -> list[Column]:
    """1 / 0 flags; a null value has none of them."""
    return [F.coalesce((col(c) == v).cast("int"), F.lit(0)).alias(n) for v, n in zip(values, names)]


def dimension_key(cols: Sequence[str]) -> Column:
    """Group key values joined with ' | '."""
    return F.concat_ws(" | ", *[F.col(c).cast("string") for c in cols])


def format_money(c: str | Column) -> Column:
    """'$1,234' (no decimals)."""
    return F.concat(F.lit("$"), F.format_number(F.bround(col(c), 0), 0))


def format_pct(c: str | Column, decimals: int = 1) -> Column:
    return F.concat(F.format_number(col(c), decimals), F.lit("%"))


# -- exact rounding of ratios ------------------------------------------------

_D0 = DecimalType(38, 0)


def scaled_int(c: str | Column, scale: int) -> Column:
    """An exact DECIMAL/integer value times 10^scale as DECIMAL(38,0).

    ``c`` must carry at most ``scale`` decimals (money 2, scores 4)."""
    return (col(c).cast(DecimalType(38 - scale, scale)) * F.lit(10 ** scale).cast(DecimalType(scale + 1, 0))
            ).cast(_D0)


def round_ratio(num_int: Column, den_int: Column, dp: int) -> Column:
    """Half-even rounding of ``num_int / den_int`` to ``dp`` decimals, exact.

    Both arguments are integer-valued.  The quotient is a DECIMAL with 18
    decimals: a terminating tie (e.g. 0.025) is represented exactly and
    rounds half-to-even on the true value, and a non-tie quotient differs
    from a tie by at least 1 / (2 den), far above the 1e-18 resolution
    (exact for |num| < 1e20, den < 1e13).  A zero denominator gives null.
    """
    q = F.try_divide(num_int.cast(DecimalType(20, 0)), den_int.cast(DecimalType(17, 0)))
    return F.bround(q, dp).cast("double")


def round_avg(sum_exact: Column, count: Column, scale: int, dp: int) -> Column:
    """Exact half-even ``round(sum / count, dp)`` for a DECIMAL sum of ``scale``
    (quotient carried with >= 16 decimals; exact for counts < 1e13)."""
    q = F.try_divide(sum_exact.cast(DecimalType(24, scale)), count.cast(DecimalType(14, 0)))
    return F.bround(q, dp).cast("double")


def round_pct(part_exact: Column, whole_exact: Column, scale: int, dp: int) -> Column:
    """Exact half-even ``round(part / whole * 100, dp)`` (18-decimal quotient;
    exact for |whole| < 1e13 units of the last decimal)."""
    num = (part_exact.cast(DecimalType(17, scale)) * F.lit(100).cast(DecimalType(3, 0))).cast(DecimalType(20, scale))
    q = F.try_divide(num, whole_exact.cast(DecimalType(16, scale)))
    return F.bround(q, dp).cast("double")
