"""Whole-table and per-group statistics as distributed Spark plans.

* ``quantiles``: linear-interpolated quantiles (numpy ``linear`` /
  DuckDB ``quantile_cont``).  Two exact strategies:

  - ``bounded=True``: columns on a bounded grid (4-dp scores in [0, 1] have
    at most 10,001 values) are counted per distinct value first; one
    ``percentile`` with frequencies then works on a table of that size.
  - otherwise two passes.  ``percentile_approx`` gives for each wanted rank
    a bracket of values that must hold it (its rank error is bounded); the
    second pass counts what lies below the bracket and keeps counts per
    distinct value inside it, and the rank is picked there.  Nothing depends
    on how rows are partitioned; a rank outside its bracket would fail the
    job instead of giving a wrong value.

* ``top_k_sums``: exact sum of the k largest values, tie-safe, from the
  k-th largest value ``t``: sum(v > t) + (k - count(v > t)) * t.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from . import exprs as X


def scalars(one_row: DataFrame) -> dict[str, Column]:
    """The columns of a one-row frame (a global aggregate) as fields of ONE
    scalar subquery: the statistics are computed once, used as literals, and
    reach every row without a join."""
    cols = one_row.columns
    row = one_row.select(F.struct(*cols).alias("_r")).scalar()
    return {c: row.getField(c) for c in cols}


def one_row(spark, cols: dict[str, Column]) -> DataFrame:
    """A one-row frame holding the given scalar expressions."""
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()])


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match (a null group is a group)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


#: Of ``percentile_approx``: ranks are right within n / ACCURACY.  A bracket
#: then holds a few ten-thousandths of all values: of 10^7 different ones the
#: task that ranks it sees fewer than 10,000.
ACCURACY = 20_000


def _order_stats(df: DataFrame, value: str, by: Sequence[str], probs: Mapping[str, float], targets) -> DataFrame:
    """Values at given 0-based ascending ranks, per group.

    ``probs``: name -> about which share of the values lies below;
    ``targets(n)`` maps the per-group count column to a list of
    ``(name, part, rank_column)`` with ranks within one of that share of
    n - 1.  Returns ``by + [_n, _name, _part, _rank, _v]`` rows.
    """
    by, names = list(by), list(probs)
    v = F.col(value)
    d = df.where(v.isNotNull()).select(*by, v.alias("_v"))
    edge = 2.0 / ACCURACY
    shares = [F.lit(min(1.0, max(0.0, probs[n] + side * edge))) for n in names for side in (-1, 1)]
    ends = (d.groupBy(*by) if by else d).agg(F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                                              F.percentile_approx("_v", F.array(*shares), ACCURACY).alias("_q"))
    # few values: the ends of the whole range, so that neighbouring ranks lie inside
    small = F.col("_n") < 4 * ACCURACY
    bracket = F.array(*[F.struct(F.lit(i).alias("i"), F.when(small, F.col("_min")).otherwise(F.col("_q")[2 * i]).alias("lo"),
                                 F.when(small, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias("hi")) for i in range(len(names))])
    ends = ends.select(*by, "_n", bracket.alias("_b"))
    if by:
        j = _join_null_safe(d, ends, by)
    else:
        sc = scalars(ends)
        j = d.select("_v", sc["_n"].alias("_n"), sc["_b"].alias("_b"))
    # what lies below a bracket is counted under null, which sorts first
    hits = F.transform(F.filter("_b", lambda x: F.col("_v") <= x["hi"]),
                       lambda x: F.struct(x["i"].alias("i"), F.when(F.col("_v") >= x["lo"], F.col("_v")).alias("v")))
    counted = (j.select(*by, "_n", "_v", F.explode(hits).alias("_h"))
               .groupBy(*by, "_n", F.col("_h.i").alias("_i"), F.col("_h.v").alias("_v")).agg(F.count("*").alias("_c")))
    w = Window.partitionBy(*by, "_i").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_c").over(w))
    tg = targets(F.col("_n"))
    arr = F.array(*[F.struct(F.lit(names.index(n)).alias("i"), F.lit(part).alias("part"), r.cast("bigint").alias("rank")) for n, part, r in tg])
    inside = F.filter(arr, lambda t: (t["i"] == F.col("_i")) & (t["rank"] >= F.col("_upto") - F.col("_c")) & (t["rank"] < F.col("_upto")))
    label = F.array(*[F.lit(n) for n in names])
    found = F.when(F.col("_v").isNull(), F.raise_error(F.lit("a rank lies outside its bracket"))).otherwise(F.col("_v"))
    return (upto.select(*by, "_n", "_i", "_v", F.explode(inside).alias("_t"))
            .select(*by, "_n", F.element_at(label, F.col("_i") + 1).alias("_name"), F.col("_t.part").alias("_part"),
                    F.col("_t.rank").alias("_rank"), found.alias("_v")))


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
              bounded: bool = False, scale: int | None = None) -> DataFrame:
    """One row per group with one column per named probability.

    Linear interpolation between order statistics (numpy default, pandas
    ``quantile``, DuckDB ``quantile_cont``).  Nulls are ignored.  With
    ``scale`` (values on a fixed decimal grid, e.g. 2-dp money) the rank and
    the interpolation are exact DECIMALs, so a median halfway between two
    cents is exactly x.xx5 and later half-even rounding is decided on the
    true value; the result is then DECIMAL.
    """
    by = list(by)
    names = list(probs)
    if bounded and scale is None:
        counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
        arr = F.percentile(F.col(value), F.array(*[F.lit(float(probs[n])) for n in names]), F.col("_c"))
        agg = (counted.groupBy(*by) if by else counted.groupBy()).agg(arr.alias("_q"))
        return agg.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

    def rank(n: Column, p: float) -> Column:
        if scale is None:
            return (n - 1).cast("double") * F.lit(float(p))
        return (n - 1).cast(DecimalType(20, 0)) * X.dlit(format(p, ".8f"), 10, 8)

    def targets(n: Column):
        return [(nm, part, f(rank(n, probs[nm]))) for nm in names for part, f in (("lo", F.floor), ("hi", F.ceil))]

    hit = _order_stats(df, value, by, probs, targets)
    aggs = []
    for nm in names:
        here = F.col("_name") == nm
        lo = F.max(F.when(here & (F.col("_part") == "lo"), F.col("_v")))
        hi = F.max(F.when(here & (F.col("_part") == "hi"), F.col("_v")))
        rn = F.max(F.when(here, rank(F.col("_n"), probs[nm])))
        frac = rn - F.floor(rn)
        if scale is None:
            lo_d, hi_d = lo.cast("double"), hi.cast("double")
            aggs.append(F.when(frac == 0, lo_d).otherwise(lo_d + (hi_d - lo_d) * frac).alias(nm))
        else:
            lo_d, hi_d = lo.cast(DecimalType(18, scale)), hi.cast(DecimalType(18, scale))
            aggs.append((lo_d + (hi_d - lo_d) * frac).alias(nm))
    return (hit.groupBy(*by) if by else hit.groupBy()).agg(*aggs)


def lowest(df: DataFrame, value: str, share: float, by: Sequence[str] = ()) -> DataFrame:
    """Per group ``_t``: the value of rank ceil(share * n), so that so many
    rows (more at ties) are not above it."""
    hit = _order_stats(df, value, by, {"t": share}, lambda n: [("t", "t", F.ceil(n * F.lit(share)) - 1)])
    return hit.select(*by, F.col("_v").alias("_t"))


def quantile_row(df: DataFrame, value: str, probs: Mapping[str, float], bounded: bool = False) -> DataFrame:
    """Whole-table quantiles as a single row (empty input -> nulls)."""
    # A global aggregation always yields exactly one row (nulls if empty).
    return quantiles(df, value, probs, (), bounded)


def top_k_sums(df: DataFrame, value: str, fractions: Mapping[str, float], scale: int = 2) -> DataFrame:
    """Sums of the k = max(1, int(n * fraction)) largest values (tie-safe),
    for several fractions at once: one order-statistic search for all k-th
    values, then one pass summing above each threshold.

    Returns one row: ``k_<name>``, ``top_<name>`` (double from an exact sum).
    """
    names = list(fractions)

    def targets(n: Column):
        return [(nm, "t", n - F.greatest(F.lit(1), F.floor(n.cast("double") * F.lit(float(fractions[nm])))))
                for nm in names]

    hit = _order_stats(df, value, [], {nm: 1.0 - fractions[nm] for nm in names}, targets)
    kt = hit.agg(*[F.max(F.when(F.col("_name") == nm, F.col("_n") - F.col("_rank"))).alias(f"k_{nm}")
                   for nm in names],
                 *[F.max(F.when(F.col("_name") == nm, F.col("_v"))).alias(f"t_{nm}") for nm in names])
    sc = scalars(kt)
    # thresholds are projected first (an aggregate may not take a subquery)
    j = df.select(F.col(value).alias("_v"), *[sc[f"t_{nm}"].alias(f"t_{nm}") for nm in names])
    v = F.col("_v")
    aggs = []
    for nm in names:
        t = F.col(f"t_{nm}")
        aggs += [F.sum(F.when(v > t, X.dec(v, scale))).alias(f"_above_{nm}"),
                 X.count_if(v > t).alias(f"_n_{nm}"), F.max(t).alias(f"_t_{nm}")]
    s = j.agg(*aggs)
    out = []
    for nm in names:
        k = sc[f"k_{nm}"]
        top = (F.coalesce(F.col(f"_above_{nm}"), F.lit(0).cast("decimal(18,0)"))
               + (k - F.col(f"_n_{nm}")).cast("decimal(20,0)") * X.dec(F.col(f"_t_{nm}"), scale))
        out += [k.alias(f"k_{nm}"), top.cast("double").alias(f"top_{nm}")]
    return s.select(*out)


def top_k_sum(df: DataFrame, value: str, fraction: float, scale: int = 2) -> DataFrame:
    """Sum of the k = max(1, int(n * fraction)) largest values: one row
    ``k``, ``top_sum``."""
    r = top_k_sums(df, value, {"x": fraction}, scale)
    return r.select(F.col("k_x").alias("k"), F.col("top_x").alias("top_sum"))


#: Ranges of a probability in which positives and negatives are ranked apart.
_RANGES = 4096


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row ``n, n_positive, auc``: the exact area under the ROC curve of
    a probability, as a rank sum in which ties count half (null without both
    classes).

    Rows are counted per distinct score; running counts are taken within
    ranges of the score, and the ranges' totals (at most _RANGES + 1) are
    added: no distinct score is ranked in one task with all others.  All sums
    are whole numbers.
    """
    d = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    at = d.groupBy(F.floor(F.col(score) * F.lit(float(_RANGES))).alias("_r"), F.col(score).alias("_s")).agg(
        F.sum(F.col(label).cast("long")).alias("_p"), F.sum(1 - F.col(label).cast("long")).alias("_q"))
    whole = at.groupBy("_r").agg(F.sum("_q").alias("_all"))
    before = whole.withColumn("_below", F.coalesce(F.sum("_all").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("_q").over(Window.partitionBy("_r").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = at.withColumn("_in", inside).join(before.select(F.col("_r").alias("_b"), "_below"), F.col("_r") == F.col("_b"))
    wins = F.sum((F.col("_p") * 2).cast("decimal(20,0)") * (F.col("_below") + F.col("_in")).cast("decimal(18,0)")
                 + F.col("_p").cast("decimal(20,0)") * F.col("_q").cast("decimal(18,0)"))
    p, q = F.sum("_p"), F.sum("_q")
    return j.agg(F.coalesce(p + q, F.lit(0)).alias("n"), F.coalesce(p, F.lit(0)).alias("n_positive"),
                 F.when((p > 0) & (q > 0), wins.cast("double") / (p.cast("double") * q.cast("double") * 2)).alias("auc"))


def fit_quality(df: DataFrame, predicted: str, actual: str, scale: int = 2) -> DataFrame:
    """One row ``n, r2, mae``, from exact decimal sums of values rounded to
    ``scale`` places (r2 is null where all actual values are equal)."""
    y, p = X.dec(F.col(actual), scale), X.dec(F.col(predicted), scale)
    unit = 10 ** scale
    whole = lambda c: (c * unit).cast("decimal(18,0)")
    d = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).select(whole(y).alias("_y"), whole(p).alias("_p"))
    e = F.col("_y") - F.col("_p")
    s = d.agg(F.count("*").alias("n"), F.sum("_y").alias("sy"), F.sum(F.col("_y") * F.col("_y")).alias("yy"), F.sum(e * e).alias("ee"), F.sum(F.abs(e)).alias("ae"))
    n = F.col("n").cast("decimal(12,0)")
    sst = (n * F.col("yy").cast("decimal(26,0)")) - F.col("sy").cast("decimal(19,0)") * F.col("sy").cast("decimal(19,0)")
    sse = n * F.col("ee").cast("decimal(26,0)")
    return s.select("n", F.when(sst > 0, 1 - sse.cast("double") / sst.cast("double")).alias("r2"),
                    F.when(F.col("n") > 0, F.col("ae").cast("double") / F.lit(float(unit)) / F.col("n").cast("double")).alias("mae"))


def five_numbers(df: DataFrame, value: str, by: Sequence[str] = (), bounded: bool = False,
                 prefix: str = "", scale: int | None = None) -> DataFrame:
    """min, q1, median, q3, max per group (box-plot statistics)."""
    by = list(by)
    q = quantiles(df, value, {f"{prefix}q1": 0.25, f"{prefix}median": 0.5, f"{prefix}q3": 0.75}, by,
                  bounded, scale)
    mm = (df.groupBy(*by) if by else df.groupBy()).agg(
        F.min(value).cast("double").alias(f"{prefix}min"), F.max(value).cast("double").alias(f"{prefix}max"),
        F.count(value).alias(f"{prefix}n"))
    if not by:
        return mm.select("*", *[c.alias(name) for name, c in scalars(q).items()])
    return _join_null_safe(mm, q, by, "left")


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over the whole column's [min, max] range.

    Bin ``i`` covers [lo + i*w, lo + (i+1)*w), the last bin is closed; a
    constant column falls into bin 0.  Rows: by + bin, bin_start, bin_end, count.
    """
    by = list(by)
    v = F.col(value).cast("double")
    rng = scalars(df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")))  # one subquery
    j = df.where(F.col(value).isNotNull()).select(*by, v.alias("_x"), rng["_lo"].alias("_lo"), rng["_hi"].alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width * F.lit(float(bins))), F.lit(bins - 1))).cast("int")
    out = j.groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select(*by, "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"), "count")


def stable_sample(df: DataFrame, n: int, seed: int, key: str = "customer_id") -> DataFrame:
    """Deterministic sample of n rows: the same rows for any partitioning.

    Rows are ranked by the MD5 of the key and the seed; the limit is the
    feature (a sampling operator), so a TakeOrderedAndProject of n rows is
    the intended plan.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
