"""Exact data-quality profile of every column, by load.

Method: columns are unpivoted to (load, column, value) counts, which a map-side combine shrinks
before the one shuffle; frequencies, distinct counts, ranges and medians come from these counts,
and loads are compared with all loads by population stability index and chi-square.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayledger.session import materialize

VERSION_PATTERN = r"\AV\d{2}\.\d{2}\.\d{3}\z"


@dataclass(frozen=True)
class ProfileRules:
    """Ranges and patterns of columns, and the bounds beyond which a load is named."""

    ranges: Mapping[str, tuple[float, float]] = field(default_factory=lambda: {"latitude": (-90.0, 90.0), "rx_level": (-120.0, -30.0)})
    patterns: Mapping[str, str] = field(default_factory=lambda: {"protocol_version": VERSION_PATTERN})
    constants: tuple[str, ...] = ("rx_level",)
    medians: Mapping[str, float] = field(default_factory=lambda: {"rx_level": 10.0})
    shares: Mapping[str, float] = field(default_factory=lambda: {"protocol_version": 0.5})
    null_excess: float = 0.15
    violation_share: float = 0.06
    constant_share: float = 0.5


def value_counts(df: DataFrame, columns: Sequence[str], load: str = "batch_id") -> DataFrame:
    """(load, column_name, value, n): exact counts of every value as text, null included.

    Text and number share one column; ``-0.0`` and ``0.0`` count as one value, NaN is a value.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def text(c: str):
        col = F.col(f"`{c}`")
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            col = F.when(col == 0, F.lit(0.0)).otherwise(col)
        return (F.to_json(F.struct(col.alias("v"))) if isinstance(kinds[c], (T.ArrayType, T.MapType, T.StructType)) else col).cast("string")

    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in columns])
    long = df.select(F.col(f"`{load}`").cast("string").alias("load"), F.explode(cells).alias("cell"))
    return long.groupBy("load", "cell.column_name", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def _checked(counts: DataFrame, rules: ProfileRules, numeric: Sequence[str]) -> DataFrame:
    """Counts with the value as a number (of numeric columns) and whether it breaks its rule."""
    num = F.when(F.col("column_name").isin(*numeric), F.expr("try_cast(value as double)"))
    bad = F.lit(False)
    for c, (lo, hi) in rules.ranges.items():
        bad = F.when(F.col("column_name") == c, ~F.coalesce(F.col("num").between(lo, hi), F.lit(False))).otherwise(bad)
    for c, p in rules.patterns.items():
        bad = F.when(F.col("column_name") == c, ~F.col("value").rlike(p)).otherwise(bad)
    return counts.withColumn("num", num).withColumn("bad", F.col("value").isNotNull() & bad)


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str], prefix: str):
    """Whether the keys of two tables are the same, those of the second renamed with a prefix."""
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[f"{prefix}{k}"])
    return same


def exact_quantiles(counts: DataFrame, keys: list[str], fractions: Sequence[float]) -> DataFrame:
    """(keys, quantiles): exact quantiles of the values in range, from counts; the keys have column_name.

    The quantile of a fraction f of n values is the one at place ceil(f n) in order, for an even n
    and f of one half the mean of that and the next. Each column's values are put into bins between
    approximate quantiles of its distinct values, and are ranked within the bins that hold a place
    asked for, after the bins' own totals: no task ranks a whole column, and the bins
    don't show in the result.
    """
    ok = counts.where("num is not null and not isnan(num) and not bad").groupBy(*keys, "num").agg(F.sum("n").alias("n"))
    edges = ok.groupBy("column_name").agg(F.percentile_approx("num", [i / 256 for i in range(1, 256)], 2000).alias("edges")).withColumnRenamed("column_name", "e_column")
    ok = ok.join(edges, F.col("column_name") == F.col("e_column")).withColumn("bin", F.size(F.filter("edges", lambda x: x < F.col("num")))).drop("edges", "e_column")
    bins = ok.groupBy(*keys, "bin").agg(F.sum("n").alias("bin_n"))
    over = Window.partitionBy(*keys)
    bins = bins.withColumn("below", F.sum("bin_n").over(over.orderBy("bin")) - F.col("bin_n")).withColumn("all_n", F.sum("bin_n").over(over))
    place = lambda f: F.greatest(F.lit(1), F.ceil(F.lit(f) * F.col("all_n") - 1e-9))
    places = [place(f) for f in fractions] + [F.floor((F.col("all_n") + 2) / 2)]  # the upper middle
    asked = F.array(*places)
    middle = bins.withColumn("asked", F.filter(asked, lambda k: (k > F.col("below")) & (k <= F.col("below") + F.col("bin_n")))).where(F.size("asked") > 0).drop("asked").withColumnsRenamed({k: f"m_{k}" for k in [*keys, "bin"]})
    upto = F.col("below") + F.sum("n").over(Window.partitionBy(*keys, "bin").orderBy("num"))
    cum = ok.join(middle, _null_safe(ok, middle, [*keys, "bin"], "m_")).withColumn("upto", upto)
    at = [F.min(F.when(F.col("upto") >= k, F.col("num"))) for k in places]
    values = [(a + at[-1]) / 2 if f == 0.5 else a for f, a in zip(fractions, at, strict=False)]
    return cum.groupBy(*keys).agg(F.array(*values).alias("quantiles"))


def drift_bins(counts: DataFrame, edges: DataFrame | None = None, widths: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """(load, column_name, value, n): counts of bins instead of values, nulls left out.

    Texts are their own bins. Numbers are binned by ``widths`` (start and width by column), else by
    ``edges`` (column_name, quantiles of all loads): the number of edges below the value.
    """
    rows = counts.where("value is not null")
    if widths is not None:
        bin_ = F.col("value")
        for c, (lo, w) in widths.items():
            bin_ = F.when(F.col("column_name") == c, F.floor((F.col("num") - lo) / w).cast("string")).otherwise(bin_)
    else:
        rows = rows.join(edges.select(F.col("column_name").alias("e_column"), "quantiles"), F.col("column_name") == F.col("e_column"), "left")
        number = F.size(F.filter("quantiles", lambda x: x < F.col("num"))).cast("string")
        bin_ = F.when(F.col("quantiles").isNull() | F.col("num").isNull(), F.col("value")).when(F.isnan("num"), "NaN").otherwise(number)
    return rows.select("load", "column_name", bin_.alias("value"), "n").groupBy("load", "column_name", "value").agg(F.sum("n").alias("n"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, load: str = "batch_id", rules: ProfileRules | None = None, drift: bool = True) -> DataFrame:
    """One row per load and column; without ``drift`` the loads aren't compared.

    n_rows, n_null, null_rate, n_distinct, min/max (as text), min/max/mean as number, top value
    and its share, n_bad (range or pattern violations), psi and chi_square against all loads, of
    texts by value and of numbers by the deciles of all loads' values in range.
    Columns without any value have zero distincts and null ranges; an empty table has no rows.
    """
    rules = rules or ProfileRules()
    columns = list(columns or [c for c in df.columns if c != load])
    numeric = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, T.NumericType)]
    counts = materialize(_checked(value_counts(df, columns, load), rules, numeric), "counts")
    known = F.col("value").isNotNull()
    base = counts.groupBy("load", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_null"),
        F.count_if(known).alias("n_distinct"),
        F.min("value").alias("min_text"),
        F.max("value").alias("max_text"),
        F.min("num").alias("min_number"),
        F.max("num").alias("max_number"),
        (F.sum(F.col("num") * F.col("n")) / F.sum(F.when(F.col("num").isNotNull(), F.col("n")))).alias("mean_number"),
        F.max(F.when(known, F.struct("n", "value"))).alias("top"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("n_bad"),
    )
    share = F.col("n_null") / F.col("n_rows")
    cols = [
        F.col("load").alias("batch_id"), "column_name", "n_rows", "n_null", share.alias("null_rate"), "n_distinct", "min_text", "max_text", "min_number", "max_number", "mean_number",
        F.col("top.value").alias("top_value"), (F.col("top.n") / (F.col("n_rows") - F.col("n_null"))).alias("top_share"), "n_bad",
    ]
    if not drift:
        return base.select(*cols)
    deciles = exact_quantiles(counts, ["column_name"], [i / 10 for i in range(1, 10)])
    shift = compare_loads(drift_bins(counts, deciles))
    joined = base.join(shift, (base.column_name == shift.d_column) & base["load"].eqNullSafe(shift.d_load), "left")
    return joined.select(*cols, F.coalesce("psi", F.lit(0.0)).alias("psi"), F.coalesce("chi_square", F.lit(0.0)).alias("chi_square"))


def compare_loads(counts: DataFrame) -> DataFrame:
    """PSI and chi-square of each load's bins against those of all loads.

    ``counts`` has load, column_name, value (a bin, never null) and n. Bins that a load lacks enter
    through the remainder: their expected counts add to chi-square, and to PSI with a share of
    one in a million for all of them.
    """
    eps = 1e-6
    by_bin = counts.groupBy("column_name", "value").agg(F.sum("n").alias("n_all"))
    totals = counts.groupBy("load", "column_name").agg(F.sum("n").alias("load_n"))
    sums = totals.groupBy("column_name").agg(F.sum("load_n").alias("col_n"))
    t = totals.join(sums, "column_name").select(F.col("load").alias("t_load"), F.col("column_name").alias("t_col"), "load_n", "col_n")
    v = counts.join(by_bin, ["column_name", "value"])
    j = v.join(t, (v.column_name == t.t_col) & v["load"].eqNullSafe(t.t_load))
    p, q = F.col("n") / F.col("load_n"), F.col("n_all") / F.col("col_n")
    e = F.col("n_all") * F.col("load_n") / F.col("col_n")
    g = j.groupBy("t_load", "t_col").agg(F.sum((p - q) * F.log(p / q)).alias("psi_seen"), F.sum((F.col("n") - e) * (F.col("n") - e) / e).alias("chi_seen"), F.sum(q).alias("q_seen"), F.max("load_n").alias("ln"))
    rest = F.greatest(F.lit(0.0), 1 - F.col("q_seen"))
    psi = F.col("psi_seen") + F.when(rest > eps, (F.lit(eps) - rest) * F.log(F.lit(eps) / rest)).otherwise(0.0)
    return g.select(F.col("t_load").alias("d_load"), F.col("t_col").alias("d_column"), psi.alias("psi"), (F.col("chi_seen") + rest * F.col("ln")).alias("chi_square"))


def least_psi(gap: float) -> float:
    """The least PSI of two distributions in which some value's shares differ by ``gap``.

    Merging all other values never adds to PSI, and of two values it is least about one half.
    """
    return gap * math.log(((1 + gap) / (1 - gap)) ** 2) if gap < 1 else math.inf


def load_findings(df: DataFrame, columns: Sequence[str] = ("latitude", "rx_level", "protocol_version"), load: str = "batch_id", rules: ProfileRules | None = None) -> DataFrame:
    """(batch_id, column_name, finding): the loads in which a column went wrong.

    null_rate, out_of_range, pattern, constant and distribution, as ``ProfileRules`` bounds them,
    each judged on the exact value counts. A load of only nulls can only have null_rate.

    ``distribution`` goes by PSI and chi-square of the load against all loads, and then by the exact
    bound: a share can only differ by the bound where PSI is at least ``least_psi`` of it, and a
    median only where chi-square over bins as wide as the bound isn't zero.
    """
    r = rules or ProfileRules()
    numeric = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, T.NumericType)]
    counts = materialize(_checked(value_counts(df, columns, load), r, numeric), "counts")
    known = F.col("value").isNotNull()
    by = counts.groupBy("load", "column_name").agg(F.sum("n").alias("rows"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("vals"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bads"), F.max(F.when(known, F.col("n"))).alias("top"))
    all_nulls = Window.partitionBy("column_name")
    by = by.withColumn("null_all", 1 - F.sum("vals").over(all_nulls) / F.sum("rows").over(all_nulls))
    c = F.col("column_name")
    over = lambda a, b, s: F.coalesce(F.col(a) > s * F.col(b), F.lit(False))
    simple = by.select(
        "load",
        "column_name",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(1 - F.col("vals") / F.col("rows") - F.col("null_all") > r.null_excess, F.lit("null_rate")),
                    F.when(c.isin(*r.ranges) & over("bads", "vals", r.violation_share), F.lit("out_of_range")),
                    F.when(c.isin(*r.patterns) & over("bads", "vals", r.violation_share), F.lit("pattern")),
                    F.when(c.isin(*r.constants) & over("top", "vals", r.constant_share), F.lit("constant")),
                )
            )
        ).alias("finding"),
    )
    widths = {k: (r.ranges.get(k, (0.0, 0.0))[0], b) for k, b in r.medians.items()}
    judged = counts.where(c.isin(*r.shares, *r.medians) & known & ~(c.isin(*r.medians) & (F.col("bad") | F.col("num").isNull())))
    drift = materialize(compare_loads(drift_bins(judged, widths=widths)), "drift")
    bound = F.lit(None).cast("double")
    for k, b in r.shares.items():
        bound = F.when(F.col("d_column") == k, F.lit(least_psi(b) - 1e-3)).otherwise(bound)
    suspects = drift.where(F.when(F.col("d_column").isin(*r.medians), F.col("chi_square") > 1e-9).otherwise(F.col("psi") >= bound)).select("d_load", "d_column")
    of_suspects = lambda df: df.join(suspects, df["load"].eqNullSafe(suspects.d_load) & (df.column_name == suspects.d_column), "left_semi")
    # medians
    mc = counts.where(c.isin(*r.medians))
    median = lambda df, keys: exact_quantiles(df, keys, [0.5]).withColumn("median", F.col("quantiles")[0])
    whole = median(mc, ["column_name"]).select(F.col("column_name").alias("w_col"), F.col("median").alias("w_med"))
    bound = F.lit(None).cast("double")
    for k, b in r.medians.items():
        bound = F.when(c == k, F.lit(b)).otherwise(bound)
    med = median(of_suspects(mc), ["load", "column_name"]).join(whole, c == F.col("w_col")).where(F.abs(F.col("median") - F.col("w_med")) > bound).select("load", "column_name")
    # shares: also of values that a load lacks, hence loads x values of a column
    sc = counts.where(c.isin(*r.shares) & known)
    col_n = sc.groupBy("column_name").agg(F.sum("n").alias("col_n"))
    val_q = sc.groupBy("column_name", "value").agg(F.sum("n").alias("val_n")).join(col_n, "column_name").select("column_name", "value", (F.col("val_n") / F.col("col_n")).alias("q"))
    load_n = sc.groupBy("load", "column_name").agg(F.sum("n").alias("load_n")).withColumnsRenamed({"load": "l_load", "column_name": "l_col"})
    common = val_q
    s = of_suspects(sc).join(val_q, ["column_name", "value"]).join(load_n, sc["load"].eqNullSafe(F.col("l_load")) & (F.col("column_name") == F.col("l_col"))).withColumn("p", F.col("n") / F.col("load_n"))
    least = F.lit(None).cast("double")
    for k, b in r.shares.items():
        least = F.when(c == k, F.lit(b)).otherwise(least)
    off = s.where(F.abs(F.col("p") - F.col("q")) > least).select("load", "column_name")
    # a value with more than the bound of all loads is at most one per column; loads without it differ too
    common = common.where(F.col("q") > least).select("column_name", "value")
    have = s.join(common, ["column_name", "value"], "left_semi").select("load", "column_name", "value").withColumnsRenamed({"load": "h_load", "column_name": "h_col", "value": "h_val"})
    loads = s.select("load", "column_name").distinct().join(common, "column_name")
    lack = loads.join(have, loads["load"].eqNullSafe(have.h_load) & (loads.column_name == have.h_col) & (loads.value == have.h_val), "left_anti").select("load", "column_name")
    shifted = med.unionByName(off).unionByName(lack).distinct().withColumn("finding", F.lit("distribution"))
    return simple.unionByName(shifted).withColumnRenamed("load", "batch_id")
