"""Exact quantiles without an unbounded buffer.

An approximate pass brackets each quantile's rank; a second pass counts the
values below the bracket and keeps, as value -> count, only those inside it,
whose running counts give the exact ranks. A bracket holds a share of the rows, so
for event-sized tables ``cells`` narrows it: its values are counted by cells of
equal width, and only those in the cells that hold the ranks are put in order.
Works alike at every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

ACCURACY = 10_000
#: Half the width of a bracket, as a share of the rows; wider than the error of
#: the approximate pass (1 / ACCURACY).
MARGIN = 5e-4
#: Cells of a bracket for tables with a row for each event.
CELLS = 4096


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] | None = None, cells: int = 0) -> DataFrame:
    """keys and ``quantiles``, the linearly interpolated quantiles of the
    non-null values of ``value`` at ``probs``, one row for each key. With ``cells``
    only the values of two cells of a bracket at most meet in one task."""
    keys = keys or []
    rows = df.select(*keys, F.col(value).cast("double").alias("_quantile_v")).filter("_quantile_v is not null")
    edges = [min(1.0, max(0.0, p + side)) for p in probs for side in (-MARGIN, MARGIN)]
    stats = rows.groupBy(*keys).agg(F.count("*").alias("_quantile_n"), F.percentile_approx("_quantile_v", edges, ACCURACY).alias("_quantile_e"), F.min("_quantile_v").alias("_quantile_lo"), F.max("_quantile_v").alias("_quantile_hi"))
    # a margin of less than two ranks could miss the neighbour: then all values are inside
    few = F.col("_quantile_n") * MARGIN < 2
    spans = F.array(*[F.struct(F.lit(k).alias("k"), F.when(few | F.lit(p <= MARGIN), F.col("_quantile_lo")).otherwise(F.col("_quantile_e")[2 * k]).alias("a"),
                               F.when(few | F.lit(p >= 1 - MARGIN), F.col("_quantile_hi")).otherwise(F.col("_quantile_e")[2 * k + 1]).alias("b"),
                               (F.lit(p) * (F.col("_quantile_n") - 1)).alias("at")) for k, p in enumerate(probs)])
    stats = stats.select(*[F.col(k).alias(f"_quantile_key{j}") for j, k in enumerate(keys)], spans.alias("_quantile_s"))
    if keys:
        same = F.lit(True)
        for j, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_quantile_key{j}"))
        joined = rows.join(stats, same)
    else:
        joined = rows.crossJoin(F.broadcast(stats))
    each = joined.select(*keys, "_quantile_v", F.explode("_quantile_s").alias("_quantile_e")).filter(F.col("_quantile_v") <= F.col("_quantile_e.b"))
    inside = F.when(F.col("_quantile_v") >= F.col("_quantile_e.a"), F.col("_quantile_v"))  # null stands for all below the bracket
    ends = [F.col(f"_quantile_e.{c}").alias(f"_quantile_{c}") for c in "ab"] if cells else []
    counts = each.groupBy(*keys, F.col("_quantile_e.k").alias("_quantile_k"), F.col("_quantile_e.at").alias("_quantile_at"), *ends, inside.alias("_quantile_v")).agg(F.count("*").alias("_quantile_c"))
    low, high = F.floor("_quantile_at"), F.ceil("_quantile_at")
    holds = lambda r: (F.col("_quantile_upto") > r) & (F.col("_quantile_upto") - F.col("_quantile_c") <= r)
    before, of = F.lit(0), [*keys, "_quantile_k"]
    if cells:
        counts = _held_cells(counts, keys, cells, holds(low) | holds(high))
        before, of = F.col("_quantile_before"), [*of, "_quantile_cell"]
    w = Window.partitionBy(*of).orderBy(F.asc_nulls_first("_quantile_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_quantile_upto", before + F.sum("_quantile_c").over(w)).filter("_quantile_v is not null")
    found = ranked.groupBy(*keys, "_quantile_k", "_quantile_at").agg(F.max(F.when(holds(low), F.col("_quantile_v"))).alias("_quantile_x"), F.max(F.when(holds(high), F.col("_quantile_v"))).alias("_quantile_y"))
    found = found.withColumn("_quantile_q", F.col("_quantile_x") + (F.col("_quantile_at") - F.floor("_quantile_at")) * (F.col("_quantile_y") - F.col("_quantile_x")))
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_quantile_k", "_quantile_q"))), lambda s: s["_quantile_q"]).alias("quantiles"))


def _held_cells(counts: DataFrame, keys: list[str], cells: int, held) -> DataFrame:
    """The rows of counts whose cell of the bracket holds a wanted rank, with the
    number of values before the cell. What is below the bracket is a cell of its own;
    brackets without a finite width have one cell for what can't be placed."""
    width = F.col("_quantile_b") - F.col("_quantile_a")
    share = F.when(width == 0, 0.0).otherwise((F.col("_quantile_v") - F.col("_quantile_a")) / width)
    cell = F.when(F.col("_quantile_v").isNull(), -1).otherwise(F.least(F.floor(F.nanvl(share, F.lit(1.0)) * cells), F.lit(cells - 1)))
    counts = counts.withColumn("_quantile_cell", cell.cast("int"))
    w = Window.partitionBy(*keys, "_quantile_k").orderBy("_quantile_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.groupBy(*keys, "_quantile_k", "_quantile_at", "_quantile_cell").agg(F.sum("_quantile_c").alias("_quantile_c"))
    chosen = totals.withColumn("_quantile_upto", F.sum("_quantile_c").over(w)).filter(held)
    own = [*keys, "_quantile_k", "_quantile_cell"]
    chosen = chosen.select(*[F.col(c).alias(f"_quantile_held{j}") for j, c in enumerate(own)], (F.col("_quantile_upto") - F.col("_quantile_c")).alias("_quantile_before"))
    same = F.lit(True)
    for j, c in enumerate(own):
        same = same & F.col(c).eqNullSafe(F.col(f"_quantile_held{j}"))
    return counts.join(chosen, same).drop(*[f"_quantile_held{j}" for j in range(len(own))])
