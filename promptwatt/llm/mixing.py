"""Mixing sources to target weights (operator 6), in DataFrame operations only.

With p the shares of the sources' tokens, the weights are w = p^a / sum(p^a).
The exponent a in [0, 1] is found by bisection (each pass cuts the bracket into
SECTIONS parts at once, so a few passes settle it): the largest a whose entropy
reaches the target share of the highest possible entropy, raised if need be until
no source is seen more than `max_repeats` times. The budget is a number of
tokens; by default the least one at which every source is seen once in full, so
that mixing drops no document.

Realisation: every source is cut into BLOCKS blocks by a hash of the document,
and each epoch of a source visits its blocks in a permutation of its own. Whole
epochs take every block; the last, partial one takes a prefix of its permutation,
until the source's share of the budget is used up, and documents of the block on the
border up to the last that still fits. The epochs of a source, one after the other,
are its run, and a row's place is its share of the run: tokens before it over all
tokens of the run. All sources begin at 0 and end at 1, so the rows up to any
place hold the sources at the target weights. A hot source is thus many blocks,
never one group of documents; a window holds the visits of one source (BLOCKS rows
an epoch) or the documents of one border block.

Defined results: null and empty texts have no tokens and come with every whole
epoch; a null source is a source of its own; a source without any tokens is seen
once; repeated rows are documents of their own (ties in an order are broken by
doc_id and text); an empty table gives an empty result; other columns of the
rows are kept, and columns of the same names as outputs do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE_CLASS, stored

TARGET_ENTROPY = 0.9
MAX_REPEATS = 4.0
BLOCKS = 1024
SECTIONS, PASSES = 32, 5
SEED = 17


def word_count(text: Column) -> Column:
    """Words, as runs of anything but the six white-space characters."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SPACE_CLASS}]++", "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    """source, tokens, docs of rows (source, _mix_tokens)."""
    return rows.groupBy("source").agg(F.coalesce(F.sum("_mix_tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("docs"))


def _whole_sum(c: Column) -> Column:
    """A sum of scaled whole numbers, which does not depend on the rows' order."""
    return F.sum(F.round(c * F.lit(1e12)).cast("decimal(38,0)")).cast("double") / F.lit(1e12)


def _at(shares: DataFrame, lo: float, hi: float) -> list:
    """Entropy and repetition at SECTIONS + 1 exponents between lo and hi."""
    x = shares.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(SECTIONS)))).withColumn("a", F.lit(lo) + F.col("k") * F.lit((hi - lo) / SECTIONS))
    x = x.withColumn("q", F.pow("p", F.col("a"))).withColumn("seen", F.col("q") / F.col("p"))
    sums = x.groupBy("k", "a").agg(_whole_sum(F.col("q")).alias("z"), _whole_sum(F.col("q") * F.log("q")).alias("e"), F.count("*").alias("n"), F.max("seen").alias("most"), F.min("seen").alias("least"))
    return sums.select("k", "a", (F.log("z") - F.col("e") / F.col("z")).alias("entropy"), F.log(F.col("n").cast("double")).alias("highest"),
                       (F.col("most") / F.col("least")).alias("repeats"), (F.col("most") / F.col("z")).alias("share")).orderBy("k").collect()


def exponent(shares: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS, ratio: float | None = None) -> float:
    """The exponent for shares (source, p > 0); ratio: the budget in multiples
    of all tokens, None for the least budget that shows every source once."""
    def border(low) -> tuple[float, float]:
        """Bracket in [0, 1] around where low(row) stops to hold."""
        lo, hi = 0.0, 1.0
        for _ in range(PASSES):
            rows = _at(shares, lo, hi)
            if not rows or low(rows[-1]):
                return hi, hi
            if not low(rows[0]):
                return lo, lo
            last = next(r.k for r in rows if not low(r)) - 1
            lo, hi = rows[last].a, rows[last + 1].a
        return lo, hi

    a = border(lambda r: r.entropy >= target_entropy * r.highest - 1e-12)[0]
    if max_repeats is not None:
        a = max(a, border(lambda r: (r.repeats if ratio is None else r.share * ratio) > max_repeats)[1])
    return a


def weights(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """source, tokens, docs, weight, epochs (how often the source is seen) of
    sources (source, tokens, docs)."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    ratio = None if budget is None else budget / max(total, 1)
    if ratio is not None and max_repeats is not None and ratio > max_repeats:
        raise ValueError("the budget needs more repetitions than max_repeats allows")
    shares = stored(sources.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1)))), "mix-shares")
    a = exponent(shares, target_entropy, max_repeats, ratio)
    q = shares.withColumn("q", F.pow("p", F.lit(a)))
    z, least = q.agg(_whole_sum(F.col("q")), F.min(F.col("q") / F.col("p"))).first()
    z, least = z or 1.0, least or 1.0
    seen = q.select("source", "tokens", "docs", (F.col("q") / F.lit(z)).alias("weight"),
                    F.round(F.col("q") / F.col("p") * F.lit(1 / least if ratio is None else ratio / z), 9).alias("epochs"))
    empty = sources.filter("tokens = 0").select("source", "tokens", "docs", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"))
    return seen.unionByName(empty)


def _order(*cols) -> Column:
    return F.xxhash64(F.lit(SEED), *cols)


def counted(docs: DataFrame) -> DataFrame:
    """docs with their tokens and a key of the text, as plan() takes them."""
    return docs.withColumns({"_mix_tokens": word_count(F.col("text")), "_mix_key": F.xxhash64("text"),
                             "_mix_block": F.pmod(_order("doc_id"), F.lit(BLOCKS)).cast("int")})


def block_plan(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """_mix_of (the source), weight, block, size, full (whole epochs), and of the
    last epoch: left (tokens for the block and those after it), whole (takes all)."""
    seen = mixed.select(F.col("source").alias("_mix_of"), "weight", F.floor("epochs").cast("int").alias("full"),
                        F.floor((F.col("epochs") - F.floor("epochs")) * F.col("tokens")).cast("long").alias("rest"))
    blocks = (rows.groupBy("source", F.col("_mix_block").alias("block")).agg(F.sum("_mix_tokens").alias("size"))
              .join(seen, F.col("source").eqNullSafe(F.col("_mix_of"))))
    in_source = Window.partitionBy("source").orderBy(_order("full", "block"), "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.greatest(F.lit(0).cast("long"), F.col("rest") - F.sum("size").over(in_source) + F.col("size"))
    return blocks.withColumn("left", left).select("_mix_of", "weight", "block", "size", "full", "left", ((F.col("left") >= F.col("size")) & (F.col("rest") > 0)).alias("whole"))


def visits(blocks: DataFrame) -> DataFrame:
    """source, epoch, block and the part of the source's run, from `begin`, `width`
    long, that the visit takes."""
    last = F.when(F.col("whole"), F.col("size")).otherwise(F.col("left"))
    number = F.col("full") + (F.col("whole") | (F.col("left") > 0)).cast("int")
    each = blocks.withColumn("last", last).filter(number > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), number)))
    each = each.withColumn("taken", F.when(F.col("epoch") <= F.col("full"), F.col("size")).otherwise(F.col("last")))
    order = Window.partitionBy("_mix_of").orderBy("epoch", _order((F.col("epoch") - 1).cast("int"), "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("taken").over(Window.partitionBy("_mix_of"))
    part = lambda c: F.coalesce(c / F.nullif(whole, F.lit(0)), F.lit(0.0))
    return each.select(F.col("_mix_of").alias("_mix_from"), F.col("epoch").alias("_mix_at"), F.col("block").alias("_mix_visit"),
                       part(F.coalesce(F.sum("taken").over(order), F.lit(0))).alias("begin"), F.when(whole > 0, part(F.col("taken"))).otherwise(1.0).alias("width"))


def plan(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows of counted() with `_mix_copies`, how often each comes, and the
    weight of its source."""
    blocks = block_plan(rows, mixed).select(
        "_mix_of", F.col("block").alias("_mix_of_block"), F.col("weight").alias("_mix_weight"), F.col("full").alias("_mix_full"),
        F.col("left").alias("_mix_left"), F.col("whole").alias("_mix_whole"))
    rows = rows.join(blocks, F.col("source").eqNullSafe(F.col("_mix_of")) & (F.col("_mix_block") == F.col("_mix_of_block")))
    # only the documents of border blocks need an order
    border = ~F.col("_mix_whole") & (F.col("_mix_left") > 0)
    in_block = Window.partitionBy("source", "_mix_block").orderBy(_order("_mix_full", "doc_id"), "doc_id", "_mix_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.filter(border).withColumn("_mix_copies", F.col("_mix_full") + (F.sum("_mix_tokens").over(in_block) <= F.col("_mix_left")).cast("int"))
    rest = rows.filter(~border).withColumn("_mix_copies", F.col("_mix_full") + F.col("_mix_whole").cast("int"))
    return rest.unionByName(cut).drop("_mix_of", "_mix_of_block", "_mix_full", "_mix_left", "_mix_whole")


def repeated(planned: DataFrame) -> DataFrame:
    """A row for each time that a planned row comes, with `_mix_epoch`."""
    return planned.filter("_mix_copies > 0").withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """A row for each time that a row of docs (doc_id, text, source) comes:
    doc_id, source, weight, tokens, epoch, block and `place`, its share of its
    source's run. Sorted by place, the rows up to any of them hold the sources at
    their weights, up to a block or a document."""
    rows = stored(counted(docs.select(F.col("doc_id").cast("long"), "source", "text")).drop("text"), "mix-tokens")
    mixed = stored(weights(source_tokens(rows), target_entropy, max_repeats, budget), "mix-weights")
    out = repeated(plan(rows, mixed))
    at = visits(block_plan(rows, mixed))
    out = out.join(at, F.col("source").eqNullSafe(F.col("_mix_from")) & (F.col("_mix_epoch") == F.col("_mix_at")) & (F.col("_mix_block") == F.col("_mix_visit")))
    inside = F.pmod(_order("_mix_epoch", "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return out.select("doc_id", "source", F.col("_mix_weight").alias("weight"), F.col("_mix_tokens").alias("tokens"),
                      F.col("_mix_epoch").alias("epoch"), F.col("_mix_block").alias("block"), (F.col("begin") + F.col("width") * inside).alias("place"))


def mixed_documents(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """The rows of docs themselves, each as often as the mix sees it."""
    rows = counted(docs)
    mixed = stored(weights(source_tokens(rows), target_entropy, max_repeats, budget), "mix-weights")
    return repeated(plan(rows, mixed)).select(*[F.col(f"`{c}`") for c in docs.columns])
