"""Mixing sources to target weights by entropy balancing (operator 6).

DataFrame functions only. A document of size x in source s gets the rate

    r = min(cap, exp(lambda_s * x / mean_s))

the exponential tilt that stays closest (in relative entropy) to one copy per
document among all rates that meet the source's token constraint
sum(r * x) = target_s. The dual is convex in lambda_s; distributed Newton steps
solve all sources at once, from sums over (source, size) counts, each step kept
inside the bracket found so far (the capped dual has kinks, and a very long
document makes raw Newton steps overshoot).

Rates become copies by error feedback: documents are dealt by hash into blocks
of about ``BLOCK`` rows of a source; in a block, from the largest document
down, each takes floor or ceiling of its rate, whichever brings the block's
words nearer to the words its rates ask for. The error of a block is about half
of its small documents, and no source is gathered in one task. Rows with the
same source, id and size (null or repeated ids) are counted first and enter the
blocks as slices of at most ``BLOCK`` rows: a slice takes copies for all its
rows at once, which its rows then share as evenly as whole copies allow.

Targets: sources in code-point order (null last) get weights 5, 2, 1 in turn
and share 100 % of all words; a target stops at ``cap`` times its source's
words and the excess goes to the others by weight (one sorted pass over the
sources: the share per weight t solves sum(min(cap * S, t * w)) = total).

Defined results: null text: size 0, rate and copies 0 words; null source: a
source of its own, last; sources without words: target 0; repeated rows are
separate documents, and so are rows with a null id; very long texts are counted
whole; other columns are not read and not returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import WORDS, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK = 256
STEPS = 40
CLOSE = 1e-7


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, rows, source_size, target`` from ``source, size`` rows. The
    windows hold one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("ceiling", F.col("source_size") * float(cap))
    by_ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("ceiling").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (total - before) / left)
    # the first source below its ceiling sets the level of all later ones
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    level = F.first(open_, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0))
    return per.select("source", "rows", "source_size",
                      F.coalesce(F.least(F.col("ceiling"), level * F.col("weight")), F.col("ceiling")).alias("target"))


def tilts(counts: DataFrame, goal: DataFrame, cap: int = CAP, steps: int = STEPS, close: float = CLOSE) -> DataFrame:
    """``goal`` with ``tilt`` (lambda per source) by Newton steps on the dual.
    ``counts``: ``source, size, n``."""
    mean = F.col("source_size") / F.col("rows")
    top = F.log(F.lit(float(cap)))
    state = written(goal.withColumn("mean", F.greatest(mean, F.lit(1e-9))).withColumn("tilt", F.lit(0.0))
                    .withColumn("low", F.lit(None).cast("double")).withColumn("high", F.lit(None).cast("double"))
                    .withColumn("off", F.lit(None).cast("double")), "tilts")
    for _ in range(steps):
        s, c = state.alias("s"), counts.alias("c")
        z = F.col("c.size") / F.col("s.mean")
        power = F.col("s.tilt") * z
        rate = F.when(power >= top, F.lit(float(cap))).otherwise(F.exp(power))
        slope = F.when(power >= top, F.lit(0.0)).otherwise(F.exp(power) * z)
        sums = (c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
                .groupBy(F.col("c.source").alias("source"))
                .agg(F.sum(rate * F.col("c.size") * F.col("c.n")).alias("got"), F.sum(slope * F.col("c.size") * F.col("c.n")).alias("slope")))
        now = state.alias("s").join(sums.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
            "s.source", "s.rows", "s.source_size", "s.target", "s.mean", "s.tilt", "s.low", "s.high", "g.got", "g.slope")
        short = F.col("got") < F.col("target")
        now = (now.withColumn("off", F.abs(F.col("got") - F.col("target")) / F.greatest("target", F.lit(1.0)))
               .withColumn("low", F.when(short, F.col("tilt")).otherwise(F.col("low")))
               .withColumn("high", F.when(short, F.col("high")).otherwise(F.col("tilt"))))
        newton = F.col("tilt") + (F.col("target") - F.col("got")) / F.greatest("slope", F.lit(1e-300))
        step = F.when(F.col("low").isNull(), F.greatest(newton, 4 * F.col("high") - 1)).when(
            F.col("high").isNull(), F.least(newton, 4 * F.col("low") + 1)).when(
            (newton > F.col("low")) & (newton < F.col("high")), newton).otherwise((F.col("low") + F.col("high")) / 2)
        now = now.withColumn("tilt", F.when(F.col("off") <= close, F.col("tilt")).otherwise(step))
        state = written(now.select("source", "rows", "source_size", "target", "mean", "tilt", "low", "high", "off"), "tilts")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= close:
            return state
    raise RuntimeError(f"the tilts did not settle in {steps} steps")


def rated(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", cap: int = CAP) -> DataFrame:
    """``id, source, size, source_size, target, rate, block`` per document."""
    slim = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                               F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    counts = written(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    found = tilts(counts, targets(slim.select("source", "size"), cap=cap), cap)
    x, s = slim.alias("x"), found.alias("s")
    joined = x.join(s, F.col("x.source").eqNullSafe(F.col("s.source"))).select("x.*", "s.source_size", "s.target", "s.rows", "s.tilt", "s.mean")
    power = F.col("tilt") * F.col("size") / F.col("mean")
    rate = F.when(power >= F.log(F.lit(float(cap))), F.lit(float(cap))).otherwise(F.exp(power))
    rows = joined.select("id", "source", "size", "source_size", "target", F.when(F.col("target") > 0, rate).otherwise(0.0).alias("rate"),
                         F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK)).cast("long").alias("blocks"))
    alike = rows.groupBy("source", "id", "size").agg(*[F.first(c).alias(c) for c in ("source_size", "target", "rate", "blocks")], F.count("*").alias("alike"))
    sliced = alike.select("*", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("alike") / BLOCK) - 1).cast("int"))).alias("slice"))
    return sliced.select("id", "source", "size", "source_size", "target", "rate",
                         F.least(F.lit(BLOCK), F.col("alike") - F.col("slice") * BLOCK).cast("int").alias("alike"),
                         F.pmod(F.xxhash64(F.col("slice") + 6, "id", "size"), F.col("blocks")).alias("block"))


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", cap: int = CAP) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` per document."""
    rows = rated(docs, text_col, source_col, id_col, cap)
    # largest first; ties by id, then identical
    row = F.struct((-F.col("size")).alias("neg"), "id", "rate", "alike")
    blocks = rows.groupBy("source", "block", "source_size", "target").agg(F.sort_array(F.collect_list(row)).alias("docs"))
    start = F.struct(F.lit(0.0).alias("owed"), F.expr("cast(array() as array<int>)").alias("copies"))

    def deal(state, d):
        size = -d["neg"]
        want = state["owed"] + d["rate"] * size * d["alike"]
        floor = F.floor(d["rate"]).cast("int")
        most = F.least(F.when(d["rate"] > floor, floor + 1).otherwise(floor), F.lit(cap))
        # copies of the slice: the number of words nearest to those asked for (a half goes up)
        near = F.floor(want / F.greatest(size, F.lit(1)) + 0.5).cast("int")
        copies = F.when(size > 0, F.greatest(floor * d["alike"], F.least(most * d["alike"], near))).otherwise(floor * d["alike"]).cast("int")
        return F.struct((want - copies * size).cast("double").alias("owed"), F.array_append(state["copies"], copies).alias("copies"))
    dealt = blocks.withColumn("copies", F.aggregate("docs", start, deal)["copies"])
    out = dealt.select("source", "source_size", "target", F.explode(F.arrays_zip("docs", "copies")).alias("z"))
    out = out.select("source", "source_size", "target", "z.docs.*", F.col("z.copies").alias("total"),
                     F.explode(F.sequence(F.lit(1), F.col("z.docs.alike"))).alias("nth"))
    own = F.floor(F.col("total") / F.col("alike")) + F.when(F.col("nth") <= F.pmod("total", "alike"), 1).otherwise(0)
    return out.select(F.col("id").alias("doc_id"), "source", (-F.col("neg")).alias("size"), "source_size", "target", "rate", own.cast("int").alias("copies"))
