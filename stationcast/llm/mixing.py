"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.store import null_safe_join, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Ranks are first told apart by one of so many equal bins; only the bin on the cut is sorted.
BINS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(seed: str, doc_id: Column, text: Column) -> Column:
    """A number strictly between 0 and 1 that id and text decide (52 bits of an MD5)."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(
        doc_id.cast("string"), F.lit("null")), own).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Word targets per source: (source, source_size) to (source, source_size, target).

    Sources in code-point order, null last, weigh ``weights`` in turn and share the total. Targets
    stop at ``cap`` times the source's size and the excess is shared anew by weight. One row per
    source; the shares are found by repeated sums over that table, of which only three numbers
    reach the driver.
    """
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                  F.lit(len(weights)))
    # Ordering the sources is the one step in a single task: one row per source, not per document.
    table = stored(sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    full, level, capped = F.col("source_size") * cap, 0.0, -1
    while True:
        above = F.col("weight") * level >= full if capped >= 0 else F.lit(False)
        row = table.agg(F.coalesce(F.sum(F.when(above, full)), F.lit(0)).alias("caps"),
                        F.sum(F.when(~above, F.col("weight"))).alias("open"),
                        F.count_if(above).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], float(total - row["caps"]) / float(row["open"])
    share = F.lit(level) * F.col("weight")
    return table.select("source", "source_size", "weight",
                        F.when(share >= full, full.cast("double")).otherwise(share).alias("target"))


def _with_rank(rows: DataFrame, plan: DataFrame, cap: int) -> DataFrame:
    """Join the sources' numbers: whole copies for certain, and the Pareto rank of one more."""
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return (null_safe_join(rows, plan, ["source"])
            .withColumn("expected", F.least(F.col("per_unit") * F.col("w"), F.lit(float(cap))))
            .withColumn("whole", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("whole"))
            .withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds))))


def _measured(docs: DataFrame, seed: str, weight: Column | None) -> DataFrame:
    return docs.withColumns({
        "size": word_count(F.col("text")), "u": uniform(seed, F.col("doc_id"), F.col("text")),
        "w": F.lit(1.0) if weight is None else weight.cast("double")})


def plan_mix(narrow: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """One row per source: source_size, target, copies per unit of weight, rank of the cut."""
    targets = stored(source_targets(
        narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "targets")
    plan = _copies_per_weight(narrow, targets, cap)
    ranked = _with_rank(narrow, plan, cap).withColumn(
        "bin", F.least(F.floor(F.col("rank") * BINS), F.lit(BINS - 1)))
    # One pass over the documents: the null bin holds those without a fraction.
    bins = stored(ranked.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain")),
        "bins")
    left = null_safe_join(plan.select("source", "target"), bins.groupBy("source").agg(
        F.sum("certain").alias("certain")), ["source"]).select(
        "source", (F.col("target") - F.col("certain")).alias("left"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = bins.where("bin IS NOT NULL").withColumn(
        "before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    # The last bin that begins at or before the cut; every source with words left to take has one.
    cut = stored(null_safe_join(sums, left, ["source"]).where("before <= left").groupBy("source")
                 .agg(F.max(F.struct("bin", "before", "left")).alias("at"))
                 .select("source", "at.*"), "cut")

    inside = Window.partitionBy("source").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("words").over(inside), F.lit(0))
    last = (null_safe_join(ranked, cut, ["source", "bin"])
            .groupBy("source", "rank").agg(F.sum("size").alias("words"),
                                           F.first("left").alias("left"),
                                           F.first("before").alias("before"))
            .withColumn("ahead", ahead).groupBy("source")
            .agg(F.max(F.when(F.col("ahead") + F.col("words") / 2 <= F.col("left"),
                              F.col("rank"))).alias("last")))
    # Nothing of the bin on the cut may fit: the cut is then just below it.
    cuts = null_safe_join(cut, last, ["source"], "left").select("source", F.coalesce(
        "last", F.col("bin") / BINS - 1e-12).alias("cut_rank"))
    # Without a cut there is no fraction, or rounding left less than no words for them.
    return stored(null_safe_join(plan, cuts, ["source"], "left").withColumn(
        "cut_rank", F.coalesce("cut_rank", F.lit(-1.0))), "plan")


def copies_to_take(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3,
                   seed: str = "mix", weight: Column | None = None) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, source).

    A document's expected number of copies is its source's target over its source's size, never
    above ``cap``. The whole part is taken for certain. The fraction is the inclusion probability p
    of one more copy: documents are ranked by (u / (1 - u)) / (p / (1 - p)), with u uniform from id
    and text, and taken in that order until the words left over are reached; the document on the
    cut counts if its middle lies before it. ``weight`` (positive) makes the expected copies within
    a source unequal, in proportion to it as far as ``cap`` allows.

    Ranks fall into 65,536 bins whose sums per source are added up; only documents in the bin on the
    cut are sorted, so no source is sorted as a whole, however many of all rows it holds.

    Returns doc_id, source, size, source_size, target, copies, taken. A null text has size 0; null
    is a source of its own; rows equal in id and text share their fate; a source of size 0 has
    target 0; an empty table gives no rows. Other columns are not read.
    """
    narrow = stored(_measured(docs.select("doc_id", "source", "text"), seed, weight).drop("text"),
                    "sizes")
    return _with_copies(_with_rank(narrow, plan_mix(narrow, weights, cap), cap)).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def _with_copies(ranked: DataFrame) -> DataFrame:
    extra = F.coalesce((F.col("rank") <= F.col("cut_rank")).cast("int"), F.lit(0))
    return ranked.withColumn("copies", (F.col("whole") + extra).cast("int"))


def _copies_per_weight(narrow: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """Per source the factor c at which sum(size * min(cap, c * w)) is the target.

    Documents at the cap are set aside and the rest shared anew until none is added. With equal
    weights the first share is the last. Each round is one map-side combined sum per source.
    """
    factor = targets.withColumn("per_unit", F.lit(0.0))
    seen = -1
    while True:
        capped = F.col("per_unit") * F.col("w") > cap
        sums = null_safe_join(narrow, factor.select("source", "per_unit"), ["source"]).groupBy(
            "source").agg(
            F.coalesce(F.sum(F.when(capped, F.col("size") * cap)), F.lit(0)).alias("full"),
            F.sum(F.when(~capped, F.col("size") * F.col("w"))).alias("open"),
            F.count_if(capped).alias("n"))
        share = F.when(F.col("open") > 0, (F.col("target") - F.col("full")) / F.col("open"))
        factor = stored(null_safe_join(sums, targets, ["source"]).select(
            "source", "source_size", "target", "n",
            F.coalesce(share, F.lit(0.0)).alias("per_unit")), "factors")
        n = factor.agg(F.sum("n")).first()[0] or 0
        if n == seen:
            return factor.select("source", "source_size", "target", "per_unit")
        seen = n


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3,
               seed: str = "mix", weight: Column | None = None) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (0 to ``cap`` times), same columns.

    Texts are not moved: each row's copies follow from its id, text and its source's numbers.
    """
    inputs = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text")
    measured = _measured(inputs, seed, weight)
    narrow = stored(measured.drop("row", "text"), "sizes")
    plan = plan_mix(narrow, weights, cap)
    taken = _with_copies(_with_rank(measured, plan, cap)).where("copies > 0")
    return (taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("row.*"))


def op3_pareto_mix(spark, docs: DataFrame) -> DataFrame:
    """The words the mix takes of every document; odd rows as in ``copies_to_take``."""
    return copies_to_take(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
