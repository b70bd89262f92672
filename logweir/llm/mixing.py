"""Mixing sources to target weights by capped water-filling.

Sources are clamped at the most epochs they may give, and what they can't take is shared out again by weight among the
others until none is above. All levels are exact fractions, found by aggregates over one row per source. A source then
gives whole repetitions of all its documents and, in a seeded order of them, the fraction that is left.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.tables import word_list, written
from logweir.operators.ordered import number_rows
from logweir.operators.skew import lookup_join

WEIGHTS = (5, 2, 1)
#: The mix has this percentage of all sizes, and no source gives more than this many epochs.
PERCENT = 150
EPOCHS = 2
SEED = 17
#: Aimed at documents of a run, and the most runs of a source, as its runs are summed by one task.
RUN = 1_000
MOST_RUNS = 65_536

_WIDE = "decimal(20,0)"


def water_level(sources: DataFrame, amount: int) -> tuple[int, int]:
    """The level (numerator, denominator) at which the sources take ``amount`` in all.

    ``sources`` has ``weight`` and ``cap``; a source takes its weight times the level, or its cap. Each round clamps
    the sources that the level lifts above their caps; the level only rises, so a clamped source stays so.
    """
    total, weights = sources.agg(F.sum("cap"), F.sum("weight")).first()
    if not total:
        return 0, 1
    if amount >= total:
        # All sources are full.
        return int(total), 1
    top, bottom, clamped = amount, int(weights), 0
    while True:
        over = F.col("cap").cast(_WIDE) * F.lit(bottom).cast("decimal(18,0)") < F.col("weight").cast("decimal(18,0)") * F.lit(top).cast(_WIDE)
        caps, heavy, n = sources.filter(over).agg(F.sum("cap"), F.sum("weight"), F.count("*")).first()
        if n == clamped:
            return top, bottom
        top, bottom, clamped = amount - int(caps), int(weights) - int(heavy), n


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``(key, source_size, n, target, take)`` from a table (key, source_size, n) of sources.

    Sources ascend by key and have ``weights`` in turn, repeating. Their targets share ``percent`` of all sizes by
    weight; none is above ``epochs`` times its size. ``take`` is the target rounded to whole words, halves up. Without
    any words all targets are 0.
    """
    ranked = number_rows(sizes, ["key"], "rank")
    weight = F.get(F.array(*(F.lit(w) for w in weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))
    # Sizes count in hundredths, so that a percentage of them is whole.
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * 100 * epochs)
    ranked = written(ranked, "mix-sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    top, bottom = water_level(ranked, int(total) * percent)
    share = F.col("weight").cast("double") * F.lit(float(top)) / F.lit(float(bottom)) / 100
    target = F.least(share, (F.col("source_size") * epochs).cast("double"))
    return ranked.select("key", "source_size", "n", target.alias("target"), F.floor(target + 0.5).cast("long").alias("take"))


def _place(seed: int, parts: list[Column]) -> Column:
    """Hexadecimal digits that order rows as if at random, the same in each run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = PERCENT,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``repeats``, ``extra``, ``taken``.

    The size is the number of words; null has 0. ``target`` is that of the row's source, see ``targets``; null is a
    source of its own, the last one. All rows of a source are taken ``repeats`` times, the whole part of target by
    size. The words still missing come from rows in the order of a seeded hash of id and size, each taken once more
    while they last, and the row at which they end gives just its first ``extra`` ones: ``taken`` = ``repeats`` *
    ``size`` + ``extra`` adds up to the rounded target of the source exactly, and is never above ``epochs`` times the
    size. Equal ids of equal sizes are taken in any order. An empty table gives no rows; other columns are ignored.

    Rows are not sorted by source. They are summed by runs of the hash, and only those of the one run of each source in
    which the words end are put in order.
    """
    # Null comes behind every name.
    key = F.coalesce(F.concat(F.lit("="), source_col), F.lit("~"))
    words = F.size(word_list(F.col(text_col))).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), words.alias("size"))
    rows = written(rows.withColumn("place", _place(seed, [F.col("id"), F.col("size")])), "mix-sizes")
    sizes = written(rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-totals")
    goals = targets(sizes, weights, percent, epochs)
    whole = F.when(F.col("source_size") > 0, F.expr("take div source_size")).otherwise(F.lit(0))
    n_runs = F.least(F.lit(MOST_RUNS), F.ceil(F.col("n") / RUN))
    goals = goals.withColumn("repeats", whole).withColumn("missing", F.col("take") - F.col("repeats") * F.col("source_size"))
    goals = written(goals.withColumn("runs", n_runs.cast("long")), "mix-targets")

    aimed = lookup_join(rows, goals, ["key"], "inner", ["place"])
    digits = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    aimed = aimed.withColumn("run", F.expr("0L") + F.shiftright(digits * F.col("runs"), 32))
    sums = aimed.groupBy("key", "run").agg(F.sum("size").alias("run_size"))
    before = Window.partitionBy("key").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("run_size").over(before), F.lit(0)))
    # One row per source: the run in which the missing words end, and what is missing when it begins.
    ends = sums.join(goals.select("key", "missing"), "key").filter("before <= missing and missing < before + run_size")
    ends = written(ends.select("key", F.col("run").alias("end"), (F.col("missing") - F.col("before")).alias("left")), "mix-ends")
    marked = lookup_join(aimed, ends, ["key"], "left", ["place"])
    # Without an end, which needs a size above 0, there is nothing to take.
    early = F.when(F.col("run") < F.col("end"), F.col("size")).otherwise(F.lit(0).cast("long"))
    sure = marked.filter("end is null or run != end").withColumn("extra", early)
    ordered = Window.partitionBy("key").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = marked.filter("run = end").withColumn("sum", F.coalesce(F.sum("size").over(ordered), F.lit(0)))
    last = last.withColumn("extra", F.greatest(F.least(F.col("left") - F.col("sum"), "size"), F.lit(0)).cast("long")).drop("sum")
    return sure.unionByName(last).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.col("repeats").cast("long").alias("repeats"),
        "extra",
        (F.col("repeats") * F.col("size") + F.col("extra")).cast("long").alias("taken"),
    )
