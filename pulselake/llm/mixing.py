"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots, each filled with one block of equally many words. Slot ``i`` is the
golden-ratio point ``frac(i * 0.618...)``; the source whose stretch of the cumulative targets
holds the point owns the slot, so every prefix of the mix is close to the targets. The slots of
a source are ranked, and rank ``r`` takes the ``r``-th block of the source's documents, which
stand in a shuffled order and start again from the front when they are used up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import WORD, offsets, pieces
from pulselake.session import stage

# Weights by rank of the source, and the most often a word may be taken.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

BLOCK_WORDS = 1000
#: Points are multiples of 2**-31; the step is the golden ratio's fraction at that precision.
POINTS = 1 << 31
STEP = 1327217885
#: Rows that one window of a hot source may hold, about.
WINDOW_ROWS = 4096


def _in_order(df: DataFrame, key: str, label: str) -> DataFrame:
    """The rows dealt into ranges of ``key`` (nulls last), with ``part`` and ``rank`` from 0."""
    parts = stage(
        df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, F.col(key).asc_nulls_last()).withColumn(
            "part", F.spark_partition_id()
        ),
        label,
    )
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per range
    within = Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last())
    return parts.withColumn("rank", F.row_number().over(within) - 1 + _lookup("part", offsets(counts, "part", "n"), 0))


def _lookup(key: str, found: dict, at: int) -> Column:
    """Value of a small driver-side table, one entry per range, for column ``key``."""
    if not found:
        return F.lit(0).cast("long")
    pairs = [F.lit(x) for k, v in found.items() for x in (k, v[at])]
    return F.create_map(*pairs)[F.col(key)].cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Per source: source_size, part, rank, weight, target, words (whole words of the target).

    ``sizes`` has columns source, size. Targets share the total by weight and stop at
    ``MOST_REPEATS`` times the source's size; what is above goes to the others by weight until
    none is above. Only sums come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = _in_order(totals, "source", "sources").withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int") + 1).cast("long"),
    )
    ranked = stage(ranked, "sources-ranked")
    cap = F.col("source_size") * MOST_REPEATS
    all_weight = F.coalesce(F.sum("weight"), F.lit(0))
    total, open_weight = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), all_weight).first()
    capped_words = capped_sources = 0
    while True:
        left, among = total - capped_words, max(open_weight, 1)
        wide = "decimal(38,0)"
        full = F.lit(left).cast(wide) * F.col("weight").cast("decimal(9,0)") >= cap.cast("decimal(20,0)") * F.lit(
            among
        ).cast("decimal(18,0)")
        words, weight, sources = ranked.filter(full).agg(
            F.coalesce(F.sum(cap), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count(F.lit(1))
        ).first()
        # The number of sources, not their words: one without words is capped and leaves its weight to the others.
        if sources == capped_sources:
            break
        capped_words, capped_sources = words, sources
        open_weight = ranked.agg(all_weight).first()[0] - weight
    target = F.when(full, cap.cast("double")).otherwise(
        F.lit(left).cast("double") * F.col("weight").cast("double") / F.lit(float(among))
    )
    return ranked.withColumn("target", target).withColumn("words", F.floor("target").cast("long"))


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, start: every document's place in its source's shuffled stream.

    The order is that of ``md5(doc_id)``. A hot source is cut into ranges of that order; sums
    per range give the offsets, so no window holds more than about ``WINDOW_ROWS`` rows.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        order.alias("spot"),
    )
    rows = stage(rows, "mix-sizes")
    cells = pieces(rows.count(), WINDOW_ROWS, 16)
    cell = F.floor(F.conv(F.substring("spot", 1, 7), 16, 10).cast("double") / (1 << 28) * cells).cast("long")
    rows = rows.withColumn("cell", cell)
    per_cell = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.withColumn("base", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    within = (
        Window.partitionBy("source", "cell")
        .orderBy("spot", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumn("local", F.coalesce(F.sum("size").over(within), F.lit(0)))
    bases = per_cell.select(F.col("source").alias("c_source"), F.col("cell").alias("c_cell"), "base")
    return local.join(
        bases, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell"))
    ).select("doc_id", "source", "size", (F.col("base") + F.col("local")).cast("long").alias("start"))


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """slot, source, rank: which source fills each slot, and which of its blocks.

    ``goals`` is a staged result of ``targets``. Each source gets exactly the slots its target
    needs: surplus slots are left out, and the few that the points fall short of follow at the end.
    """
    spark = goals.sparkSession
    total = goals.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    sums = goals.groupBy("part").agg(F.sum("words").alias("n")).collect()  # one row per range
    upto = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    above = F.sum("words").over(upto) + _lookup("part", offsets(sums, "part", "n"), 0)
    scaled = lambda c: F.floor(c.cast("double") / max(total, 1) * POINTS).cast("long")
    ends = goals.filter(F.col("words").isNotNull()).withColumn("hi", scaled(above)).withColumn(
        "lo", scaled(above - F.col("words"))
    )
    ends = ends.withColumn("need", F.ceil(F.col("words") / block).cast("long")).select("source", "lo", "hi", "need")
    shift = 21  # 2**10 equal stretches of the points, each met by its own sources only
    owners = ends.filter("hi > lo").withColumn(
        "stretch", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift)))
    )
    slots = spark.range(-(-total // block)).select(
        F.col("id").alias("slot"), ((F.col("id") % POINTS) * STEP % POINTS).alias("point")
    )
    drawn = (
        slots.withColumn("stretch", F.shiftright("point", shift))
        .join(owners, "stretch")
        .filter((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
        .select("slot", "source", "need", F.floor(F.col("slot") / WINDOW_ROWS).alias("run"))
    )
    drawn = stage(drawn, "mix-slots")
    runs = drawn.groupBy("source", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = (
        drawn.withColumn("local", F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1)
        .join(
            runs.select(F.col("source").alias("r_source"), F.col("run").alias("r_run"), "base"),
            F.col("source").eqNullSafe(F.col("r_source")) & (F.col("run") == F.col("r_run")),
        )
        .withColumn("rank", (F.col("base") + F.col("local")).cast("long"))
        .filter(F.col("rank") < F.col("need"))
        .select("slot", "source", "rank")
    )
    have = drawn.groupBy(F.col("source").alias("d_source")).agg(F.count(F.lit(1)).alias("have"))
    short = (
        ends.join(have, F.col("source").eqNullSafe(F.col("d_source")), "left")
        .withColumn("have", F.coalesce("have", F.lit(0)))
        .filter(F.col("have") < F.col("need"))
        .withColumn("rank", F.explode(F.sequence(F.col("have"), F.col("need") - 1)))
        .select((F.lit(-(-total // block)) + F.col("rank")).alias("slot"), "source", "rank")
    )
    return ranked.unionByName(short)


def segments(placed: DataFrame, goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: slot, source, doc_id, start, size, from_word, n_words.

    A block is ``block`` words of the source's endless stream, so it may pass from the last
    document to the first; each pass over the stream is a span of its own. Spans and documents
    meet on cells of ``block`` words.
    """
    slots = schedule(goals, block)
    own = goals.select(F.col("source").alias("g_source"), "words", "source_size")
    length = F.col("source_size")
    spans = (
        slots.join(own, F.col("source").eqNullSafe(F.col("g_source")))
        .withColumn("a", F.col("rank") * block)
        .withColumn("b", F.least(F.col("words"), (F.col("rank") + 1) * block))
        .withColumn("pass", F.explode(F.sequence(F.expr("a div source_size"), F.expr("(b - 1) div source_size"))))
        .select(
            "slot",
            "source",
            (F.greatest("a", F.col("pass") * length) - F.col("pass") * length).alias("a"),
            (F.least("b", (F.col("pass") + 1) * length) - F.col("pass") * length).alias("b"),
        )
        .withColumn("cell", F.explode(F.sequence(F.expr(f"a div {block}"), F.expr(f"(b - 1) div {block}"))))
        .withColumnRenamed("source", "s_source")
    )
    cells = placed.filter("size > 0").withColumn(
        "p_cell", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))
    )
    first = F.greatest("start", "a", F.col("cell") * block)
    last = F.least(F.col("start") + F.col("size"), F.col("b"), (F.col("cell") + 1) * block)
    return (
        cells.join(spans, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("p_cell") == F.col("cell")))
        .withColumn("n_words", last - first)
        .filter("n_words > 0")
        .select("slot", "source", "doc_id", "start", "size", (first - F.col("start")).alias("from_word"), "n_words")
    )


def mix(docs: DataFrame, block: int = BLOCK_WORDS, carry_source: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and source if asked for.

    ``size`` counts words (null text: 0). Sources stand in code-point order, a null source last;
    it is a source of its own. A source takes the whole words of its target, so ``taken`` sums
    to the target less under one word, and no document exceeds three times its size. Documents without words are never
    taken. Repeated rows are documents of their own. An empty table gives no rows. Other columns
    are ignored. The same table gives the same mix, however it is partitioned.
    """
    placed = stage(place(docs.select("doc_id", "source", "text")), "mix-placed")
    goals = stage(targets(placed.select("source", "size")), "mix-targets")
    used = segments(placed, goals, block).select("source", "start", "doc_id", "size", "n_words")
    none = placed.filter("size > 0").select("source", "start", "doc_id", "size", F.lit(0).cast("long").alias("n_words"))
    taken = used.unionByName(none).groupBy("source", "start", "doc_id", "size").agg(F.sum("n_words").alias("taken"))
    empty = placed.filter("size = 0").select("source", "start", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    own = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    return (
        taken.unionByName(empty)
        .join(own, F.col("source").eqNullSafe(F.col("g_source")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.col("taken").cast("long").alias("taken"),
            *(["source"] if carry_source else []),
        )
    )
