"""Mixing sources to target weights with Pareto order samples, by DataFrame operations only.

Every document of a source is wanted target / source size times. The whole part
of that is certain: each document is taken that often. For the fraction f left,
documents are ranked by random odds over inclusion odds, u/(1-u) / (f/(1-f)), and
those ranked first are taken once more until the source has its words. The odds
of a document can be tilted by a weight of its own, so inclusion may be unequal
within a source too. The random number is a hash of the id: reruns agree.

No task sorts a source: the ranks are cut into cells, word sums of cells find the
one cell in which the target falls, and that is cut again. Only the documents of a
cell of a cell are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, materialise, named

#: No document is taken more than this many times.
MOST_COPIES = 3
#: Cells of the rank (0 to 1) and of each cell.
CELLS = 4096
#: Documents next in size to what is missing that may end a source's sample.
LAST_PLACES = 4
#: The seed goes into the hashed text.
SEED = "mix-1"


def uniform(key: Column) -> Column:
    """A number above 0 and below 1 from the first 13 hex digits of an MD5."""
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size and target; ``sizes`` has a row for each source.

    Sources by code point, null last, weigh 1, 2, 3, 1 and so on. A target stops at
    ``most`` times its source; what is over is shared by the others by weight. Put in
    order of size / weight the stopped sources come first, so running sums give the
    share of the first source that is not stopped.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    to_end = Window.orderBy("full", F.col("source").isNull(), "source")
    weighed = (
        sizes.withColumn("w", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("full", float(most) * F.col("source_size") / F.col("w"))
    )
    before = to_end.rowsBetween(Window.unboundedPreceding, -1)
    after = to_end.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (
        F.sum("source_size").over(everything).cast("double")
        - float(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("w").over(after)
    return (
        weighed.withColumn("share", share)
        .withColumn("level", F.min(F.when(F.col("share") <= F.col("full"), F.struct("full", (-F.col("share")).alias("less")))).over(everything))
        .select(
            "source", "source_size",
            F.when(F.col("full") < F.col("level.full"), float(most) * F.col("source_size"))
            .otherwise(F.col("w") * -F.col("level.less")).alias("target"),
        )
    )


def _crossing(rows: DataFrame, cell: str, label: str) -> DataFrame:
    """For each source, the words of the cells before the one in which ``need`` falls, and that cell."""
    run = Window.partitionBy("source_key").orderBy(cell).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = rows.groupBy("source_key", cell).agg(F.sum("size").alias("words"), F.min("need").alias("need"))
    return materialise(
        cells.withColumn("upto", F.sum("words").over(run))
        .where((F.col("upto") > F.col("need")) & (F.col("upto") - F.col("words") <= F.col("need")))
        .select("source_key", F.col(cell).alias("at"), (F.col("need") - F.col("upto") + F.col("words")).alias("rest")),
        label,
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, most: int = MOST_COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of ``docs``.

    Size is the number of words; a null text has none and takes none. Null is a
    source of its own. ``taken`` is copies * size, at most ``most`` times the size.
    The ranked sample ends at the first document that does not fit; the last few places
    go to documents next in size to the words that are missing, so a source misses its
    target by no more than its spare documents are too long for. ``weight``
    (over the columns of ``docs``, above 0) tilts inclusion odds. Equal rows get
    equal random numbers and follow each other in rank; a null id is hashed as empty.
    Results are written to the shared folder, with one row for each row of ``docs``.
    """
    tilt = F.lit(1.0) if weight is None else weight.cast("double")
    base = materialise(docs.select(
        named(id_col).cast("long").alias("doc_id"), named(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(named(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        tilt.alias("tilt"),
    ), "mix-sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(
        source_targets(sizes, most).withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
        .withColumnRenamed("source", "target_source"), "mix-targets",
    )
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(times)
    fraction = times - whole
    u = uniform(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    odds = u / (1 - u) / (F.col("tilt") * F.col("fraction") / (1 - F.col("fraction")))
    ranked = (
        base.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
        .withColumns({"whole": whole.cast("long"), "fraction": fraction})
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("odds", F.when(F.col("fraction") > 0, odds))
        .withColumn("rank", F.col("odds") / (1 + F.col("odds")))
        .withColumn("scaled", F.col("rank") * CELLS)
        .withColumn("cell", F.least(F.floor("scaled"), F.lit(CELLS - 1)))
        .withColumn("inner", F.least(F.floor((F.col("scaled") - F.col("cell")) * CELLS), F.lit(CELLS - 1)))
    )
    ranked = materialise(ranked, "mix-ranked")
    live = ranked.where("odds IS NOT NULL AND size > 0")
    first = _crossing(live, "cell", "mix-cells").withColumnsRenamed({"at": "cell1", "rest": "rest1"})
    inside = live.join(first, "source_key").where("cell = cell1").withColumn("need", F.col("rest1"))
    second = _crossing(inside, "inner", "mix-inner").withColumnsRenamed({"at": "cell2", "rest": "rest2"})
    upto = Window.partitionBy("source_key").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        inside.join(second, "source_key").where("inner = cell2")
        .withColumn("upto", F.sum("size").over(upto))
    )
    # The first document that does not fit ends the sample; the words before it are taken.
    cut = materialise(
        last.where("upto > rest2").groupBy("source_key").agg(
            F.min(F.struct("rank", "doc_id", "size", "cell1", "cell2", (F.col("rest2") - F.col("upto") + F.col("size")).alias("rest"))).alias("c")
        ).select("source_key", "c.*"), "mix-cut",
    ).select("source_key", *[F.col(c).alias(f"cut_{c}") for c in ("rank", "doc_id", "size", "rest")])
    met = ranked.join(cut, "source_key", "left")
    here = F.struct("rank", F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), "size")
    there = F.struct(F.col("cut_rank").alias("rank"), F.coalesce("cut_doc_id", F.lit(-(2**63))).alias("d"), F.col("cut_size").alias("size"))
    fits = F.col("odds").isNotNull() & (F.col("cut_rank").isNull() | (here < there))
    met = materialise(met.withColumn("more", F.when(fits & (F.col("size") > 0), 1).otherwise(0)), "mix-fit")
    # The last places: the document whose size is next to what is missing, if that brings the source nearer.
    place = F.struct("rank", "doc_id", "size")
    spare = met.where("more = 0 AND odds IS NOT NULL AND size > 0").select("source_key", "rank", "doc_id", "size")
    state = cut.select("source_key", F.col("cut_rest").alias("rest"), F.array().cast("array<struct<rank:double,doc_id:bigint,size:bigint>>").alias("last"))
    for _ in range(LAST_PLACES):
        best = (
            spare.join(state, "source_key").where((F.col("size") < 2 * F.col("rest")) & ~F.array_contains("last", place))
            .groupBy("source_key").agg(F.min(F.struct(F.abs(F.col("size") - F.col("rest")).alias("gap"), "rank", "doc_id", "size")).alias("best"))
        )
        found = F.col("best").isNotNull()
        state = materialise(state.join(best, "source_key", "left").select(
            "source_key",
            (F.col("rest") - F.when(found, F.col("best.size")).otherwise(0)).alias("rest"),
            F.when(found, F.array_append("last", F.struct("best.rank", "best.doc_id", "best.size"))).otherwise(F.col("last")).alias("last"),
        ), "mix-last")
    chosen = (F.col("more") == 0) & F.coalesce(F.array_contains("last", place), F.lit(False))
    return (
        met.join(state.select("source_key", "last"), "source_key", "left")
        .withColumn("copies", F.col("whole") + F.when(chosen, 1).otherwise(F.col("more")))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weight: Column | None = None, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs`` with their columns, each repeated as often as the mix takes it.

    An id stands for one document: rows that share it are taken as often as the mix
    takes the first of them. Documents without words and those without id are not taken.
    """
    own = free_name(docs, "mix_id")
    times = free_name(docs, "mix_copies")
    taken = (
        mix(docs, id_col, text_col, source_col, weight, most).where("copies > 0 AND size > 0 AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias(own)).agg(F.min("copies").alias(times))
    )
    met = docs.withColumn(own, named(id_col).cast("long")).join(taken, own)
    kept = [named(c) for c in docs.columns]
    return met.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(own)).select(kept)
