"""Mixing sources to target weights with Pareto order sampling, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.shared import stored

WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and how often a source may be repeated at most.
SHARE, MOST_COPIES = 1.5, 2
SEED = 7
#: Steps of the rank by which a source's ranks are counted before any two are compared.
BINS = 4096
_WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)).cast("long"), F.lit(0))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target. Sources by code point, a missing source last, weigh ``weights``, repeating.

    No target is above ``most`` times its source's size; the rest is shared again by weight. In order of the weight at
    which a source is full, a source is full if its equal share of what the fuller ones left would overfill it.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    sums = sums.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long"))
    by_fill = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    later = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    left = total * share - F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * float(most)
    shared = sums.withColumn("per_weight", left / F.sum("weight").over(later))
    full = F.col("source_size") * float(most) <= F.col("per_weight") * F.col("weight")
    open_ones = F.when(~full, F.struct("place", "per_weight"))
    rate = F.min(open_ones).over(Window.partitionBy(F.lit(1)))
    shared = shared.withColumn("place", F.row_number().over(by_fill)).withColumn("rate", rate["per_weight"])
    return shared.select(
        "source", "source_size",
        F.when(full, F.col("source_size") * float(most)).otherwise(F.col("rate") * F.col("weight")).alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number above 0 and below 1 from 52 bits of the md5 of seed and id."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def mix_cuts(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The mix as one row per source: source, source_size, target, copies, rate, and the last drawn rank, size and id.

    A document of size s gets ``copies`` whole copies (how often the target holds the whole source). For what remains of
    the target it is included once more with odds of p = min(1, rate * s), the rate such that the included sizes add up to
    the rest: sizes that reach p = 1 are certain, the others are drawn by Pareto order sampling. Each has the rank
    (u / (1 - u)) / (p / (1 - p)) with u a fixed random number of its id, and the smallest ranks are taken up to the point
    nearest to the rest; rows of equal id and size stand or fall together.

    Nothing here is collected or gathered by source: sums by size and by a coarse step of the rank find the step in which
    the draw ends, and only rows of that step are put in order.
    """
    targets = source_targets(sizes, weights, share, most).withColumn(
        "copies", F.when(F.col("source_size") == 0, 0).otherwise(F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size"))))
    ).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size")))
    # the rate: by sizes, largest first
    whole = "decimal(38,0)"
    by_size = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    largest = Window.partitionBy("source").orderBy(F.col("size").desc())
    square = F.col("size").cast("decimal(12,0)") * F.col("size").cast("decimal(12,0)") * F.col("n").cast("decimal(12,0)")
    cells = by_size.withColumn("square", square.cast(whole)).withColumn(
        "above", F.coalesce(F.sum(F.col("size") * F.col("n")).over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("squares", F.sum("square").over(largest.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast("double"))
    cells = cells.join(targets.select(F.col("source").alias("of"), "rest"), F.col("source").eqNullSafe(F.col("of")))
    uncertain = (F.col("rest") - F.col("above")) * F.col("size") < F.col("squares")
    rates = cells.where(uncertain).groupBy("of").agg(
        F.max(F.struct("size", "above", "squares", "rest")).alias("m")
    ).select("of", F.greatest(F.lit(0.0), F.col("m.rest") - F.col("m.above")).alias("open"), F.col("m.size").alias("below"),
             (F.greatest(F.lit(0.0), F.col("m.rest") - F.col("m.above")) / F.col("m.squares")).alias("rate"))
    plan = targets.join(rates, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # the draw
    ranked = _ranked(sizes.join(plan.select(F.col("source").alias("of"), "rate", "open", "below"),
                                F.col("source").eqNullSafe(F.col("of"))), seed)
    ranked = ranked.where("rank IS NOT NULL").withColumn("bin", F.floor(F.col("rank") / (F.col("rank") + 1) * BINS).cast("int"))
    bins = ranked.groupBy("of", "bin").agg(F.sum("size").alias("in_bin"), F.first("open").alias("open"))
    upto = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("in_bin").over(upto), F.lit(0)))
    # the last bin that can hold a drawn row
    ends = bins.where("before <= open").groupBy("of").agg(F.max(F.struct("bin", "before")).alias("e")).select(
        F.col("of").alias("ends_of"), F.col("e.bin").alias("end_bin"), F.col("e.before").alias("before"))
    last = ranked.join(ends, F.col("of").eqNullSafe(F.col("ends_of")) & (F.col("bin") == F.col("end_bin")))
    last = last.groupBy("of", "rank", "size", "doc_id").agg(
        F.sum("size").alias("peers"), F.first("before").alias("before"), F.first("open").alias("open"))
    inside = Window.partitionBy("of").orderBy("rank", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("earlier", F.col("before") + F.coalesce(F.sum("peers").over(inside), F.lit(0)))
    drawn = last.where(2 * F.col("earlier") + F.col("peers") <= 2 * F.col("open")).groupBy("of").agg(
        F.max(F.struct("rank", "size", F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("cut"))
    marks = ends.select(F.col("ends_of").alias("mark_of"), "end_bin").join(
        drawn, F.col("mark_of").eqNullSafe(F.col("of")), "left").select("mark_of", "end_bin", "cut")
    return plan.join(marks, F.col("source").eqNullSafe(F.col("mark_of")), "left").drop("mark_of", "rest")


def _ranked(rows: DataFrame, seed: int) -> DataFrame:
    """Adds ``rank`` for the documents that are drawn."""
    odds, u = F.col("rate") * F.col("size"), uniform(F.col("doc_id"), seed)
    drawn = (F.col("size") > 0) & (F.col("size") <= F.col("below")) & (F.col("rate") > 0)
    return rows.withColumn("rank", F.when(drawn, u * (1 - odds) / ((1 - u) * odds)))


def _copies(size: Column, key: Column, cut: Column, seed: int) -> Column:
    """How often a row is taken, from its size, its id and its source's cut."""
    odds, u = cut["rate"] * size, uniform(key, seed)
    drawn = F.coalesce((size > 0) & (size <= cut["below"]) & (cut["rate"] > 0), F.lit(False))
    rank = F.when(drawn, u * (1 - odds) / ((1 - u) * odds))
    step = F.floor(rank / (rank + 1) * BINS).cast("int")
    place = F.struct(rank.alias("rank"), size.alias("size"), key.isNotNull().alias("named"), key.alias("doc_id"))
    taken = drawn & ((step < cut["end_bin"]) | ((step == cut["end_bin"]) & (place <= cut["cut"])))
    more = F.when(F.coalesce((size > cut["below"]) | taken, F.lit(False)), 1).otherwise(0)
    return F.when(size == 0, 0).otherwise(cut["copies"] + more).cast("int")


def document_sizes(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, source, size, stored once: the texts are read a single time."""
    return stored(df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(source_column).cast("string").alias("source"),
                            word_count(F.col(text_column).cast("string")).alias("size")), "sizes")


def mix_sources(df: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED,
                id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken (words the mix takes, repeats counted), copies.

    A missing source is a source of its own, the last. Empty and missing texts have size 0 and are not taken. Repeated
    rows of one id are taken equally often. The same rows and seed give the same mix. An empty table gives no rows.
    """
    sizes = document_sizes(df, id_column, text_column, source_column)
    cuts = mix_cuts(sizes, weights, share, most, seed).select(F.struct("*").alias("cut"))
    rows = sizes.join(cuts, F.col("source").eqNullSafe(F.col("cut.source")))
    rows = rows.withColumn("copies", _copies(F.col("size"), F.col("doc_id"), F.col("cut"), seed))
    return rows.select("doc_id", "source", "size", "cut.source_size", "cut.target",
                       (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def copied(df: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: int = SEED,
           id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself: every row as often as the mix takes it, with the columns it had.

    A row's copies follow from its own size and id and its source's cut, so texts meet nothing but one row per source.
    """
    cuts = stored(mix_cuts(document_sizes(df, id_column, text_column, source_column), weights, share, most, seed), "cuts")
    rows = df.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("key"), F.col(source_column).cast("string").alias("of"),
                     word_count(F.col(text_column).cast("string")).alias("size"))
    rows = rows.join(cuts.select(F.struct("*").alias("cut")), F.col("of").eqNullSafe(F.col("cut.source")))
    rows = rows.withColumn("copies", _copies(F.col("size"), F.col("key"), F.col("cut"), seed)).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
