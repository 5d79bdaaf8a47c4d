"""Mixing sources to target weights (11): entropy balancing by distributed Newton iterations, then rounding into copies.

DataFrame functions alone: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.llm.runtime import written

WORD = r"[^\x20\x09-\x0D]++"
#: A source's words are met to within this share of its target by the rates, before they are rounded into copies.
EXACT = 1e-9
#: Newton iterations at most; each that leaves its bracket halves it instead, so far fewer are needed.
ITERATIONS = 80
#: Sizes are looked through for the last words of a target in so many classes for each doubling of the size.
CLASSES = 4
#: Source of a row: its name, and whether it has none. Joins on both treat null as a source of its own.
SOURCE = ["unnamed", "name"]


def exact_sum(x: Column) -> Column:
    """A sum that no order of additions changes: of six decimals."""
    return F.sum(x.cast("decimal(28,6)"))


def placed(rows: DataFrame, group: list[str], order: list[str], name: str, facts: DataFrame | None = None) -> DataFrame:
    """Number rows from 1 within their group, by a total order, in the column name, and add the group's facts; no task holds a group.

    Rows are dealt in ranges of (group, order) and written; a range's rows of a group are counted, the counts before it are added up, and a
    row's number within its range comes on top. Facts meet the counts, of which a large group has one for each range, not the rows.
    """
    dealt = written(rows.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()), name)
    each = dealt.groupBy(*group, "__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offset = each.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    if facts is not None:
        offset = offset.join(facts, group)
    own = F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*order))
    return dealt.join(offset, [*group, "__range"]).withColumn(name, (F.col("__before") + own).cast("bigint")).drop("__range", "__before")


def with_targets(sources: DataFrame, most: int) -> DataFrame:
    """Share the sources' words by weight, none more than most times its own: target = min(most * own, weight * level) for the one level at which all words are shared.

    The level rises with each pass as sources reach their limit and leave their excess to the others.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, cap = 0.0, F.col("source_size") * most
    share = F.col("weight") * F.lit(level)
    while total:
        full = cap <= F.col("weight") * F.lit(level)
        held, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not weight or not (total - held) / weight > level:
            break
        level = (total - held) / weight
        share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.least(cap.cast("double"), share))


def balanced(classes: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """The tilt of each source: the solution of the convex dual, by safeguarded Newton steps for all sources at once.

    Of all rates between 0 and most whose words add up to the target, those of least relative entropy to 1 are min(most, exp(tilt * x)), x being the
    document's size. The dual's derivative is what the rates take less the target; the step is taken for its logarithm, which is nearly
    straight. Sizes and counts alone matter, so an iteration reads classes of equal source and size, not documents.
    """
    own = sources.where((F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most))
    ratio = F.log(F.col("target") / F.col("source_size"))
    low = F.when(ratio < 0, ratio / F.col("least")).otherwise(0.0)
    high = F.when(ratio < 0, ratio / F.col("greatest")).otherwise(F.log(F.lit(float(most))) / F.col("least"))
    state = written(own.select(*SOURCE, "target", low.alias("low"), high.alias("high"), (ratio / F.col("typical")).alias("tilt"), F.lit(False).alias("done")), "tilt-0")
    filled = classes.where("size > 0")
    for i in range(1, ITERATIONS):
        if not state.where("not done").limit(1).count():
            break
        x, tilt = F.col("size"), F.col("tilt")
        free = tilt * x < F.log(F.lit(float(most)))
        words = F.col("n") * x * F.when(free, F.exp(tilt * x)).otherwise(float(most))
        slope = F.when(free, words * x).otherwise(0.0)
        sums = filled.join(state.where("not done"), SOURCE).groupBy(*SOURCE).agg(exact_sum(words).alias("words"), exact_sum(slope).alias("slope"))
        w, s, t = F.col("words").cast("double"), F.col("slope").cast("double"), F.col("target")
        met = F.coalesce(F.abs(w - t) <= t * EXACT, F.lit(False))
        low, high = F.when(w < t, F.greatest("low", "tilt")).otherwise(F.col("low")), F.when(w > t, F.least("high", "tilt")).otherwise(F.col("high"))
        step = tilt + F.when((s > 0) & (w > 0), F.log(t / w) * w / s)
        moved = F.when((step > F.col("l")) & (step < F.col("h")), step).otherwise((F.col("l") + F.col("h")) / 2)
        ended = F.col("done") | F.col("met") | (F.col("h") - F.col("l") <= F.abs("tilt") * 1e-15)
        joined = state.join(sums, SOURCE, "left").withColumns({"l": F.when(F.col("done"), F.col("low")).otherwise(low), "h": F.when(F.col("done"), F.col("high")).otherwise(high), "met": met})
        state = written(joined.select(*SOURCE, "target", F.col("l").alias("low"), F.col("h").alias("high"), F.when(ended, tilt).otherwise(moved).alias("tilt"), ended.alias("done")), f"tilt-{i}")
    return state.select(*SOURCE, "tilt")


def whole_copies(classes: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Round the rates of the classes (source, size, n, rate) to whole numbers of copies whose words come close to the target.

    Copies are first the differences of the rounded running sum of rates, from the largest size down, which is less than the largest size
    off the target. Some classes, CLASSES for each doubling of the size and so a bounded number, then take up what is missing, largest
    first, which leaves less than the smallest of them as long as they have copies to give or to take.
    """
    wide = Window.partitionBy(*SOURCE).orderBy(F.desc("size"))
    upto = F.sum(F.col("n") * F.col("rate")).over(wide)
    first = F.round("upto") - F.coalesce(F.lag(F.round("upto")).over(wide), F.lit(0.0))
    room = F.col("n") * most
    rounded = written(classes.withColumn("upto", upto).withColumn("copies", F.greatest(F.lit(0), F.least(room, first.cast("bigint")))).drop("upto"), "rounded")
    missing = sources.select(*SOURCE, F.round("target").cast("bigint").alias("target")).join(rounded.groupBy(*SOURCE).agg(F.sum(F.col("copies") * F.col("size")).alias("taken")), SOURCE).select(*SOURCE, (F.col("target") - F.col("taken")).alias("left"))
    free = F.when(F.col("left") > 0, room - F.col("copies")).otherwise(F.col("copies"))
    able = rounded.where("size > 0").join(missing.where("left <> 0"), SOURCE).withColumn("free", free).where("free > 0")
    chosen = able.groupBy(*SOURCE, F.floor(F.log2("size") * CLASSES).alias("class")).agg(F.max_by(F.struct("size", "free", "left"), F.struct("free", "size")).alias("x"))
    lists = chosen.groupBy(*SOURCE).agg(F.reverse(F.array_sort(F.collect_list("x"))).alias("list"))
    empty = F.array().cast("array<struct<size: bigint, move: bigint>>")

    def taken(acc: Column, x: Column) -> Column:
        move = F.least(x["free"], F.floor(F.abs(acc["left"]) / x["size"]))
        move = F.when(acc["left"] < 0, -move).otherwise(move)
        return F.struct((acc["left"] - move * x["size"]).alias("left"), F.concat(acc["moves"], F.array(F.struct(x["size"].alias("size"), move.alias("move")))).alias("moves"))

    moves = F.aggregate("list", F.struct(F.col("list")[0]["left"].alias("left"), empty.alias("moves")), taken)["moves"]
    settled = lists.select(*SOURCE, F.explode(moves).alias("m")).select(*SOURCE, "m.size", "m.move").where("move <> 0")
    return rounded.join(settled, [*SOURCE, "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0))).drop("move")


def mix(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 11) -> DataFrame:
    """Mix documents so that each source gives its target of words; one row for each row of documents.

    doc_id, size (words of the whole text), source_size, target, taken (copies * size), source, copies (0 to most) and rate. Sources in order of code
    points, the one of null last, weigh `weights` in turn and share as many words as there are; see with_targets, balanced and
    whole_copies. Of documents alike in source and size, those first by a hash of doc_id have the copy more, so reruns agree.

    A null or empty text has no words and takes none; a source without words has target 0. A null doc_id stays null; repeated rows are mixed
    each, and which of them has the copy more is open. An empty table gives no rows; other columns are ignored.

    Documents are read once. Everything but the last numbering works on classes of equal source and size; that numbering deals rows in
    ranges, so neither a large source nor a frequent size lands in one task.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = written(documents.select(F.col("doc_id").cast("bigint"), F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name"), words.alias("size"), F.monotonically_increasing_id().alias("row")), "sizes")
    classes = written(rows.groupBy(*SOURCE, "size").agg(F.count("*").alias("n")), "classes")
    some = F.when(F.col("size") > 0, F.col("size"))
    square = exact_sum(F.col("n") * F.col("size").cast("double") * F.col("size")).cast("double")
    facts = classes.groupBy(*SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.min(some).alias("least"), F.max(some).alias("greatest"), square.alias("square"))
    sources = placed(facts, [], SOURCE, "number")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    typical = F.when(F.col("source_size") > 0, F.col("square") / F.col("source_size"))
    sources = written(with_targets(sources.select(*SOURCE, "source_size", "least", "greatest", typical.alias("typical"), weight.alias("weight")), most), "sources")
    exponent = F.col("tilt") * F.col("size")
    rate = F.when(F.col("tilt").isNull(), F.when(F.col("source_size") > 0, float(most)).otherwise(1.0)).when(exponent < F.log(F.lit(float(most))), F.exp(exponent)).otherwise(float(most))
    rated = classes.join(sources.select(*SOURCE, "source_size", "target"), SOURCE).join(balanced(classes, sources, most), SOURCE, "left").withColumn("rate", rate).drop("tilt")
    copied = written(whole_copies(rated, sources, most), "copies").withColumns({"each": F.expr("copies div n"), "more": F.expr("copies % n")}).drop("n", "copies")
    numbered = placed(rows.withColumn("hash", F.xxhash64(F.lit(seed), "doc_id")), [*SOURCE, "size"], ["hash", "doc_id", "row"], "number", copied)
    copies = F.col("each") + (F.col("number") <= F.col("more")).cast("bigint")
    named = F.when(~F.col("unnamed"), F.col("name"))
    return numbered.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), named.alias("source"), copies.alias("copies"), "rate")
