"""Search over an inverted index: entities in blocks of neighbours, postings with a bit for each entity of a block, and a top-k that reads only blocks which can still enter.

What an entity can score follows from the postings of the query's words, moods and hint, from what it is worth unasked and from its position;
the last two are kept by block. So the k-th best score is known to within rounding before any entity is read, and blocks all of
whose entities lie below it are not. The few others are scored by the very expressions of the whole search.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.functions.text import haversine_m
from waymark.operators import search as se

#: Entities of a block, a bit of a long for each.
BLOCK = 64
#: Blocks that are read by their numbers; more of them are joined.
FEW = 1000
#: What rounding of distances and scores can change of a score.
ROUNDING = 0.005
#: Parquet row groups of the cards are small, so that the block's statistics let whole ones be skipped.
ROW_GROUP = 1 << 20


def zorder(lat: Column, lon: Column, bits: int = 20) -> Column:
    """Position on a space-filling curve; null without a position."""
    cell = lambda x, span: F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.floor((x / span + 0.5) * (1 << bits)))).cast("bigint")

    def spread(x: Column) -> Column:
        """The bits of x at every other place (a well-known sequence of shifts and masks)."""
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x

    return spread(cell(lat, 180.0)) * 2 + spread(cell(lon, 360.0))


def keys_of(entities: DataFrame) -> Column:
    """Everything of an entity that a query can ask for: words of all it says, words of where it is, and its moods."""
    words = lambda x, least: F.array_distinct(F.filter(F.split(x, "[^a-z0-9]+"), lambda w: F.length(w) >= least))
    named = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{kind}:"), x))
    where = F.lower(F.concat_ws(" ", "name", "locality", "address"))
    return F.concat(named("term", words(F.col("__hay"), 3)), named("place", words(where, 1)), named("mood", F.col("mood_tags")))


@dataclass(frozen=True)
class Index:
    """Three tables under a path: cards (entities with their block and slot in it), blocks (what each slot is worth and where it lies) and
    postings (key, block, and the bits of the slots that have the key)."""

    spark: SparkSession
    path: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @staticmethod
    def write(entities: DataFrame, path: str) -> Index:
        """Index entities (the columns that se.cards reads). They are dealt in ranges of the curve and cut into blocks of neighbours there."""
        spark = entities.sparkSession
        dealt = entities.withColumn("__z", zorder(F.col("latitude"), F.col("longitude"))).repartitionByRange("__z", "id").withColumn("__part", F.spark_partition_id())
        dealt.write.parquet(f"{path}/dealt")
        rows = spark.read.parquet(f"{path}/dealt")
        place = F.row_number().over(Window.partitionBy("__part").orderBy("__z", "id")) - 1
        numbered = rows.withColumn("__place", place).withColumns({"block": F.shiftleft(F.col("__part").cast("bigint"), 32) + F.floor(F.col("__place") / BLOCK), "slot": F.pmod("__place", F.lit(BLOCK)).cast("int")})
        numbered.drop("__z", "__part", "__place").sortWithinPartitions("block").write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/cards")
        cards = spark.read.parquet(f"{path}/cards")
        worth = se.standing(cards)
        slot = F.struct("slot", (worth["suited"] + worth["shown"]).alias("asked"), worth["unasked"].alias("unasked"), "latitude", "longitude")
        cards.groupBy("block").agg(F.array_sort(F.collect_list(slot)).alias("slots")).write.parquet(f"{path}/blocks")
        told = se.with_words(cards)
        bit = F.expr("shiftleft(1L, slot)")
        postings = told.select("block", bit.alias("bit"), F.explode(keys_of(told)).alias("key")).groupBy("key", "block").agg(F.bit_or("bit").alias("slots"))
        postings.repartitionByRange("key", "block").sortWithinPartitions("key", "block").write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/postings")
        return Index(spark, path)


def bounds(index: Index, query: se.Query, k: int) -> DataFrame:
    """block, bound, least: of every block that can hold a card of the query a number that no score in it exceeds, and numbers that its k best scores reach."""
    blocks = index.read("blocks")
    asked = bool(query.terms or query.moods or query.hint)
    of_term = [[f"term:{t}", *[f"mood:{m}" for m in se.asked_moods(t)]] for t in dict.fromkeys(query.terms)]
    of_mood = [[f"mood:{m}"] for m in query.moods]
    of_hint = [f"place:{w}" for w in re.findall("[a-z0-9]+", query.hint or "")]
    keys = sorted({k for ks in [*of_term, *of_mood, of_hint] for k in ks})
    none, zero, all_ = F.create_map().cast("map<string,bigint>"), F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
    rows = blocks.withColumn("met", none)
    if keys:
        met = index.read("postings").where(F.col("key").isin(keys)).groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("key", "slots"))).alias("met"))
        rows = blocks.join(met, "block", "left").withColumn("met", F.coalesce("met", none))
    bits = lambda k: F.coalesce(F.try_element_at("met", F.lit(k)), zero)
    either = lambda xs: reduce(lambda a, b: a.bitwiseOR(b), xs, zero)
    masks = [(either(map(bits, ks)), 0.9) for ks in of_term] + [(either(map(bits, ks)), 1.4) for ks in of_mood]
    wanted = either([m for m, _ in masks]) if masks else all_
    if of_hint:
        masks.append((reduce(lambda a, b: a.bitwiseAND(b), map(bits, of_hint), all_), 3.0))
    rows = rows.withColumns({"bits": F.array(*[m for m, _ in masks]) if masks else F.array().cast("array<bigint>"), "wanted": wanted})
    has = lambda mask, x: F.call_function("getbit", mask, x.slot) == 1

    def scored(x: Column) -> Column:
        if not asked:
            return F.struct(x.unasked.alias("score"), F.lit(True).alias("able"), F.lit(True).alias("sure"))
        score, near, nearer = x.asked, F.lit(False), F.lit(False)
        for i, (_, w) in enumerate(masks):
            score = score + F.when(has(F.col("bits")[i], x), w).otherwise(0.0)
        if query.centre:
            km = haversine_m(F.lit(query.centre[0]), F.lit(query.centre[1]), x.latitude, x.longitude, se.RADIUS_M) / 1000
            score = score + F.coalesce(F.greatest(F.lit(0.0), 2.5 - 0.25 * F.least(km, F.lit(10.0))), F.lit(0.0))
            if query.hint:
                near, nearer = F.coalesce(km <= 8 + 2 * ROUNDING, F.lit(False)), F.coalesce(km <= 8 - 2 * ROUNDING, F.lit(False))
        return F.struct(score.alias("score"), (has(F.col("wanted"), x) | near).alias("able"), (has(F.col("wanted"), x) | nearer).alias("sure"))

    rows = rows.withColumn("scored", F.filter(F.transform("slots", scored), lambda s: s.able)).where(F.size("scored") > 0)
    most = F.array_max(F.transform("scored", lambda s: s.score)) + ROUNDING
    least = F.slice(F.sort_array(F.transform(F.filter("scored", lambda s: s.sure), lambda s: s.score - ROUNDING), asc=False), 1, k)
    return rows.select("block", most.alias("bound"), least.alias("least"))


@dataclass(frozen=True)
class Found:
    """The best cards, how many blocks were scored for them and how many there are."""

    cards: DataFrame
    read: int
    blocks: int


def search(index: Index, query: se.Query, limit: int) -> Found:
    """The rows of se.top(se.cards(entities, query, whole=True), limit), from the blocks that can hold them.

    `limit` numbers come to the driver: those that the best scores reach. Blocks with a bound of the last of them or more are read: as many
    as there are cards asked for, and ties.
    """
    able = bounds(index, query, limit)
    reached = [r[0] for r in able.select(F.explode("least").alias("x")).orderBy(F.desc("x")).limit(limit).collect()]
    chosen = able.where(F.col("bound") >= reached[-1]) if len(reached) == limit else able
    few = [r["block"] for r in chosen.select("block").limit(FEW + 1).collect()]
    cards, count = index.read("cards"), len(few)
    if count <= FEW:  # the numbers are pushed to the files' statistics
        cards = cards.where(F.col("block").isin(few))
    else:
        count, cards = chosen.count(), cards.join(chosen.select("block"), "block", "left_semi").select(cards.columns)
    return Found(se.top(se.cards(cards, query, whole=True), limit), count, index.read("blocks").count())
