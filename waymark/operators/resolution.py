"""Resolution of found entities, batch by batch: what meeting each of them in turn with all that are known would give.

In turn means: a found entity takes the place of the known one that it is most similar to, merged into it, or is a new one; the next
meets the outcome. Merged entities have more names, and a position or website they lacked, so they may match what none of their parts did.
Chains of such merges are settled in components: records that can match at all are linked, a component is worked off in turn by one task,
and where the outcome could match a record of another component the two are joined and worked off again. Distance and names bound
what can match, so components stay as small as places are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import haversine_m, plain
from waymark.operators.resolve import ADDRESS, GEO, MATCH, NAME, REACH_M, SITE, SITE_NAME, geo_score, name_scores, names_of

#: Height of a cell in degrees, which REACH_M cannot step over; a cell's width follows from its row.
CELL = REACH_M / 111_000 * 1.05
#: Columns of a record that is compared. (turn, place, id) is its place in the order of processing, node its name in the graph.
FACTS = ["node", "turn", "place", "id", "names", "address", "site", "latitude", "longitude"]
MEMBERS = "node string, root string, seq int, saved_turn bigint, saved_place bigint"


def found_node() -> Column:
    return F.concat_ws(":", F.lit("found"), "turn", "place")


def facts(entities: DataFrame, known: bool) -> DataFrame:
    """What is compared of entities with turn and place, the order in which they were saved or are found."""
    node = F.concat(F.lit("known:"), "id") if known else found_node()
    return entities.select(node.alias("node"), "turn", "place", "id", names_of(entities).alias("names"), plain(F.col("address")).alias("address"), F.nullif("website", F.lit("")).alias("site"), F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))


# Blocks --------------------------------------------------------------------------------------------------------------


def width(row: Column) -> Column:
    """Width in degrees of the cells of a row: what a cell's height is at the row's edge that is farther from the equator."""
    edge = F.least(F.lit(89.0), F.greatest(F.abs(row), F.abs(row + 1)) * CELL)
    return F.lit(CELL) / F.cos(F.radians(edge))


def cell_of(lat: Column, lon: Column) -> Column:
    """The cell of a position as a key, null without one. Rows and columns count from 0 degrees, so keys never change."""
    row = F.floor(lat / CELL)
    return F.concat_ws(":", F.lit("cell"), row, F.floor(lon / width(row)))


def cells_about(lat: Column, lon: Column) -> Column:
    """Keys of all cells that hold positions within REACH_M: of three rows those columns that the reach covers."""
    reach = F.lit(CELL) / F.cos(F.radians(F.least(F.lit(89.0), F.abs(lat) + CELL)))

    def of_row(row: Column) -> Column:
        columns = F.sequence(F.floor((lon - reach) / width(row)), F.floor((lon + reach) / width(row)))
        return F.transform(columns, lambda c: F.concat_ws(":", F.lit("cell"), row, c))

    at = F.floor(lat / CELL)
    return F.flatten(F.array(*[of_row(at + i) for i in (-1, 0, 1)]))


def own_blocks(rows: DataFrame) -> DataFrame:
    """Facts once for each block they lie in: their cell, and their site."""
    cell = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), cell_of(F.col("latitude"), F.col("longitude")))
    return rows.withColumn("block", F.explode(F.array_compact(F.array(cell, F.concat(F.lit("site:"), "site")))))


def asked_blocks(rows: DataFrame) -> DataFrame:
    """Facts once for each block in which a record that they match may lie."""
    near = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), cells_about(F.col("latitude"), F.col("longitude")))
    both = F.concat(F.coalesce(near, F.array().cast("array<string>")), F.array_compact(F.array(F.concat(F.lit("site:"), "site"))))
    return rows.withColumn("block", F.explode(both))


# Links ---------------------------------------------------------------------------------------------------------------


def alike(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of records with the same names, position and site, named after one of them, and links from the others to that one."""
    able = F.col("site").isNotNull() | (F.col("latitude").isNotNull() & F.col("longitude").isNotNull())  # others match nothing
    keyed = rows.where(able).withColumn("class", F.to_json(F.struct("names", "latitude", "longitude", "site")))
    heads = keyed.groupBy("class").agg(F.min("node").alias("node"), *[F.first(c).alias(c) for c in ("names", "latitude", "longitude", "site")])
    links = keyed.select("node", "class").join(heads.select("class", F.col("node").alias("head")), "class").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return heads.drop("class"), links


def links_between(found: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of found and others that can match whatever their addresses are: no pair that can is left out."""
    side = lambda df, s: df.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "names", "latitude", "longitude", "site")], "block")
    metres = haversine_m(F.col("latitude_a"), F.col("longitude_a"), F.col("latitude_b"), F.col("longitude_b"))
    met = side(asked_blocks(found), "a").join(side(own_blocks(others), "b"), "block").where("node_a <> node_b").withColumn("metres", metres)
    same = F.coalesce(F.col("site_a") == F.col("site_b"), F.lit(False))
    by_place = F.when(F.col("metres") <= REACH_M, (MATCH - ADDRESS - GEO * geo_score(F.col("metres"))) / NAME)
    least = F.least(by_place, F.when(same, (MATCH - SITE) / SITE_NAME)) - 1e-9
    able = met.withColumn("least", least).where("least is not null").groupBy("node_a", "node_b", "names_a", "names_b").agg(F.min("least").alias("least"))
    return name_scores(able, F.col("least")).where(F.col("name_score") >= F.col("least")).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def components(links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node and the least node that it is linked with, over any number of links; keep writes a table and reads it back."""
    both = keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least"))
        step = label.join(near, "node").select("node", F.least("root", "least").alias("up"), "root")
        # The root's own root is as good: paths halve, so that long chains take few rounds.
        over = label.select(F.col("node").alias("up"), F.col("root").alias("top"))
        new = keep(step.join(over, "up", "left").select("node", F.least("up", F.coalesce("top", "up")).alias("root"), F.col("root").alias("old")))
        label = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return label


# Turns ---------------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=200_000)
def ratio_of(x: str, y: str) -> float:
    return SequenceMatcher(None, x, y).ratio()


def metres_between(a: tuple[float, float], b: tuple[float, float]) -> float:
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def similarity(a: dict, b: dict) -> float:
    """Score of a found record a against a state b."""
    near = 0.0
    if a["at"] is not None and b["at"][0] is not None and b["at"][1] is not None:
        d = metres_between(a["at"], tuple(b["at"]))
        near = 1.0 if d <= 120 else max(0.0, 1 - d / 1000)
    same = 1.0 if a["site"] and a["site"] == b["site"] else 0.0
    if max(NAME + GEO * near + ADDRESS, SITE_NAME + SITE * same) < MATCH:
        return 0.0
    name = max(ratio_of(x, y) for x in a["names"] for y in b["names"])
    return max(NAME * name + GEO * near + ADDRESS * ratio_of(a["address"], b["address"]), SITE_NAME * name + SITE * same)


def in_turn(rows: pd.DataFrame) -> pd.DataFrame:
    """One component, worked off in turn: the members of each state that a found record has entered, with their order in it."""
    states: list[dict] = []
    for r in rows.sort_values(["turn", "place", "id"]).to_dict("records"):
        at = None if pd.isna(r["latitude"]) or pd.isna(r["longitude"]) else (r["latitude"], r["longitude"])
        parts = [None if pd.isna(r[c]) else r[c] for c in ("latitude", "longitude")]
        own = {"names": set(r["names"]), "address": r["address"], "site": r["site"] or None, "at": at}
        best, score = None, 0.0
        if not r["node"].startswith("known:"):
            for s in states:
                x = similarity(own, s)
                if x >= MATCH and x > score:
                    best, score = s, x
        if best is None:
            states.append(own | {"at": parts, "members": [r["node"]], "saved": (r["turn"], r["place"])})
            continue
        states.remove(best)
        states.append({
            "names": best["names"] | own["names"], "address": best["address"] or own["address"], "site": best["site"] or own["site"], "at": [p if p is not None else q for p, q in zip(best["at"], parts)],
            "members": [*best["members"], r["node"]], "saved": (r["turn"], r["place"]),
        })
    out = [(m, s["members"][0], i, *s["saved"]) for s in states if len(s["members"]) > 1 or not s["members"][0].startswith("known:") for i, m in enumerate(s["members"])]
    return pd.DataFrame(out, columns=[c.split()[0] for c in MEMBERS.split(", ")])


def state_facts(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Facts of the states of more than one member: all names, and the first position and site there are."""
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq")))
    whole = members.join(rows, "node").groupBy("root").agg(F.count("*").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"), *[first(c).alias(c) for c in ("latitude", "longitude", "site")])
    return whole.where("n > 1").drop("n").withColumnRenamed("root", "node")


def resolved(found: DataFrame, known: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Members of all entities that the found ones make or enter (see MEMBERS): node, root, and seq, the order in which they were merged.

    found, known: rows of FACTS; of known those are enough that lie in the blocks that found asks for. keep writes a table and reads it
    back. A component is one task's; its rows are the records of one place, of which each is compared with the few states there are.
    Positions on both sides of the 180th meridian do not meet.
    """
    heads, stars = alike(found)
    links = keep(links_between(heads, heads.unionByName(known.select(heads.columns))).unionByName(stars))
    rows = keep(found.withColumn("is_known", F.lit(False)).unionByName(known.withColumn("is_known", F.lit(True))))
    while True:
        of = components(links, keep)
        grouped = rows.join(of.withColumnRenamed("root", "component"), "node")
        members = keep(grouped.groupBy("component").applyInPandas(in_turn, MEMBERS))
        states = state_facts(members, rows)
        # A found record that a state of another component can match joins the two.
        wider = links_between(heads, states).join(of.select(F.col("node").alias("a"), F.col("root").alias("of_a")), "a", "left").join(of.select(F.col("node").alias("b"), F.col("root").alias("of_b")), "b", "left")
        more = keep(wider.where("of_a is null or of_a <> of_b").select("a", "b"))
        if more.isEmpty():
            break
        links = keep(links.unionByName(more))
    alone = rows.where("not is_known").join(of, "node", "left_anti")
    return members.unionByName(alone.select("node", F.col("node").alias("root"), F.lit(0).alias("seq"), F.col("turn").alias("saved_turn"), F.col("place").alias("saved_place")))


# Merged rows ---------------------------------------------------------------------------------------------------------

#: How the columns of merged entities come from their members', in the order of merging. All others are the first member's, or else the first there is.
SETS = ("aliases", "subcategories", "amenities", "phone_numbers", "intent_tags", "context_keys", "branch_ids", "source_names", "source_types")
IN_ORDER, LAST_WINS, LARGEST, ANY = ("sources",), ("suitability_scores",), ("confidence",), ("has_contact", "has_social", "has_media", "event_known", "community_known")
NEWEST = ("timings", "opening_hours_raw", "last_seen_at")


def folded(members: DataFrame, entities: DataFrame) -> DataFrame:
    """One entity for each root: entities has node and the columns of an entity, members node, root, seq, saved_turn and saved_place.

    The first member gives id and name; other names become aliases. Pictures count once by id or url, relations once by predicate and object.
    Of entities that end with one id the one that was saved last stays, as saving replaces.
    """
    kinds = dict(entities.dtypes)
    names = [c for c in entities.columns if c not in ("node", "turn", "place")]
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "") if kinds[c] == "string" else F.col(c).isNull()
    first = lambda c: F.min_by(F.col(c), F.when(~blank(c), F.col("seq")))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col(c))), lambda x, y: x.seq - y.seq), lambda x: x[c])
    in_order = lambda c: F.flatten(F.filter(listed(c), lambda x: x.isNotNull()))

    def once(items: Column, key: Callable[[Column], Column]) -> Column:
        keys = F.transform(items, key)
        return F.filter(items, lambda x, i: F.array_position(keys, key(x)) == i + 1)

    def merged(c: str) -> Column:
        if c in SETS:
            return F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast(kinds[c]))))))
        if c in IN_ORDER:
            return in_order(c)
        if c == "media":
            return once(in_order(c), lambda m: F.coalesce(F.nullif(m.id, F.lit("")), m.url))
        if c == "relationships":
            return once(in_order(c), lambda r: F.struct(r.predicate, r.object_id))
        if c in LAST_WINS:
            return F.aggregate(F.filter(listed(c), lambda x: x.isNotNull()), F.create_map().cast(kinds[c]), lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b))
        if c in LARGEST:
            return F.max(c)
        if c in ANY:
            return F.bool_or(c)
        if c in NEWEST:
            return F.max_by(F.col(c), F.when(~blank(c), F.col("seq")))
        return F.min_by(F.col(c), F.col("seq")) if c in ("id", "name", "category", "status") else first(c)

    whole = members.join(entities, "node").groupBy("root").agg(*[merged(c).alias(c) for c in names], F.max("saved_turn").alias("turn"), F.max("saved_place").alias("place"), F.array_distinct(F.collect_list("name")).alias("__names"))
    whole = whole.withColumn("aliases", F.array_sort(F.array_except(F.array_union("aliases", F.filter("__names", lambda n: n.isNotNull())), F.array("name")))).drop("__names")
    from waymark.operators.tables import keep_first

    return keep_first(whole, [F.col("id")], [F.desc("turn"), F.desc("place"), F.desc("root")]).drop("root")
