"""Row-level table operations: keep-first, upserts, child replacement, frontier order, and merges of matched records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")  # a group limit runs before the shuffle


def one_of_key(df: DataFrame, key: str, order: list[Column] = ()) -> DataFrame:
    """Of the rows with one key the first by the order given, then by all columns as JSON, the largest first. Rows with a null key share none: all stay."""
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return keep_first(df, [F.col(key), own], [*order, F.desc(F.to_json(F.struct(*df.columns)))])


def append_unique(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and the new ones whose keys are not there yet, each once."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, key: str, keep: list[str] = ()) -> DataFrame:
    """New rows replace old ones of the same key, but for the columns in keep, where an old value stays.

    Of new rows with one key the first of one_of_key counts. Rows with a null key replace none and are all added.
    """
    new = one_of_key(new, key)
    kept = old.select(key, *[F.col(c).alias(f"__{c}") for c in keep])
    fresh = new.join(kept, key, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in keep else F.col(c) for c in new.columns])
    return old.join(new.select(key), key, "left_anti").unionByName(fresh)


def replace_children(children: DataFrame, fresh: DataFrame, parent: str, parents: DataFrame) -> DataFrame:
    """Children of the given parents are replaced by the fresh ones."""
    return children.join(parents.select(parent).distinct(), parent, "left_anti").unionByName(fresh)


def delete_unlisted(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return rows.join(listed.select(key).distinct(), key, "left_semi")


def dedupe_frontier(frontier: DataFrame) -> DataFrame:
    """One candidate for each (kind, source, lower(value)): highest priority, then earliest."""
    return keep_first(frontier, [F.col("kind"), F.col("source"), F.lower("value")], [F.desc("priority"), F.col("seq")])


def next_batch(frontier: DataFrame, size: int, max_depth: int = 3) -> DataFrame:
    """The next candidates to visit; those beyond max_depth are dropped."""
    return frontier.where(F.col("depth") <= max_depth).orderBy(F.desc("priority"), "seq").limit(size)


def retried(frontier: DataFrame) -> DataFrame:
    """Failed candidates that may be tried again, at half their priority: urls never after one retry, queries up to three."""
    most = F.when(F.col("kind") == "source_url", 1).otherwise(3)
    return frontier.where(F.col("retry_count") < most).withColumn("priority", F.col("priority") * 0.5).withColumn("retry_count", F.col("retry_count") + 1)


def rank_decayed(priority: Column, rank: Column, step: float = 0.03, least: float = 0.1) -> Column:
    return F.greatest(F.lit(least), priority - F.lit(step) * rank)


def merged(left: str, right: str, coalesced: list[str], unions: list[str], maxima: list[str]) -> list[Column]:
    """Columns of a matched pair: left wins where it has a value; sets are united and sorted; maxima are taken."""
    columns = [F.coalesce(f"{left}.{c}", f"{right}.{c}").alias(c) for c in coalesced]
    columns += [F.array_sort(F.array_union(F.coalesce(f"{left}.{c}", F.array()), F.coalesce(f"{right}.{c}", F.array()))).alias(c) for c in unions]
    return columns + [F.greatest(f"{left}.{c}", f"{right}.{c}").alias(c) for c in maxima]


def round_robin(df: DataFrame, group: str, groups: list[str], order: list[Column], spread: Column | None = None, parts: int = 64) -> DataFrame:
    """Interleave groups: first rows of each group in the given order of groups, then the second ones, and so on.

    spread: a number that ascends with the order. With it a group is cut at its quantiles into about `parts` ranges, which are numbered
    each and start after those before, so a few large groups are many tasks; equal numbers stay in one range.
    """
    place = F.array_position(F.array(*map(F.lit, groups)), F.col(group))
    if spread is None:
        return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).withColumn("group_order", place)
    rows = df.withColumn("__s", spread.cast("double"))
    steps = [i / parts for i in range(1, parts)]
    cuts = {r[0]: sorted(set(r[1] or [])) for r in rows.groupBy(group).agg(F.percentile_approx("__s", steps, 1000)).collect()}  # parts numbers for each group
    of = F.lit(0)
    for name, bounds in cuts.items():
        if bounds and name is not None:
            own = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("__s")))
            of = F.when(F.col(group) == name, own).otherwise(of)
    rows = rows.withColumn("__part", of)
    sizes = rows.groupBy(group, "__part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    turn = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))
    whole = rows.withColumn("__turn", turn).join(F.broadcast(before), [group, "__part"])  # parts rows for each group
    return whole.withColumn("turn", (F.col("__turn") + F.col("__before")).cast("int")).withColumn("group_order", place).drop("__s", "__part", "__turn", "__before")


def top_tokens(df: DataFrame, key: str, text: str, most: int = 12, longer: int = 4) -> DataFrame:
    """The most frequent tokens of each text, ties by first place."""
    tokens = df.select(key, F.posexplode(F.split(F.lower(text), r"[ \t\r\n\f]+")).alias("pos", "token")).where(F.length("token") > longer)
    counted = tokens.groupBy(key, "token").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))
    return counted.withColumn("place", place.cast("int")).where(F.col("place") <= most).select(key, "token", "n", "place")


def share_of_target(df: DataFrame, group: Column, target: int) -> DataFrame:
    """Rows of each group, and their percentage of a target."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.round(100 * F.count("*") / F.lit(float(target)), 2).alias("percent_of_target"))


def capped(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """Rows in the order of ids up to and with the one at which the sum of size reaches most: the cap is looked at after each row, so it may be passed.

    Rows of size 0 bring nothing and are left out; of the others, no more than `most` can be needed, so only these are summed in one task.
    """
    few = rows.withColumn("__size", size).where("__size > 0").orderBy("id").limit(most)
    before = F.coalesce(F.sum("__size").over(Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return few.withColumn("__before", before).where(F.col("__before") < most).drop("__size", "__before")


def first_results(results: DataFrame, enough: int = 12) -> DataFrame:
    """results (id, query_no, pos, url, title): of each id the first row of each url (or title), query by query, until `enough` are there.

    Whole queries are taken: the number is looked at after each.
    """
    key = F.lower(F.coalesce(F.nullif("url", F.lit("")), "title", F.lit("")))
    once = keep_first(results.withColumn("__key", key).where("__key <> ''"), [F.col("id"), F.col("__key")], [F.col("query_no"), F.col("pos")]).drop("__key")
    sizes = once.groupBy("id", "query_no").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("id").orderBy("query_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = sizes.withColumn("__before", before).where(F.col("__before") < enough).select("id", "query_no")
    return once.join(taken, ["id", "query_no"], "left_semi")


def map_merge(left: Column, right: Column, right_wins: bool = True) -> Column:
    """Both maps as one; a key of both has the right one's value, or the left one's."""
    a, b = (F.coalesce(m, F.create_map().cast("map<string,string>")) for m in ((left, right) if right_wins else (right, left)))
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k)), b)


#: How each field of an entity merges with the matched one's: the left value first, sorted unions, right-winning maps, lists one after the other.
FIRST = ["description", "locality", "address", "latitude", "longitude", "website", "primary_category", "entity_type"]
SORTED = ["subcategories", "amenities", "audience", "related_entities"]
MAPS = ["timings", "contact", "social_links", "pricing", "popularity"]
LISTS = ["ratings", "sources"]


def merged_entities(pairs: DataFrame) -> DataFrame:
    """Pairs of matched entities (structs a, the canonical one, and b) as one entity each, with a's id and name.

    b's name and aliases become aliases, but for a's name; media count once by id (or url), relations once by subject, predicate and
    object, the first of each; the confidence is the larger one; last_seen_at is b's. Fields that the structs lack are left out.
    """
    fields = {f.name: f.dataType for f in pairs.schema["a"].dataType.fields}
    both = lambda c: (F.col(f"a.{c}"), F.col(f"b.{c}"))
    empty = lambda c: F.array().cast(fields[c])

    def first_of(items: Column, key) -> Column:
        keys = F.transform(items, key)
        return F.filter(items, lambda x, i: F.array_position(keys, key(x)) == i + 1)

    out = {"id": F.col("a.id"), "name": F.col("a.name")}
    for c in fields:
        a, b = both(c)
        if c in FIRST:
            out[c] = F.coalesce(F.nullif(a, F.lit("")) if fields[c].simpleString() == "string" else a, b)
        elif c in SORTED:
            out[c] = F.array_sort(F.array_union(F.coalesce(a, empty(c)), F.coalesce(b, empty(c))))
        elif c in MAPS:
            out[c] = map_merge(a, b)
        elif c in LISTS:
            out[c] = F.concat(F.coalesce(a, empty(c)), F.coalesce(b, empty(c)))
    if "aliases" in fields:
        a, b = both("aliases")
        out["aliases"] = F.array_sort(F.array_except(F.array_union(F.array_union(F.coalesce(a, empty("aliases")), F.coalesce(b, empty("aliases"))), F.array("b.name")), F.array("a.name")))
    if "media" in fields:
        a, b = both("media")
        out["media"] = first_of(F.concat(F.coalesce(a, empty("media")), F.coalesce(b, empty("media"))), lambda m: F.coalesce(F.nullif(m.id, F.lit("")), m.url))
    if "relationships" in fields:
        a, b = both("relationships")
        out["relationships"] = first_of(F.concat(F.coalesce(a, empty("relationships")), F.coalesce(b, empty("relationships"))), lambda r: F.struct(r.predicate, r.object_id))
    if "confidence_score" in fields:
        out["confidence_score"] = F.greatest(*both("confidence_score"))
    if "last_seen_at" in fields:
        out["last_seen_at"] = F.col("b.last_seen_at")
    return pairs.select(*[v.alias(k) for k, v in out.items()])


#: The kind of candidate that each source's adapter takes.
ADAPTERS = {"firecrawl_search": "query", "firecrawl_page": "source_url", "google_search": "query", "openstreetmap": "query", "web_page": "source_url", "wikipedia": "query", "wikidata": "query"}


def dispatched(frontier: DataFrame) -> DataFrame:
    """Candidates with the adapter that takes them: that of their source, if it takes their kind; else null."""
    return frontier.withColumn("adapter", F.coalesce(*[F.when((F.col("source") == s) & (F.col("kind") == k), F.lit(s)) for s, k in ADAPTERS.items()]))


def name_histogram(entities: DataFrame) -> DataFrame:
    """How often the first three long tokens of localities, addresses and names stand for a place."""
    values = entities.select(F.explode(F.array("locality", "address", "name")).alias("v"))
    long = F.filter(F.regexp_extract_all(F.lower("v"), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: F.length(w) > 2)
    return values.select(F.array_join(F.slice(long, 1, 3), " ").alias("value")).where("value <> ''").groupBy("value").agg(F.count("*").alias("n"))
