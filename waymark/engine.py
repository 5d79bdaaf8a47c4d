"""The engine: a root folder with versioned tables, and the steps that a user runs over them, from seeds to served tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions import documents as dc
from waymark.functions import text as tx
from waymark.operators import publish as pb
from waymark.operators import quality as ql
from waymark.operators import refine as rf
from waymark.operators import resolution as rs
from waymark.operators import search as se
from waymark.operators import search_index as six
from waymark.operators.extract import relations
from waymark.operators.tables import keep_first, top_tokens, upsert
from waymark.sources import landed
from waymark.streaming.batches import Versions, candidate_key, crawl, first_frontier, remove, seeded
from waymark.streaming.buckets import Buckets


#: Columns of an entity. The first ones tell what it is, the later ones where it comes from and what it has, the last two when it was saved:
#: the version and the place in it, the order in which later ones meet it.
ENTITY = (
    "id string, name string, display_name string, aliases array<string>, entity_type string, category string, primary_category string, subcategories array<string>, description string, summary string, text string, locality string, address string, latitude double, longitude double, "
    "geo_precision string, website string, status string, confidence double, rating double, rating_count bigint, timings string, opening_hours_raw string, price_level string, amenities array<string>, phone_numbers array<string>, emails array<string>, "
    "intent_tags array<string>, negative_intent_tags array<string>, topics array<string>, sentiment string, popularity double, hidden_gem double, review_count bigint, context_keys array<string>, branch_ids array<string>, suitability_scores map<string,double>, extraction_mode string, has_contact boolean, has_social boolean, has_media boolean, event_known boolean, "
    "community_known boolean, source_names array<string>, source_types array<string>, sources array<struct<source: string, url: string, source_type: string, raw_path: string, extraction_confidence: double>>, "
    "media array<struct<id: string, url: string, source: string, caption: string, labels: array<string>, is_primary: boolean>>, "
    "relationships array<struct<predicate: string, object_id: string, object_name: string, confidence: double, evidence: string, source_url: string>>, first_seen_at timestamp, last_seen_at timestamp, turn bigint, place bigint"
)


def as_entities(rows: DataFrame) -> DataFrame:
    """Rows with all columns of an entity: absent ones and null lists are empty, sources and media tell what follows from them."""
    fields = {f.name: f.dataType for f in T._parse_datatype_string(ENTITY).fields}
    out = []
    for name, kind in fields.items():
        own = F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)
        if isinstance(kind, T.ArrayType):
            own = F.coalesce(own, F.array().cast(kind))
        elif isinstance(kind, T.MapType):
            own = F.coalesce(own, F.create_map().cast(kind))
        out.append(own.alias(name))
    e = rows.select(*out)
    names, kinds = F.transform("sources", lambda s: s.source), F.array_compact(F.transform("sources", lambda s: s.source_type))
    return e.withColumns({"source_names": F.when(F.size("source_names") > 0, F.col("source_names")).otherwise(names), "source_types": F.when(F.size("source_types") > 0, F.col("source_types")).otherwise(kinds),
                          "has_media": F.coalesce("has_media", F.lit(False)) | (F.size("media") > 0), "status": F.coalesce("status", F.lit("ACTIVE"))})


#: Number of the refinement's rules: a new one makes all entities go through them again.
RULES = 3
#: What a card shows of an entity.
CARD = ("id", "name", "category", "locality", "address", "latitude", "longitude", "image_id", "timings", "rating", "rating_count", "review_count", "review_snippets", "mood_tags", "intent_tags", "suitability_scores", "matched_terms", "moods", "distance_km",
        "relevance_score", "source_count", "website")


@dataclass(frozen=True)
class Settings:
    """What a run may be told: bounds of batches and pages, and the goals of reports."""

    max_depth: int = 3
    batch: int = 50
    target_ready: int = 500
    max_entities: int | None = None
    min_page_text: int = 500
    max_page_text: int = 12_000
    max_links: int = 20
    buckets: int = 16


class Engine:
    """Steps over tables under a root that driver and executors share. Each step reads the newest versions and writes the next ones."""

    def __init__(self, spark: SparkSession, root: str, settings: Settings = Settings()):
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings

    def table(self, name: str) -> Versions:
        """A table: in `buckets` hash buckets by its key if batches change parts of it, else in whole versions."""
        keys = {"entities": F.col("id"), "blocks": F.col("block"), "frontier": candidate_key()}
        path = f"{self.root}/{name}"
        return Buckets(self.spark, path, keys[name], self.settings.buckets) if name in keys else Versions(self.spark, path)

    def rows(self, name: str) -> DataFrame | None:
        t = self.table(name)
        return t.read() if t.at else None

    def needed(self, name: str) -> DataFrame:
        """A table's rows in the order of ids, at most max_entities of them where the settings say so."""
        rows = self.rows(name)
        if rows is None:
            raise ValueError(f"no table {name} under {self.root} yet")
        return rows if self.settings.max_entities is None else rows.orderBy("id").limit(self.settings.max_entities)

    # Frontier ---------------------------------------------------------------------------------------------------------

    def init(self) -> DataFrame:
        """The first frontier, or what there is of one with the seeds that it lacks."""
        return self.seed(first_frontier(self.spark))

    def seed(self, seeds: DataFrame) -> DataFrame:
        t = self.table("frontier")
        return t.write(seeded(t.read(), seeds) if t.at else seeds)

    def run(self, visit: Callable[[DataFrame], DataFrame], rounds: int = 1, gaps: Callable[[DataFrame], DataFrame] | None = None, found: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Crawl batches; visit lands what it finds and says what became of each candidate. found gives the entities of a batch's visits: they are
        resolved against those that are known before the frontier goes on, once for each batch, also where a run broke off between."""
        land = (lambda result, number: self.resolve(found(result), f"batch {number}")) if found is not None else None
        return crawl(self.table("frontier"), visit, self.settings.batch, rounds, self.settings.max_depth, gaps, land)

    def coverage(self) -> dict[str, list[tuple]]:
        """Counts of entities by category, locality and source, and how far the frontier lags behind."""
        e, f = self.needed("entities"), self.rows("frontier")
        count = lambda c: sorted(tuple(r) for r in e.groupBy(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))).count().collect())
        total, open_ = e.count(), f.count() if f is not None else 0
        sources = sorted(tuple(r) for r in e.select(F.explode("source_names").alias("s")).groupBy("s").count().collect())
        return {"category": count("category"), "locality": count("locality"), "source": sources, "plateau": [(round(max(0.0, 1 - min(open_, total) / total), 3) if total else 0.0,)]}

    # Entities ---------------------------------------------------------------------------------------------------------

    def add(self, entities: DataFrame) -> DataFrame:
        """Entities replace those of the same id; new ones are added. Rows of one id count as the one with the most sources, then the largest name.

        Nothing is compared: resolve() merges what is alike.
        """
        t = self.table("entities")
        once = keep_first(as_entities(entities), [F.col("id")], [F.desc(F.size("sources")), F.desc("name")])
        return self._save(t.at + 1, self._turned("added", once, t.at + 1))

    def resolve(self, entities: DataFrame, step: str | None = None) -> DataFrame:
        """Found entities, each merged into the known one that it matches best, or added: see operators.resolution. Returns all entities.

        Only blocks and entities that the found ones reach are read and written. A step that has a name is done once.
        """
        t, steps = self.table("entities"), self.table("steps")
        number = t.at + 1
        if step is not None and any(n <= t.at and steps.read(n).first()["step"] == step for n in steps.numbers()):
            return t.read()
        steps.write(self.spark.createDataFrame([(step,)], "step string"), number)
        own = self._turned("found", as_entities(entities), number)
        facts, scratch = rs.facts(own, False), f"{self.root}/scratch/{number:06d}"
        known = self.spark.createDataFrame([], facts.schema)
        if t.at:
            asked = rs.asked_blocks(facts).select("block").distinct()
            known = self.table("blocks").holding(asked).join(asked, "block", "left_semi").select(facts.columns).dropDuplicates(["node"])
        members = rs.resolved(facts, known, lambda df: Versions(self.spark, f"{scratch}/{uuid.uuid4().hex}").write(df))
        rows = own.withColumn("node", rs.found_node())
        if t.at:
            met = members.where(F.startswith("node", F.lit("known:"))).select(F.expr("substr(node, 7)").alias("id")).distinct()
            rows = rows.unionByName(t.holding(met).join(met, "id", "left_semi").withColumn("node", F.concat(F.lit("known:"), "id")))
        out = self._save(number, rs.folded(members, rows).select(own.columns))
        remove(self.spark, scratch)
        return out

    def _turned(self, name: str, rows: DataFrame, number: int) -> DataFrame:
        """Rows as they are worked off, numbered, written so that the numbers stay."""
        now = {c: F.coalesce(c, F.current_timestamp()) for c in ("first_seen_at", "last_seen_at")}
        return self.table(name).write(rows.withColumns({**now, "turn": F.lit(number).cast("bigint"), "place": F.monotonically_increasing_id()}), number)

    def _save(self, number: int, changed: DataFrame) -> DataFrame:
        """Entities of new content: blocks first, then the entities, whose version makes both count."""
        t, blocks = self.table("entities"), self.table("blocks")
        changed = self.table("changed").write(changed, number)
        fresh = rs.own_blocks(rs.facts(changed, True))
        gone = fresh.select("block", "id").limit(0)
        if t.at:
            gone = rs.own_blocks(rs.facts(t.holding(changed).join(changed.select("id"), "id", "left_semi"), True)).select("block", "id")
        blocks.change(number, fresh.select("block").unionByName(gone.select("block")), lambda before: fresh if before is None else before.join(gone, ["block", "id"], "left_anti").unionByName(fresh.select(before.columns)))
        return t.change(number, changed, lambda before: changed if before is None else upsert(before, changed.select(before.columns), "id", ["first_seen_at"]))

    def bulk(self, elements: DataFrame, group: str = "place") -> DataFrame:
        """Map elements as a table, with the reasons of those that are rejected."""
        return self.table("bulk").write(landed.map_entities(elements, group))

    def refine(self, reviews: DataFrame | None = None, geocodes: DataFrame | None = None, evidence: DataFrame | None = None, everything: bool = False) -> DataFrame:
        """Enrich from texts and reviews, decide, merge web evidence and decide again, and write entities, reviews and relations.

        Only entities whose inputs (their own row, reviews, geocoder's answer, evidence, and the number of the rules) differ from those
        that the newest refined version was made of go through; the others are carried over. everything: all go through.

        Beside what texts say, entities get the suitability of the engine's tags, topics, sentiment, popularity and the score of hidden gems.
        """
        e = self.needed("entities").withColumn("__reviews", F.lit(0))
        if reviews is not None:
            said = reviews.groupBy("entity_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda r: F.coalesce(r.text, F.lit(""))), " ").alias("__said"), F.count("*").alias("__n"))
            e = e.join(said, e.id == said.entity_id, "left").drop("entity_id").withColumns({"text": F.concat_ws(" ", "text", "__said"), "__reviews": F.coalesce("__n", F.lit(0))}).drop("__said", "__n")
            self.table("reviews").write(reviews.select(*[F.col(c).cast("string").alias(c) for c in ("id", "entity_id", "text")]))
        e = self._with_inputs(e, geocodes, evidence)
        before, same = self.rows("refined"), None
        if before is not None and "inputs" in before.columns and not everything:
            same = before.join(e.select("id", "inputs"), ["id", "inputs"], "left_semi")
            e = e.join(before.select("id", "inputs"), ["id", "inputs"], "left_anti")
        named = dc.enriched(e.withColumn("text", F.concat_ws(" ", "name", "category", "description", "locality", "address", "text")))
        meta = dc.engine_metadata(F.coalesce(F.nullif("primary_category", F.lit("")), "category"), F.col("locality"), F.col("text"), F.col("branch_ids"), F.col("context_keys"))
        named = named.withColumn("has_contact", F.coalesce("has_contact", F.lit(False)) | (F.size("emails") > 0) | (F.size("phone_numbers") > 0))
        tagged = named.withColumns({"branch_ids": meta["branch_ids"], "context_keys": meta["context_keys"], "intent_tags": dc.united(F.col("intent_tags"), meta["intent_tags"])})
        done = rf.refined(self._scored(tagged), geocodes)
        if evidence is not None:
            merged = rf.merged_evidence(done.withColumn("subcategories", F.coalesce("subcategories", F.array().cast("array<string>"))), rf.best_evidence(evidence))
            done = rf.refined(merged.drop("decision", "decision_score", "decision_reasons", "strong_identity", "needs_human_review", "review_reason"), geocodes)
        out = self.table("refined").write(done if same is None else done.unionByName(same, allowMissingColumns=True))
        signals = out.select("id", F.explode(tx.review_signals(F.col("id"), F.col("text"))).alias("s")).select("s.id", F.col("id").alias("entity_id"), "s.idx", "s.text")
        self.table("signals").write(signals)
        self.table("relations").write(relations(out))
        return out

    def _with_inputs(self, e: DataFrame, *more: DataFrame | None) -> DataFrame:
        """Entities with a fingerprint of all that their refinement reads; more: tables with rows for ids, in any order."""
        own = [c for c in e.columns if c not in ("turn", "place")]
        e = e.withColumn("inputs", F.xxhash64(F.lit(RULES), F.to_json(F.struct(*own))))
        for rows in more:
            if rows is None:
                e = e.withColumn("inputs", F.xxhash64("inputs", F.lit(None).cast("bigint")))
                continue
            sums = rows.groupBy(F.col("id").alias("__of")).agg(F.sum(F.xxhash64(F.to_json(F.struct(*rows.columns))).cast("decimal(20,0)")).alias("__sum"))
            e = e.join(sums, e.id == sums["__of"], "left").withColumn("inputs", F.xxhash64("inputs", F.coalesce("__sum", F.lit(0)).cast("string"))).drop("__of", "__sum")
        return e

    def _scored(self, e: DataFrame) -> DataFrame:
        """Entities with what their text, their rating, the number of their reviews and their sources are worth."""
        n, ratings, sources = F.col("__reviews"), F.coalesce("rating_count", F.lit(0)), F.size(F.array_distinct("source_names"))
        share = F.coalesce(F.col("rating") / 5, F.lit(0.0))
        found = dc.engine_scores(F.col("text"), share, n)
        found = F.when(F.size(found) > 0, found).otherwise(F.create_map(F.lit("explore"), ql.suitability(F.lit(0), share, n)))  # what stands for no tag
        had = F.map_filter("suitability_scores", lambda k, _: ~F.map_contains_key("__scores", k))
        rows = e.withColumn("__scores", found).withColumns({
            "suitability_scores": F.map_concat(had, "__scores"), "sentiment": dc.polarity(F.col("text")), "popularity": ql.popularity(ratings, n, sources), "hidden_gem": ql.hidden_gem(ratings, sources), "review_count": n.cast("bigint"),
        }).drop("__scores", "__reviews", "topics")
        said = top_tokens(rows, "id", "text").groupBy(F.col("id").alias("__id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda t: t.token).alias("topics"))
        return rows.join(said, rows.id == said["__id"], "left").withColumn("topics", F.coalesce("topics", F.array().cast("array<string>"))).drop("__id")

    def validate(self) -> DataFrame:
        """Quality of each refined entity, as a table."""
        return self.table("quality").write(pb.validated(self.needed("refined")).select("id", "name", "missing", "blockers", "warnings", "quality_score", "production_ready", "enrichment_queries"))

    def enrichment_candidates(self, most: int = 200) -> DataFrame:
        """Queries for the gaps of entities that may be enriched, in the order of ids until 3 * most candidates are there."""
        from waymark.operators.tables import capped

        rated = pb.validated(self.needed("refined"))
        fit = ~F.col("production_ready") & (F.coalesce(F.col("status") != rf.REJECTED, F.lit(True))) & ~F.array_contains("blockers", "low_confidence")
        rows = rated.where(fit).withColumn("queries", F.col("enrichment_queries"))
        return ql.gap_candidates(capped(rows, 2 * F.size("queries"), 3 * most))

    def image_candidates(self, limit: int | None = None) -> DataFrame:
        """Entities that only lack a picture, taken from the branches in turn, as many as the goal of ready ones still needs."""
        from waymark.functions import lexicons as lex
        from waymark.operators.tables import round_robin

        rated = pb.validated(self.needed("refined"))
        needed = max(0, self.settings.target_ready - rated.where("production_ready").count())
        only = (F.size(F.array_except("missing", F.array(F.lit("image")))) == 0) & (F.size(F.array_except("blockers", F.array(F.lit("missing_image")))) == 0) & ~F.col("production_ready")
        branch = dc.card_branch(F.col("own_category"), F.lower(F.concat_ws(" ", "name", "own_category")))
        order = [F.desc(F.coalesce("confidence", F.lit(0.0))), F.desc(F.lower("name")), F.col("id")]
        return round_robin(rated.where(only).withColumn("branch", branch), "branch", lex.BRANCHES, order).orderBy("turn", "group_order").limit(needed if limit is None else min(needed, limit))

    def normalize_branches(self) -> DataFrame:
        """Branches of served entities and the tags that they bring; entities, with changed saying which ones are new."""
        e = self.needed("refined")
        category = F.coalesce(F.nullif("primary_category", F.lit("")), "category")
        fit = ql.recommendable(F.col("name"), category, F.col("status")) & ~ql.source_like(F.col("name"), F.col("latitude"), F.col("longitude"))
        branch = dc.card_branch(category, F.lower(F.concat_ws(" ", "name", category, F.array_join("intent_tags", " "))))
        own = e.where(fit).withColumn("branch", branch)
        fresh = dc.branch_normalised(F.col("branch"), F.col("intent_tags"), F.col("context_keys"), F.col("branch_ids"))
        return self.table("branches").write(own.select("id", "branch", *[c.alias(k) for k, c in fresh.items()]))

    # Serving ----------------------------------------------------------------------------------------------------------

    def sources(self) -> DataFrame:
        return landed.registry(self.spark)

    def search(self, query: str, limit: int = 100, lat: float | None = None, lon: float | None = None) -> DataFrame:
        """The best cards of ready entities for a query, as a table of one version beside the others: from the index of the refined entities where
        there is one, else from themselves. Their reviews' words count."""
        at = self.table("indexed")
        index = None
        if at.at and (row := at.read().first())["refined"] == self.table("refined").at:
            index = six.Index(self.spark, row["path"])
        ready = index.read("cards") if index else self._ready()
        asked = se.hinted(se.compiled(query, lat, lon), ready)
        found = six.search(index, asked, limit).cards if index else se.top(se.cards(ready, asked, whole=True), limit)
        return self.table("search").write(found.select(*CARD))

    def _ready(self) -> DataFrame:
        """Ready entities as cards are made of them."""
        ready = pb.validated(self.needed("refined")).where("production_ready").withColumns({"image_id": F.get("media", F.lit(0)).id, "n_sources": F.size("sources"), "source_count": F.size(F.array_distinct("source_names"))})
        reviews = self.rows("reviews")
        if reviews is None:
            reviews = self.spark.createDataFrame([], "id string, entity_id string, text string")
        return pb.with_reviews(ready.drop("review_count"), reviews, reviews.limit(0))

    def index_cards(self) -> six.Index:
        """Index the ready entities of the newest refined version for search()."""
        marker = self.table("indexed")
        index = six.Index.write(self._ready(), f"{self.root}/index/n={marker.at + 1:06d}")
        marker.write(self.spark.createDataFrame([(index.path, self.table("refined").at)], "path string, refined long"))
        return index

    def publish(self, reviews: DataFrame, pages: DataFrame, images: DataFrame) -> str:
        """Write the nine served tables as one version, and only then name it as the published one. Returns its folder."""
        marker = self.table("published")
        path = f"{self.root}/served/v={marker.at + 1:06d}"
        for name, df in pb.served_tables(self.needed("refined"), reviews, pages, images).items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        marker.write(self.spark.createDataFrame([(path,)], "path string"))
        return path

    def published(self, name: str) -> DataFrame:
        """A served table of the newest published version."""
        return self.spark.read.parquet(f"{self.table('published').read().collect()[0]['path']}/{name}")
