"""What requests may be made and when, as tables: robots rules joined to urls, starts of requests by host, delays before retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymark.operators.scratch import kept

#: Least time between two requests of a host, longest wait before a retry, wait where a limited host names none, all in seconds; attempts at most.
SPACING, LONGEST, UNNAMED, ATTEMPTS = 1.2, 120.0, 30.0, 4
RETRIED = (429, 500, 502, 503, 504)
AGENTS, RULES = ("user-agent",), ("allow", "disallow")


def robots_rules(robots: DataFrame) -> DataFrame:
    """origin, entry, agents, rules of each group of a robots file: rules are structs of path and allowed, in the file's order.

    robots: origin and body. A group is some lines of agents and the rules behind them; a blank line ends it, and agents without rules before one
    are none. Comments, other keys and rules before any agent count for nothing; a disallow without a path allows everything.
    """
    line = robots.select("origin", F.posexplode(F.split(F.coalesce("body", F.lit("")), r"\r\n|\r|\n")).alias("at", "raw"))
    said = F.trim(F.regexp_replace("raw", "#.*", ""))
    both = F.split(said, ":", 2)
    line = line.withColumns({"blank": F.trim("raw") == "", "key": F.lower(F.trim(both[0])), "value": F.trim(F.get(both, F.lit(1)))})
    known = F.col("value").isNotNull() & F.col("key").isin(*AGENTS, *RULES)
    kind = F.when(F.col("blank"), "blank").when(known & F.col("key").isin(*AGENTS), "agent").when(known, "rule")
    line = line.withColumn("kind", kind).where("kind is not null")
    order = Window.partitionBy("origin").orderBy("at")
    starts = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(order), F.lit("blank")) != "agent")
    line = line.withColumn("starts", starts | (F.col("kind") == "blank")).withColumn("entry", F.sum(F.col("starts").cast("int")).over(order))
    rule = F.struct("at", F.col("value").alias("path"), ((F.col("key") == "allow") | (F.col("value") == "")).alias("allowed"))
    listed = lambda x, k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, x)))
    groups = line.where("kind <> 'blank'").groupBy("origin", "entry").agg(listed(F.struct("at", F.lower("value").alias("agent")), "agent").alias("a"), listed(rule, "rule").alias("r"))
    agents, rules = F.transform("a", lambda x: x.agent), F.transform("r", lambda x: F.struct(x.path.alias("path"), x.allowed.alias("allowed")))
    return groups.where((F.size("a") > 0) & (F.size("r") > 0)).select("origin", "entry", agents.alias("agents"), rules.alias("rules"))


def agent_rules(groups: DataFrame, agent: str) -> DataFrame:
    """origin and the rules for an agent: of the first group that names a part of the agent's name, else of the first one for all."""
    name = agent.split("/")[0].lower()
    named = F.exists("agents", lambda a: (a != "*") & F.contains(F.lit(name), a))
    rank = F.when(named, 0).when(F.array_contains("agents", "*"), 1)
    return groups.withColumn("rank", rank).where("rank is not null").groupBy("origin").agg(F.min_by("rules", F.struct("rank", "entry")).alias("rules"))


def decoded(x: Column) -> Column:
    """Percent signs resolved, where they can be: paths are compared as they read."""
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def allowed(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """urls with may_fetch: the first rule whose path begins the url's decides; without rules everything may be fetched.

    urls: url. robots: origin (scheme and host), status and body of each file, null where it could not be read. Files that were refused
    (401, 403) forbid everything, those of failing servers too; those that are not there, or that no answer came for, forbid nothing. A url without scheme or host may be fetched.
    """
    origin, path = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1), F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^#]*)", 1)
    asked = urls.withColumns({"__origin": F.nullif(origin, F.lit("")), "__path": F.when(path == "", F.lit("/")).otherwise(decoded(path))})
    rules = agent_rules(robots_rules(robots.where("status between 200 and 399")), agent)
    known = robots.select(F.col("origin").alias("__origin"), "status").join(rules.withColumnRenamed("origin", "__origin"), "__origin", "left")
    first = F.get(F.filter("rules", lambda r: F.startswith(F.col("__path"), decoded(r.path))), F.lit(0)).allowed
    may = F.when(F.col("status").isin(401, 403) | (F.col("status") >= 500), False).when(F.col("status").between(200, 399), F.coalesce(first, F.lit(True))).otherwise(True)
    return asked.join(known, "__origin", "left").withColumn("may_fetch", may).drop("__origin", "__path", "status", "rules")


def retry_delay(status: Column, attempt: Column, retry_after: Column, now: Column, jitter: Column) -> Column:
    """Seconds before the next attempt (attempts count from 0): null where none is made.

    retry_after: what a limited host says, seconds or a date. now: seconds of the clock. status: null for a request without an answer.
    """
    said = F.trim(retry_after).try_cast("double")
    until = F.try_to_timestamp(F.regexp_replace(F.trim(retry_after), "^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss")).cast("double") - now
    wait = F.coalesce(said, until)
    limited = F.when(wait.isNull(), UNNAMED).otherwise(F.least(F.lit(LONGEST), F.greatest(F.lit(1.0), wait)))
    usual = F.least(F.lit(LONGEST), F.pow(F.lit(2.0), attempt) + jitter)
    again = (status.isNull() | status.isin(*RETRIED)) & (attempt < ATTEMPTS - 1)
    return F.when(again, F.when(F.coalesce(status == 429, F.lit(False)), limited).otherwise(usual))


def request_starts(requests: DataFrame, spacing: float = SPACING) -> DataFrame:
    """requests (id, host, arrival, and hold: seconds for which the host is closed after it, or null) with start: the earliest second at which each
    may begin, as they come: start = max(arrival, start before + the larger of spacing and hold before), by arrival and id.

    With gaps added up to G before each request, start - G is the greatest arrival - G so far, so there is no loop. Requests are dealt in
    ranges of (host, arrival, id); a range's sum of gaps and greatest difference are carried to the host's later ranges, so no task
    holds a host. A request without a host, arrival or id keeps its place among others of a null host; without arrival it has no start.
    """
    keys = ["host", "arrival", "id"]
    gap = F.greatest(F.lit(float(spacing)), F.coalesce("hold", F.lit(0.0)).cast("double"))
    dealt = kept(requests.withColumn("__gap", gap).repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    inner = Window.partitionBy("host", "__part").orderBy("arrival", "id")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("__sum", F.coalesce(F.sum("__gap").over(before), F.lit(0.0))).withColumn("__over", F.col("arrival") - F.col("__sum"))
    parts = own.groupBy("host", "__part").agg(F.sum("__gap").alias("total"), F.max("__over").alias("most"))
    earlier = Window.partitionBy("host").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__base", F.coalesce(F.sum("total").over(earlier), F.lit(0.0))).withColumn("__level", F.max(F.col("most") - F.col("__base")).over(earlier)).select(F.col("host").alias("__host"), F.col("__part").alias("__of"), "__base", "__level")
    joined = own.join(parts, own.host.eqNullSafe(F.col("__host")) & (F.col("__part") == F.col("__of")))
    level = F.greatest(F.max(F.col("__over") - F.col("__base")).over(inner.rowsBetween(Window.unboundedPreceding, 0)), F.col("__level"))
    start = F.when(F.col("arrival").isNotNull(), level + F.col("__base") + F.col("__sum"))
    return joined.withColumn("start", start).select(*requests.columns, "start")
