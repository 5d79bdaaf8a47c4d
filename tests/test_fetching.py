"""Robots rules against the standard library's reader, starts of requests against the loop, delays by hand."""

import random
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from waymark.operators import fetching

BODIES = [
    "User-agent: *\nDisallow: /private\nAllow: /\n", "User-agent: *\nAllow: /a/b\nDisallow: /a\n\nUser-agent: mybot\nDisallow: /\n", "# nothing\n", "", "Disallow: /x\nUser-agent: *\n\nDisallow: /y\n",
    "User-agent: other\nUser-agent: MyBot\nDisallow: /only # here\nCrawl-delay: 5\nDisallow:\n", "User-agent: my\nDisallow: *\n", "User-agent: *\r\nDisallow: /?q\r\n\r\nUser-agent: *\r\nDisallow: /second\r\n", "User-agent: *\nnonsense\nDisallow: /p\n# c\nDisallow: /q", "user-agent:*\ndisallow:/%63\nDisallow: /+\nUser-agent: z\nDisallow: /",
]
PATHS = ["", "/", "/private/x", "/a/b/c", "/a/x", "/only/1", "/x", "/y", "/?q=1", "/second", "/p", "/q?x#f", "/c", "?q", "/%70/z", "/a%2Fb", "/+x"]


@pytest.mark.parametrize("agent", ["MyBot/1.0", "someone"])
def test_robots_rules_equal_the_standard_reader(spark, agent):
    want, urls = {}, []
    for i, body in enumerate(BODIES):
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        parser.modified()
        for p in PATHS:
            urls.append(f"https://h{i}.example{p}")
            want[urls[-1]] = parser.can_fetch(agent, urls[-1])
    robots = [(f"https://h{i}.example", 200, b) for i, b in enumerate(BODIES)] + [("https://no.example", 403, None), ("https://gone.example", 404, "User-agent: *\nDisallow: /"), ("https://down.example", 503, None), ("https://mute.example", None, None)]
    more = {"https://no.example/": False, "https://gone.example/": True, "https://down.example/a": False, "https://mute.example/": True, "https://unseen.example/": True, "/relative": True, "": True}
    df = spark.createDataFrame([(u,) for u in [*urls, *more]] + [(None,)], "url string")
    got = {r.url: r.may_fetch for r in fetching.allowed(df, spark.createDataFrame(robots, "origin string, status int, body string"), agent).collect()}
    assert got == want | more | {None: True}


def test_request_starts_equal_the_loop(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *[rng.random() * 300] * 9]), rng.choice([None, None, None, 0.5, 20.0, 60.0])) for i in range(700)]
    got = {r.id: r.start for r in fetching.request_starts(spark.createDataFrame(rows, "id int, host string, arrival double, hold double").repartition(5)).collect()}
    for host in ("a", "b", None):
        free = None
        for i, _, arrival, hold in sorted((r for r in rows if r[1] == host), key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
            if arrival is None:
                assert got[i] is None
                continue
            start = arrival if free is None else max(arrival, free)
            assert got[i] == pytest.approx(start)
            free = start + max(1.2, hold or 0)
    assert fetching.request_starts(spark.createDataFrame([], "id int, host string, arrival double, hold double")).count() == 0


def test_retry_delays(spark):
    rows = [(1, 429, 0, "7"), (2, 429, 1, "0"), (3, 429, 0, "9999"), (4, 429, 0, None), (5, 429, 0, "soon"), (6, 500, 0, None), (7, 503, 2, "5"), (8, None, 1, None), (9, 500, 3, None), (10, 404, 0, None), (11, 200, 0, None), (12, 429, 0, "Thu, 01 Jan 1970 00:01:40 GMT"), (13, 429, 0, "Thu, 01 Jan 1970 00:00:05 GMT")]
    df = spark.createDataFrame(rows, "id int, status int, attempt int, said string")
    c = F.col
    got = {r.id: r.d for r in df.select("id", fetching.retry_delay(c("status"), c("attempt"), c("said"), F.lit(60.0), F.lit(0.5)).alias("d")).collect()}
    assert got == {1: 7.0, 2: 1.0, 3: 120.0, 4: 30.0, 5: 30.0, 6: 1.5, 7: 4.5, 8: 2.5, 9: None, 10: None, 11: None, 12: 40.0, 13: 1.0}
