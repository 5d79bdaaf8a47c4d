"""WARC (2): archives written and read through Spark, and an external merge of capture runs into an ordered index."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.runtime import salted, scratch, written

#: Captures of an index range, about; rows sampled from all runs for the ranges' bounds: at least, about, and for each range.
RANGE_ROWS, SAMPLE, FOR_RANGE = 50_000, 20_000, 8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURES = (
    "url_key string, captured string, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, stored_digest string, file string, offset bigint, length bigint"
)


def base32(sha: Column) -> Column:
    """Upper-case base32 of a digest of 40 hex digits: each 10 of them are 8 letters."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(sha, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, without scheme, user, leading www, default port and fragment; lower-case host, then path and query."""
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?]*)", 1)), r"^www\d*\.|:(80|443)$", "")
    path = F.regexp_replace(rest, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))


def record_id(page_id: Column) -> Column:
    """A URN whose last 16 hex digits are the page's number."""
    digits = F.lpad(F.lower(F.hex(page_id)), 16, "0")
    return F.concat(F.lit("<urn:uuid:00000000-0000-8000-"), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">"))


def page_of(urn: str) -> int:
    number = int(urn.rstrip(">")[-17:].replace("-", ""), 16)
    return number - (1 << 64) if number >> 63 else number


def records(pages: DataFrame, least: int) -> DataFrame:
    """Pages with digest, record_type and refers_to. Of equal payloads of at least `least` bytes the smallest page_id is the response.

    Payloads are compared by their SHA-1 in hex, taken once wherever it is read; its base32 form is made of the joined column.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), body.alias("html"), F.sha1(body.cast("binary")).alias("sha"), F.octet_length(body).alias("size"))
    slim = rows.select("page_id", "sha", "size")
    first = slim.where(F.col("size") >= least).groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").select("sha", "refers_to")
    found = salted(slim.select("page_id", "sha"), first, ["sha"], F.col("page_id"), "inner").where("page_id <> refers_to").select("page_id", "sha", "refers_to").distinct()
    joined = rows.join(found, ["page_id", "sha"], "left").withColumn("digest", base32(F.col("sha"))).drop("sha")
    return joined.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def write_archives(pages: DataFrame, path: str, captured: Column, least: int = 0) -> None:
    """Write one WARC/1.1 record for each page into gzip files under path, one for each partition of the join that finds revisits.

    Spark's text writer puts the records: a record is a line whose separator is the CR LF CR LF that ends records, so the usual
    commit protocol holds on any file system. A revisit holds no payload but names the response and the payload's size. Payloads
    are shuffled once; files are as large as a shuffle partition, and are read as a stream.
    """
    rows = records(pages, least)
    stored = F.when(F.col("record_type") == "response", F.col("html")).otherwise("")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type", F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), captured, F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "digest", F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("\r\nWARC-Refers-To: "), record_id(F.col("refers_to")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(stored).cast("string"), F.lit("\r\n\r\n"), stored,
    )
    rows.select(head.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def inflated(content: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of a file's bytes; gzip, of one or more members, is unpacked as it goes."""
    if bytes(content[:2]) != b"\x1f\x8b":
        for at in range(0, len(content), step):
            yield bytes(content[at : at + step])
        return
    unpack = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        piece = bytes(content[at : at + step])
        while piece:
            yield unpack.decompress(piece)
            piece = unpack.unused_data
            if unpack.eof and piece:
                unpack = zlib.decompressobj(31)


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Header fields (names in lower case), block, offset and length of each record of an archive, framed by Content-Length."""
    held, offset = bytearray(), 0

    def has(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while has(1):
        want = 4096
        while (stop := held.find(b"\r\n\r\n")) < 0:
            if not has(want):
                if (stop := held.find(b"\r\n\r\n")) >= 0:
                    break
                raise ValueError(f"no end of a record's header at byte {offset}")
            want = len(held) + 4096
        lines = held[:stop].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = stop + 4
        end = block + int(fields["content-length"])
        if not lines[0].startswith("WARC/") or not has(end + 4) or held[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"broken record at byte {offset}")
        yield fields, bytes(held[block:end]), offset, end + 4
        del held[: end + 4]
        offset += end + 4


def captures_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["captured", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "stored_digest", "file", "offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for i in range(batch.num_rows):
            content, file = memoryview(batch.column("content")[i].as_buffer()), batch.column("path")[i].as_py().rsplit("/", 1)[-1]
            rows = []
            for fields, block, offset, length in parsed(inflated(content)):
                refers = fields.get("warc-refers-to")
                response = fields["warc-type"] == "response"
                stored = base64.b32encode(hashlib.sha1(block).digest()).decode() if response else None
                size = len(block) if response else int(fields.get("x-payload-length", 0))
                rows.append((fields["warc-date"], page_of(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], page_of(refers) if refers else None,
                             size, stored or fields["warc-payload-digest"].removeprefix("sha1:"), stored, file, offset, length))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_archives(df_session, path: str) -> DataFrame:
    """Captures of all archives under path. Offsets are those in the unpacked archive."""
    files = df_session.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = CAPTURES.split(", ", 1)[1]
    return files.mapInArrow(captures_of, schema).withColumn("url_key", url_key(F.col("url"))).select(*[c.split()[0] for c in CAPTURES.split(", ")])


class LoserTree:
    """Merges sorted runs: inner nodes hold the losers of their matches, so the next winner is found along one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * self.k
        for run in range(self.k):
            self.replay(run)

    def key(self, run: int):
        """Sorts finished runs last, and equal keys by run."""
        at = self.at[run]
        return (0, self.runs[run][at], run) if at < len(self.runs[run]) else (1, (), run)

    def replay(self, run: int) -> None:
        node = (run + self.k) // 2
        winner = run
        while node > 0:
            other = self.losers[node]
            if other < 0:  # while the tree is built: wait for the opponent
                self.losers[node] = winner
                return
            if self.key(other) < self.key(winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in the run) of each item, in order."""
        if not self.k:
            return
        while self.at[self.winner] < len(self.runs[self.winner]):
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            self.replay(run)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each range; rows come by (range, run, place), a run's rows in its order, a range's rows being of bounded number."""

    def out(table: pa.Table) -> pa.Table:
        run = table["run"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        keys = list(zip(*(table[c].to_pylist() for c in ("url_key", "captured", "page_id", "file", "offset"))))
        order = [edges[r] + i for r, i in LoserTree([keys[a:b] for a, b in zip(edges, edges[1:])])]
        table = table.take(pa.array(order))
        place = (table["range"].to_numpy().astype(np.int64) << 32) + np.arange(len(order))
        return table.drop_columns(["range", "run", "place"]).append_column("position", pa.array(place))

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        which = table["range"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(which)]
        for a, b in zip(edges, edges[1:]):
            part = table.slice(a, b - a)
            if held and held[0]["range"][0].as_py() != part["range"][0].as_py():
                yield from out(pa.concat_tables(held)).to_batches()
                held = []
            held.append(part)
    if held:
        yield from out(pa.concat_tables(held)).to_batches()


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each row in its sorted run."""
    place = 0
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(place, place + batch.num_rows))], names=[*batch.schema.names, "place"])
        place += batch.num_rows


def ranged(batches: Iterator[pa.RecordBatch], bounds: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The range of each row. Adjoining rows of a run are sorted, so those of one range adjoin: ranges are looked up by halving."""
    from bisect import bisect_right

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("url_key", "captured", "page_id"))))
        which = np.zeros(len(keys), np.int32)
        steps = np.diff(batch.column("place").to_numpy()) != 1
        edges = [0, *(np.flatnonzero(steps | (np.diff(batch.column("run").to_numpy()) != 0)) + 1).tolist(), len(keys)]
        spans = list(zip(edges, edges[1:]))
        while spans:
            a, b = spans.pop()
            low = bisect_right(bounds, keys[a])
            if b - a == 1 or low == bisect_right(bounds, keys[b - 1]):
                which[a:b] = low
            else:
                spans += [(a, (a + b) // 2), ((a + b) // 2, b)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(which)], names=[*batch.schema.names, "range"])


def capture_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures with position, ordered over the whole index by URL key, time and page.

    Each partition is sorted into a run, whose rows are numbered, and written. Bounds from a sample of all runs cut every run into ranges of
    about range_rows captures; a bound is a key with its time and page, so one URL or host with very many captures spreads over
    many ranges. The shuffle that deals ranges brings a run's rows back in order by their numbers alone, and a loser tree merges the
    runs of a range: keys are compared there only. The sample has some FOR_RANGE keys a range, so a range stays of bounded size; the
    driver holds one key for each 6,000 captures.
    """
    names = [f.name for f in captures.schema.fields]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in captures.schema.fields)
    runs = captures.sortWithinPartitions("url_key", "captured", "page_id", "file", "offset").mapInArrow(numbered, f"{columns}, place bigint")
    runs = written(runs.withColumn("run", F.spark_partition_id()), "runs")
    n = runs.count()
    ranges = max(1, -(-n // range_rows))
    share = min(1.0, max(SAMPLE, FOR_RANGE * ranges) / max(1, n))
    drawn = runs.select("url_key", "captured", "page_id").where(F.pmod(F.xxhash64("run", "place"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    sample = sorted(tuple(r) for r in drawn.collect())
    ranges = min(len(sample) + 1, ranges)
    bounds = [sample[len(sample) * i // ranges] for i in range(1, ranges)]
    cut = runs.select(*names, "run", "place").mapInArrow(lambda it: ranged(it, bounds), f"{columns}, run int, place bigint, range int")
    dealt = cut.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "run", "place")
    return dealt.mapInArrow(merged, f"{CAPTURES}, position bigint")


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archive all pages, read the archives back, and return their ordered index.

    WARC-Date is 2020-01-01 plus page_id seconds, as pages have no time. Payload is html in UTF-8; a null is empty. Rows that repeat a page_id are
    archived each, by their own payloads; of equal payloads those with the smallest page_id are responses. A row with a null page_id takes no part. A null url is empty.
    Other columns are ignored. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    path = scratch(spark, "archives")
    captured = F.date_format(F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.col("page_id"), F.lit(1 << 31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    write_archives(pages.select("page_id", "url", "html").where("page_id is not null"), path, captured, least)
    return capture_index(read_archives(spark, path))
