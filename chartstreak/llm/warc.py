"""WARC archives of pages and their capture index.

``write_warc`` writes one record per page: a ``response`` for the page with the
smallest id of each distinct payload, a ``revisit`` for the others. Records are
built from column expressions and written by Spark's text writer (record
separator CRLF CRLF, gzip), so any file system Spark can reach will do and a
lost executor only costs its task. The payload digests are aggregated first
(one row per digest, partial aggregation before the shuffle); joining that
verdict back is a sort-merge join whose hot digests Spark splits.

``read_captures`` reads the archives back by content length, checks every
payload against its digest and returns one capture run per file, sorted by
(URL key, time, id).

``merge_index`` is the external merge: boundaries from a sample of bounded size
cut each sorted run into pieces, the pieces of a key range meet in one task and
a loser tree merges them, however many there are. The driver holds at most about
``driver_marks`` sampled keys; where the captures need more ranges than these
give, each range is cut again by its own marks, which stay in a table. A range
thus holds about ``rows_per_shard`` captures at any size. The boundaries include
time and id, so one URL with a third of all captures still spreads over many
ranges. (``shard``, ``position``) is the global order of the capture histories.

``offset`` and ``length`` count bytes of the archive's records. With
``compression="none"`` they are places in the file itself, so ``read_record``
reads a capture by them alone; a gzip archive is one stream per file and is read
whole.

Defined results: null html is an empty payload, null url an empty target; line
ends in a url are written as %0D and %0A. Payloads below ``min_payload`` bytes
are always responses. Rows that repeat the smallest page id of a payload are
responses too; null ids sort behind all others. An empty table gives an empty
archive and index. Other columns are not read. A capture time that is null is the
epoch. Files hold ``file_bytes`` of payload on average, at least one record each:
records are written in the order of their digests, so sizes are mixed as by
chance and large pages that stand together in the input do not meet in a file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartstreak.llm.common import quoted, table, text_of
from chartstreak.session import materialise, shared_path, workers_import_package

# Fixed values of the WARC 1.1 format and of base32.
EOL = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
GZIP = b"\x1f\x8b"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CAPTURE = ("page_id long, url string, url_key string, captured string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, file string, offset long, length long")
ENTRY = [c.split()[0] for c in CAPTURE.split(", ")]
KEY = ["url_key", "captured", "page_id"]


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: ten hex digits are eight base32 digits."""
    hexa = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexa, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32HEX, BASE32)


def url_key(url: Column) -> Column:
    """Sort key: host labels reversed, ``)``, path and query; no scheme, www, port or fragment."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\d*\.)?([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                    F.when(path == "", "/").otherwise(path))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               captured: Column | None = None, min_payload: int = 0, file_bytes: int = 32 << 20,
               compression: str = "gzip") -> int:
    """Write the archive of ``pages`` below ``path``; returns the number of records."""
    epoch = F.lit("1970-01-01T00:00:00Z")
    captured = epoch if captured is None else F.coalesce(captured.cast("string"), epoch)
    src = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), text_of(url_col).alias("url"),
                       text_of(html_col).alias("html"), captured.alias("captured"))
    src = src.withColumn("digest", base32_sha1(F.encode("html", "UTF-8"))).withColumn("size", F.octet_length("html"))
    first = materialise(src.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"),
                                                  F.sum("size").alias("bytes")), "warc-digests")
    total = first.agg(F.sum("n"), F.sum("bytes")).first()
    n, size = total[0] or 0, total[1] or 0
    rows = src.join(first.select("digest", "first_id").hint("merge"), "digest")
    response = ((F.col("size") < min_payload) | F.col("page_id").eqNullSafe(F.col("first_id")))
    urn = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.col("size").cast("string"), F.lit(EOL * 2))
    block = F.concat(http, F.when(response, F.col("html")).otherwise(""))
    header = F.concat(
        F.lit(f"{VERSION}{EOL}WARC-Type: "), F.when(response, "response").otherwise("revisit"),
        F.lit(f"{EOL}WARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"{EOL}WARC-Target-URI: "), target,
        F.lit(f"{EOL}WARC-Target-Key: "), url_key(target), F.lit(f"{EOL}WARC-Date: "), F.col("captured"),
        F.lit(f"{EOL}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(response, "").otherwise(F.concat(F.lit(f"{EOL}WARC-Profile: {PROFILE}{EOL}WARC-Refers-To: "),
                                                urn(F.col("first_id")))),
        F.lit(f"{EOL}Content-Type: application/http; msgtype=response{EOL}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(EOL * 2))
    records = rows.select(F.concat(header, block).alias("value"))
    per_file = max(1, int(file_bytes * n / size)) if size else 1_000_000
    (records.write.option("lineSep", EOL * 2).option("compression", compression)
     .option("maxRecordsPerFile", per_file).text(path))
    return n


def parse_records(content: bytes):
    """(offset, length, headers, HTTP block) of each record of an uncompressed archive."""
    at, end = 0, len(content)
    while at < end:
        stop = content.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in content[at:stop].decode().split(EOL)[1:])
        start = stop + 4
        after = start + int(head["Content-Length"])
        yield at, after - at, head, content[start:after]
        at = after + 4


def _number(urn: str | None):
    value = urn[len("<urn:capture:"):-1] if urn else "none"
    return None if value == "none" else int(value)


def _capture(file: str, offset: int, length: int, head: dict, block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"{file} at {offset}: payload does not match its digest")
    return (_number(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Target-Key"], head["WARC-Date"], size,
            digest, head["WARC-Type"], _number(head.get("WARC-Refers-To")), file, offset, length)


def order(entry: tuple) -> tuple:
    """Sort key of a capture: URL key, time, id with null ids last."""
    return entry[2], entry[3], entry[0] is None, entry[0] or 0, entry[8], entry[9]


def _runs(batches):
    for files in batches:
        for path, content in zip(files["path"], files["content"]):
            plain = gzip.decompress(content) if content[:2] == GZIP else content
            run = [_capture(path, *x) for x in parse_records(plain)]
            run.sort(key=order)
            for i in range(0, len(run), 10_000):
                yield _frame(run[i:i + 10_000])


def read_record(file, offset: int, length: int) -> tuple[dict, bytes]:
    """Headers and HTTP block of the record at ``offset`` of an open, uncompressed archive file."""
    file.seek(offset)
    (_, _, head, block), = parse_records(file.read(length))
    return head, block


def _frame(entries: list) -> pd.DataFrame:
    out = pd.DataFrame(entries, columns=ENTRY)
    for c in ("page_id", "refers_to"):
        out[c] = out[c].astype("Int64")
    return out


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of an archive, one sorted run per file."""
    workers_import_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(_runs, CAPTURE)


def loser_tree(runs: list):
    """Merge sorted lists of (key, value) by a tournament tree that stores the losers."""
    runs = [r for r in runs if r]
    k = len(runs)
    if not k:
        return
    heads = [0] * k
    last = object()

    def beats(a, b) -> bool:
        if a is last or b is last:
            return b is last
        x, y = runs[a], runs[b]
        if heads[a] >= len(x) or heads[b] >= len(y):
            return heads[a] < len(x)
        return (x[heads[a]][0], a) < (y[heads[b]][0], b)

    tree: list = [last] * k
    winners: list = [last] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    win = winners[1] if k > 1 else 0
    while heads[win] < len(runs[win]):
        yield runs[win][heads[win]][1]
        heads[win] += 1
        node = (win + k) // 2
        while node:
            if beats(tree[node], win):
                tree[node], win = win, tree[node]
            node //= 2


def _cut(bounds: list):
    def cut(batches):
        for frame in batches:
            pieces: dict = {}
            for e in frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None):
                pieces.setdefault((e[8], bisect_right(bounds, order(e)[:4])), []).append(e)
            yield pd.DataFrame({"shard": [s for _, s in pieces],
                                "piece": [[dict(zip(ENTRY, e)) for e in p] for p in pieces.values()]})
    return cut


def _merge(key, frame: pd.DataFrame) -> pd.DataFrame:
    runs = []
    for piece in frame["piece"]:
        entries = [tuple(e[c] for c in ENTRY) for e in piece]
        runs.append([(order(e), e) for e in entries])
    out = _frame(list(loser_tree(runs)))
    out.insert(0, "position", range(len(out)))
    out.insert(0, "shard", key[0])
    return out


def _cut_again(per: int):
    def again(batches):
        for frame in batches:
            shards, pieces = [], []
            for shard, piece, marks in zip(frame["shard"], frame["piece"], frame["marks"]):
                marks = [(m["url_key"], m["captured"], m["missing"], m["id"]) for m in (() if marks is None else marks)]
                bounds = [marks[i * len(marks) // per] for i in range(1, per)] if marks else []
                parts: dict = {}
                for e in piece:
                    parts.setdefault(bisect_right(bounds, order(tuple(e[c] for c in ENTRY))[:4]), []).append(e)
                shards += [shard * per + part for part in parts]
                pieces += parts.values()
            yield pd.DataFrame({"shard": shards, "piece": pieces})
    return again


def merge_index(captures: DataFrame, rows_per_shard: int = 20_000, driver_marks: int = 200_000,
                marks_per_shard: int = 20) -> DataFrame:
    """Captures in global order of (URL key, time, id): columns ``shard``, ``position`` and the capture.

    The boundaries come from a sample of about ``marks_per_shard`` keys per
    shard. The driver takes about ``driver_marks`` of them at most and cuts the
    captures into as many ranges as these allow; a range that is to be more
    than one shard is cut by the marks of its own, joined by its number.
    """
    spark = captures.sparkSession
    workers_import_package(spark)
    captures = materialise(captures, "capture-runs")
    n = captures.count()
    shards = max(1, -(-n // rows_per_shard))
    ranges = min(shards, max(1, driver_marks // marks_per_shard))
    per = -(-shards // ranges)
    want = ranges * marks_per_shard
    bounds: list = []
    if ranges > 1:
        sample = captures.select(*KEY).sample(fraction=min(1.0, want / n), seed=7).limit(2 * want).collect()
        marks = sorted((r[0], r[1], r[2] is None, r[2] or 0) for r in sample)
        bounds = [marks[i * len(marks) // ranges] for i in range(1, ranges)] if marks else []
    schema = f"shard long, piece array<struct<{CAPTURE.replace(' ', ':').replace(',:', ',')}>>"
    pieces = captures.mapInPandas(_cut(bounds), schema)
    if per > 1:
        pieces = materialise(pieces, "capture-ranges")
        mark = F.struct("url_key", "captured", F.col("page_id").isNull().alias("missing"),
                        F.coalesce("page_id", F.lit(0)).alias("id"))
        sample = pieces.select("shard", F.inline("piece")).sample(
            fraction=min(1.0, shards * marks_per_shard / n), seed=11)
        marks = sample.groupBy("shard").agg(F.sort_array(F.collect_list(mark)).alias("marks"))
        pieces = pieces.join(marks, "shard", "left").mapInPandas(_cut_again(per), schema)
    return pieces.groupBy("shard").applyInPandas(_merge, f"shard long, position long, {CAPTURE}")


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    captured = F.date_format(F.timestamp_seconds(F.coalesce(F.col("page_id"), F.lit(0)) + 1_600_000_000),
                             "yyyy-MM-dd'T'HH:mm:ss'Z'")
    write_warc(table(spark, sf_dir, "pages"), path, captured=captured)
    return merge_index(read_captures(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hexa from pages),
coded as (
  select page_id, payload_bytes, array_to_string(flatten(
    [[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             cast((cast('0x' || substr(hexa, cast(1 + 10 * g as bigint), 10) as bigint)
                   >> cast(35 - 5 * k as integer)) & 31 as integer) + 1, 1)
      for k in range(8)] for g in range(4)]), '') as payload_digest
  from payloads),
firsts as (select *, min(page_id) over (partition by payload_digest) as first_id from coded)
select page_id, payload_bytes, payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from firsts"""
