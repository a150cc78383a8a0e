import base64
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from chartstreak.llm import warc as op
from chartstreak.session import shared_path

PAGES = [
    (1, "http://www.B.example.org:80/x?q=1#top", "<p>one</p>"),
    (2, "https://a.example.org/", "<p>two\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"),
    (3, "http://a.example.org", "<p>one</p>"),
    (4, None, None),
    (5, "http://a.example.org/\nWARC-Type: x\r", ""),
    (6, "no url", "ü" * 300_000),
    (7, "http://a.example.org/", "<p>one</p>"),
    (7, "http://a.example.org/", "<p>one</p>"),
    (None, "http://a.example.org/", "<p>one</p>"),
    (None, "http://c.example.org/", "alone"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archive(spark, rows, **kw):
    path = shared_path(spark, "warc-test")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as size")
    op.write_warc(df, path, **kw)
    return path


def test_round_trip(spark):
    path = archive(spark, PAGES, file_bytes=200)
    out = op.merge_index(op.read_captures(spark, path), rows_per_shard=2).collect()
    assert len(out) == len(PAGES)
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[digest(html)] = min(i, first.get(digest(html), i))
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out)
    want = []
    for i, _, html in PAGES:
        code = digest(html)
        same = first.get(code) == i
        want.append((str(i), len((html or "").encode()), code, "response" if same else "revisit",
                     None if same else first.get(code)))
    assert got == sorted(want)
    ordered = sorted(out, key=lambda r: (r.shard, r.position))
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys) and len({r.shard for r in out}) > 1


def test_small_payloads_are_responses(spark):
    path = archive(spark, PAGES, min_payload=20)
    out = op.read_captures(spark, path).collect()
    assert all(r.record_type == "response" for r in out if r.payload_bytes < 20)


def test_url_keys(spark):
    df = spark.createDataFrame([("http://www.B.example.org:80/X?q=1#top",), ("https://u:p@a.org",)], "url string")
    keys = [r[0] for r in df.select(op.url_key(df.url)).collect()]
    assert keys == ["org,example,b)/x?q=1", "org,a)/"]


def test_empty_table(spark):
    path = archive(spark, [])
    assert op.merge_index(op.read_captures(spark, path)).collect() == []


def test_hot_url_is_cut_by_time_and_id(spark):
    rng = random.Random(1)
    rows = [(i, "http://hot.example.org/" if rng.random() < 0.5 else f"http://h{i}.example.org/", f"p{i}")
            for i in range(300)]
    out = op.merge_index(op.read_captures(spark, archive(spark, rows, file_bytes=100)), rows_per_shard=20).collect()
    hot = {r.shard for r in out if r.url_key == "org,example,hot)/"}
    assert len(out) == 300 and len(hot) > 2
    keys = [(r.url_key, r.page_id) for r in sorted(out, key=lambda r: (r.shard, r.position))]
    assert keys == sorted(keys)


def test_ranges_are_cut_again_by_their_own_marks(spark):
    rng = random.Random(2)
    rows = [(i if i % 11 else None, "http://hot.example.org/" if rng.random() < 0.4 else f"http://h{i % 50}.example.org/",
             f"p{i}") for i in range(400)]
    captures = op.read_captures(spark, archive(spark, rows, file_bytes=200))
    out = op.merge_index(captures, rows_per_shard=10, driver_marks=40).collect()
    plain = op.merge_index(captures, rows_per_shard=10).collect()

    def ordered(rows):
        return [(r.url_key, r.captured, r.page_id is None, r.page_id or 0, r.payload_digest)
                for r in sorted(rows, key=lambda r: (r.shard, r.position))]
    sizes = {}
    for r in out:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
    keys = [k[:4] for k in ordered(out)]
    assert len(out) == 400 and keys == sorted(keys) and sorted(ordered(out)) == sorted(ordered(plain))
    assert len(sizes) > 20 and max(sizes.values()) < 60


def test_record_is_read_by_offset_alone(spark):
    path = archive(spark, PAGES, compression="none", file_bytes=400)
    captures = op.read_captures(spark, path).collect()
    texts = {digest(html): (html or "").encode() for _, _, html in PAGES}
    assert len(captures) == len(PAGES)
    for r in captures:
        with open(r.file.removeprefix("file:"), "rb") as f:
            head, block = op.read_record(f, r.offset, r.length)
        assert head["WARC-Target-URI"] == r.url and head["WARC-Type"] == r.record_type
        payload = block.partition(b"\r\n\r\n")[2]
        assert payload == (texts[r.payload_digest] if r.record_type == "response" else b"")


def test_null_capture_time_is_the_epoch(spark):
    path = archive(spark, PAGES[:3], captured=op.F.lit(None))
    assert {r.captured for r in op.read_captures(spark, path).collect()} == {"1970-01-01T00:00:00Z"}


def test_query_meets_revisits(spark, tmp_path):
    import duckdb
    rows = [(i, f"http://h{i % 3}.example.org/", ["<p>one</p>", "", None, f"<p>{i}</p>"][i % 4]) for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in op.op9_warc_index(spark, str(tmp_path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(op.OP9_SQL).fetchall())
    assert got == want and {r[3] for r in got} == {"response", "revisit"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree_merges(runs):
    merged = list(op.loser_tree([[(x, x) for x in sorted(r)] for r in runs]))
    assert merged == sorted(x for r in runs for x in r)
