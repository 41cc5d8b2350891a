import base64
import gzip
import hashlib
import glob

from hypothesis import given
from hypothesis import strategies as st

from tessera.llm import warc


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        first.setdefault(html or "", set()).add(page_id)
    least = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        name = base64.b32encode(hashlib.sha1(data).digest()).decode()
        to = least[html or ""]
        own = to is None or page_id == to
        out.append((page_id, len(data), name, "response" if own else "revisit", None if own else to))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert rows_of(warc.archive_round_trip(pages)) == expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_dirty_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(1, "http://www.a.example.com/x", "same"), (2, "https://a.example.com/x", "same"), (3, None, None), (4, "", ""), (5, "no url\r\n at all", "é\r\n\r\nWARC/1.1"),
            (1, "http://www.a.example.com/x", "same"), (None, "http://b.example.com", "same"), (None, None, None), (6, "http://[bad", "x" * 100_000),
            (-7, "http://ü.example/ü?q=ä b", "<p>"), (8, "http://b.example.com:8080/", "one id"), (8, "http://b.example.com:8080/", "two texts")]
    rows += [(100 + k, "http://hot.example.com/", "hot") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS hash", "3 AS first", "4 AS refers_to")
    assert rows_of(warc.archive_round_trip(pages)) == expected(rows)


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_plain_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>one"), (2, "http://a.example/2", "<p>one")], "page_id long, url string, html string").coalesce(1)
    files = warc.write_archives(pages, str(tmp_path)).collect()
    assert sum(f["lines"] for f in files) == 2
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"<p>one") == 1 and b"WARC-Refers-To: <urn:page:1>" in text


def test_url_keys():
    assert warc.url_key("http://www.A.example.com:80/B?c=D#e") == "com,example,a)/b?c=D"
    assert warc.url_key("https://a.example.com:8443") == "com,example,a:8443)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


@given(st.lists(st.tuples(st.sampled_from(["a", "a/b", "b", "b c", ""]), st.integers(-5, 5)), min_size=1, max_size=30))
def test_index_finds_every_line(entries):
    import io

    class Held:
        def __init__(self, data):
            self.data = data

        def size(self):
            return len(self.data)

        def read_at(self, n, at):
            return self.data[at : at + n]

        def open_input_file(self, _):
            return self

    class Out(io.BytesIO):
        def close(self):
            self.done = self.getvalue()

    out, old = Out(), warc.BLOCK_LINES
    warc.BLOCK_LINES = 4
    try:
        writer = warc.IndexWriter(out)
        lines = sorted(warc.line_key(u, i) for u, i in entries)
        for n, key in enumerate(lines):
            writer.add(key, "f", n, 1)
        writer.close()
    finally:
        warc.BLOCK_LINES = old
    index = warc.IndexFile(Held(out.done), "")
    for key in [*lines, "a 0", "zz -"]:
        assert index.find(key) == [("f", n, 1) for n, k in enumerate(lines) if k == key]
