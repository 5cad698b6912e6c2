import hashlib

import pytest

from seatmeter.llm import warc
from seatmeter.llm.store import new_path


def brute(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= 100:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        lead = first.get(body)
        revisit = page is not None and lead is not None and lead != page
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=str)


def run(sp, df, **kw):
    path = new_path(sp, "w")
    warc.write_archives(df, path, **kw)
    return path, sorted((tuple(r)[:5] for r in warc.read_archives(sp, path).collect()), key=str)


def test_edge_rows_and_chunks(sp, frame):
    big = "é<p>" * 20_000
    rows = [(1, "http://a/", big), (2, "http://b/", big), (3, None, None), (4, "u", ""), (5, "u", "x" * 99), (6, "u", "x" * 99),
            (7, "u", "y" * 100), (8, "u\r\nWARC-Type: bad", "y" * 100), (8, "u", "y" * 100), (7, "v", "y" * 100), (None, "u", "y" * 100),
            (9, "u", "tail\r\n\r\n" * 30), (10, "u", "\r\n\r\n" * 600), (11, "u", big + "z")]
    path, got = run(sp, frame(rows, "page_id long, url string, html string"), chunk=1000)
    assert got == brute(rows)
    chunks = sp.read.parquet(path)
    assert chunks.selectExpr("max(length(data))").first()[0] <= 1000 + 600
    assert chunks.filter("n_chunks > 1").count() > 100
    # the running digest of a record's last chunk is that of its whole payload
    last = {r.record_id: r.digest for r in chunks.filter("chunk_no = n_chunks - 1").collect()}
    assert last["<urn:page:11>"] == hashlib.sha256((big + "z").encode()).hexdigest()


def test_archive_bytes_are_warc(sp, frame):
    path, _ = run(sp, frame([(1, "http://a/", "h" * 150), (2, "http://b/", "h" * 150)], "page_id long, url string, html string"))
    rows = sp.read.parquet(path).orderBy("archive", "record_no", "chunk_no").collect()
    raw = b"".join(bytes(r.data) for r in rows)
    seen = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        n = int(fields["Content-Length"])
        seen.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
        assert rest[n: n + 4] == b"\r\n\r\n"
        raw = rest[n + 4:]
    assert sorted(seen) == [("response", "<urn:page:1>", None), ("revisit", "<urn:page:2>", "<urn:page:1>")]


def test_damage_is_found(sp, frame):
    path, _ = run(sp, frame([(1, "u", "h" * 5000)], "page_id long, url string, html string"), chunk=1000)
    rows = [r.asDict() for r in sp.read.parquet(path).collect()]
    rows[2]["data"] = bytearray(rows[2]["data"]).replace(b"h", b"i", 1)
    bad = new_path(sp, "w")
    sp.createDataFrame(rows, warc.CHUNKS).write.parquet(bad)
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(sp, bad).collect()


def test_long_urls(sp, frame):
    rows = [(i, "data:," + "é"[: i % 2] + "u" * n, "h" * 150 + str(i % 3)) for i, n in enumerate([200_000, 65_300, 65_400, 65_500, 65_536, 3_000_000, 5])]
    path, got = run(sp, frame(rows, "page_id long, url string, html string"), chunk=100)
    assert got == brute(rows)
    assert {r.page_id: r.url for r in warc.read_archives(sp, path).collect()} == {i: u for i, u, _ in rows}


def test_empty_table(sp, frame):
    assert run(sp, frame([], "page_id long, url string, html string"))[1] == []
