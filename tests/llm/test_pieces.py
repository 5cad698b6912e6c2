import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from seatmeter.llm import pieces
from seatmeter.llm.queries import QUERIES

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()
SCHEMA = "doc_id long, text string"


def brute(doc_id, text, percent=100, spm=50):
    text = text or ""
    digest = SHA(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, SHA(text), SHA(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), SHA(out), SHA(text)


COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def run(df, **kw):
    p = pieces.Params(**kw)
    return sorted((tuple(r) for r in pieces.restore(pieces.fill_in_middle(df, p), p).select(*COLUMNS).collect()), key=str)


def test_table(sp, docs):
    got = QUERIES["op11_fill_in_middle"](sp, "/root/testdata/sf0.001")
    assert got.columns == COLUMNS
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(brute(*r) for r in docs.select("doc_id", "text").collect())
    assert {r[2] for r in rows} >= {"psm", "spm"}


def test_edges(frame):
    texts = ["", None, "\n", "\n\n\n", "one line", "one\n", "a\nb\nc", "é\nü\n漢字\n🎉🎉\n" * 50, "has <P> in it\nx", "<M>", "<S", "\r\n x\n",
             "x" * 300_000 + "\n" + "y\n" * 50_000]
    rows = [(i * 37, t) for i, t in enumerate(texts)] + [(None, "a\nb\n"), (None, None), (7, "p\nq\n"), (7, "p\nq\n"), (-5, "m\nn\n")]
    df = frame(rows, SCHEMA)
    assert run(df) == sorted((brute(*r) for r in rows), key=str)
    assert run(df, percent=50, spm_percent=10) == sorted((brute(*r, 50, 10) for r in rows), key=str)
    assert run(frame([], SCHEMA)) == []


def test_texts_come_back_and_pieces_name_the_output(frame):
    rows = [(i, "".join(f"line {j} é\n" for j in range(i))) for i in range(30)]
    arranged = pieces.fill_in_middle(frame(rows, SCHEMA))
    back = {r.doc_id: r.text for r in pieces.restore(arranged).collect()}
    assert back == dict(rows)
    for r in arranged.collect():
        buffers = dict(rows)[r.doc_id].encode(), b"<P><M><S>"
        assert b"".join(buffers[p.buffer][p.start:p.start + p.length] for p in r.pieces).decode() == r.output
    bare = pieces.fill_in_middle(frame(rows, SCHEMA), output=False)
    assert "output" not in bare.columns and bare.count() == 30


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\né", max_size=30), st.lists(st.integers(0, 60), max_size=5), st.permutations(range(6)))
def test_cut_and_permute_are_undone(text, places, order):
    raw = text.encode()
    places = sorted(p for p in places if p <= len(raw))
    table = pieces.PieceTable(memoryview(raw), memoryview(b"")).cut(*places)
    assert len(table.pieces) == len(places) + 1 and table.join() == raw
    order = tuple(x for x in order if x < len(table.pieces))
    assert table.permute(order).permute(pieces.inverse(order)).join() == raw
    assert table.sha256() == hashlib.sha256(raw).hexdigest()
