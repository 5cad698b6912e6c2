import zlib

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import __spark_entry__ as entry
from seatmeter.llm import quality, queries
from seatmeter.llm.store import new_path
from test_decontaminate import brute as leaks
from test_minhash import brute as groups


@pytest.fixture(scope="module")
def stages(sp):
    """(input rows, output rows) of every stage on the small folder, with planted rows."""
    folder = "/root/testdata/sf0.001"
    docs = sp.read.parquet(f"{folder}/documents.parquet")
    more = [(900_001, None), (900_002, ""), (900_003, "the end"), (None, "the text and a line of it with no number " * 3)]
    extra = sp.createDataFrame([(d, t, "en", "s", 0) for d, t in more], docs.schema)
    docs, out = docs.unionAll(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(sp, name)
        stage(sp, docs, folder).write.parquet(path)
        new = sp.read.parquet(path)
        out[name] = (docs, new)
        docs = new
    return out


def texts(df):
    return sorted(map(str, df.select("doc_id", "text").collect()))


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_quality_keeps_what_it_judges_good(stages):
    before, after = stages["quality_rules"]
    assert texts(after) == texts(quality.judge(before, carry=["doc_id", "text"]).filter("kept"))
    assert after.count() < before.count()


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    stay = sorted((str(d) for d, _, _, kept in groups(rows, 5) if kept))
    assert sorted(str(r.doc_id) for r in after.collect()) == stay and len(stay) < len(rows)


def test_leaks_go_and_nothing_else(sp, stages):
    before, after = stages["decontamination"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    items = [tuple(r) for r in sp.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    bad = {p[0] for p in leaks(rows, items)}
    assert bad and sorted(str(r.doc_id) for r in after.collect()) == sorted(str(d) for d, _ in rows if d not in bad)


def test_mixing_keeps_rows_whole(stages):
    before, after = stages["source_mixing"]
    assert set(texts(after)) <= set(texts(before))


def test_tokens(stages):
    tokenizers = pytest.importorskip("tokenizers")
    before, after = stages["token_output"]
    t = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    want, got = [], sorted(after.collect(), key=lambda r: r.start)
    for r in before.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append(str((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))))
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(want)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)


def test_rows_that_share_a_doc_id(sp, frame):
    from seatmeter.llm import minhash
    df = frame([(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "another text of some more words"), (2, "a b c d e f g"), (None, "x"), (None, "x")], "doc_id long, text string")
    out = minhash.keep_one(df)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "None", "None"]


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)
