import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")

from seatmeter.llm import tokens
from seatmeter.llm.queries import tokenizer_path
from seatmeter.llm.store import new_path
from seatmeter.llm import text as tx


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def expected(plain, rows):
    out, start = [], 0
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_give_the_ids_of_whole_texts(plain):
    rng = random.Random(5)
    parts = ["a", "the", "don't", "é", "ß", "ñ", " ", "  ", "\n", "\t", " ", "　", "\u0085", ".", "12", "😀", "<|endoftext|>",
             "'s", "\x1c", "\x00", "ÃÃ", "×"]
    texts = ["".join(rng.choice(parts + [" "] * 12) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", " ", "a ", " a"]
    e = tokens.Encoder(tokenizer_path(), most=300)      # small: the table is cleared many times
    for a in range(0, len(texts), 97):
        ids, counts = e.encode(*tx.utf8(pa.array(texts[a: a + 97])))
        want = [x.ids for x in plain.encode_batch(texts[a: a + 97], add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [x for w in want for x in w]


def test_whole_table_round_trip(sp, docs, plain):
    path = new_path(sp, "t")
    tokens.write_tokens(docs, path, tokens.Params(tokenizer=tokenizer_path(), container_bytes=20_000))
    rows = sorted(docs.select("doc_id", "text").collect())
    want = expected(plain, [(r.doc_id, r.text) for r in rows])
    assert sorted(map(tuple, tokens.read_digests(sp, path).collect())) == want
    boxes = sp.read.parquet(path + "/containers")
    assert boxes.count() > 3 and boxes.select("dict_sha256").distinct().count() == 1
    one = rows[17]
    assert tokens.read_document(sp, path, one.doc_id) == [plain.encode(one.text, add_special_tokens=False).ids + [0]]


def test_edge_rows(sp, frame, plain):
    rows = [(3, None), (1, ""), (2, "x " * 50_000), (5, "same"), (5, "same"), (None, "no id"), (4, "  \n ")]
    path = new_path(sp, "t")
    tokens.write_tokens(frame(rows, "doc_id long, text string"), path, tokens.Params(tokenizer=tokenizer_path()))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(map(tuple, tokens.read_digests(sp, path).collect()), key=lambda r: r[1])
    assert got == expected(plain, order)


def test_empty_table(sp, frame):
    path = new_path(sp, "t")
    tokens.write_tokens(frame([], "doc_id long, text string"), path, tokens.Params(tokenizer=tokenizer_path()))
    assert tokens.read_digests(sp, path).collect() == []


def test_damaged_dictionary_is_refused(sp, frame):
    path = new_path(sp, "t")
    tokens.write_tokens(frame([(1, "a b")], "doc_id long, text string"), path, tokens.Params(tokenizer=tokenizer_path()))
    sp.createDataFrame([("00", bytearray(b"x"))], "dict_sha256 string, dictionary binary").write.mode("overwrite").parquet(path + "/dictionary")
    with pytest.raises(ValueError):
        tokens.read_digests(sp, path)
