import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from seatmeter.llm import language

PAGES = "page_id long, url string, html string"


def test_parts():
    assert language.visible("<p>a</p><script>x<b></script><!-- <i> -->b") .split() == ["a", "b"]
    assert language.declared_language('<!DOCTYPE html><HTML class=x LANG="de-AT">') == "de"
    assert language.declared_language('<html><meta http-equiv="Content-Language" content="fr">') == "fr"
    assert language.declared_language("<p lang=en>") is None
    assert language.address("https://u:p@WWW.a.example.org:80/x") == ("www.a.example.org", "example.org", "org")
    assert language.address("http://10.0.0.1/")[2] == "" and language.address(None) == ("", "", "") and language.address("/x") == ("", "", "")


def by_hand(pages, model, p):
    k, scored = len(model.languages), []
    for page, url, html in pages:
        raw = language.visible(html or "").encode().lower()
        code, _ = language.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), p.buckets)
        s = model.log_p[code].sum(axis=0) * min(len(code), p.evidence) / len(code) if len(code) else np.zeros(k)
        s = s - s.max()
        d = language.declared_language(html or "")
        scored.append((page, *language.address(url), d if d in model.languages else "none" if d is None else "other", s, np.exp(s) / np.exp(s).sum()))
    sums = [defaultdict(lambda: np.zeros(k)) for _ in range(4)]
    for x in scored:
        for held, key in zip(sums, (x[1], x[2], x[3], x[4])):
            held[key] += x[6]
    total, out = sum((x[6] for x in scored), np.zeros(k)), []
    for page, host, domain, suffix, declared, s, q in scored:
        rest = total - q
        everywhere = (rest + 1) / (total.sum() - 1 + k)
        in_domain = (sums[1][domain] - q + p.pull * everywhere) / (sums[1][domain].sum() - 1 + p.pull)
        in_host = (sums[0][host] - q + p.pull * in_domain) / (sums[0][host].sum() - 1 + p.pull)
        trust = np.array([p.trust * (n == declared) for n in model.languages])
        markup = (sums[3][declared] - q + 1 + trust) / (rest + k + 2 + p.trust)
        suf = (sums[2][suffix] - q + 1) / (rest + len(sums[2]))
        z = s + sum(np.log(np.maximum(x, 1e-12)) for x in (in_host, markup, suf))
        post = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        out.append((page, host, suffix, declared, model.languages[int(q.round(6).argmax())], model.languages[int(post.round(6).argmax())], post.max()))
    return sorted(out, key=str)


def compare(got, want):
    got = sorted(((r.page_id, r.host, r.suffix, r.declared, r.text_language, r.language, r.probability) for r in got), key=str)
    assert [g[:6] for g in got] == [w[:6] for w in want]
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want], abs=2e-6)


def test_table_against_plain_python(sp, docs):
    pages = sp.read.parquet("/root/testdata/sf0.001/pages.parquet")
    p = language.Params()
    compare(language.identify(pages, docs, p).collect(), by_hand([tuple(r) for r in pages.select("page_id", "url", "html").collect()], language.train(docs, p), p))


def test_edge_rows(sp, frame, docs):
    p = language.Params(evidence=5.0)
    rows = [(1, None, None), (2, "http://a.b.de/", ""), (3, "http://a.b.de/", '<html lang="fr">le la les ' + "des " * 20_000), (3, "http://a.b.de/", "x"),
            (None, "nonsense", "<html lang=zz>the of and"), (4, "http://c.b.de/", "<html lang=de>ab"), (4, "http://c.b.de/", "<html lang=de>ab")]
    compare(language.identify(frame(rows, PAGES), docs, p).collect(), by_hand(rows, language.train(docs, p), p))


def test_held_out_accuracy(sp):
    folder = "/root/testdata/sf0.01"
    labelled = sp.read.parquet(f"{folder}/documents.parquet")
    rows = language.identify(sp.read.parquet(f"{folder}/pages.parquet"), labelled).collect()
    urls = {r.page_id: r.url for r in sp.read.parquet(f"{folder}/pages.parquet").collect()}
    right = [f"/{r.language}/" in urls[r.page_id] for r in rows]
    assert sum(right) >= 0.97 * len(right)
    # pages' own documents are never trained on; unseen documents are told apart by text alone
    model = language.train(labelled.filter("doc_id % 2 = 0"), language.Params())
    tests = labelled.filter("doc_id % 2 = 1 and n_chars > 200").select("lang", "text").collect()
    hit = 0
    for lang, t in tests:
        raw = t.encode().lower()
        code, _ = language.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 1 << 15)
        hit += model.languages[int(model.log_p[code].sum(axis=0).argmax())] == lang
    assert hit >= 0.95 * len(tests)


def test_fusion_uses_host_and_markup(sp, frame, docs):
    """A page without text takes the language of its host, unless its markup speaks."""
    german = [(i, "http://h.example/", "<html lang=de>die der und das ist nicht ein eine sich auf mit zu den") for i in range(30)]
    rows = german + [(100, "http://h.example/", ""), (101, "http://other.test/", "<html lang=fr>")]
    got = {r.page_id: r for r in language.identify(frame(rows, PAGES), docs).collect()}
    assert got[100].language == "de" and got[101].language == "fr"


def test_empty_tables(sp, frame, docs):
    assert language.identify(frame([], PAGES), docs).collect() == []
    got = language.identify(frame([(1, "http://a/", "x")], PAGES), docs.limit(0)).collect()
    assert len(got) == 1 and got[0].language is None


def test_every_language_is_kept(sp, frame):
    """More than 32 languages, the last of them in a single document far outside the sample of the frequent ones."""
    names = [a + b for a in "abcdefgh" for b in "vwxyz"]
    labelled = [(i, f"{names[i % 39] * 4} " * 20, names[i % 39]) for i in range(800)] + [(9000, "hz hzhzhz " * 20, "HZ")]
    labelled = frame(labelled, "doc_id long, text string, lang string")
    p = language.Params(sample_docs=30, least_docs=2)
    assert language.train(labelled, p).languages == sorted(names)
    assert language.train(labelled, language.Params()).languages == sorted(names)
    rows = [(i, "http://h/", f"<html lang={n}>{(n * 4 + ' ') * 20}") for i, n in enumerate(names)]
    got = {r.page_id: r for r in language.identify(frame(rows, PAGES), labelled, p).collect()}
    assert [(got[i].declared, got[i].language) for i in range(40)] == [(n, n) for n in names]


def test_dirty_labels_and_a_bounded_model(sp, frame):
    names = [a + b for a in "abcd" for b in "vwxyz"]
    clean = [(i, f"{names[i % 20] * 4} " * 20, names[i % 20]) for i in range(100)]
    dirty = [(1000 + i, "some text", x) for i, x in enumerate(["", " ", "english", "e", "x1", "?", None, "a b", "toolong-x"])]
    dirty += [(2000, "av" * 30, " AV-latn_XX "), (2001, None, "zz")]
    labelled = frame(clean + dirty, "doc_id long, text string, lang string")
    assert language.train(labelled, language.Params()).languages == sorted(names)
    p = language.Params(model_bytes=20 * 8 * 2048)
    model = language.train(labelled, p)
    assert model.languages == sorted(names) and model.log_p.shape == (2048, 20)
    rows = [(i, "http://h/", f"<p>{(n * 4 + ' ') * 20}") for i, n in enumerate(names)]
    got = {r.page_id: r.text_language for r in language.identify(frame(rows, PAGES), labelled, p).collect()}
    assert [got[i] for i in range(20)] == names


# what is hidden and declared, stated as patterns (which take quadratic time)
HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.I | re.S)
DECLARED = re.compile(r"<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)
META = re.compile(r"<meta\b[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*?content\s*=\s*[\"']?\s*([A-Za-z]+)", re.I)


def test_markup_is_read_as_the_patterns_say():
    rng = random.Random(1)
    bits = ["<script", "</script>", "</SCRIPT  >", "<style>", "</style>", "<!--", "-->", "<!-->", "<", ">", "text", " ", "\n", "<html", "<HTML lang=de", "lang = 'fr'",
            " lang=", "xml:lang=es", "<meta", "http-equiv=content-language", " content=", "'it'", "en", "\"", "'", "=", "<p>", "</p", "scripty", "<scripts>"]
    for _ in range(30_000):
        html = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        found = DECLARED.search(html) or META.search(html)
        assert language.visible(html) == HIDDEN.sub(" ", html)
        assert language.declared_language(html) == (found[1].lower() if found else None)


@pytest.mark.parametrize("piece", ["<!--x", "<html ", "<script ", "<script>a</script ", "<meta http-equiv=content-language ", "<", " lang=", "<html lang=" + " " * 50, "<style", "a<b "])
def test_long_pages_take_linear_time(piece):
    html = piece * (1_000_000 // len(piece))
    begin = time.process_time()
    language.visible(html)
    language.declared_language(html)
    assert time.process_time() - begin < 5
