"""The registered queries against DuckDB or brute force over the smallest tables."""

import hashlib
import html
import re
import struct
import zlib
from collections import Counter

import duckdb
import pytest

from tablesync.llm.oracle import ORACLE
from tablesync.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    return tuple(value) if isinstance(value, list) else value


@pytest.mark.parametrize("query", sorted(ORACLE))
def test_same_as_sql(spark, duck, query):
    frame = QUERIES[query](spark, DIR)
    cursor = duck.execute(ORACLE[query])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = Counter(tuple(plain(x) for x in r) for r in cursor.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in frame.collect()) == expected


def test_benchmark_passages(spark, duck):
    def fold(text):
        return " ".join(text.lower().split())

    docs = [(i, fold(t)) for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    items = [(i, fold(t)) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()]
    whole = {(d, i) for d, t in docs for i, x in items if x in t}
    found = QUERIES["op1_benchmark_decontamination"](spark, DIR).collect()
    assert whole and whole <= {(r.doc_id, r.item_id) for r in found}
    raw = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    names = dict(items)
    for r in found:
        if (r.doc_id, r.item_id) in whole:
            assert r.edits == 0 and names[r.item_id] in fold(raw[r.doc_id][r.start : r.end])


def test_languages_of_held_out_documents(spark, duck):
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op2_language_id"](spark, DIR).collect()
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in truth}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_articles_of_pages(spark, duck):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    rows = QUERIES["op4_html_extraction"](spark, DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        body = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", body))
        assert r.text == " ".join(html.unescape(body).split())
        assert r.n_chars == len(r.text)


def test_base_secrets(spark, duck):
    words = "(password|passwd|secret|token|api_?key)"
    kinds = (
        ("assign", re.compile(words + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    )
    larger = DIR.replace("sf0.001", "sf0.01")
    texts = dict(duck.execute(f"SELECT doc_id, text FROM '{larger}/documents.parquet'").fetchall())
    seen = 0
    for r in QUERIES["op6_secret_scans"](spark, larger).collect():
        spans = [(m.start(), k, m.end(), kind) for k, (kind, rx, ok) in enumerate(kinds) for m in rx.finditer(texts[r.doc_id]) if ok(m)]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("markov")) == listed
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == kind for s in spans) for kind, *_ in kinds]
        seen += len(spans)
    assert seen


def test_pieces_give_the_texts_back(spark, duck):
    rows = QUERIES["op8_sentencepiece"](spark, DIR).collect()
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r.decoded and len(r.scores) == 3 and list(r.scores) == sorted(r.scores, reverse=True) for r in rows)


def test_url_rules(spark, duck):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    urls = dict(duck.execute("SELECT page_id, url FROM pages").fetchall())
    rows = QUERIES["op9_url_filters"](spark, DIR).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rest = urls[r.page_id].split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        assert (r.host, r.path) == (host.lower(), path)
        fits = [x for x in rules if path.startswith(x[x.index("/") :]) and ("." + host).endswith("." + x[: x.index("/")])]
        assert r.rule == max(fits, key=len, default=None)
        assert r.verdict == (rules[r.rule] if r.rule else "block" if r.score >= 0.45 else "allow")


def test_token_ids(spark, duck):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    rows = QUERIES["op10_token_ids"](spark, DIR).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == expected
