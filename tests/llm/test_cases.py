"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random

import pytest
from pyspark.sql import functions as F

from tablesync.llm import decontaminate, html_text, jaccard, language, line_dedup, pieces, quality, secrets, token_files, url_filter
from tablesync.storage import new_dir

LONG = " ".join(f"word{i % 977} and the {i}" for i in range(60_000))
PROSE = "\n".join(f"Line{i} says that{i} the{i * 7} text is{i} here and{i * 3} goes on{i} for a{i} while{i}." for i in range(12))
ROWS = [
    (1, PROSE, "en", "a", 10),
    (1, PROSE, "en", "a", 10),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, PROSE + " More of it.", "en", None, 5),
    (4, LONG, "de", "b", 9),
    (5, "  \n\t ", None, "c", 4),
    (6, "one two", "en", "c", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("w", "m", "n", "kept", "measures", "row", "key", "cut", "parts", "stay", "node", "found", "gaps", "body", "host", "Text2", "n_words", "a.b")


def frame(spark, rows=ROWS, clashes=True):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit(7) for c in CLASHES}) if clashes else docs


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_quality(spark):
    docs = frame(spark)
    measured = quality.measure(docs, "m_")
    assert set(docs.columns) < set(measured.columns)
    rows = by_id(quality.judge(measured, "m_", "kept_").collect())
    assert [r.kept_ for r in rows[1]] == [True, True] and rows[None][0].kept_
    assert rows[2][0].m_.n_words == 0 and not rows[2][0].kept_ and not rows[3][0].kept_
    assert rows[4][0].m_.n_words == len(LONG.split())
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, None}
    assert quality.good_documents(frame(spark, [])).collect() == []


def test_hosts_rates_are_shrunk_and_enforced(spark):
    good, junk = PROSE, " ".join(f"junk{i}$ and" for i in range(80))
    rows = [(i, junk if i % 2 else good, None, "bad", 1) for i in range(40)] + [(100 + i, good, None, "fine", 1) for i in range(400)]
    rows += [(900, junk, None, "fine", 1)]
    kept = {r.doc_id for r in quality.good_documents(frame(spark, rows)).collect()}
    assert kept == {r[0] for r in rows if r[1] == good} | {900}


def test_rules_hold_at_the_hosts_that_break_them(spark):
    junk = " ".join(f"junk{i}$ and" for i in range(80))
    bad = {"half": 100, "some": 12, "few": 2, "none": 0}
    rows = [(1000 * k + i, junk if i < n else PROSE, None, host, 1) for k, (host, n) in enumerate(bad.items()) for i in range(200)]
    kept = quality.good_documents(frame(spark, rows)).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in kept} == {"half": 100, "some": 188, "few": 200, "none": 200}


def test_line_dedup(spark):
    rule = line_dedup.Spread(min_sites=3)
    rows = [(i, f"own line of site {i}\n  All rights reserved. \nok\n", None, f"s{i}", 1) for i in range(5)]
    rows += [(9, "All rights reserved.", None, None, 1), (10, None, None, "s1", None), (11, "ok\n\nok", None, "s1", 6), (11, "ok\n\nok", None, "s1", 6)]
    docs = frame(spark, rows)
    found = line_dedup.drop_boilerplate(docs, removed="cut_lines", rule=rule)
    assert found.columns == [*docs.columns, "cut_lines"]
    rows = by_id(found.collect())
    assert rows[0][0].text == "own line of site 0\nok\n" and rows[0][0].n_chars == len(rows[0][0].text) and rows[0][0].cut_lines == 1
    assert rows[9][0].text == "" and rows[10][0].text is None and [r.text for r in rows[11]] == ["ok\n\nok"] * 2
    assert line_dedup.drop_boilerplate(frame(spark, [])).collect() == []


@pytest.mark.parametrize("sites", [2, 3, 4])
def test_lines_near_the_threshold_are_counted(spark, sites):
    rows = [(i, "a line that is shared", None, f"s{i % sites}", 1) for i in range(12)]
    texts = {r.text for r in line_dedup.drop_boilerplate(frame(spark, rows), rule=line_dedup.Spread(min_sites=3)).collect()}
    assert texts == ({""} if sites >= 3 else {"a line that is shared"})


def test_jaccard(spark):
    docs = frame(spark)
    rows = by_id(jaccard.join(docs).collect())
    assert [r.component_id for r in rows[1]] == [1, 1] and rows[None][0].component_id == 1
    assert [(rows[i][0].n_shingles, rows[i][0].component_id) for i in (2, 3, 5, 6)] == [(0, 2), (0, 3), (0, 5), (1, 6)]
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert jaccard.join(frame(spark, [])).collect() == []


def test_decontamination(spark):
    item = "The quick brown fox jumps over the lazy dog while the cat sleeps on the warm mat by the fire."
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "short"), (11, item)], "item_id long, text string")
    hidden = LONG[:150_000] + " " + item.upper().replace(" ", " \n ").replace("LAZY", "LAXY") + " " + LONG[:5000]
    rows = [*ROWS, (20, hidden, None, None, 1), (21, item, None, None, 1), (21, item, None, None, 1)]
    docs = frame(spark, rows)
    found = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(20, 7), (20, 11), *[(21, 7)] * 2, *[(21, 11)] * 2]
    at = next(r for r in found if r.doc_id == 20)
    assert at.edits == 1 and hidden[at.start : at.end].startswith("THE") and hidden[at.start : at.end].endswith("FIRE.")
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert decontaminate.leaks(frame(spark, []), benchmark).collect() == []
    empty = benchmark.limit(0)
    assert decontaminate.leaks(docs, empty).collect() == [] and decontaminate.clean_documents(docs, empty).count() == len(rows)
    small = decontaminate.Search(block_chars=10)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark, how=small).collect()) == sorted((r.doc_id, r.item_id) for r in found)


def test_language(spark):
    english, german = "the cat and the dog were in the house " * 30, "der hund und die katze waren in dem haus " * 30
    rows = [(i, (english, german)[i % 2], ("en", "de")[i % 2], "a", 1) for i in range(40)] + [(99, None, None, "a", 1), (98, "12 + 3!", None, "a", 1)]
    docs = frame(spark, rows)
    model = language.train(docs, language.Training(train_rows=30, calibration_rows=10))
    found = by_id(language.predict(docs, model).collect())
    assert all(found[i][0].lang_pred == ("en", "de")[i % 2] for i in range(40))
    assert (found[99][0].lang_pred, found[99][0].score, found[98][0].lang_pred) == ("und", 0.0, "und")
    assert language.predict(frame(spark, []), model).collect() == []
    nothing = language.train(frame(spark, []))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert by_id(language.predict(frame(spark), model).collect())[4][0].lang_pred in ("en", "de")


def test_every_language_is_learned_where_the_sample_is_bounded(spark):
    rng = random.Random(3)
    words = {"en": "the cat and dog were in house with this", "de": "der hund und die katze waren im haus mit", "fi": "kissa ja koira olivat talossa tämän kanssa hyvin", "is": "kötturinn og hundurinn voru í húsinu með þessu"}
    text = lambda lang: " ".join(rng.choice(words[lang].split()) for _ in range(30))
    sizes = {"en": 3000, "de": 800, "fi": 12, "is": 1}
    rows = [(lang, text(lang)) for lang, n in sizes.items() for _ in range(n)]
    docs = frame(spark, [(i, body, lang, "a", 1) for i, (lang, body) in enumerate(rows)])
    how = language.Training(train_rows=60, calibration_rows=20, least_rows=5)
    model = language.train(docs, how)
    assert model.languages == ["de", "en", "fi", "is"]
    held = [(i, text(lang), lang, "a", 1) for i, lang in enumerate(list(sizes) * 25)]
    found = by_id(language.predict(frame(spark, held), model).collect())
    assert all(found[i][0].lang_pred == lang for i, _, lang, *_ in held)
    sample = language._of_each_language(docs.select("doc_id", "text", "lang"), 80, 5).groupBy("lang").count().collect()
    sample = {r["lang"]: r["count"] for r in sample}
    assert (sample["fi"], sample["is"]) == (12, 1) and 15 <= sample["de"] <= 60 and 15 <= sample["en"] <= 60
    assert language._limit([3000, 800, 12, 1], 80) == 33.5 and language._limit([5, 5], 10) == float("inf")


def test_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "u", ""), (None, "u", "<p>just text"), (2, "u", "<<<a <b")], "page_id long, url string, html string")
    rows = html_text.extract(pages.withColumns({c: F.lit(1) for c in ("text", "n_chars")})).collect()
    assert sorted((r.page_id or 0, r.text) for r in rows) == [(0, "just text"), (1, ""), (2, ""), (2, "<<<a <b")]
    assert html_text.extract(pages.limit(0)).collect() == []


def test_secrets(spark):
    key = "Zx81kQ9vLw3Tn7Rb2Yp5Hd0Mf6"
    rows = [*ROWS, (30, f"é {key} and password: 'abc' token=abcdef", None, None, 1), (31, f"secret={key}\n" * 3000, None, None, 1)]
    docs = frame(spark, rows)
    found = secrets.scan(docs, secrets.train(docs))
    assert set(docs.columns) <= set(found.columns)
    rows = by_id(found.collect())
    assert rows[30][0].spans == f"markov:2:{2 + len(key)},assign:{2 + len(key) + 21}:{2 + len(key) + 33}"
    assert rows[31][0].n_assign == 3000 and rows[31][0].spans.endswith(f":{len(f'secret={key}') * 3000 + 2999}")
    assert rows[2][0].spans == rows[3][0].spans == "" and rows[2][0].base_sha256 == rows[3][0].base_sha256
    assert len({r.spans for r in rows[1]}) == 1
    assert secrets.scan(frame(spark, []), secrets.train(frame(spark, []))).collect() == []


def test_urls(spark):
    urls = [(1, None), (2, "no scheme"), (3, ""), (4, "http://EXAMPLE.ORG/es/1?x#y"), (5, "http://a.b.com"), (None, "x://h/" + "p" * 200_000), (5, "http://a.b.com")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule")})
    rows = url_filter.judge_urls(pages).collect()
    got = {(r.page_id, r.host, r.rule, r.verdict) for r in rows if r.page_id}
    assert len(rows) == 7 and (4, "example.org", "example.org/es/", "block") in got and (1, "", None, "allow") in got
    assert (2, "", None, "allow") in got and (5, "a.b.com", None, "allow") in got
    assert url_filter.judge_urls(pages.limit(0)).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(pages, url_filter.train([])).collect()} == {"allow", "block"}


def test_token_files(spark):
    docs = frame(spark)
    folder = new_dir(spark, "tokens")
    index = token_files.write_tokens(docs, folder)
    rows = sorted(token_files.read_tokens(index, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6] and rows[3].n_tokens == rows[4].n_tokens == 1
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert rows[1].ids_crc32 == rows[2].ids_crc32
    empty = new_dir(spark, "tokens")
    assert token_files.read_tokens(token_files.write_tokens(frame(spark, []), empty), empty).collect() == []


def test_pieces(spark):
    rows = by_id(pieces.encode(frame(spark)).collect())
    assert all(r.decoded for own in rows.values() for r in own)
    assert rows[2][0].ids == rows[3][0].ids == [] and list(rows[3][0].scores) == [0.0]
    assert rows[1][0] == rows[1][1]
    assert pieces.encode(frame(spark, [])).collect() == []
