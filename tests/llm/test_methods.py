"""The methods against brute force on small inputs."""

import io
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablesync.llm import decontaminate, jaccard, language, pieces, secrets, token_files, url_filter
from tablesync.llm.components import components
from tablesync.llm.html_text import main_text
from tablesync.llm.shingles import shingle_sets


def components_of(nodes, links):
    name = {n: n for n in nodes}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    links = [(a, b) for a, b in links if a != b]
    frame = spark.createDataFrame(links, "a long, b long")
    expected = components_of({x for e in links for x in e}, links)
    assert {r.node: r.component for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).collect() == []


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_shingle_sets_count_like_words(spark):
    texts = [None, "", " ", "a b", "A B", "a  b\n", "a b c d e", "A b C d E f", "é É é É é É", "x" * 70_000, "b a", "a " * 9]
    for part in (pa.array(texts), pa.array(texts, pa.large_string()).slice(2)):
        sets = list(shingle_sets(part))
        wanted = [shingles(t or "") for t in part.to_pylist()]
        assert [len(s) for s in sets] == [len(s) for s in wanted]
        assert len(set(np.concatenate(sets).tolist())) == len(set().union(*wanted))


def near_copies(seed, sizes=(5, 8, 30, 120, 300)):
    """Groups of copies with edits around the threshold, chains, a large group, and a passage in many documents."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage, docs = [word() for _ in range(40)], []
    for size in sizes:
        for _ in range(6):
            base = [word() for _ in range(size)]
            for _ in range(5):
                base = list(base)  # a chain
                for _ in range(rng.randrange(0, max(2, size // 40) + 1)):
                    base[rng.randrange(size)] = word()
                docs.append(base)
    large = [word() for _ in range(100)]
    for i in range(60):
        own = list(large)
        own[rng.randrange(100)] = f"x{i}"
        docs.append(own)
    docs += [[*passage, *(word() for _ in range(rng.choice((3, 30, 200))))] for _ in range(40)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("how", [jaccard.Join(), jaccard.Join(common=3), jaccard.Join(common=2, frequent=40), jaccard.Join(frequent=1)])
def test_every_link_of_the_join(spark, how):
    docs = near_copies(11)
    sets = {i: shingles(t) for i, t in docs}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and 100 * (n := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - n)
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.join(frame, how=how).collect()}
    assert found == components_of(sets, links)


def test_sketches_share_a_key_when_sets_are_near():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 700))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = rng.random(len(a)) < rng.random() * 0.12
        b = np.unique(np.concatenate([a[~drop], rng.integers(0, 2**63, int(drop.sum() * rng.random())).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        out = rng.choice(a, int(len(a) * rng.choice([0, 0.3, 0.9, 1.0])), replace=False)
        keys = [jaccard.sketch_keys(x, ~np.isin(x, out), 80) for x in (a, b)]
        assert np.intersect1d(keys[0][0], keys[1][0]).size or np.intersect1d(keys[0][1], keys[1][1]).size
        differ = sum(int(x).bit_count() for x in (jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64))
        assert differ <= len(a) + len(b) - 2 * both


def edits(segment, text):
    """Least edits between the segment and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(segment, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_search_finds_what_alignment_finds():
    rng = random.Random(8)
    item = "".join(rng.choice("abcde ") for _ in range(100)).strip()
    index = decontaminate.Index([("i", item)])
    segments = ["".join(map(chr, codes)) for codes in index.codes]
    assert segments[0] == item and len(segments) > 5
    near = far = 0
    for _ in range(120):
        changed = list(item)
        for _ in range(rng.randrange(0, 26)):
            at = rng.randrange(len(changed))
            changed[at : at + 1] = rng.choice((["x"], [], [changed[at], "y"]))
        text = "".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 60))) + "".join(changed) + "zz" * rng.randrange(0, 9)
        folded = "".join(map(chr, decontaminate.folded(text)[0]))
        least = [edits(segment, folded) for segment in segments]
        found = list(index.search([text]))
        assert bool(found) == any(n <= k for n, k in zip(least, index.budget))
        if least[0] <= index.budget[0]:
            near += 1
            assert found[0][4] == least[0]
        far += not found
    assert near > 20 and far > 10


def test_hashes_of_any_length():
    codes = np.frombuffer("abcabcabcabcabcxabc".encode("utf-32-le"), dtype=np.uint32)
    for q in (1, 3, 5, 8, 11):
        h = decontaminate.gram_hashes(codes, q)
        runs = ["abcabcabcabcabcxabc"[i : i + q] for i in range(20 - q)]
        assert len(h) == len(runs) and len(set(h.tolist())) == len(set(runs))
        assert all((h[i] == h[j]) == (runs[i] == runs[j]) for i in range(len(h)) for j in range(len(h)))


def test_kneser_ney_like_its_definition():
    text = language.letters("the cat sat on the mat and the rat ran")
    grams = language.grams(text)
    keys, counts = np.unique(grams, return_counts=True)
    probability, _, alphabet = language.kneser_ney([(keys, counts)])
    padded = "   " + text + " "
    full = Counter(padded[i : i + 4] for i in range(len(padded) - 3))
    levels = [full]
    for _ in range(3):
        levels.append(Counter(g[1:] for g in levels[-1]))

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (alphabet + 1)
        level = levels[4 - n]
        own = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        once, twice = (sum(c == k for c in level.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once else 0.5
        total = sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * p(gram[1:])

    expected = -sum(np.log(p(padded[i : i + 4])) for i in range(len(padded) - 3)) / (len(padded) - 3)
    model = language.Model(["x"], [(keys, counts)])
    assert model.entropies(text)[0] == pytest.approx(expected)
    other = language.letters("zebra then the quiz")
    padded2 = "   " + other + " "
    expected = -sum(np.log(p(padded2[i : i + 4])) for i in range(len(padded2) - 3)) / (len(padded2) - 3)
    assert model.entropies(other)[0] == pytest.approx(expected)
    language_window, language.WINDOW = language.WINDOW, 7
    try:
        assert model.entropies(other)[0] == pytest.approx(expected, rel=0.2)
    finally:
        language.WINDOW = language_window


def test_best_segmentations():
    lattice = pieces.pieces(pieces.default_model())

    def brute(text):
        text, out = pieces.SPACE + text.replace(" ", pieces.SPACE), []

        def go(i, score):
            if i == len(text):
                out.append(score)
            for j in range(i + 1, len(text) + 1):
                if text[i:j] in lattice.pieces:
                    go(j, score + lattice.pieces[text[i:j]][1])
            if i < len(text) and text[i] not in lattice.pieces:
                go(i + 1, score + lattice.unknown)

        go(0, 0.0)
        return sorted(out, reverse=True)[: lattice.n]

    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("theinag .é日\nxy,") for _ in range(rng.randrange(1, 9)))
        found = lattice.segmentations(text)
        assert [s for s, _ in found] == brute(text) == lattice.encode(text)[1]
        assert len({tuple(i) for _, i in found}) == len(found)
        assert all(lattice.decode(np.array(i, dtype="<u4").tobytes()) == text for _, i in found)
    for text in ("▁", " ▁ a", "a\0b", "  x  ", "☃️▁▁ok"):
        assert lattice.decode(lattice.encode(text)[0]) == text


def test_encoder_like_the_library():
    encoder = token_files.encoder(token_files.default_tokenizer())
    rng = random.Random(6)
    parts = ["a", "b", " ", "  ", "\n", " \n", "the", "'s", "'", ".", "!!", "12", "é", "\t", " ", "　", "<|endoftext|>", "\x1f", "ß", "日", "'re", "-", "\r\n", "_x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(8000)]
    assert encoder.encode(texts) == encoder._ids(texts)


def test_frames_are_read_alone():
    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    sink = File()
    writer = token_files.FrameWriter(sink)
    ids = np.random.default_rng(1).integers(0, 50_000, 5 * token_files.FRAME_IDS + 123).astype("<u4")
    for part in np.array_split(ids, 97):
        writer.write(part.tobytes())
    writer.close()
    reader = token_files.FrameReader(sink)
    assert len(reader.entries) == 6
    start = 3 * token_files.FRAME_IDS + 5
    assert b"".join(reader.chunks(start, 50)) == ids[start : start + 50].tobytes() and reader.frames_read == 1
    assert b"".join(reader.chunks(0, len(ids))) == ids.tobytes()
    with pytest.raises(ValueError):
        list(reader.chunks(len(ids) - 1, 2))
    damaged = bytearray(sink.getvalue())
    damaged[len(damaged) - 9 - 12 * 6 + 8] ^= 1  # a checksum of the table
    with pytest.raises(ValueError):
        list(token_files.FrameReader(File(bytes(damaged))).chunks(0, 10))


def test_models_tell_random_from_words(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, f"some ordinary words_and_identifiers here secret = {rng.getrandbits(160):040x}") for i in range(50)], "doc_id long, text string")
    model = secrets.train(docs)
    size = len(secrets.ALPHABET)

    def ratio(token):
        at = [secrets.ALPHABET.index(c) for c in token.lower()]
        return sum(model[a * size + b] for a, b in zip(at, at[1:]))

    tokens = ["ordinary_identifiers_words", "Qz7Xk2Vw9Lp4Rt8Yb3Nc6Jd1"]
    frame = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(tokens)], "doc_id long, text string")
    found = {r.doc_id: r.n_markov for r in secrets.scan(frame, model).collect()}
    assert found == {i: int(ratio(t) >= max(10.0, 0.5 * len(t))) for i, t in enumerate(tokens)} == {0: 0, 1: 1}


def test_pages_without_an_article_element():
    page = (
        '<div id="nav"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div><h2>Head</h2>The text of the page that is '
        "not marked as an article, but it is the long one in it.<br>Next&nbsp;line &lt;b&gt;</div>"
        '<div class="sidebar">the of and to in is that for it as was with be by on are this</div><p>© Me</p>'
    )
    assert main_text(page) == "Head The text of the page that is not marked as an article, but it is the long one in it. Next line <b>"
    page = (
        "<header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use the cookies of this site for you.</div>"
        "<main><h1>Title</h1><p>This is the first paragraph of the article and it is long enough to count.<p>Short one.<aside>Also in the "
        "news of the day and of the week, as was said.</aside><form><p>Leave a reply to the author of this</p></form><section id='comments'>"
        "<p>I think that the article is the best of all that I have read</p></section></main><footer>&copy; 2024</footer><script>var a='<p>'"
    )
    assert main_text(page) == "Title This is the first paragraph of the article and it is long enough to count. Short one."
    assert main_text("<main><p>Tiny.</p></main><div>the words of the advert that is here and there, for you and me to be in</div>") == "Tiny."


def test_an_open_head_ends_with_the_first_thing_of_the_body():
    article = "<article><h1>Title</h1><p>This is the first paragraph of the article and it is long enough to count.</p></article>"
    wanted = "Title This is the first paragraph of the article and it is long enough to count."
    head = "<html><head><meta charset=utf-8><title>x</title><style>p {}</style>"
    for start in (f"{head}<body>", head, f"{head}<noscript><img src=x><body>", f"{head}<body><div>", f"{head}</head><body>"):
        assert main_text(start + article) == wanted
    assert main_text(f"{head}the words of a page that is without any tag in it, and this is all of it") == "the words of a page that is without any tag in it, and this is all of it"


def test_words_of_a_wrapper_do_not_put_the_article_out():
    text = "<h1>Title</h1><p>This is the first paragraph of the article and it is long enough to count.</p>"
    wanted = "Title This is the first paragraph of the article and it is long enough to count."
    comment = "<div class=comments><article><p>I think that the article is the best of all that I have read in the year.</p></article></div>"
    for kind in ("layout has-sidebar", "site sticky-header", "page with-nav cookie-consent"):
        for tag in ("article", "main"):
            assert main_text(f"<div class='{kind}'><div id=banner-top><p>the text of the banner that is on all of the pages of it</p></div><{tag}>{text}</{tag}></div>") == wanted
        assert main_text(f"<main><div class='{kind}'><article>{text}</article></div></main>") == wanted
        assert main_text(f"<div class='{kind}'><article>{text}</article>{comment}</div>") == wanted
    assert main_text(f"<article>{text}</article>{comment}") == wanted
    assert main_text(f"<div class='has-sidebar' hidden><article>{text}</article></div>") == ""
    assert main_text(f"<div class=ad>{text}</div><p>{wanted}</p>") == wanted


def test_excerpts_at_every_offset_of_a_long_item():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    item = " ".join(word() for _ in range(60))
    index = decontaminate.Index([("i", item)])
    size = decontaminate.Search().surely
    assert size <= 60 and len(item) > 250
    before, behind = " ".join(word() for _ in range(30)) + " #", "# " + " ".join(word() for _ in range(30))
    for n in (size, 110):
        for at in range(0, len(item) - n + 1, 1 if n == size else 7):
            excerpt = item[at : at + n].strip() if n > size else item[at : at + n]
            (row,) = index.search([before + excerpt + behind])
            # A segment that the excerpt cuts may add its edits at either end.
            assert row[4] == 0 and len(before) - 19 <= row[2] <= len(before)
            assert 0 <= row[3] - len(before) - len(excerpt) <= 19
    # With edits, and the longest of two passages.
    for at in range(0, len(item) - 110, 7):
        changed = list(item[at : at + 110])
        for k in (20, 45, 70, 95):
            changed[k] = "#"
        (row,) = index.search([before + "".join(changed) + behind])
        assert row[4] and row[2] <= len(before) + 46 and row[3] >= len(before) + 70
    (row,) = index.search([item[:70] + behind + item + before])
    assert (row[2], row[3], row[4]) == (70 + len(behind), 70 + len(behind) + len(item), 0)
    assert not list(index.search([before + item[:25] + behind + item[100:125]]))
    assert [r[0] for r in index.search([before, item, item[:80]], once=True)] == [1, 2]


def test_urls_are_judged_on_hosts_the_model_has_not_seen():
    rows = url_filter.labelled_urls()
    hosts = [url_filter._split(url)[0] for url, _ in rows]
    paths = [url_filter._split(url)[1] for url, _ in rows]
    assert len(rows) > 200 and len(set(hosts)) == len(rows) and len(set(paths)) > 0.95 * len(rows)
    assert not any(host.endswith((".test", ".example", "example.com", "example.org", "example.net")) for host in hosts)
    found = url_filter.held_out(rows)
    assert sum(found.values()) == len(rows) and found[True, True] + found[False, False] >= 0.7 * len(rows)
    words = [("http://a.net/red/1", True), ("http://b.net/red/2", True), ("http://a.org/blue/3", False), ("http://b.org/blue/4", False)]
    weights = url_filter.train(words)
    assert url_filter.blocked(weights, "c.com", "/red/9") > url_filter.blocked(weights, "c.com", "/blue/9")
