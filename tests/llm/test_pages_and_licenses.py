import random
import time

from cases import clashing, edge_texts, frame, prose

from stageline.llm import pages
from stageline.llm.licenses import TEMPLATES, Index, align, license_spans, template_words
from stageline.llm.pages import main_text, page_blocks, shared_lines


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_shared_lines_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(2))
        found = sorted(shared_lines(a, b))
        assert len(found) == lcs(a, b)
        it = iter(b)
        assert all(a[i] in it for i in found)


def test_shared_lines_of_many_equal_lines(monkeypatch):
    """The split by bit rows gives subsequences of the same length, in seconds for long pages."""
    rng = random.Random(2)
    monkeypatch.setattr(pages, "MATCHES", 3)
    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(14))] for _ in range(2))
        found = sorted(shared_lines(a, b))
        assert len(found) == lcs(a, b)
        it = iter(b)
        assert all(a[i] in it for i in found)
    monkeypatch.undo()
    start = time.time()
    cells = ["0"] * 20_000
    assert len(shared_lines(cells, cells[:-7])) == 19_993
    assert len(shared_lines(["x", *cells, "y"], ["z", *cells, *cells, "w"])) == 20_000
    assert len(shared_lines(["0", "1"] * 10_000, ["1", "1", "0"] * 6_000)) >= 12_000
    assert time.time() - start < 30


def test_long_and_broken_markup():
    start = time.time()
    assert page_blocks("<div>" * 20_000 + "</p>" * 20_000 + "text") == [("text", False)]
    assert page_blocks("<i>" * 20_000 + "</b>" * 20_000 + "text") == [("text", False)]
    assert time.time() - start < 30
    assert page_blocks('<p>a</p><script src="x"/>var a=1;</script><p>b</p>') == [("a", False), ("b", False)]
    assert page_blocks("<p>a<style/>p{}</style>b</p>") == [("a", False), ("b", False)]


def test_a_sentence_that_articles_share_stays(spark):
    """Between lines of their own, and at the edge of a few; what half of a host's have goes."""
    rng = random.Random(6)
    own = [[prose(rng, 9) for _ in range(4)] for _ in range(8)]
    some = [(["first words"] if i in (2, 3) else []) + [*o[:2], "said before", *o[2:]] for i, o in enumerate(own)]
    rows = [
        (f"http://a.example/{i}", "<div>Menu</div><article>" + "".join(f"<p>{t}</p>" for t in [*o, "More", "Foot"]) + "</article>")
        for i, o in enumerate(some)
    ]
    assert texts_of(spark, rows) == {i: "\n".join(o) for i, o in enumerate(some)}


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- c > --><div class="ad">Buy</div>
    <article class="post"><h1>Head &amp; line</h1><p><b>One<br>two<p>three
      &copy; x &lt;y&gt;<div id="comments"><p>reader</p></div><aside>side</aside><form>f<input></form><p>e<i>nd</i>.</article>
    <div class='cookie-notice'>c</div><footer>F</footer></body></html>"""
    assert page_blocks(page) == [(t, True) for t in ("Head & line", "One two", "three © x <y>", "end.")]
    assert page_blocks("") == [] and page_blocks("just text") == [("just text", False)]
    assert page_blocks("<p>a</p><p>b &am") == [("a", False), ("b &am", False)]
    assert page_blocks("<article><p>a</p><p>b <a hre") == [("a", True), ("b", True)]
    assert page_blocks("<p>x</b> y</p><ul><li>1<li>2</ul>") == [("x y", False), ("1", False), ("2", False)]


def site(n, host, rng):
    def page(i):
        own = "".join(f"<p>{prose(rng, 8)} {i}</p>" for _ in range(3))
        return f"<html><body><div>Welcome to {host}</div><div>Top</div>{own}<div>All rights</div></body></html>"

    return [(f"https://{host}/en/{i}?q=1", page(i)) for i in range(n)]


def test_shared_lines_of_neighbours_go(spark):
    rng = random.Random(3)
    rows = site(30, "a.example", rng) + site(2, "b.example", rng) + [("http://solo.example/", "<p>only</p><p>here</p>"), (None, None), ("", "<p>q</p>")]
    rows += [("http://c.example/1", "<nav>m</nav><article><p>same</p></article>")] * 2
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r for r in main_text(clashing(df)).collect()}
    assert sorted(got) == list(range(len(rows)))
    for i in range(32):
        blocks = [t for t, _ in page_blocks(rows[i][1])]
        assert got[i].text == "\n".join(blocks[2:-1])
    assert [got[i].text for i in range(32, 37)] == ["only\nhere", "", "q", "same", "same"]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert main_text(df.where("false")).count() == 0


def texts_of(spark, rows, name="page_id long, url string, html string"):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], name)
    return {r.page_id: r.text for r in main_text(df).collect()}


def test_articles_are_aligned_too(spark):
    rng = random.Random(5)
    own = [[prose(rng, 9) for _ in range(3)] for _ in range(5)]
    art = ["<article>" + "".join(f"<p>{t}</p>" for t in o) + "<p>Share now</p></article>" for o in own]
    rows = [
        ("http://a.example/n/1", "<div>Menu</div>" + art[0]),
        ("http://a.example/n/2", "<div>Menu</div>" + art[1]),
        # without an article, on a host of article pages
        ("http://a.example/n/3", "<div>Menu</div>" + "".join(f"<p>{t}</p>" for t in own[2])),
        # a small teaser beside the main text
        ("http://a.example/n/4", f"<div>Menu</div><div><p>{own[3][0]}</p><p>{own[3][1]}</p></div><article><p>Teaser {own[4][0]}</p></article>"),
        # an article and a copy of it that differs in one line keep their text
        ("http://b.example/1", "<div>Menu</div>" + art[0]),
        ("http://b.example/2", "<div>Menu</div>" + art[0].replace("<p>Share", "<p>x</p><p>Share")),
    ]
    got = texts_of(spark, rows)
    want = [own[0], own[1], own[2], [*own[3][:2], "Teaser " + own[4][0]], [*own[0], "Share now"], [*own[0], "x", "Share now"]]
    assert got == {i: "\n".join(w) for i, w in enumerate(want)}


def test_neighbours_are_exact_at_any_host_size(spark):
    """Each directory has a line of its own, so that only the true neighbour shares it."""

    def rows(n):
        paths = [f"dir{i // 2:05d}/{i}" for i in range(n)]
        return [(f"http://hot.example/{p}", f"<p>Section {i // 2}</p><p>own text {i} of the page</p><p>Foot</p>") for i, p in enumerate(paths)]

    for n in (998, 2200):
        assert texts_of(spark, rows(n)) == {i: f"own text {i} of the page" for i in range(n)}
    slugs = [(f"http://hot.example/slug-{i}", f"<p>Top</p><p>own text {i} of the page</p>") for i in range(1200)]
    assert texts_of(spark, slugs) == {i: f"own text {i} of the page" for i in range(1200)}


def test_copies_of_a_page_keep_their_text(spark):
    def page(i):
        return f"<div>Top</div><p>own text {i} of the page</p><p>more of {i} to read</p>"

    paths = ["en/1?utm=x", "en/1", "mirror/en/1", "en/1", "en/2", "en/3", "en/3/"]
    rows = [(f"http://a.example/{p}", page(p.split("?")[0].strip("/")[-1])) for p in paths]
    rows += [("http://alone.example/1", page(7)), ("http://alone.example/1?x", page(7))]
    got = texts_of(spark, rows)
    for i in range(len(paths)):
        k = rows[i][0].split("?")[0].strip("/")[-1]
        assert got[i] == f"own text {k} of the page\nmore of {k} to read"
    assert got[7] == got[8] == "Top\nown text 7 of the page\nmore of 7 to read"


def full_matches(template, words):
    return lcs(template, words)


def test_banded_alignment():
    t = template_words(TEMPLATES["GPL-3.0"])
    for text, matched in (
        (t, len(t)),
        (["x"] * 3 + t + ["y"], len(t)),
        (t[:4] + ["new"] + t[4:], len(t)),
        (t[:4] + t[5:], len(t) - 1),
    ):
        shift = 3 if text[0] == "x" else 0
        assert align(t, text, shift)[0] == matched == full_matches(t, text)


def test_license_spans(spark):
    rng = random.Random(9)
    notices = sorted(TEMPLATES.items())
    texts = edge_texts()
    planted = {}
    for i, (name, notice) in enumerate(notices * 2):
        head, tail = prose(rng, i), prose(rng, 5)
        words = notice.split(" ")
        if i >= len(notices) and len(words) > 8:
            words.insert(5, "really")
        body = " ".join(words)
        planted[len(texts)] = (name, len(head) + 1, body)
        texts.append(f"{head}\n{body.upper() if i % 3 == 0 else body}\n{tail}")
    texts.append(" ".join(TEMPLATES.values()))
    rows = license_spans(clashing(frame(spark, texts))).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for doc, (name, start, body) in planted.items():
        own = [r for r in got[doc] if r.license == name]
        assert [(r.start, r.coverage) for r in own] == [(start, 1.0)], name
        assert texts[doc][own[0].start : own[0].end].lower() == body.lower().rstrip(".")
    assert {r.license for r in got[len(texts) - 1]} == set(TEMPLATES)
    assert not [d for d in got if d < len(edge_texts())]
    assert license_spans(frame(spark, texts), templates={}).count() == 0
    assert license_spans(frame(spark, [])).count() == 0


def test_index_covers_every_template():
    index = Index(TEMPLATES)
    assert set(index.template.tolist()) == set(range(len(TEMPLATES)))
