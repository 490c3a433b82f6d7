import html
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from inkwell.llm import html_extract

from .helpers import SMALL, prose

BODY = "<p>The first paragraph of a long article.</p><p>The second one says a good deal more than that.</p>"
TEXT = ["The first paragraph of a long article.", "The second one says a good deal more than that."]
MENU = "<nav>home news</nav>"


@pytest.mark.parametrize("page", [
    *[f"<html class='{c}'><body class='home {c}' id='{c}'>{MENU}<article>{BODY}</article></body></html>"
      for c in ("no-sidebar", "right-sidebar", "comments-open", "cookies-set", "menu", "widget")],
    f"<body>{MENU}<div class='content with-sidebar'>{BODY}</div></body>",
    f"<body>{MENU}<div class='content right-sidebar'>{BODY}</div></body>",
    f"<body>{MENU}<div class='has-sidebar'><main>{BODY}</main></div></body>",
    f"<body>{MENU}<div class='right-sidebar'><article>{BODY}</article></div></body>",
    f"<body><form action='/'>{MENU}<main>{BODY}</main></form></body>",
    f"<body>{MENU}<main>{BODY}</main><article>A teaser.</article></body>",
    f"<body>{MENU}<div class='content'>{BODY}</div><article>A teaser.</article></body>",
    f"<body>{MENU}<div class='content'>{BODY}</div><aside><article>A teaser.</article></aside></body>",
    f"<body>{MENU}<main><p>more</p><article>{BODY}</article></main></body>",
])
def test_the_article_is_found(page):
    assert html_extract.regions(page)[0] == TEXT


def test_a_teaser_inside_the_body_does_not_replace_it():
    assert html_extract.regions(f"<main>{BODY}<article>A teaser.</article></main>")[0] == [*TEXT, "A teaser."]


@pytest.mark.parametrize("name", ["sidebar", "cookie-banner", "sidebar-left", "site-nav", "post-comments", "comment-body", "ad-slot",
                                  "newsletter-signup", "related-posts", "widget_area"])
def test_named_surroundings_stay_out(name):
    page = f"<body><main>{BODY}<div class='{name}'>not the article</div></main></body>"
    assert html_extract.regions(page) == (TEXT, [(True, "not the article")])


def test_hidden_articles_and_articles_in_asides_stay_side():
    assert html_extract.regions("<div hidden><article>x</article></div><aside><article>y</article></aside>") == ([], [(True, "x"), (True, "y")])


def article(*blocks):
    return "<body><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article></body>"


def test_articles_keep_what_they_repeat(spark):
    rng = random.Random(4)
    line, own = "This sentence stands in many of the articles of this host, and in others.", [prose(rng, 60) for _ in range(12)]
    pages = [(i, f"http://a.example/{i}", article("A head", own[i], line)) for i in range(12)]
    pages += [(20, "http://a.example/20", article(line)), (21, "http://b.example/", article(own[0], line))]
    pages += [(30 + i, "http://a.example/x", f"<body><div>{line}</div><div>{own[i]}</div></body>") for i in range(3)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == ({i: f"A head {own[i]} {line}" for i in range(12)} | {20: line, 21: f"{own[0]} {line}"}
                   | {30 + i: own[i] for i in range(3)})


def brute_unnamed(pages, min_words=html_extract.MIN_WORDS):
    """Unique runs by comparing every run of words of every two pages of a host."""
    parsed = {p: html_extract.regions(html)[1] for p, _, html in pages}
    out = {}
    for p, url, _ in pages:
        others = [parsed[q] for q, u, _ in pages if u.split("/")[2] == url.split("/")[2] and parsed[q] != parsed[p]]
        runs = set()
        for around in others:
            for _, t in around:
                w = t.split()
                runs |= {tuple(w[i:i + min_words]) for i in range(len(w) - min_words + 1)} if len(w) >= min_words else {(*w, None)}
        kept = []
        for side, t in parsed[p]:
            w = t.split()
            gone = [(*w, None) in runs] * len(w) if len(w) < min_words else [
                any(tuple(w[s:s + min_words]) in runs for s in range(max(0, i - min_words + 1), min(i, len(w) - min_words) + 1))
                for i in range(len(w))]
            kept += [] if side else [x for x, g in zip(w, gone, strict=True) if not g]
        out[p] = " ".join(kept)
    return out


def test_repetition_decides_pages_whose_markup_names_nothing(spark):
    """The given pages with every name taken from their markup: <div> for all structure, no class or id."""
    strip = re.compile(r"<(/?)(article|main|nav|header|footer|aside|section|form)\b[^>]*>")
    pages = [(r.page_id, r.url, re.sub(r"""\s(class|id|role)\s*=\s*("[^"]*"|'[^']*')""", "", strip.sub(r"<\1div>", r.html)))
             for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    pages += [(10_000 + i, pages[0][1], pages[0][2]) for i in range(2)]        # mirrors do not erase each other
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == brute_unnamed(pages)
    boiler = [t for p, _, html in pages for _, t in html_extract.regions(html)[1] if len(t.split()) >= 8]
    assert len(boiler) != len(set(boiler)) and sum(map(len, got.values())) > 0


def test_articles_of_the_larger_sample_are_whole(spark):
    """Every page of sf0.1: the text is that of its <article>, read by a plain parser of these pages."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_text(pages).collect()}
    n = 0
    for r in pages.collect():
        inner = re.search(r"<article[^>]*>(.*?)</article>", r.html, re.DOTALL)
        if inner:
            n += 1
            assert got[r.page_id] == " ".join(html.unescape(re.sub(r"</?(p|h1|br)[^>]*>", " ", inner.group(1))
                                                            .replace("<b>", "").replace("</b>", "")).split())
    assert n == 2500


PAGES = "page_id long, url string, html string"


def test_repetition_decides_between_regions_that_the_markup_names(spark):
    """A region that stands on many pages of the host is no body, however large; a unique one is, and so is a named article that is copied."""
    rng = random.Random(6)
    boiler, copy, own = prose(rng, 90), prose(rng, 40), [prose(rng, 20) for _ in range(6)]
    pages = [(i, f"http://a.example/{i}", f"<body><article>{own[i]}</article><div class='content'>{boiler}</div></body>") for i in range(4)]
    pages += [(9, "http://a.example/0?again", pages[0][2])]                     # a mirror
    pages += [(10, "http://b.example/", f"<body><article>{own[4]}</article><div class='content'>{boiler}</div></body>")]
    pages += [(20 + i, f"http://c.example/{i}", f"<body><article>{copy}</article><div class='content'>{own[i]}</div></body>") for i in range(2)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {i: own[i] for i in range(4)} | {9: own[0], 10: boiler, 20: copy, 21: copy}


def test_the_array_holds_every_page_of_a_host_whose_pages_all_name_their_article(spark):
    """The numbers of pages of repeated substrings, against brute force, at sf0.001: articles and surroundings, each apart."""
    rows = [("h", r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    got = sorted(r.pages for r in html_extract.repeated(spark.createDataFrame(rows, "host string, html string")).collect())
    n, seen = html_extract.MIN_WORDS, Counter()
    for _, page in rows:
        main, around = html_extract.regions(page)
        assert main
        runs = set()
        for collection, t in [*((1, t) for t in main), *((0, t) for _, t in around)]:
            w = t.split()
            runs |= {(collection, *w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {(collection, *w, None)}
        seen.update(runs)
    assert got == sorted(c for c in seen.values() if c > 1)
    assert any(c > 1 and run[0] for run, c in seen.items()) and any(c > 1 and not run[0] for run, c in seen.items())


@pytest.mark.parametrize("chunk", [1, 50, 10 ** 6])
def test_lists_of_a_task_keep_every_key(monkeypatch, chunk):
    monkeypatch.setattr(html_extract, "CHUNK_KEYS", chunk)
    rng = random.Random(8)
    texts = [prose(rng, 30) for _ in range(5)] * 2 + ["", "short"]
    batch = pa.RecordBatch.from_pydict({"host": ["a"] * len(texts), "html": [f"<article>{t}</article>" for t in texts]})
    lists = pa.Table.from_batches(html_extract._sorted_lists(8)(iter([batch, batch])))
    found = [html_extract.unpack(*(lists.column(c)[i].as_py() for c in ("size", "low", "high"))) for i in range(lists.num_rows)]
    keys, counts = html_extract.merge(*(np.concatenate(c) for c in zip(*found, strict=True)))
    assert [len(keys), sorted(counts.tolist())] == [5 * 23 + 1, [2] + [4] * 115]
    assert (np.diff(keys.astype(object)) > 0).all()


def test_boilerplate_inside_articles_is_decided_by_the_array(spark):
    """What a host names as surroundings elsewhere is taken out of most of its articles, whole blocks only, and nothing else."""
    rng = random.Random(9)
    line, tip, own = "Sign up to the letter that we send to all of our readers once a week.", "Read on", [prose(rng, 30) for _ in range(24)]
    box = f"<div class='newsletter'>{line}</div><footer>{tip}</footer>"

    def page(i, *blocks, around=""):
        return f"<body>{around}<article><p>{own[i]}</p>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article></body>"

    pages = [(i, f"http://a.example/{i}", page(i, line, tip, around=box if i < 2 else "")) for i in range(5)]
    pages += [(5, "http://a.example/5", article(line))]                                              # no region loses all of it
    pages += [(6, "http://a.example/0?again", pages[0][2])]
    pages += [(7, "http://a.example/7", f"<body><article>{own[6]}</article><div class='content'><p>{own[7]} {own[8]} {own[9]} {own[23]}</p><p>{line}</p></div></body>")]
    # the surroundings of another host do not count
    pages += [(10 + i, f"http://b.example/{i}", page(10 + i, line)) for i in range(4)]
    # two of six articles have it, and mirrors of one are one
    pages += [(14 + i, f"http://c.example/{i}", page(14 + i, *[line] * (i < 2), around=box)) for i in range(6)]
    pages += [(24 + i, f"http://c.example/0?{i}", pages[-6][2]) for i in range(4)]
    # a headline that all pages of the host show in a menu; a longer block that only begins like a notice
    pages += [(30 + i, f"http://d.example/{i}", page(20 + i, f"{line} {own[i]} and more", around=f"<nav>{own[20]}</nav>{box}")) for i in range(3)]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == ({i: own[i] for i in range(5)} | {5: line, 6: own[0], 7: f"{own[7]} {own[8]} {own[9]} {own[23]}"}
                   | {10 + i: f"{own[10 + i]} {line}" for i in range(4)}
                   | {14 + i: f"{own[14 + i]} {line}" if i < 2 else own[14 + i] for i in range(6)}
                   | {24 + i: f"{own[14]} {line}" for i in range(4)}
                   | {30 + i: f"{own[20 + i]} {line} {own[i]} and more" for i in range(3)})
