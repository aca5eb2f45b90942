"""Main text of pages: declared structure, repetition, and white space."""

from __future__ import annotations

import html
import random
import time
import re

import numpy as np
import pytest

from tallygate.llm import html_text

SCHEMA = "page_id bigint, url string, html string, host string, kinds int, texts int, groups int"
EXTRA = ("h", 1, 2, 3)


def text_of(page: str) -> str:
    return html_text.group_texts([html_text.blocks(page)])[0]


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a  b\n c</p><p> d </p>", "a b c d"),
        ("<p>one<p>two<p>three", "one two three"),
        ("<p>bo<b>ld</b> and <i>it</i>alic<br>next</p>", "bold and italic next"),
        ("a &lt;b&gt; &amp;amp; &eacute; &#x41; &nbsp; x", "a <b> &amp; é A x"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<article><h1>T</h1><p>x</p></article><p>outside</p>", "T x"),
        ("<main>m</main><aside>s</aside>", "m"),
        ("<article>a</article><article>b</article>", "a b"),
        ("<article>a<nav>n</nav>b<div class='ad'>c <p>d</div>e</article>", "a b e"),
        ("<article>a<section id=reader-comments><p>no</p></section>b</article>", "a b"),
        ("<article><p>a<p>b<form><p>f</form><ul><li>c<li>d</ul></article>", "a b c d"),
        ("<article class='post-header'>kept</article>", "kept"),
        ("<header>h</header><footer>f</footer><div role=banner>r</div>t", "t"),
        ("<script>if (a < b) '</p>'</script><style>p{}</style>t", "t"),
        ("<script>never closed <p>x</p>", ""),
        ("<!-- <p>c</p> -->t<!-- open", "t"),
        ("<p title='a > b'>t</p>", "t"),
        ("</div></p>t</article>", "t"),
        ("<head><title>x</title></head><body>t", "t"),
        ("<p class=notice>n<p>a<p class=ad><b>x<h2>b</h2><ul><li class=ad>y<li>c</ul>", "a b c"),
        ("<table><tr><td>a<td class=ad>b<tr><td>c</table><dl><dt>d<dd class=ad>e<dt>f</dl>", "a c d f"),
        ("<div class=sidebar><p>s<div>t</div></div>u", "u"),
        ("<div class='cookie-notice'>n</div><div class='navigate'>t</div>", "t"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ],
)
def test_pages(page, text):
    assert text_of(page) == text


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in html_text.extracted(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>|<br>", article)
        blocks = [" ".join(html.unescape(b.replace("<b>", "")).split()) for b in blocks]
        wanted = " ".join(b for b in blocks if b)
        assert found[row.page_id].text == wanted
        assert found[row.page_id].n_chars == len(wanted)
    assert len(found) == pages.count()


def words(rng, count):
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(count))


def test_repeated_stretches_go_and_unique_runs_stay():
    rng = random.Random(1)
    menu, legal = words(rng, 12), words(rng, 20)
    own = [(words(rng, 30), words(rng, 15)) for _ in range(20)]
    pages = [f"<div>{menu} {a}</div><div>{legal}</div><div>{b}</div>" for a, b in own]
    texts = html_text.group_texts([html_text.blocks(p) for p in pages])
    assert texts == [f"{a} {b}" for a, b in own]


def test_articles_keep_what_other_pages_have_too():
    rng = random.Random(2)
    shared = words(rng, 40)
    pages = [f"<article><p>{shared}</p></article>" for _ in range(10)]
    assert html_text.group_texts([html_text.blocks(p) for p in pages]) == [shared] * 10


def brute_repeated(streams, least):
    """Every window of RUN_WORDS words, and the pages it stands on."""
    run, where = html_text.RUN_WORDS, {}
    for page, own in enumerate(streams):
        for i in range(len(own) - run + 1):
            where.setdefault(tuple(own[i : i + run]), set()).add(page)
    out = []
    for own in streams:
        covered = np.zeros(len(own), bool)
        for i in range(len(own) - run + 1):
            if len(where[tuple(own[i : i + run])]) >= least:
                covered[i : i + run] = True
        out.append(covered.tolist())
    return out


@pytest.mark.parametrize("seed", range(5))
def test_repetition_against_all_windows(seed):
    rng = random.Random(seed)
    phrases = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 15))] for _ in range(12)]
    streams = [
        [w for p in rng.choices(phrases, k=rng.randint(0, 12)) for w in p] for _ in range(15)
    ]
    found = [c.tolist() for c in html_text.repeated(streams, 3)]
    assert found == brute_repeated(streams, 3)


def test_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP_PAGES", 4)
    rng = random.Random(3)
    rows = [(i, f"http://hot.example/{i}", f"<p>{words(rng, 30)}</p>") for i in range(40)]
    rows += [
        (100, None, "<p>no address</p>"),
        (101, "", None),
        (102, "nothing", ""),
        (None, "http://x.example/", "<p>no id</p>"),
        (5, "http://y.example/", "<article>again</article>"),
        (5, "http://y.example/", "<article>again</article>"),
        (103, "http://z.example/", "<p>" + "long words " * 50_000 + "</p>"),
    ]
    pages = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    found = html_text.extracted(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    wanted = [(i, u, text_of(h or ""), len(text_of(h or ""))) for i, u, h in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_no_pages(spark):
    assert html_text.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def on_a_host(spark, texts, **options):
    rows = [(i, f"http://hot.example/{i}", t, *EXTRA) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = html_text.extracted(pages, **options).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


@pytest.mark.parametrize("size", [30, 900])
def test_a_repeat_is_one_however_large_its_host(spark, size):
    rng = random.Random(4)
    notice, pair = words(rng, 20), words(rng, 20)
    own = [words(rng, 30) for _ in range(size)]
    shown = [f"<p>{o} {notice if i < 3 else pair if i < 5 else ''}</p>" for i, o in enumerate(own)]
    wanted = [f"{o} {pair}" if 3 <= i < 5 else o for i, o in enumerate(own)]
    assert on_a_host(spark, shown) == wanted
    assert html_text.group_texts([html_text.blocks(p) for p in shown]) == wanted


def test_other_hosts_do_not_count(spark):
    text = words(random.Random(5), 20)
    rows = [(i, f"http://h{i}.example/", f"<p>{text}</p>", *EXTRA) for i in range(5)]
    found = html_text.extracted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.text for r in found} == {text}


@pytest.mark.parametrize("bound", [250_000, 0])
def test_hosts_against_the_suffix_array(spark, monkeypatch, bound):
    monkeypatch.setattr(html_text, "GROUP_PAGES", 3)
    monkeypatch.setattr("tallygate.llm.common.BROADCAST_ROWS", bound)
    rng = random.Random(6)
    phrases = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 15))) for _ in range(40)]
    tags = ["p", "div", "nav", "article"]
    shown = [
        "".join(f"<{t}>{p}</{t}>" for p in rng.choices(phrases, k=rng.randint(0, 9))
                for t in rng.choices(tags, [4, 4, 2, 0.3]))
        for _ in range(60)
    ]
    shown += shown[:5]
    assert on_a_host(spark, shown) == html_text.group_texts([html_text.blocks(p) for p in shown])


def test_repetition_decides_on_given_pages_without_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    whole = {r.page_id: r.text.split() for r in html_text.extracted(pages).collect()}
    found = {r.page_id: r.text.split() for r in html_text.extracted(pages, articles=False).collect()}
    assert found.keys() == whole.keys()
    kept = sum(map(len, found.values())) / sum(map(len, whole.values()))
    assert 0.99 < kept < 1  # passages that three pages share go
    for page, own in found.items():
        rest = iter(whole[page])
        assert all(word in rest for word in own)  # nothing else comes in, nothing is moved


@pytest.mark.parametrize(
    "broken",
    [
        "<a ", "<a '", '<a "', "<script ", "<!", "</", "<b>", "<b><i>", "<div><b></i>", "<!--",
        "</i>", "<p><b>", '<a "<a" ', "&#", "&amp", "<li><b>", "<b><div></div>", "<article ",
    ],
)
def test_broken_markup_takes_linear_time(broken):
    """Half a megabyte of it, alone and after what it might walk through again and again."""
    count = 500_000 // len(broken)
    for page in (broken * count, "<b>" * 50_000 + broken * count + "</i>" * 50_000):
        started = time.perf_counter()
        html_text.blocks(page)
        assert time.perf_counter() - started < 4


def test_long_character_numbers():
    page = f"<p>a&#{'0' * 9000}65;b&#{'9' * 9000};c&#x{'0' * 9000}41;</p>"
    assert html_text.blocks(page) == [(html_text.OPEN, "aAb�cA")]


def test_comments_marked_up_as_articles():
    def core(page):
        return [text for kind, text in html_text.blocks(page) if kind == html_text.CORE]

    inner = '<article class="comment">Reader says hi</article>'
    assert core(f"<article><p>Main text here.</p>{inner}<p>More.</p></article>") == [
        "Main text here.", "More.",
    ]
    assert core(f"<article><p>Main text here.</p></article>{inner}") == ["Main text here."]
    assert core('<article class="ad-free post"><p>Text.</p></article>') == ["Text."]
    assert core('<main class="notice"><article><p>Text.</p></article></main>') == ["Text."]
