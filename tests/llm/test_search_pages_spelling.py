"""Ranked search, main text of pages, spelling variants: against brute force and SQL."""

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import oracle_rows, spark_rows
from pyspark.sql import functions as F

from sensorloom.llm import html_text, ranked_search, spelling_variants
from sensorloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(docs, items, top):
    """(item_id, rank, doc_id, score) with every document scored; docs and items are (id, text)."""
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, bag) for d, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = collections.Counter(t for _, bag in bags for t in bag)
    rows = []
    for item, text in items:
        scored = []
        for d, bag in bags:
            m = 100 - 90 + 90 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in set(terms(text)) if t in bag
            )
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        rows += [(item, k, d, -score) for k, (score, _, d) in enumerate(scored[:top], 1)]
    return collections.Counter(rows)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_spelling_variants"])
def test_query_matches_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == oracle_rows(ORACLES[name], SF)


def awkward_items(rng, docs):
    found = [(i, " ".join(rng.sample(terms(t), min(len(terms(t)), 12)))) for i, (_, t) in enumerate(docs) if t and len(t) < 9000]
    return found + [(3, "same id"), (3, "one two"), (None, "one Two"), (50, None), (51, ""), (52, " .,; "), (53, "absent"),
                    (54, " ".join(t or "" for _, t in docs[:40])), (55, "漢字 É é"), (55, "漢字 É é")]


@pytest.mark.parametrize("block", [1 << 22, 1 << 17])
def test_search_of_awkward_rows(spark, awkward, awkward_rows, none, block, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    docs = [(d, t) for d, t, *_ in awkward_rows]
    items = awkward_items(random.Random(3), docs)
    asked = spark.createDataFrame([(*i, 1, 2, 0.5) for i in items], "item_id long, text string, rank int, item int, score double")
    assert rows_of(ranked_search.ranked(awkward, asked)) == ranking(docs, items, 10)
    assert rows_of(ranked_search.ranked(awkward, asked, top=3)) == ranking(docs, items, 3)
    assert ranked_search.ranked(none, asked).count() == ranked_search.ranked(awkward, asked.limit(0)).count() == 0


def test_search_with_ties_and_a_hot_text(spark):
    """A third of the documents is one text, many score alike, and terms are frequent."""
    rng = random.Random(8)
    docs = [(i, "a b c" if i % 3 == 0 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))) for i in range(900)]
    items = [(i, " ".join(rng.sample("abcdefgh", rng.randint(1, 8)))) for i in range(30)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert rows_of(ranked_search.ranked(rows, spark.createDataFrame(items, "item_id long, text string"))) == ranking(docs, items, 10)


def test_masks_spare_documents():
    """Masks of frequent terms alone are never scored once ten better documents are known."""
    rng = np.random.default_rng(1)
    n = 4000
    pairs = [(d, t) for t, share in enumerate((0.9, 0.8, 0.02)) for d in np.flatnonzero(rng.random(n) < share)]
    doc, term = np.array(pairs).T
    postings = ranked_search._Postings(n, doc, term, np.array([10, 12, 900])[term])
    best = ranked_search._Best(10)
    scored = ranked_search.search_block(postings, np.arange(3), best, np.arange(n), np.zeros(n, bool))
    totals = np.bincount(doc, weights=np.array([10, 12, 900])[term], minlength=n)
    assert sorted(best.scores, reverse=True) == sorted(totals, reverse=True)[:10] and scored < n / 5


def variants_of(docs, least=5, often=3, dropping=97):
    counts = collections.Counter()
    for doc, text in docs:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % dropping == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if c >= often and len(w) >= least}
    near = collections.defaultdict(set)
    patterns = collections.defaultdict(list)
    for word in n:
        for i in range(len(word)):
            patterns[word[:i], word[i + 1 :]].append(word)
            if (cut := word[:i] + word[i + 1 :]) in n:
                near[word].add(cut)
                near[cut].add(word)
    for words in patterns.values():
        for a in words:
            near[a].update(b for b in words if b != a)
    form = {}
    for word, own in n.items():
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best and n[best] >= 2 * own else None

    def root(word):
        while form[word]:
            word = form[word]
        return word

    return collections.Counter((w, form[w], root(w), c, len(near[w]), n.get(form[w])) for w, c in n.items())


def test_variants_match_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(QUERIES["op13_spelling_variants"](spark, SF))
    assert got == variants_of(docs) and max(got.values()) == 1


def typed(rng, words, n):
    """Words in Zipfian numbers, some mistyped."""
    out = []
    for _ in range(n):
        word = words[min(int(rng.paretovariate(0.6)) - 1, len(words) - 1)]
        if rng.random() < 0.3:
            at, letter = rng.randrange(len(word)), rng.choice("abéÿ×÷")
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])
        out.append(word.upper() if rng.random() < 0.1 else word)
    return rng.choice([" ", "-", "1", "\n", "ā"]).join(out)


@pytest.mark.parametrize("limits", [{}, {"FILTER_BYTES": 100, "SLICE": 4, "CELLS": 64, "SUMMED": 10}])
def test_variants_of_mistyped_words(spark, limits, monkeypatch):
    """Also in rounds of small filters, whose slices and chunks are tiny."""
    for name, value in limits.items():
        monkeypatch.setattr(spelling_variants, name, value)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaaa", "aaaaa", "aaaaaaa"]
    docs = [(i if i % 7 else None, typed(rng, words, 60)) for i in range(120)]
    got = rows_of(spelling_variants.variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), dropping=5))
    assert got == variants_of(docs, dropping=5)
    assert sum(1 for r in got if r[1] and r[2] != r[1]) > 0  # forms of forms


def test_variants_of_awkward_rows(spark, awkward, awkward_rows, none):
    docs = [(d, t) for d, t, *_ in awkward_rows] + [(9, "b" * 2000), (8, "b" * 2000), (7, "b" * 1999 + "c"), (6, "b" * 2000)]
    more = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1)})
    assert rows_of(spelling_variants.variants(more)) == variants_of(docs)
    assert rows_of(spelling_variants.variants(awkward, often=1)) == variants_of(docs[:-4], often=1)
    assert spelling_variants.variants(none).count() == 0


def article(page):
    """The article of the given pages, whose markup is known."""
    inside = re.search("<article>(.*)</article>", page or "", re.S)
    parts = re.split("</?(?:p|h1|br)>", re.sub("</?b>", "", inside[1])) if inside else []
    return "\n\n".join(t for p in parts if (t := " ".join(html.unescape(p).split())))


def test_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = rows_of(QUERIES["op12_html_text"](spark, SF))
    assert got == collections.Counter((p.page_id, p.url, article(p.html), len(article(p.html))) for p in pages)


PARTS = [
    ("<article><h1>Big  &amp;\n news</h1><p>One<br>two<p>three</article>", ["Big & news", "One two", "three"]),
    ("<body class='no-ad sidebar'><div>a<div class='left ad'>x<div>y</div>z</div>b</div>", ["a", "b"]),
    ("<main><p>in</p><aside>x</aside><form>y</form><section id=comments>z</section></main><p>out</p>", ["in"]),
    ("<header>site</header><article><header><h1>T</h1></header>t<footer>f</footer></article><article class=comment>c</article>", ["T", "t"]),
    ("<nav><ul><li>a<li>b</ul><article>unclosed menu</article>", ["unclosed menu"]),
    ("<p title='a>b' data-x=\"</p>\">q</p><script>if (a<b) '</p>'</script ><style>p</style><!-- <p>no --><p>r", ["q", "r"]),
    ("1 < 2 &lt; 3 &#233;&nbsp;&eacute; x<b>y</b>z", ["1 < 2 < 3 é é xyz"]),
    ("<p>open <script>never closed <p>x", ["open"]),
    ("<table><tr><td>a<td>b<tr><td>c</table><p hidden>h</p><p style='display: none'>h<p>d", ["a b", "c", "d"]),
    ("<div role=navigation>m</div><div aria-hidden=true>h</div><textarea>t</textarea>k<template><p>t</template>", ["k"]),
    ("<P>UP</P><P>tail <a href='x", ["UP", "tail"]),
    ("<p>a &amp", ["a &"]),
    ("plain text", ["plain text"]),
    ("<article></article>", []),
]


@pytest.mark.parametrize("page,want", PARTS)
def test_markup(page, want):
    assert [text for text, status in html_text.blocks_of(page) if status != html_text.SETTLED] == want


def test_odd_pages_end_in_linear_time():
    for piece in ("<a ", "<p title=\"", "<!--", "<div>", "</div>", "<p>", "&", "<script>", "<a href='"):
        html_text.blocks_of(piece * 20_000)


def soup(rng, host, n):
    """Pages without helpful markup: menu, notice and footer of the host around own text."""
    def words(k):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(k))

    menu, notice, foot = words(9), words(15), words(10)
    pages = []
    for i in range(n):
        own = [words(rng.randint(3, 40)) for _ in range(rng.randint(1, 5))]
        mixed = words(12)  # a unique run in a boilerplate block
        body = "".join(f"<div>{p}</div>" for p in own)
        page = f"<div><span>{menu}</span></div><div>{notice}</div>{body}<div>{foot} {mixed}</div>"
        pages.append((f"http://{host}/{i}", page, "\n\n".join([*own, mixed])))
    return pages


@pytest.fixture(scope="module")
def soups():
    rng = random.Random(11)
    return [p for k, n in enumerate((60, 5, 2)) for p in soup(rng, f"h{k}.example.org", n)]


def extracted(spark, pages, **more):
    rows = [(i, url, page, "x", 0) for i, (url, page) in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, page int").repartition(6)
    return {r.page_id: r.text for r in html_text.main_text(frame, **more).collect()}


def test_repeated_runs_go_and_unique_runs_stay(spark, soups):
    got = extracted(spark, [(url, page) for url, page, _ in soups])
    assert [got[i] for i in range(len(soups))] == [want for *_, want in soups]


def covered_by_brute_force(pages, run):
    """Texts without tokens in a substring of `run` tokens or more that another page of the host has."""
    places = collections.defaultdict(set)
    streams = [" ".join(t for t, _ in html_text.blocks_of(page)).split(" ") for _, page in pages]
    for i, tokens in enumerate(streams):
        for k in range(len(tokens) - run + 1):
            places[html_text.host_of(pages[i][0]), tuple(tokens[k : k + run])].add(tuple(tokens))
    out = []
    for i, (url, page) in enumerate(pages):
        tokens, gone = streams[i], set()
        for k in range(len(tokens) - run + 1):
            if html_text.host_of(url) and len(places[html_text.host_of(url), tuple(tokens[k : k + run])]) > 1:
                gone.update(range(k, k + run))
        at, kept = 0, []
        for text, _ in html_text.blocks_of(page):
            own = text.split(" ")
            marks = "".join("x" if k in gone else "." for k in range(at, at + len(own)))
            if "." in marks:
                marks = re.sub("x+", lambda m: m[0] if len(m[0]) >= run else "." * len(m[0]), marks)
                kept.append(" ".join(t for t, mark in zip(own, marks) if mark == "."))
            at += len(own)
        out.append("\n\n".join(kept))
    return out


def test_suffix_array_matches_brute_force(spark):
    """Few different tokens, so that repeats of all lengths overlap; equal pages are one page."""
    rng = random.Random(2)
    pages = []
    for i in range(80):
        blocks = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(0, 3))]
        pages.append((f"https://H{i % 3}.org:80/{i}", "".join(f"<p>{b}</p>" for b in blocks)))
    pages += [(f"http://solo.org/{i}", "<p>" + "same text twice " * 6) for i in range(2)]
    pages += [(None, "<p>" + "same text twice " * 6), ("no host", "<p>" + "a b c " * 9)]
    for run in (5, 8):
        got = extracted(spark, pages, run=run)
        assert [got[i] for i in range(len(pages))] == covered_by_brute_force(pages, run)


def test_marked_articles_keep_what_adverts_repeat(spark):
    """Lines that are adverts and footers of most pages, of the same page too, are paragraphs of some articles."""
    lines = [f"Line {k} of eleven words that a host and its articles repeat" for k in range(3)]
    pages, want = [], []
    for i in range(30):
        own = [f"Own words of page {i}", *(lines[: i % 3] if i < 9 else [])]
        body = "".join(f"<p>{p}</p>" for p in own)
        pages.append((f"http://h.org/{i}", f"<div class=ad>{lines[i % 3]}</div><article>{body}</article><footer>{lines[0]}</footer>"))
        want.append("\n\n".join(own))
    got = extracted(spark, pages)
    assert [got[i] for i in range(30)] == want


def test_marked_articles_vouch_for_open_text(spark):
    """A passage on open pages is text where as many pages have it in their article; on more pages without, it goes."""
    vouched, notice = "A passage of eleven words that articles of this host share", "Quite another ten words for a notice on open pages"
    marked = [f"<article><p>Own words {i}</p><p>{vouched if i < 3 else notice if i < 5 else 'None'}</p></article>" for i in range(6)]
    opens = [f"<p>Other own words {i}</p><p>{vouched}</p><p>{notice}</p>" if i < 3 else f"<p>{notice}</p><p>Last {i}</p>" for i in range(4)]
    got = extracted(spark, [(f"http://h.org/{i}", page) for i, page in enumerate([*marked, *opens])])
    assert [got[i] for i in range(6)] == [f"Own words {i}\n\n{vouched if i < 3 else notice if i < 5 else 'None'}" for i in range(6)]
    assert [got[i] for i in range(6, 10)] == [*(f"Other own words {i}\n\n{vouched}" for i in range(3)), "Last 3"]
    # Another host's articles say nothing, and equal pages count once.
    other = [("http://a.org/1", marked[0])] * 3 + [(f"http://{h}.org/{i}", f"<p>{vouched}</p><p>Own {i}</p>") for h in "ab" for i in range(2)]
    got = extracted(spark, other)
    assert [got[i] for i in range(3, 7)] == ["Own 0", "Own 1"] * 2


@pytest.mark.parametrize("words", range(1, 8))
def test_streams_of_few_words(words):
    """All pages of a task may have fewer words than a run."""
    found = html_text.Streams(["word " * words], np.zeros(1, np.uint64), 8)
    assert [len(part) for part in found.begun()] == [0, 0]


def test_awkward_pages(spark):
    rows = [(1, "http://a.org", None), (None, None, None), (2, None, ""), (2, None, ""), (3, "http://a.org/x", "<p>" + "w " * 200_000),
            (4, "http://a.org", "<p>漢字</p>"), (None, "http://a.org", "<p>漢字</p>")]
    frame = spark.createDataFrame([(*r, 5, "t", True) for r in rows], "page_id long, url string, html string, n_chars int, text string, open boolean")
    want = collections.Counter((p, u, " ".join(re.sub("<[^>]*>", "", h or "").split())) for p, u, h in rows)
    got = html_text.main_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert collections.Counter((r.page_id, r.url, r.text) for r in got.collect()) == want
    assert html_text.main_text(frame.limit(0)).count() == 0
