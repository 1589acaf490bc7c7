"""Operators against SQL, against brute force, and against the libraries whose results they must equal."""

import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from against_sql import DATA, same
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from duplexa.llm import bpe_automaton, components, embedding_dedup, html_extract, license_scan, line_dedup, minhash_dedup, packing, quality_classifier, queries, suffix_dedup, suffix_sort, topk_search
from duplexa.llm.queries import word_bpe

FOLDER = f"{DATA}/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def document_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# Pages ---------------------------------------------------------------------------


@tables
def test_main_text_is_what_the_article_holds(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for row in queries.op1_extract_main_text(spark, FOLDER).collect():
        body = re.search(r"<article[^>]*>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h\d|ul|li|div)\b[^>]*>", body)]
        assert row["text"] == "\n".join(p for p in parts if p) and row["n_chars"] == len(row["text"])


def test_templates_leave_the_slot_that_varies(spark):
    page = lambda n: (
        n,
        f"https://Host.example/{n}",
        f"<html><body><div class=top><span>Our site</span></div><div class=box><p>Read this first, everybody.</p><h2>Title {n}</h2><p>Body {n} of page{'s' * n}.<p>More {n * 7}</div>"
        "<div class=low><p>Write to us at any time, day or night, and we shall answer soon.</p></div></body></html>",
    )
    pages = spark.createDataFrame([page(n) for n in range(12)] + [(99, "http://alone/x", page(3)[2])], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    assert all(got[n] == f"Title {n}\nBody {n} of page{'s' * n}.\nMore {n * 7}" for n in range(12))
    assert "Body 3" in got[99]


@pytest.mark.parametrize(
    "source, text",
    [
        ("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
        ("<nav>menu</nav><header>top</header><main><header><h1>T</h1></header><p>a  b\n c</p></main><aside>x</aside>", "T\na b c"),
        ("<article><p>a<br>b &lt;i&gt; &#39;c&#39;</p><div class='share-bar'>Share</div></article><section id=comments><p>I agree entirely with all of this, thanks</p></section>", "a b <i> 'c'"),
        ("<div class='cookie-notice'>We use cookies</div><div class='content'><p>real text here</p></div><form>Name <input></form>", "real text here"),
        ("<div class='content-sidebar-wrap'><article>in</article></div>", "in"),
        ("<article><ul><li>one<li>two</ul>tail", "one\ntwo\ntail"),
        ("<ARTICLE><P>x</P></ARTICLE", "x"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"),
        ("plain & simple", "plain & simple"),
        ("<article><p>own</p><article class='comment'><p>a remark that is longer than the text</p></article></article>", "own"),
        ("<div id=topNav>x</div><div class='post'><p>one</p></div><div class='userComments'><p>a long and winding remark on it</p></div>", "one"),
        ("<main><p>a<td>b</td></p><table><tr><td>c<td>d</table></main>", "a\nb\nc\nd"),
    ],
)
def test_markup(source, text):
    assert html_extract.main_text(source) == text


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body><div class=post><div class=intro><p>Short lead.</p></div><div class=part><p>" + "long part " * 20 + "</p></div></div></body>", "Short lead.\n" + ("long part " * 20).strip()),
        ("<body><section><h2>One</h2><p>first part</p></section><section><p>second, longer part</p></section></body>", "One\nfirst part\nsecond, longer part"),
        ("<div class=post><p>before the table</p><table><tr><td>a cell<td>another cell of more text</table><p>after</p></div>", "before the table\na cell\nanother cell of more text\nafter"),
        ("<body><div>Site</div><div><p>" + "the article " * 9 + "</p><p>its end</p></div><div>(c) Us</div></body>", ("the article " * 9).strip() + "\nits end"),
    ],
)
def test_an_article_in_several_boxes_stays_whole(source, text):
    assert html_extract.main_text(source) == text


def extracted(spark, pages):
    rows = spark.createDataFrame([(n, f"https://host.example/{n}", p) for n, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(html_extract.extract_text(rows).collect(), key=lambda r: r["page_id"])]


def test_the_template_takes_nothing_out_of_an_article(spark):
    body = lambda n: f"<h1>Dish {n}</h1><p>About {n}, a dish.</p><h2>Ingredients</h2><ul><li>{n} eggs<li>Salt</ul><h2>References</h2><p>Book {n * 3}</p>"
    want = lambda n: f"Dish {n}\nAbout {n}, a dish.\nIngredients\n{n} eggs\nSalt\nReferences\nBook {n * 3}"
    frame = "<html><body><div class=top>Our site</div>{}<div class=low>Write to us at any time.</div></body></html>"
    for box in ("<article>{}</article>", "<div class=box>{}</div>"):
        assert extracted(spark, [frame.format(box.format(body(n))) for n in range(8)]) == [want(n) for n in range(8)]
    # Near copies of one article, and other pages of the host.
    shared = [f"Paragraph {k} is the same on very many pages of this host, word by word." for k in range(6)]
    copies = ["".join(f"<p>{p}</p>" for p in [*shared[:3], f"Edition {n}.", *shared[3:]]) for n in range(9)]
    for box in ("<article>{}</article>", "<div class=box>{}</div>"):
        got = extracted(spark, [frame.format(box.format(c)) for c in copies] + [frame.format(box.format(body(9)))])
        assert got[:9] == ["\n".join([*shared[:3], f"Edition {n}.", *shared[3:]]) for n in range(9)]


@pytest.mark.parametrize("pages", [1, 2, 3, 4, 5, 9, 40, 100])
def test_pages_without_an_article_element(spark, pages):
    frame = (
        "<html><body><table><tr><td>Our site of many things</td><td><a href=/>Start</a> <a href=/all>All</a></td></tr></table>"
        "<div class=x1><span>Posted to you by the people of the site, who write daily.</span></div>{}<div class=x2><span>Write to us at any time.</span> <a href=/m>Mail</a></div></body></html>"
    )
    body = lambda n: "<div class=x3>" + f"<h1>Title {n}</h1>" + "".join(f"<p>Paragraph {k} of page {n} tells {n * 7 + k} things{' at length' * (n % 5)}.</p>" for k in range(4)) + "</div>"
    got = extracted(spark, [frame.format(body(n)) for n in range(pages)])
    for n, text in enumerate(got):
        want = "\n".join([f"Title {n}", *(f"Paragraph {k} of page {n} tells {n * 7 + k} things{' at length' * (n % 5)}." for k in range(4))])
        # A page alone has no others to tell its frame by.
        assert text == want if pages > 1 else want in text


FRAMED = "<html><body><div class=top>Our site of many things</div>{}<div class=low>Write to us at any time of the day.</div></body></html>"


def story(n):
    return f"<h1>Title {n}</h1>" + "".join(f"<p>Paragraph {k} of page {n} tells {n * 7 + k} things{' at length' * (n % 5)}.</p>" for k in range(4))


def told(n):
    return "\n".join([f"Title {n}", *(f"Paragraph {k} of page {n} tells {n * 7 + k} things{' at length' * (n % 5)}." for k in range(4))])


@pytest.mark.parametrize("pages", [10, 20])
@pytest.mark.parametrize(
    "box",
    [
        "<form id=aspnetForm><input type=hidden name=v><div>{}</div></form>",
        "<form id=aspnetForm><nav>Start</nav><article>{}</article><footer>End of it</footer></form>",
        '<div class="content has-sidebar">{}</div>',
        '<div class="layout no-sidebar">{}</div>',
        '<div class="post comments-open">{}</div>',
        '<div class="story ad-free">{}</div>',
        '<div class="noSidebar post">{}</div>',
        '<div class="sidebar-layout"><div class=x>{}</div></div>',
        '<div class="page-banner-layout">{}</div>',
    ],
)
def test_boxes_around_an_article_are_not_taken_for_chrome(spark, box, pages):
    # As if without a host of its own, and on a host of such pages.
    assert told(3) in html_extract.main_text(FRAMED.format(box.format(story(3))))
    assert extracted(spark, [FRAMED.format(box.format(story(n))) for n in range(pages)]) == [told(n) for n in range(pages)]


def test_an_article_in_small_widgets(spark):
    widgets = lambda n: "".join(f'<div class="el el-widget">{part}</div>' for part in story(n).replace("</p>", "</p>|").replace("</h1>", "</h1>|").split("|") if part)
    assert extracted(spark, [FRAMED.format(f"<div class=wrap>{widgets(n)}</div>") for n in range(8)]) == [told(n) for n in range(8)]


@pytest.mark.parametrize(
    "source, text",
    [
        ("<main><article><h1>T</h1><p>one part of it</p></article><article><p>two</p></article><article><p>three, the end</p></article></main>", "T\none part of it\ntwo\nthree, the end"),
        ("<main><h1>T</h1><p>first of three</p><p>second of three</p><p>third of three</p><article><a href=/x>teaser</a></article></main>", "T\nfirst of three\nsecond of three\nthird of three"),
        ("<div><article><p>the story itself, at length</p></article><article><h3><a href=/y>Another story to read</a></h3></article></div>", "the story itself, at length"),
        ("<div><article><p>the story itself, at length</p></article></div><div><article><p>short</p></article></div>", "the story itself, at length"),
        ("<article><p>text</p><section class=related-work><h2>Related work</h2><p>Others did so too.</p></section></article>", "text\nRelated work\nOthers did so too."),
        ("<article><h2>Menu</h2><div class=menu><ul><li>Soup<li>Roast</ul></div></article>", "Menu\nSoup\nRoast"),
        ("<article><div class=banner><h1>Title</h1></div><p>text</p><p class=copyright>The law of copyright is old.</p></article>", "Title\ntext\nThe law of copyright is old."),
        ("<article><p>text</p><div class=related><ul><li><a href=/a>One more</a><li><a href=/b>Another</a></ul></div></article>", "text"),
        ("<article><p>text</p><div class=notice>We have rules.</div><form><p>Name</p><a href=/>in</a><input></form><div class=ad><p>Buy this now</p></div></article>", "text"),
        ("<article><p>let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x=2</annotation></math> be</p></article>", "let x=2 be"),
        ("<div class=post><p>one</p></div><div class='userComments'><p>a long and winding remark on it</p><p>and more of the kind</p></div>", "one"),
        ("<div class=cookie-consent><p>We use very many cookies for very many ends, as you may know.</p></div><p>short text</p>", "short text"),
    ],
)
def test_parts_of_an_article_and_what_is_none(source, text):
    assert html_extract.main_text(source) == text


def test_the_template_tells_which_article_is_the_page_s_own(spark):
    promo = "<section><article><p>" + "Our great offer to all of you, this week only, is still on. " * 9 + "</p></article></section>"
    pages = [FRAMED.format(f"{promo}<div><article>{story(n)}</article></div>") for n in range(9)]
    assert extracted(spark, pages) == [told(n) for n in range(9)]
    # Alone, the page cannot tell, and more text wins.
    assert html_extract.main_text(pages[0]).startswith("Our great offer")


def test_each_layout_of_a_host_has_its_template(spark):
    post = lambda n: f"<html><body><div class=top>Our site</div><div class=box><h1>Post {n}</h1><p>Text {n} of it.</p></div></body></html>"
    boast = "".join(f"<p>Line {k} of what stands on each product page, in many words that say little.</p>" for k in range(4))
    product = lambda n: f"<html><body><div class=top>Our site</div><div class=item><h1>Thing {n}</h1><p>It is {n} cm long, {'very ' * 20}sturdy.</p></div><div class=pitch>{boast}</div></body></html>"
    got = extracted(spark, [post(n) for n in range(12)] + [product(n) for n in range(8)])
    assert got[:12] == [f"Post {n}\nText {n} of it." for n in range(12)]
    assert got[12:] == [f"Thing {n}\nIt is {n} cm long, {'very ' * 20}sturdy." for n in range(8)]


# Near duplicates -----------------------------------------------------------------


def brute_components(sets, percent):
    """Smallest index reachable, all pairs compared and links followed breadth first."""
    near = [[] for _ in sets]
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                near[i].append(j)
                near[j].append(i)
    found = [None] * len(sets)
    for first in range(len(sets)):
        if found[first] is None:
            found[first], reached = first, [first]
            for i in reached:
                for j in near[i]:
                    if found[j] is None:
                        found[j] = first
                        reached.append(j)
    return found


def shingle_set(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(400)}"
    docs = []
    # A family larger than a block whose members are at about the threshold, small groups, and loners with a common passage.
    base = [word() for _ in range(60)]
    for _ in range(700):
        copy = list(base)
        for _ in range(rnd.choice([0, 1, 1, 1, 2])):
            copy[rnd.randrange(60)] = word()
        docs.append(" ".join(copy))
    for _ in range(40):
        own = [word() for _ in range(rnd.randrange(1, 80))]
        docs += [" ".join(own), " ".join(own).upper(), " ".join([*own[:-1], word()])]
    docs += [" ".join([word() for _ in range(30)] + base[:10]) for _ in range(60)] + ["", "  ", "a", "A", "a b", "a\tB"]
    rnd.shuffle(docs)
    for width, percent in ((3, 85), (5, 80)):
        sets = [shingle_set(d, width) for d in docs]
        want = brute_components(sets, percent)
        rows = sorted(minhash_dedup.near_duplicates(document_frame(spark, docs), words=width, percent=percent).collect(), key=lambda r: r["doc_id"])
        assert [r["n_shingles"] for r in rows] == [len(s) for s in sets]
        assert [r["component_id"] for r in rows] == want
        assert [r["kept"] for r in rows] == [i == c for i, c in enumerate(want)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 8), st.integers(1, 40), st.sampled_from([1, 30, 10**6]))
def test_collisions_equal_all_pairs(seed, least, kinds, at_once):
    rng = np.random.default_rng(seed)
    left, right = (rng.integers(0, kinds, (n, 8)).astype(np.uint64) * np.uint64(8) + np.arange(8, dtype=np.uint64) for n in rng.integers(1, 40, 2))
    count = (left[:, None] == right[None]).sum(axis=2)
    i, j, c = minhash_dedup.collisions(left, right, least, at_once)
    assert sorted(zip(i.tolist(), j.tolist(), c.tolist())) == [(a, b, count[a, b]) for a, b in zip(*np.nonzero(count >= least))]


@pytest.mark.parametrize("limit", ["BLOCK_BYTES", "HUB_BYTES", "TOGETHER_BYTES", "TOGETHER", "BLOCK"])
def test_groups_of_any_size_lose_no_link(spark, monkeypatch, limit):
    monkeypatch.setattr(minhash_dedup, limit, 30 if limit in ("BLOCK", "TOGETHER") else 12_000)
    rnd = random.Random(len(limit))
    word = lambda: f"w{rnd.randrange(300)}"
    docs = []
    for size in (15, 60, 200):
        base = [word() for _ in range(size)]
        for _ in range(90):
            base = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2]) * size // 60 + (size < 60) * rnd.randrange(2)):
                base[rnd.randrange(size)] = word()
            docs.append(" ".join(base))
    rnd.shuffle(docs)
    rows = sorted(minhash_dedup.near_duplicates(document_frame(spark, docs), words=3, percent=85).collect(), key=lambda r: r["doc_id"])
    assert [r["component_id"] for r in rows] == brute_components([shingle_set(d, 3) for d in docs], 85)


def test_a_chain_of_little_in_common_is_not_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 30)
    moved, save = {}, minhash_dedup.Scratch.save
    monkeypatch.setattr(minhash_dedup.Scratch, "save", lambda self, frame, name: moved.setdefault(name, save(self, frame, name)))
    rnd = random.Random(3)
    parts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(301)]
    # Each text shares half its words with the next; two are near copies, and so are forty others of one text.
    docs = [f"{a} {b}" for a, b in zip(parts, parts[1:])]
    docs += [docs[7] + " more", *(f"{docs[20]} more{n}" for n in range(40))]
    rows = sorted(minhash_dedup.near_duplicates(document_frame(spark, docs), words=3, percent=85).collect(), key=lambda r: r["doc_id"])
    assert [r["component_id"] for r in rows] == brute_components([shingle_set(d, 3) for d in docs], 85)
    assert moved["families"].count() > 300 and moved["group"].count() < 80


def test_dense_confirmation_equals_sparse():
    rnd = np.random.default_rng(4)
    base = np.unique(rnd.integers(0, 2**62, 80, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rnd.choice(base, 70, replace=False), rnd.integers(0, 2**62, 6, dtype=np.uint64)])) for _ in range(90)]
    keys = np.stack([minhash_dedup.signature(s) for s in sets])
    ids, every = np.arange(90), np.ones(90, bool)
    found = []
    for dense_from in (10**9, 1):
        size = np.array([len(s) for s in sets])
        i, j = minhash_dedup.matches(every, every, ids, keys, size, 70, 5)
        links = minhash_dedup.confirm(ids, ids, sets, i, j, 70, dense_from)
        a, b = components.forest(np.array([x for x, _ in links]), np.array([y for _, y in links]))
        found.append(sorted(zip(a.tolist(), b.tolist())))
    assert found[0] == found[1] and found[0]


@pytest.mark.parametrize("together", [components.TOGETHER, 100, 0])
def test_connected_components_of_chains_and_stars(spark, together, monkeypatch):
    monkeypatch.setattr(components, "TOGETHER", together)
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(40)] + [(9, 9)]
    rnd.shuffle(edges)
    from duplexa.llm.scratch import Scratch

    rows = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(16), Scratch(spark, "t")).collect()
    got = {r["node"]: r["component"] for r in rows}
    want = {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)} | {5000 + i: 5000 + i // 2 * 2 for i in range(80)}
    assert len(rows) == len(got) and got == want


# Suffixes ------------------------------------------------------------------------


def brute_removal(texts, length=50):
    first, out = {}, []
    for i, text in enumerate(texts):
        data, runs = text.encode(), []
        for at in range(len(data) - length + 1):
            if first.setdefault(data[at : at + length], i) < i:
                if runs and at <= runs[-1][1]:
                    runs[-1][1] = at + length
                else:
                    runs.append([at, at + length])
        kept, at = [], 0
        for a, b in runs:
            kept.append(data[at:a])
            at = b
        kept.append(data[at:])
        out.append((i, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(b"".join(kept)).hexdigest()))
    return out


def test_removal_equals_brute_force(spark, texts):
    rnd = random.Random(6)
    letters = "abcé "
    pool = ["".join(rnd.choice(letters) for _ in range(rnd.choice([30, 49, 50, 51, 80, 200]))) for _ in range(12)]
    docs = ["".join(rnd.choice(pool) if rnd.random() < 0.5 else "".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(rnd.randrange(8))) for _ in range(150)]
    docs += ["a" * 49, "a" * 50, "a" * 500, "ab" * 100, "ba" * 100, docs[3], docs[3]] + list(texts.values())[:100]
    rows = suffix_dedup.dedup_substrings(document_frame(spark, docs), with_text=True).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == brute_removal(docs)


@pytest.mark.parametrize("contexts", [10, 10_000])
def test_very_frequent_anchors_lose_nothing(spark, monkeypatch, contexts):
    docs = [f"{i:03d}" + "the passage that very many documents share with each other, word by word" + f"{i % 7}" * 20 for i in range(120)]
    monkeypatch.setattr(suffix_dedup, "TASK_CONTEXTS", contexts)
    rows = suffix_dedup.dedup_substrings(document_frame(spark, docs)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == brute_removal(docs)


def test_contexts_do_not_move_to_part_very_frequent_anchors_from_others(spark, monkeypatch):
    docs = [f"{i:03d}" + "the passage that very many documents share with each other, word by word" + f"{i % 7}" * 20 for i in range(120)]
    plans, save = {}, suffix_dedup.Scratch.save
    monkeypatch.setattr(suffix_dedup.Scratch, "save", lambda self, frame, name: plans.setdefault(name, frame._jdf.queryExecution().executedPlan().toString()) and save(self, frame, name))
    monkeypatch.setattr(suffix_dedup, "TASK_CONTEXTS", 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = suffix_dedup.dedup_substrings(document_frame(spark, docs)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti, BuildRight" in plans["masks"] and "LeftSemi, BuildRight" in plans["masks"] and "hashpartitioning(key" not in plans["masks"]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == brute_removal(docs)


def test_anchors_do_not_depend_on_the_texts_hashed_with_them():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcd é") for _ in range(rng.choice([0, 20, 49, 50, 51, 300, 3000]))).encode() for _ in range(80)] + [b"x" * 20_000, b""]
    met = 0
    for low, group in suffix_dedup._groups(pa.array(texts, pa.binary())):
        starts, count, found = suffix_dedup.anchors_of(group)
        ends = np.cumsum(count)
        for n, text in enumerate(group):
            own = [x[ends[n] - count[n] : ends[n]] for x in found]
            own = [*own[:3], *(x - starts[n] for x in own[3:])]
            assert text == texts[low + n] and all((a == b).all() and len(a) == len(b) for a, b in zip(own, suffix_dedup.anchors(text)))
            met += 1
    assert met == len(texts)


def test_an_anchor_takes_at_most_24_bytes_of_the_shuffle():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 123, 2500, dtype=np.uint8).tobytes().decode() for _ in range(1200)]
    ids = pa.array(range(len(texts)), pa.int64())
    blocks = list(suffix_dedup._anchor_blocks(64, 50, False)([pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["row", "doc", "text"])]))
    n = sum(len(suffix_dedup.anchors(x.encode())[0]) for x in texts)
    assert sum(b.nbytes for b in blocks) < 24 * n


def test_contexts_and_cut_texts_move_once_where_no_id_repeats(spark, monkeypatch):
    plans, save = {}, suffix_dedup.Scratch.save
    monkeypatch.setattr(suffix_dedup.Scratch, "save", lambda self, frame, name: plans.setdefault(name, frame._jdf.queryExecution().executedPlan().toString()) and save(self, frame, name))
    docs = [f"{i:03d}" + "a passage that a few documents share with each other, word by word" + f"{i % 7}" * 20 for i in range(20)]
    rows = suffix_dedup.dedup_substrings(document_frame(spark, docs)).collect()
    assert "Aggregate" not in plans["contexts"] and "Aggregate" not in plans["cut"]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == brute_removal(docs)


def test_thousands_of_extents_around_one_anchor(spark):
    rng = random.Random(2)
    side = lambda: "".join(rng.choice("abcdefgh") for _ in range(45))
    docs = [side() + "the one and only core of them" + side() for _ in range(3000)] + ["x"]
    docs += [docs[5], docs[7][10:] + "tail", docs[9][:-12] + "end"]
    rows = suffix_dedup.dedup_substrings(document_frame(spark, docs)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == brute_removal(docs)


def test_extents_are_told_apart_by_both_hashes():
    rng = np.random.default_rng(0)
    found = [np.concatenate(x) for x in zip(*(suffix_dedup.anchors(rng.integers(0, 256, 5000, dtype=np.uint8).tobytes()) for _ in range(20)))]
    key, extent, extra, at, first, last = found
    assert len(np.unique(extent)) == len(extent) and len(np.unique(extra)) > 0.99 * len(extra)
    assert abs(np.corrcoef(extent.astype(float), extra.astype(float))[0, 1]) < 0.05 and extra.max() < 2**32
    bare = suffix_dedup.anchors(b"some text that is long enough to have an anchor or two in it, or three", hashed=False)
    assert len(bare[1]) == 0 and len(bare[3]) == len(bare[0])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b)), max_size=120), st.binary(max_size=30))
def test_deep_shallow_order(strings, prefix):
    strings = strings + [prefix + s for s in strings]
    order = suffix_sort.deep_shallow_order(strings, shallow=8)
    assert [strings[i] for i in order] == sorted(strings)
    shared = suffix_sort.common_prefixes(strings, order)
    for k in range(1, len(order)):
        assert shared[k] == len(os.path.commonprefix([strings[order[k - 1]], strings[order[k]]]))


def test_segments_cover_every_window(monkeypatch):
    data = bytes(random.Random(8).randrange(97, 100) for _ in range(5000))
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    *_, at, first, last = suffix_dedup.anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all() and (at >= last).all() and (at - first <= 34).all()


# Lines ---------------------------------------------------------------------------


def brute_lines(texts, min_lines, min_chars=40):
    """Every maximal run that an earlier place has, found by comparing all pairs of places."""
    docs = [[(n, x) for n, x in enumerate(t.split("\n")) if x.strip(" ")] for t in texts]
    places = [(d, k) for d, own in enumerate(docs) for k in range(len(own))]
    gone = [set() for _ in texts]
    for n, (d, k) in enumerate(places):
        for e, j in places[:n]:
            size = 0
            while k + size < len(docs[d]) and j + size < len(docs[e]) and docs[d][k + size][1] == docs[e][j + size][1]:
                size += 1
            if size >= min_lines or size and len(docs[d][k][1]) >= min_chars:
                gone[d] |= {docs[d][k + i][0] for i in range(size if size >= min_lines else 1)}
    out = []
    for t, cut in zip(texts, gone):
        lines = t.split("\n")
        out.append(("\n".join(x for n, x in enumerate(lines) if n not in cut), len(lines), len(cut), sum(n - 1 not in cut for n in cut)))
    return out


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, min_lines):
    rnd = random.Random(min_lines)
    pool = [f"line {i}" for i in range(6)] + ["", "  ", "a line that is long enough to count on its own, in short"]
    runs = [[rnd.choice(pool[:6]) + str(rnd.randrange(9)) for _ in range(rnd.randrange(2, 30))] for _ in range(5)]
    docs = []
    for n in range(40):
        lines = []
        for _ in range(rnd.randrange(5)):
            run = rnd.choice(runs)
            low = rnd.randrange(len(run))
            lines += rnd.choice([run, run[low:], run[:low], [rnd.choice(pool)], [f"own {n} {rnd.random()}"], ["x"] * rnd.randrange(7)])
        docs.append("\n".join(lines))
    got = sorted(line_dedup.dedup_lines(document_frame(spark, docs), min_lines=min_lines).collect(), key=lambda r: r["doc_id"])
    assert [(r["text"], r["n_lines"], r["n_removed"], r["n_runs"]) for r in got] == brute_lines(docs, min_lines)


def test_ranks_follow_the_order_of_suffixes(spark, tmp_path):
    from duplexa.llm.scratch import Scratch

    rnd = random.Random(4)
    docs = [[f"l{rnd.randrange(3)}" for _ in range(rnd.randrange(40))] for _ in range(12)]
    rows = spark.createDataFrame([(n, 0, "\n".join(d)) for n, d in enumerate(docs)], "id long, key long, text string")
    number = {r["t"]: (r["a"], r["b"]) for r in spark.createDataFrame([(f"l{i}",) for i in range(3)], "t string").selectExpr("t", "xxhash64(t) a", "xxhash64(7, t) b").collect()}
    seen = 0
    for level in line_dedup.suffix_intervals(rows, 2, Scratch(spark, "t")):
        members = [(r["rank"], [number[x] for x in docs[r["id"]][r["k"] : r["k"] + r["depth"]]], r) for r in level.collect()]
        assert all(len(run) == r["depth"] for _, run, r in members)
        assert [run for _, run, _ in sorted(members, key=lambda m: m[0])] == sorted(run for _, run, _ in members)
        groups = {}
        for rank, run, r in members:
            groups.setdefault(tuple(run), []).append((rank, r["copies"], r["id"], r["k"], r["later"]))
        for g in groups.values():
            assert len({m[0] for m in g}) == 1 and all(m[1] == len(g) > 1 for m in g) and sorted(m[2:] for m in g)[0][2] is False and sum(m[4] for m in g) == len(g) - 1
        seen += len(groups)
    assert seen > 20


# Tokens --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(word_bpe())


def test_automaton_equals_the_library(library, texts):
    own = bpe_automaton.tokenizer(word_bpe())
    rnd = random.Random(1)
    labels = [t.replace("</w>", "") for t in own.auto.labels.values()]
    cases = list(texts.values())[:60]
    cases += ["".join(rnd.choice("abinterhs") for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    cases += ["".join(rnd.choice(labels) for _ in range(rnd.randint(1, 3))) for _ in range(3000)]
    cases += ["".join(chr(rnd.choice([rnd.randrange(32, 0x3000), rnd.randrange(0xA0, 0x600), rnd.randrange(0x1F300, 0x1F700)])) for _ in range(12)) for _ in range(500)]
    cases += ["word' word's it's' 's. a's, x'' \"word\". (word) word). word-word word-. WORD!? word_ w'd'"]
    cases += ["İstanbul ΣΑΣ's don't <|endoftext|>x<|startoftext|> 12½ a\x1cb é 中文 😀👍🏽 <| ' ''S", "\x00\x01\x7f", "a" * 500]
    for case in cases:
        ids = library.encode(case, add_special_tokens=False).ids
        assert own.encode(case) == ids, case
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_the_table_begins_anew_and_needs_no_suffix(library, monkeypatch):
    own = bpe_automaton.WordTokenizer(word_bpe())
    words = sorted({p for p in own.presplit("the tokens of these several words, and of some others, are the same before and after")})
    want = [own.auto.encode(w) for w in words]
    monkeypatch.setattr(bpe_automaton, "STATES", 3)
    assert [own.auto.encode(w) for w in words] == want and len(own.auto.states) < 20
    plain = bpe_automaton.TokenAutomaton({"a": 0, "b": 1, "ab": 2, "abab": 3, "ba": 4}, [("a", "b"), ("ab", "ab"), ("b", "a")], "")
    assert [plain.encode(w) for w in ("abab", "ababa", "bab", "ba", "bba")] == [[3], [3, 0], [1, 2], [4], [1, 4]]


@tables
def test_encoding_query(spark, texts, library):
    for r in queries.op6_bpe_encode_decode(spark, FOLDER).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@tables
def test_packing_holds_every_id_once(spark, texts, library):
    rows = queries.op4_pack_sequences(spark, FOLDER).collect()
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    total = 0
    for doc, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        at = 0
        for r in sorted(by[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 4


def test_hilbert_neighbours_touch():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_new_words_in_lines_equal_the_library(library):
    rnd = random.Random(3)
    cases = ["".join(chr(rnd.choice([32, 46, 44, rnd.randrange(33, 0x250), rnd.randrange(65, 123)])) for _ in range(40)) for _ in range(800)]
    cases += ["".join(chr(rnd.choice([9, 32, 0x85, 0x1C, 0x2003, rnd.randrange(0x3000), rnd.randrange(0x1F300, 0x1F700), rnd.randrange(65, 123)])) for _ in range(30)) for _ in range(300)]
    cases += ["", None, " \n ", "a" * 3000, "İstanbul ΣΑΣ's DON'T Don't <|endoftext|>x<|ENDOFTEXT|> WORDS In UPPER <|startoftext|>", "a/b a-b. ÉTUDE É. ß ÿ Ÿ ŉ ǰ it's' \"word\"'s x'dx can't."]
    ids, stops = packing.encode_all(word_bpe(), pa.array(cases), 1)
    for case, begin, end in zip(cases, [0, *stops], stops):
        assert ids[begin:end].tolist() == [*library.encode(case or "", add_special_tokens=False).ids, 1], case


def test_a_line_that_does_not_part_is_encoded_word_by_word(library, monkeypatch):
    monkeypatch.setattr(packing._Library, "_line", lambda self, lows: [])
    own = packing._Library(word_bpe())
    words = ["notmet", "norme.", "été", "x'd"]
    assert [np.frombuffer(own.encode(words)[w], "<u4").tolist() for w in words] == [library.encode(w, add_special_tokens=False).ids for w in words]


# Grades --------------------------------------------------------------------------


def test_grades_of_held_out_texts(spark):
    rnd = random.Random(5)
    common = [f"word{i}" for i in range(300)]

    def text(grade):
        words = [rnd.choice(common) for _ in range(rnd.randrange(20, 120))]
        if grade == 0:
            words = rnd.choice([[w.upper() + "!!" for w in words], [w for w in words for _ in range(4)], [x for w in words for x in (w, "|")]])
        if grade == 1:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(["vile", "nasty", "awful."])
        return " ".join(words)

    rows = [(i, g := rnd.choice([0, 1, 2, 2, 2]), text(g)) for i in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    grades = spark.createDataFrame([(i, g) for i, g, _ in rows if i < 900], "doc_id long, grade int")
    model = quality_classifier.train(docs, grades, 3, sample_rows=800)
    assert model.rows == 800 and model.thresholds[0] < model.thresholds[1]
    scored = {r["doc_id"]: r for r in quality_classifier.score(docs, model, 2).collect()}
    held = [(g, scored[i]["accepted"], scored[i]["expected_grade"]) for i, g, _ in rows if i >= 900]
    assert np.mean([ok == (g == 2) for g, ok, _ in held]) > 0.97
    means = [np.mean([e for g, _, e in held if g == k]) for k in range(3)]
    assert means[0] < 0.3 and 0.5 < means[1] < 1.6 and means[2] > 1.7


@tables
def test_classifier_keeps_clean_rows(spark):
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [(labels[r["doc_id"]], r["accepted"]) for r in queries.op5_quality_grades(spark, FOLDER).collect() if r["doc_id"] in labels]
    assert np.mean([ok for label, ok in rows if label == (1, 0)]) > 0.97
    assert np.mean([not ok for label, ok in rows if label[0] == 0]) > 0.9


# Licences ------------------------------------------------------------------------


def test_one_licence_in_many_dresses(spark):
    mit = license_scan.LICENSES["MIT"]
    wrapped = re.sub(r"(.{60,70}) ", r"\1\n", mit)
    docs = [
        "Copyright (c) 2024 A. Body\n\n" + mit,
        "(C) 1999 Some One\nAll rights reserved.\n" + wrapped.upper(),
        mit.replace('"AS IS"', "«as is»").replace("sublicense", "sub-licence").replace("NONINFRINGEMENT", "non-infringement"),
        mit + " And more.",
        "text\nReleased under the MIT Licence\nmore\nlicensed under CC BY NC 4.0",
        license_scan.LICENSES["Apache-2.0-notice"].replace("http:", "https:"),
    ]
    rows = sorted(license_scan.scan(document_frame(spark, docs)).collect())
    assert [r["license_id"] for r in rows] == ["MIT", "MIT", "MIT", None, None, "Apache-2.0-notice"]
    assert rows[4]["notices"] == "CC-BY-NC-4.0-notice,MIT-notice" and rows[0]["text_digest"] == rows[1]["text_digest"]
    plan = license_scan.scan(document_frame(spark, docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_published_licence_files_are_known(spark):
    full = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in license_scan.TEXTS.glob("*.txt")}
    mit, bsd = license_scan.LICENSES["MIT"], full["BSD-3-Clause"]
    apache = full["Apache-2.0"]
    cases = {
        "MIT License\n\nCopyright (c) 2024 A. Body\n\n" + mit: "MIT",
        "The MIT License (MIT)\nCopyright Jane Doe\n\n" + re.sub(r"(.{50,70}) ", r"\1\n", mit): "MIT",
        "BSD 3-Clause License\n\nCopyright 2020, Jane Doe\nAll rights reserved.\n" + re.sub(r"(.{50,70}) ", r"\1\n", bsd): "BSD-3-Clause",
        "Copyright Jane Doe\n" + full["BSD-2-Clause"]: "BSD-2-Clause",
        apache.replace("[yyyy] [name of copyright owner]", "2021 Jane Doe"): "Apache-2.0",
        apache[: apache.index("APPENDIX")]: "Apache-2.0",
        full["GPL-3.0"]: "GPL-3.0",
        full["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA", 1): "GPL-2.0",
        full["LGPL-2.1"]: "LGPL-2.1",
        full["MPL-2.0"]: "MPL-2.0",
        "The Unlicense\n" + full["Unlicense"]: "Unlicense",
        full["CC0-1.0"]: "CC0-1.0",
        "MIT License": None,
        "MIT License\n" + mit + "\nAnd more.": None,
        bsd.replace("may be used", "may not be used"): None,
    }
    rows = sorted(license_scan.scan(document_frame(spark, list(cases))).collect())
    assert [r["license_id"] for r in rows] == list(cases.values())
    # The SQL knows the same texts and headers.
    documents = pd.DataFrame({"doc_id": range(len(cases) + 3), "text": [*cases, None, "", "Copyright 2020 Me"]})
    con = duckdb.connect()
    con.register("documents", documents)
    found = con.execute(queries.ORACLE_SQL["op7_license_scan"]).df().astype(object).sort_values("doc_id")
    ours = license_scan.scan(spark.createDataFrame(documents, "doc_id long, text string")).toPandas().sort_values("doc_id")
    plain = lambda f: [tuple(None if pd.isna(v) else v for v in r) for r in f[["doc_id", "text_digest", "license_id", "notices"]].itertuples(index=False)]
    assert plain(found) == plain(ours) and [r[2] for r in plain(found)] == [*cases.values(), None, None, None]


# Vectors -------------------------------------------------------------------------


def planted(seed=7, n=3000, width=24):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    for i in range(0, n, 5):
        rows[i + 1] = rows[i] + rng.normal(size=width) * 0.12
    rows[2::50] = rows[2]
    rows[3::40] = rows[3] + rng.normal(size=(len(rows[3::40]), width)) * 0.16
    return rows


def at_the_threshold(width, pairs, seed=11):
    """Pairs of vectors at cosine 0.951, and nothing else close by on purpose."""
    rng = np.random.default_rng(seed)
    x = embedding_dedup.unit(rng.normal(size=(pairs, width)))
    y = rng.normal(size=(pairs, width))
    y = embedding_dedup.unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    return np.concatenate([x, 0.951 * x + math.sqrt(1 - 0.951**2) * y])


@pytest.mark.parametrize(
    "rows, least",
    [(planted(), 0.99), (at_the_threshold(4, 1500), 1), (at_the_threshold(8, 2000), 1), (at_the_threshold(16, 2000), 0.99), (at_the_threshold(64, 2000), 0.99)],
    ids=["planted", "4", "8", "16", "64"],
)
@pytest.mark.parametrize("exact", [False, True])
def test_vector_links_against_all_pairs(spark, rows, least, exact):
    rows = rows.astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
    found = sorted(embedding_dedup.near_duplicates(frame, cell_rows=100, exact=exact).collect())  # 30 cells and more
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    counts = links.sum(axis=1)
    got = np.array([r["n_links"] for r in found])
    least = 1 if exact else least
    assert (got <= counts).all() and got.sum() >= least * counts.sum()
    a, b = np.nonzero(links)
    nodes, roots = components.forest(a, b)
    want = dict(zip(nodes.tolist(), roots.tolist()))
    assert np.mean([r["component_id"] == want.get(r["vec_id"], r["vec_id"]) for r in found]) >= least


def test_cells_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 60)
    monkeypatch.setattr(embedding_dedup, "VISITORS", 90)
    test_vector_links_against_all_pairs(spark, planted(n=1200), 0.99, True)


def test_top_k_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATE_ROWS", 400)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 7)
    rows = planted(seed=9, n=1500) * 0.3
    rows[100:140] = rows[100]
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    found = topk_search.top_k(frame, frame.where("vec_id % 100 = 0")).collect()
    whole = np.floor(1024 * rows).astype(np.int64)
    for q in range(0, 1500, 100):
        score = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:10]
        assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, score[i]) for i in order]


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 9), st.integers(0, 2**31))
def test_bounds_are_never_below_the_product(width, segments, seed):
    rng = np.random.default_rng(seed)
    a, b = np.floor(1024 * rng.normal(size=(2, 5, width)))
    bound = topk_search.segment_features(a, segments) @ topk_search.segment_features(b, segments).T
    assert (bound >= a @ b.T - 1e-6 * (1 + np.abs(a @ b.T))).all()


def test_large_scores_stay_exact(spark):
    rows = [(0, [3e9, 1.0]), (1, [2.0, 5.0]), (2, [1e300, 0.0]), (3, [-1e300, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in sorted(topk_search.top_k(frame, frame.where("vec_id = 0")).collect(), key=lambda r: r["rank"])]
    assert got == [(2, 2**63 - 1), (1, int(3e9) * 1024 * 2048 + 1024 * 5120), (3, -(2**63))]
