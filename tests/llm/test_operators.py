"""Each operator against a plain-Python version, and its defined cases: nulls, empty and very long texts, repeated
rows, empty tables, further columns with clashing names."""

import collections
import hashlib
import html
import inspect
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import (fingerprints, html_text, minhash, mixing, packing, passages, pii, quality, sharding, shingles,
                         token_files)
from mercato.llm.common import shared_folder
from mercato.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def rows(prose):
    """Odd texts, copies and near copies, a source that holds most rows."""
    base = [prose(i, 40 + 7 * (i % 30)) for i in range(60)]
    near = base[3].replace("the", "teh", 1)
    texts = base + [base[0], base[0], near, None, "", "   ", "one", "one two", "x " * 30_000, "a" * 5_000,
                    "été çà " * 40, "#$% *** " * 80, "LOUD " * 200, prose(99, 20_000), "   　", "🙂 emoji 🙂 " * 30]
    out = [(i, t, "hot" if i % 3 else f"s{i % 7}") for i, t in enumerate(texts)]
    out[5] = (5, out[5][1], None)
    return out + [out[7]]


@pytest.fixture(scope="module")
def docs(make, rows):
    return make(rows)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- words and shingles ----------------------------------------------------------------------------------------

def words_of(t):
    return (t or "").encode().lower().split()


def test_shingle_sets_match_strings(rows):
    for k in (1, 3, 5):
        got = list(shingles.shingle_sets([t for _, t, _ in rows], k, at_once=1000))
        for (_, t, _), s in zip(rows, got):
            w = words_of(t)
            want = set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())
            assert len(s) == len(want)


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    data = ("été b\tc " * 500).encode() + b"z" * 3000 + b" end"
    whole = shingles.word_hashes(data)
    monkeypatch.setattr(shingles, "PIECE", 64)
    cut = shingles.word_hashes(data)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


# -- 1 html ----------------------------------------------------------------------------------------------------

def test_html_article_without_boilerplate():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
    <body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav>
    <div class="cookie-notice">We use cookies and the like.</div><aside>side <p>bar</p></aside>
    <article><h1>Head &amp; tail</h1><p>First &lt;b&gt; para
      with <a href="x">link</a> and&nbsp;more.<p><b>Second<br>line<p>Third &#233; | x ### <!-- hidden <p>x</p> --></p>
    <div class="ad">Buy of the and</div><form><p>Your name</p><input></form><ul><li>item one<li>item two</ul>
    <section id="comments"><p>Nice post, the best of all.</p></section></article>
    <footer>&copy; all</footer></body>"""
    assert html_text.main_text(page)[0] == "\n\n".join([
        "Head & tail", "First <b> para with link and more.", "Second line", "Third é | x ###", "item one", "item two"])


def test_html_without_article_uses_densities(prose):
    long, short = prose(1, 80).replace("\n", " "), "Then it was so."
    links = " ".join(f"<a href='/{i}'>link number {i}</a>" for i in range(20))
    page = (f"<body><div>{links}</div><div><h2>A heading</h2><p>{long}</p><p>{short}</p><p>{long}</p></div>"
            "<div>Imprint</div></body>")
    assert html_text.main_text(page)[0] == "\n\n".join(["A heading", long, short, long])


def test_html_article_is_a_vote(prose):
    long, other = prose(1, 80).replace("\n", " "), prose(2, 80).replace("\n", " ")
    page = f"<div>{long}</div><article><a href=x>A related headline</a></article>"
    assert html_text.main_text(page)[0] == long
    cards = "".join(f"<article><h3><a href='/{i}'>Headline {i}</a></h3><p>Teaser {i}.</p></article>" for i in range(4))
    assert html_text.main_text(f"<div><p>{long}</p><p>{other}</p></div><div>Imprint</div>{cards}")[0] == f"{long}\n\n{other}"
    assert html_text.main_text(f"<main><p>{long}</p>{cards}</main>")[0] == long
    assert html_text.main_text(f"<article><p>{long}</p></article><div>{other}</div>")[0] == f"{long}\n\n{other}"


@pytest.mark.parametrize("opening", [
    '<main class="content has-sidebar">', '<article id="privacy-law-2020">', '<article class="story share-price-news">',
    '<div class="layout with-sidebar">', '<div class="page no-header">', '<form id="aspnetForm">', '<nav><a href="/">x</a><article>',
    '<div class="layout_without_sidebar">', '<main class="search">', '<div id="legal-advice-column">'])
def test_html_marks_are_a_vote(prose, opening):
    long, other = prose(1, 90).replace("\n", " "), prose(2, 90).replace("\n", " ")
    page = f"<body><div class='ad'>Buy of the and</div>{opening}<p>{long}</p><p>{other}</p>"
    assert html_text.main_text(page)[0] == f"{long}\n\n{other}"


@pytest.mark.parametrize("name", ["sidebar-left", "cookie-banner", "comment-list", "share-buttons", "page-header", "newsletter_box", "comments"])
def test_html_doubtful_names_beside_an_article(prose, name):
    long, notice = prose(1, 90).replace("\n", " "), prose(2, 60).replace("\n", " ")
    for page in (f"<article><p>{long}</p></article><div class='{name}'><p>{notice}</p></div>",
                 f"<div class='{name}'><p>{notice}</p></div><div><p>{long}</p></div>", f"<form><p>{notice}</p></form><div><p>{long}</p></div>"):
        assert html_text.main_text(page)[0] == long


def test_html_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "c"), (2, "u", "", "c"), (3, None, "<p", "c"), (4, "u", "<article><p>x<p>y", "c"),
         (5, "u", "<article>" + "<div>" * 3000 + "deep", "c"), (6, "u", "<article><p title=\"a>b\">q & r &amp;amp; <3</p>", "c"),
         (6, "u", "<script>never closed", "c")], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_main_text(pages).collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "", 0), (4, "x\n\ny", 4), (5, "deep", 4), (6, "", 0), (6, "q & r &amp; <3", 14)]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_html_on_generated_pages(prose):
    r = random.Random(3)
    for i in range(30):
        paragraphs = [prose(i * 10 + j, r.randint(1, 60)).replace("\n", " ") + " <&>" for j in range(r.randint(1, 6))]
        body = "".join(f"<p>{html.escape(p)}</p>" if r.random() < 0.7 else f"<p><b>{html.escape(p)}<br>" for p in paragraphs)
        page = f"<nav><a href='/'>home</a></nav><div class='ad'>x</div><article>{body}</article><footer>f</footer>"
        assert html_text.main_text(page)[0] == "\n\n".join(paragraphs)


# -- 2 near-duplicates ------------------------------------------------------------------------------------------

def brute_groups(rows, k, percent):
    ids = sorted({i for i, _, _ in rows})
    sets = collections.defaultdict(list)
    for i, t, _ in rows:
        w = words_of(t)
        s = set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())
        sets[i].append(s)
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        for s in sets[a]:
            for t in sets[b]:
                both = len(s & t)
                if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_minhash_ids_with_several_texts(make, prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (7, b, "s"), (8, c, "s"), (9, None, "s"), (9, c, "s"), (None, a, "s"), (4, "", "s"), (4, b, "s")]
    docs = make(rows)
    got = {(r["doc_id"], r["n_shingles"] > 0): (r["component_id"], r["kept"]) for r in minhash.groups(docs).collect()}
    want = brute_groups([r for r in rows if r[0] is not None], 5, 80)
    for (i, _), (component, kept) in got.items():
        assert i is None and component is None and kept or (component, kept) == (want[i], i == want[i])
    assert want[5] == want[7] == want[4] == 3 and want[9] == 8
    kept = sorted(map(repr, ((r["doc_id"], r["text"]) for r in minhash.keep_one(docs).collect())))
    assert kept == sorted(map(repr, [(3, a), (4, b), (4, ""), (8, c), (9, None), (None, a)]))
    assert minhash.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("k,percent,bands,per", [(3, 85, 32, 5), (5, 80, 40, 5)])
def test_minhash_groups(docs, rows, k, percent, bands, per):
    want = brute_groups(rows, k, percent)
    got = minhash.groups(docs, k=k, percent=percent, bands=bands, rows=per).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])


def test_minhash_block_comparison(make, prose, monkeypatch):
    """Many texts that are similar, few of them enough: blocks and pairs give the same groups as all pairs."""
    core, r = prose(5, 120).split(" "), random.Random(8)
    rows = []
    for i in range(90):
        w = list(core)
        for j in r.sample(range(len(w)), r.randint(0, 9)):
            w[j] = f"w{r.randint(0, 40)}"
        rows.append((i, " ".join(w), "s"))
    want = brute_groups(rows, 3, 85)
    for many in (0, 10**9):
        monkeypatch.setattr(minhash, "MANY_PAIRS", many)
        monkeypatch.setattr(minhash, "BLOCK", 16)
        got = by_id(minhash.groups(make(rows), k=3, percent=85, bands=32, rows=5))
        assert {i: x["component_id"] for i, x in got.items()} == want


def test_minhash_null_ids_and_empty_table(make, prose):
    t = prose(1, 60)
    d = make([(None, t, "s"), (4, t, "s"), (2, t, "s"), (9, None, "s")])
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.groups(d).collect())
    n = got[0][1]
    assert got == sorted([("None", n, None, True), ("4", n, 2, False), ("2", n, 2, True), ("9", 0, 9, True)])
    assert sorted(str(r["doc_id"]) for r in minhash.keep_one(d).collect()) == ["2", "9", "None"]
    assert minhash.groups(d.limit(0)).count() == 0


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, c long")
    got = {r["id"]: r["component"] for r in minhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# -- 3 fingerprints ---------------------------------------------------------------------------------------------

def test_fingerprints(make, rows):
    once = list({i: (i, t, s) for i, t, s in rows}.values())
    got = by_id(fingerprints.compare_edited(make(once)))
    order = sorted(once, reverse=True)
    for j, (i, t, _) in enumerate(order):
        t, n = t or "", order[(j + 1) % len(order)][1] or ""
        k = len(t) // 2
        e = t[: len(t) - k] + n[:k]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and (t != e or got[i]["near_edited"] == 1)
    prints = collections.defaultdict(set)
    for i, t, _ in once:
        prints[t or ""].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_fingerprint_likeness_is_unbiased(make, prose):
    a, b = prose(1, 6000), prose(2, 6000)
    mixed = " ".join(a.split(" ")[:3000] + b.split(" ")[:3000])
    s = by_id(fingerprints.fingerprint(make([(0, a, "s"), (1, mixed, "s")]), scale=4))
    x, y = set(s[0]["_sketch"]), set(s[1]["_sketch"])
    assert abs(len(x & y) / len(x | y) - 1 / 3) < 0.05 and abs(len(x) / 6000 - 1 / 4) < 0.03


def test_fingerprint_merge_and_repeats(make, rows):
    d = fingerprints.fingerprint(make(rows))
    merged = {r["source"]: r["sketch"] for r in fingerprints.merge(d, "source", "_sketch").collect()}
    want = collections.defaultdict(set)
    for r in d.collect():
        want[r["source"]] |= set(r["_sketch"])
    assert {k: sorted(v) for k, v in want.items() if v} == merged
    assert fingerprints.compare_edited(make(rows)).count() == len(rows)
    assert fingerprints.compare_edited(make([(None, "a", "s"), (None, None, "s")])).count() == 2
    assert fingerprints.compare_edited(make(rows).limit(0)).count() == 0


# -- 4 passages -------------------------------------------------------------------------------------------------

def test_compact_windows_cover_every_passage():
    r = np.random.default_rng(1)
    for n in (1, 5, 46, 47, 300):
        v = r.integers(0, 60, n).astype(np.uint64)
        for width in (5, 46):
            found = passages.compact_windows(v, width)
            for x in range(n):
                for y in range(x + width - 1, n):
                    c = x + int(np.argmin(v[x : y + 1]))
                    assert sum(1 for l, m, h in found.tolist() if l <= x <= m <= y <= h and m == c) == 1


def test_repeated_passages(make, prose):
    planted, near = prose(500, 70), prose(501, 90)
    varied = near.split(" ")
    varied[40] = "changed"
    rows = [(i, prose(i, 120), "s") for i in range(40)]
    for i in (3, 11, 29):
        rows[i] = (i, rows[i][1] + " " + planted + " " + prose(900 + i, 50), "s")
    rows[17] = (17, near + " " + rows[17][1], "s")
    rows[20] = (20, rows[20][1] + "\n" + " ".join(varied), "s")
    rows += [(50, rows[5][1], "s"), (51, None, "s"), (52, "", "s"), (None, rows[5][1], "s"), (53, "one two", "s")]
    got = passages.repeated_passages(make(rows)).collect()
    pairs = {(r["doc_id"], r["other_id"]) for r in got}
    assert {(11, 3), (29, 3), (20, 17), (50, 5)} <= pairs <= {(11, 3), (29, 3), (29, 11), (20, 17), (50, 5)}
    text = {i: words_of(t) for i, t, _ in rows if i is not None}
    for r in got:
        a = text[r["doc_id"]][r["start_word"] : r["start_word"] + r["n_words"]]
        b = text[r["other_id"]][r["other_start"] : r["other_start"] + r["other_words"]]
        assert min(len(a), len(b)) >= 50 and (r["similarity"] < 1 or a == b)
    assert passages.repeated_passages(make(rows).limit(0)).count() == 0


@pytest.mark.parametrize("many", [0, 10**9])
def test_repeated_passages_behind_unlike_members(make, prose, monkeypatch, many):
    """A very common line stands in texts that share nothing else; pairs of later texts share a passage around it:
    none is lost behind the smaller ids."""
    monkeypatch.setattr(passages, "MANY_PAIRS", many, raising=False)
    line = prose(700, 44).replace("\n", " ")
    rows = [(i, prose(i, 60) + "\n" + line + "\n" + prose(100 + i, 60), "s") for i in range(8)]
    want = set()
    for i in range(20, 40, 4):
        passage = prose(700 + i, 3) + "\n" + line + "\n" + prose(800 + i, 3)
        tail = prose(900 + i, 70)
        rows += [(i, prose(i, 60) + "\n" + passage + "\n" + prose(200 + i, 60), "s"),
                 (i + 1, prose(300 + i, 60) + "\n" + passage + "\n" + prose(400 + i, 60) + "\n" + tail, "s"),
                 (i + 2, prose(500 + i, 30) + "\n" + tail, "s")]
        want |= {(i + 1, i), (i + 2, i + 1)}
    assert {(r["doc_id"], r["other_id"]) for r in passages.repeated_passages(make(rows)).collect()} == want


def test_passage_bands_find_near_equal_windows():
    """Passages of 50 words with one word changed: brute force finds each alike, so each needs a key in common."""
    own = inspect.signature(passages.repeated_passages).parameters
    seeds = np.random.default_rng(41).integers(1, 2**63, (own["bands"].default, own["rows"].default), dtype=np.uint64)
    r, missed = np.random.default_rng(5), 0
    for _ in range(300):
        a = r.integers(1, 2**63, 50, dtype=np.uint64)
        b = a.copy()
        b[r.integers(5, 45)] = r.integers(1, 2**63)
        assert passages.common_passages(a, b, 5, 50, 80)
        x, y = (passages.window_keys(shingles.chain(w, 5), seeds, 46)[0] for w in (a, b))
        missed += not len(np.intersect1d(x, y))
    assert missed == 0


def test_window_keys_of_several_texts(prose):
    seeds = np.random.default_rng(41).integers(1, 2**63, (3, 2), dtype=np.uint64)
    texts = [prose(1, 60), "one two", prose(2, 9000), "a b c " * 60, "x " * 300, prose(1, 60)]
    each = [shingles.chain(shingles.batch_words([t])[0], 5) if len(t) > 10 else np.empty(0, np.uint64) for t in texts]
    cut = np.concatenate(([0], np.cumsum([len(x) for x in each])))
    key, part, lo, hi = passages.window_keys(np.concatenate(each), seeds, 46, cut)
    text = np.searchsorted(cut, lo, "right") - 1
    for i, x in enumerate(each):
        own = text == i
        got = zip(key[own], part[own], lo[own] - cut[i], hi[own] - cut[i])
        assert sorted(got) == sorted(zip(*passages.window_keys(x, seeds, 46)))


def test_passage_keys_only_where_texts_share(make, prose, monkeypatch):
    """Keys are written for windows around what two texts share, also a passage with words changed, not for all text."""
    written, write = [], passages.saved

    def counted(df, name):
        out = write(df, name)
        if "part" in df.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(passages, "saved", counted)
    passage = prose(600, 54).split()
    varied = [w for w in passage]
    varied[27] = "the the"
    rows = [(i, prose(i, 600), "s") for i in range(30)]
    rows += [(40, prose(40, 300) + " " + " ".join(passage), "s"), (41, " ".join(varied) + " " + prose(41, 300), "s"),
             (42, rows[7][1].replace(" ", "  "), "s"), (43, rows[7][1], "s")]
    got = passages.repeated_passages(make(rows)).collect()
    assert {(r["doc_id"], r["other_id"], r["n_words"]) for r in got if r["doc_id"] > 41} == {(42, 7, 600), (43, 7, 600)}
    assert {(r["doc_id"], r["other_id"]) for r in got if r["doc_id"] < 42} == {(41, 40)}
    assert written and sum(written) < 2000, written


def test_passage_windows_go_on_among_three_texts(make, prose, monkeypatch):
    """Two texts of a key are compared once, so nothing of their windows is written on; of three unlike ones it is."""
    after, write = [], passages.saved

    def counted(df, name):
        out = write(df, name)
        if "state" in df.columns:
            after.append(out.filter(out["state"] != passages.PASSAGE).count())
        return out

    monkeypatch.setattr(passages, "saved", counted)
    shared = prose(1, 400)
    rows = [(1, prose(2, 90) + " " + shared, "s"), (2, shared + " " + prose(3, 90), "s")]
    assert {(r["doc_id"], r["other_id"]) for r in passages.repeated_passages(make(rows)).collect()} == {(2, 1)}
    assert sum(after) == 0, after
    line = prose(4, 44)
    rows = [(i, prose(10 + i, 3) + " " + line + " " + prose(20 + i, 3), "s") for i in range(3)]
    passages.repeated_passages(make(rows)).collect()
    assert sum(after) > 0


def test_passage_windows_after_a_comparison():
    """A window goes on once under each key, however many passages begin or end beside the same shingle."""
    shingles_of = np.array([7, 8, 7, 9, 9, 7, 8, 7, 9, 9] * 10, np.uint64)
    key, lo, hi = np.array([5, 6, 7], np.int64), np.array([0, 30, 90], np.int32), np.array([60, 40, 99], np.int32)
    found = [(s, 24, 0, 24, 1.0) for s in (10, 15, 20, 25, 25)]
    got = list(zip(*(c.tolist() for c in passages._after(found, shingles_of, 5, key, lo, hi))))
    assert len(got) == len(set(got))
    assert {x[0] for x in got if x[1:] == (6, 30, 40)} == {passages.SETTLED}
    assert {x[0] for x in got if x[1:] == (7, 90, 99)} == {passages.UNLIKE}
    want = {(1, int(shingles_of[s - 1])) for s in (10, 15, 20, 25)} | {(2, int(shingles_of[s + 20])) for s in (10, 15, 20, 25)}
    assert sum(x[0] == passages.PARTLY and x[2:] == (0, 60) for x in got) == len(want)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_equal_passages_share_a_run(edits):
    """Passages that brute force finds alike have ``shared_run`` equal shingles in a row."""
    r, n, seen = np.random.default_rng(edits), passages.shared_run(46, 80), 0
    for _ in range(400):
        a = r.integers(1, 2**63, r.integers(50, 60 * edits), dtype=np.uint64).tolist()
        b = list(a)
        for at in sorted(r.integers(0, len(a), edits).tolist(), reverse=True):
            b[at : at + r.integers(0, 2)] = [[], [b[at]] * 2, [7]][r.integers(0, 3)]
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        if passages.common_passages(a, b, 5, 50, 80):
            seen += 1
            x, y = (shingles.chain(shingles.chain(w, 5), n) for w in (a, b))
            assert len(np.intersect1d(x, y))
    assert seen > 50


def test_common_passages_merges_runs():
    def shared(a, b):
        return passages.common_passages(*(shingles.batch_words([" ".join(w)])[0] for w in (a, b)), 5, 50, 80)

    w = [f"w{i}" for i in range(400)]
    put = w[:49] + [f"x{i}" for i in range(6)] + w[49:98]
    assert shared(w[:98], put) == [(0, 98, 0, 104, 90 / 104)]
    two = w[:45] + ["x"] + w[46:50] + ["y"] + w[51:100]
    assert shared(w[:100], two) == [(0, 100, 0, 100, 86 / 106)]
    # a near passage inside a loose run: every 45th word of 0..134 changed, then every 6th
    loose = [f"x{i}" if i % 45 == 40 and i < 135 or i % 6 == 0 and i >= 135 else x for i, x in enumerate(w)]
    assert any(s == 0 and n >= 120 and j >= 0.8 for s, n, _, _, j in shared(w, loose))
    # a passage of words that repeat, beside an ordinary one
    flat = ["a", "b"] * 40
    got = shared(w[:60] + ["p"] + flat, flat + ["q"] + w[:60])
    assert {(s, n) for s, n, _, _, _ in got} >= {(0, 60)} and any(s >= 61 and n >= 50 for s, n, _, _, _ in got)
    # swapped passages are two chains
    assert {x[:4] for x in shared(w[:60] + w[100:160], w[100:160] + w[:60])} == {(0, 60, 60, 60), (60, 60, 0, 60)}


# -- 5 mixing ---------------------------------------------------------------------------------------------------

def fill(sizes, weights, cap):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in fixed)
        rest = sum(w[s] for s in names if s not in fixed)
        goal = {s: cap * sizes[s] if s in fixed else (left * w[s] / rest) for s in names}
        over = {s for s in names if goal[s] > cap * sizes[s] + 1e-9} - fixed
        if not over:
            return goal
        fixed |= over


def test_mixing(docs, rows):
    got = mixing.with_copies(docs).select("doc_id", "source", "_mix.*").collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    goal = fill(sizes, mixing.WEIGHTS, mixing.CAP)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
    again = mixing.with_copies(docs.repartition(7)).select("doc_id", "_mix.taken").collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)


def test_mixing_comes_near_targets(make, prose):
    rows = [(i, prose(i, 20 + i % 50), "ab"[i % 10 == 0]) for i in range(400)]
    got = mixing.with_copies(make(rows)).select("source", "_mix.*").collect()
    for s in "ab":
        taken = sum(r["taken"] for r in got if r["source"] == s)
        target = next(r["target"] for r in got if r["source"] == s)
        assert abs(taken - target) < 0.01 * target
    assert mixing.with_copies(make(rows).limit(0)).count() == 0
    assert [r["_mix"]["taken"] for r in mixing.with_copies(make([(None, None, None)])).collect()] == [0]


# -- 6 quality --------------------------------------------------------------------------------------------------

def test_quality_counts(docs, rows):
    got = quality.verdicts(docs).select("doc_id", "_quality.*").collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        t = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        places = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(places))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(places) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_quality_keeps_prose_and_rejects_junk(make, prose):
    rows = [(i, prose(i, 60 + i), "s") for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in prose(i, 80).split()), "s") for i in range(5)]
    rows += [(300 + i, prose(i, 80).upper().replace(" ", "!! "), "s") for i in range(5)]
    rows += [(400, "word " * 100, "s"), (401, None, "s")]
    kept = {r["doc_id"] for r in quality.keep_good(make(rows)).collect()}
    assert kept == set(range(120))
    assert quality.keep_good(make(rows)).columns == make(rows).columns
    assert quality.verdicts(make(rows).limit(0)).count() == 0


# -- 7 packing, 8 token files -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encode():
    e = Encoder(default_path())
    return lambda t: e.encode([t])[0] if t else b""


def test_encoder_matches_library(rows, encode):
    r = random.Random(1)
    texts = [t for _, t, _ in rows] + [
        "".join(r.choice("ab' st\n\t1²½éßĿ_-–’…·×÷€ .,日🙂  ") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    e = Encoder(default_path())
    e.REMEMBERED = 500
    assert list(e.batch(texts)) == [encode(t) for t in texts]


def test_packing(docs, rows, encode):
    got = packing.pack(docs, group=25).collect()
    at = collections.defaultdict(list)
    for r in got:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in at.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= packing.CAPACITY
    want = collections.Counter()
    for i, t, _ in rows:
        ids = encode(t) + bytes(4)
        n, start, piece = len(ids) // 4, 0, 0
        size = (n - 1) % 2048 + 1
        while start < n:
            want[i, piece, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)])] += 1
            start, size, piece = start + size, 2048, piece + 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    bound = packing.lower_bound(np.array([r["length"] for r in got]), 2048)
    assert bound <= len(at) <= bound + 2
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_null_and_large_ids(make, prose):
    rows = [((1 << 60) + 1, prose(1, 50), "s"), (None, prose(2, 50), "s"), ((1 << 60) + 3, prose(3, 50), "s"), (None, None, "s")]
    got = packing.pack(make(rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [
        (False, (1 << 60) + 1), (False, (1 << 60) + 3), (True, 0), (True, 0)]
    assert len({r["sequence_id"] for r in got}) == 1 and sum(r["length"] for r in got) == max(r["offset"] + r["length"] for r in got)


def test_packing_bound_and_best_fit():
    r = np.random.default_rng(4)
    for _ in range(40):
        lengths = r.integers(1, 101, r.integers(1, 8))
        bins, offsets, fills = packing.best_fit_decreasing(lengths, 100)
        assert fills.max() <= 100 and all(fills[b] >= o + n for b, o, n in zip(bins, offsets, lengths))

        def fits(i, free):
            if i == len(lengths):
                return True
            return any(fits(i + 1, tuple(sorted(free[:j] + (f - lengths[i],) + free[j + 1 :])))
                       for j, f in enumerate(free) if f >= lengths[i] and (j == 0 or f != free[j - 1]))

        best = next(n for n in range(1, 10) if fits(0, (100,) * n))
        assert packing.lower_bound(lengths, 100) <= best <= len(fills)


def test_packing_rounds_exchange(make, prose):
    rows = [(i, prose(i, 150 + 37 * i % 400), "s") for i in range(61)]
    one = {r["sequence_id"] for r in packing.pack(make(rows), group=3, rounds=0).collect()}
    more = {r["sequence_id"] for r in packing.pack(make(rows), group=3, rounds=4).collect()}
    assert len(more) < len(one)


def test_token_files(spark, docs, rows, encode):
    folder = shared_folder(spark, "test-ids")
    token_files.write_ids(docs, folder, files=4)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(spark, folder).collect())
    start, want = 0, []
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = encode(t) + (2).to_bytes(4, "little")
        want.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == want
    one = token_files.read_ids(spark, folder).filter("doc_id = 7")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().toString()
    assert all(list(r["ids"]) == np.frombuffer(encode(dict((i, t) for i, t, _ in rows)[7]) + (2).to_bytes(4, "little"), "<u4").tolist()
               for r in one.collect())
    empty = shared_folder(spark, "test-ids")
    token_files.write_ids(docs.limit(0), empty, files=2)
    assert token_files.digests(spark, empty).count() == 0


# -- 9 personal data --------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_spans(make):
    r = random.Random(2)
    bits = ["a.b@x.org", "a@b", "a@b.com_x@y.org", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.02.3.255", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "41111111111111110", "+1 (212) 555-0100", "+12", "+1 2 3", "+49 30 1234567 89", "🙂", "é", " ", "\n",
            "..", "-", "@", "+", "x", "7", "7 7 7", "12 34 56 78 90 12 34 56"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "9" * 20_000, "1 " * 20_000, "a" * 50_000, "a" * 50_000 + "@", "+" + "1 " * 9_000, "1." * 9_000]
    got = by_id(pii.digests(make([(i, t, "s") for i, t in enumerate(texts)])))
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        n = collections.Counter(k for k, _, _ in want)
        assert tuple(got[i][f"n_{k}"] for k in PATTERNS) == tuple(n[k] for k in PATTERNS), t[:200]
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest(), t[:200]
        assert got[i]["spans"].startswith(said)


def test_pii_hints_are_necessary(make):
    """Whatever a kind's pattern finds, its hint finds too (a card: of 16 digits or more, others are not valid)."""
    r = random.Random(4)
    texts = ["pwd: ABCD-EFGH-12345678", "token = live_20240131_99"]
    for letters in ("aB1_-/+ ", "12-() .+", "a1.@b- ", "0 1-2"):
        texts += ["".join(r.choice(letters) for _ in range(r.randint(12, 40))) for _ in range(150)]
    df = make([(i, t, "s") for i, t in enumerate(texts)])
    for kind, pattern in (pii.PATTERNS | {"card": r"[0-9](?:[\x20-]?[0-9]){15}"}).items():
        assert df.filter(F.col("text").rlike(pattern) & ~F.col("text").rlike(pii.HINTS[kind])).count() == 0, kind
    got = df.filter("doc_id < 2").orderBy("doc_id").select(F.size(pii.spans(F.col("text"), "secret")).alias("n")).collect()
    assert [x["n"] for x in got] == [1, 1]


def test_pii_adds_secrets_and_leaves_prose(make, prose):
    r = random.Random(5)
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    rows, secrets = [(i, prose(i, 50) + " Version 2.0. chapter12345678 extraordinarily", "s") for i in range(40)], {}
    for i in range(40, 70):
        s = ["password=" + hexa(18), 'token = "' + hexa(40) + '"', "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16))][i % 3]
        value = re.search(r"[0-9A-Za-z]{18,}", s).group()
        rows.append((i, prose(i, 10) + " " + s + " and so on", "s"))
        secrets[i] = value
    got = by_id(pii.digests(make(rows)))
    text = {i: t for i, t, _ in rows}
    for i in text:
        found = [text[i][int(s):int(e)] for k, s, e in (x.split(":") for x in got[i]["spans"].split(",") if x)]
        assert found == ([secrets[i]] if i in secrets else [])
    cleaned = by_id(pii.redact(make(rows)))
    assert all(secrets[i] not in cleaned[i]["text"] and "[SECRET]" in cleaned[i]["text"] for i in secrets)
    assert all(cleaned[i]["text"] == text[i] for i in text if i not in secrets)


def test_pii_redacts_and_handles_odd_tables(make):
    d = make([(1, "mail a@b.org or +1 (212) 555-0100.", "s"), (2, None, "s"), (3, "", "s"), (3, "", "s")])
    got = sorted((r["doc_id"], r["text"] or "-") for r in pii.redact(d).collect())
    assert got == [(1, "mail [EMAIL] or [PHONE]."), (2, "-"), (3, "-"), (3, "-")]
    assert pii.redact(d).columns == d.columns and pii.digests(d.limit(0)).count() == 0


# -- 10 sharding ------------------------------------------------------------------------------------------------

def test_sharding(spark, make, docs, rows):
    folder = shared_folder(spark, "test-shards")
    sharding.write_shards(docs, folder, shards=8, bucket_bytes=20_000)
    got = sharding.digests(docs, folder).collect()
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(slots[s]) == list(range(len(slots[s]))) for s in range(8))
    again = shared_folder(spark, "test-shards")
    sharding.write_shards(docs.repartition(5), again, shards=8, bucket_bytes=20_000)
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, sharding.digests(docs, again).collect()))
    none = shared_folder(spark, "test-shards")
    sharding.write_shards(docs.limit(0), none)
    assert sharding.digests(docs, none).count() == 0
    few = shared_folder(spark, "test-shards")
    sharding.write_shards(make(rows[:3]), few)
    assert sorted(r["slot"] for r in sharding.digests(docs, few).collect()) == [0, 0, 0]


# -- null ids ---------------------------------------------------------------------------------------------------

def test_null_ids_of_fingerprints_token_files_and_shards(spark, make, prose, encode):
    a, b = prose(1, 80), prose(2, 30)
    rows = [(None, a, "s"), (5, b, "s"), (None, None, "s"), (2, "", "s")]
    docs = make(rows)
    folder = shared_folder(spark, "test-ids")
    token_files.write_ids(docs, folder, files=2)
    start = 0
    for r in sorted(token_files.digests(spark, folder).collect(), key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    want = sorted((repr(i), zlib.crc32(encode(t) + (2).to_bytes(4, "little"))) for i, t, _ in rows)
    got = token_files.digests(spark, folder).collect()
    assert sorted((repr(r["doc_id"]), r["ids_crc32"]) for r in got) == want
    assert {r["doc_id"] for r in got if r["start"] < sum(x["n_tokens"] for x in got if x["doc_id"] is None)} == {None}
    folder = shared_folder(spark, "test-shards")
    sharding.write_shards(docs, folder)
    assert sorted((repr(r["doc_id"]), r["text_crc32"]) for r in sharding.digests(docs, folder).collect()) == sorted(
        (repr(i), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    got = fingerprints.compare_edited(docs).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"]) for r in got) == sorted((repr(i), len(t or "")) for i, t, _ in rows)
    assert fingerprints.compare_edited(docs.limit(0)).count() == 0
