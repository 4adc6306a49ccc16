"""Decontamination, chat formatting, language ID, toxicity, extraction, cosine links."""

import math
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from decisionops.llm import chat, covertree, decontaminate, html, langid, toxicity
from decisionops.llm.common import stored
from decisionops.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, EXTRA

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op2_decontaminate", "op9_chat"])
def test_oracle(spark, duck, name):
    query, sql = QUERIES[name]
    df = query(spark, SF_SMALL)
    rel = duck.execute(sql)
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(map(str, r)) for r in rel.fetchall())
    assert Counter(tuple(map(str, r)) for r in df.select(cols).collect()) == want and want


def test_contaminated_documents(spark, docs, no_docs):
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "one"), (3, None), (4, ""), (5, " ".join(words)),
                                   (6, "five words are one shingle")], "item_id long, text string")
    long = " ".join(f"x{i}" for i in range(20_000))
    own = spark.createDataFrame([
        (101, long + " " + " ".join(words).upper() + ", " + long),               # inside a long text
        (102, " ".join(words[:33])), (103, " ".join(words[:32])),                # 29 of 36 shingles; 28 of 36
        (104, "five, words... ARE one-shingle!"), (104, "five, words... ARE one-shingle!")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contaminated_pairs(
        docs.select("doc_id", "text", *EXTRA).unionByName(own, allowMissingColumns=True), items).collect()}
    assert got == {(101, 1): 1.0, (101, 5): 1.0, (102, 1): 29 / 36, (102, 5): 29 / 36, (104, 6): 1.0, (4, 2): 1.0}
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in DOCS if i != 4)
    assert decontaminate.contaminated_pairs(no_docs, items).count() == 0
    assert decontaminate.contaminated_pairs(docs, items.where("false")).count() == 0


def test_clean_texts_of_a_contaminated_id_stay(spark):
    item = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, "a clean text"), (None, None), (3, "see " + item), (3, "clean"), (3, "clean"), (4, "more")]
    clean = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), items)
    want = [(None, "a clean text"), (None, None), (3, "clean"), (3, "clean"), (4, "more")]
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(want)


def test_chat_snapshots(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (3, 0, "user", "a"), (3, 1, "bot", "c"),
            (4, 0, "user", "a"), (4, 1, "bot", "c"), (5, 0, "user", "ab"), (6, None, None, None), (7, 0, "user", ""),
            (7, 1, "bot", "x"), (7, 1, "bot", "x"), (None, 0, "user", "z"), (8, 5, "user", "a")]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("h", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_copies, r.rendered) for r in chat.format_chats(log).collect()}
    # 1 and 8 prefix 2, 3 and 4; 3 and 4 are equal; 6 is one empty turn without a role
    assert set(got) == {2, 3, 5, 6, 7, None}
    assert got[3][:2] == (2, 2) and got[7][0] == 2
    assert got[2][2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nb<|im_end|>\n"
    assert chat.format_chats(log.where("false")).count() == 0


def test_chat_rows_without_an_id(spark):
    """Each is a conversation of one turn: it can be a copy or a snapshot, and none is put together with another."""
    rows = [(None, 0, "user", "z"), (None, 0, "user", "z"), (None, 1, "bot", "y"), (None, None, "bot", "y"),
            (4, 0, "user", "z"), (5, 0, "user", "q"), (5, 1, "bot", "r"), (None, 3, "user", "q")]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Counter((r.conv_id, r.n_turns, r.n_copies, r.rendered.count("<|im_start|>"))
                  for r in chat.format_chats(log).collect())
    assert got == Counter([(4, 1, 3, 1), (None, 1, 2, 1), (5, 2, 1, 2)])


def test_chat_of_very_many_turns(spark):
    """Work is linear in the turns of a conversation."""
    n = 200_000
    log = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.lit("user").alias("role"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"))
    log = log.union(log.where(f"turn < {n // 2}").withColumn("conv_id", F.lit(2).cast("long")))
    began = time.time()
    got = chat.format_chats(log).select("conv_id", "n_turns", "n_copies", "n_chars").collect()
    assert [tuple(r) for r in got] == [(1, n, 1, n * (len("<|im_start|>user\nt0<|im_end|>\n")))]
    assert time.time() - began < 60


def test_language_id(spark, no_docs, docs):
    rows = QUERIES["op3_langid"][0](spark, MEDIUM).collect()
    lang = dict(duckdb.connect().execute(f"select doc_id, lang from '{MEDIUM}/documents.parquet'").fetchall())
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 150
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.96
    assert sum(r.rejected for r in rows) < 20 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].rejected
    assert langid.identify(no_docs).count() == 0 and langid.keep_identified(no_docs).columns == no_docs.columns
    untrained = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}


def test_toxicity(spark, docs, no_docs):
    rows = QUERIES["op1_toxicity"][0](spark, MEDIUM).collect()
    toxic = dict(duckdb.connect().execute(f"select doc_id, toxic from '{MEDIUM}/labels.parquet'").fetchall())
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    clean = [p for y, p in held if not y]
    assert sum(clean) <= 0.02 * len(clean)
    bad = [p for y, p in held if y]
    assert sum(bad) >= 0.6 * len(bad)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, none).collect()
    assert len(got) == len(DOCS) and {r.score for r in got} == {0.0}
    assert toxicity.score_documents(no_docs, none).count() == 0


def test_toxicity_features():
    score = toxicity.Scorer({"moron": 5.0, "lowei*": 4.0})
    f = dict(zip(toxicity.FEATURES, score("You MORON! loweiß m0r0n, ok")))
    assert f["hits"] == 2 and f["stem_hits"] == 1 and f["disguised_hits"] == 1 and f["near_you"] == 3
    assert len(score(None)) == len(toxicity.FEATURES) and not any(score(""))


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav>Home</nav>
<div class="cookie-notice"><div>We use cookies</div> so there</div><article><h1>Title &amp; more</h1>
<p>First&nbsp;<b>bo</b>ld<br>line</p><form>Email <input></form><p>caf&eacute; &am</p><aside>See also</aside>
<section id="comments"><p>reader says</p></section></article><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    assert html.main_text(PAGE) == "Title & more First bold line café &am"
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("<article><p>short</article>") == "short"
    body = "".join(f"<p>Sentence number {i} of the story goes on for a while here.</p>" for i in range(200))
    plain = html.main_text(f"<ul><li><a href=/>Home</a><li><a href=/b>News</a></ul><div>{body}</div><p class=footer>x</p>")
    assert plain.startswith("Sentence number 0") and plain.endswith("while here.") and "199" in plain and "Home" not in plain
    pages = spark.createDataFrame([(1, "u", PAGE, "k"), (1, "u", PAGE, "k"), (2, None, None, None)],
                                  "page_id long, url string, html string, text string")
    rows = html.extract(pages).collect()
    assert [r.n_chars for r in rows if r.page_id == 1] == [37, 37] and rows[-1].text == ""
    assert html.extract(pages.where("false")).count() == 0


def test_main_text_of_short_blocks():
    menu = "<ul><li><a href=/>Home page of it</a><li><a href=/b>News</a><li><a href=/c>About</a></ul>"
    link = "<p><a href=/x>A paragraph that is a link from end to end</a></p>"
    for size in (12, 25, 42):                        # verse, dialogue: no two blocks reach the threshold
        lines = [f"{i} ".ljust(size - 1, "x") + "." for i in range(100)]
        body = "".join(f"<p>{t}</p>\n" for t in lines)
        assert html.main_text(f"<body>{menu}<div>{body}</div>{menu}</body>") == " ".join(lines)
        note = "A note of the editor. " * 10
        cut = "".join(f"<p>{t}</p>" for t in lines[:50]) + link + "".join(f"<p>{t}</p>" for t in lines[50:])
        got = html.main_text(f"<body>{menu}{cut}<p>{note}</p>{menu}</body>")
        assert all(t in got for t in lines) and got.endswith("editor.") and "Home" not in got
    long = "".join(f"<p>Sentence number {i} of the story goes on for a while here.</p>" for i in range(200))
    got = html.main_text(f"<body>{menu}{long}{link}<p>The end.</p></body>")
    assert got.endswith("The end.")                  # light, after a paragraph without mass
    got = html.main_text(f"<body>{long}{menu}<p>{'Second part. ' * 10}</p>{menu}<p>(c) x</p></body>")
    assert got.endswith("Second part.")              # a region under a quarter of the largest


@pytest.mark.parametrize("kept", [
    '<article class="overflow-hidden"><p>kept</p></article>', '<div class="overflow-hidden"><p>kept</p></div>',
    '<article><p><a href="/hidden-valley">kept</a></p></article>', '<article><p title="hidden gems">kept</p></article>',
    '<div class="content has-sidebar"><p>kept</p></div>', '<div class="post category-search"><p>kept</p></div>',
    '<article><section id="discussion"><p>kept</p></section></article>', '<article><h2 id="related">kept</h2></article>',
    '<article class="post category-search"><h2 class="share">kept</h2></article>', '<main class="search"><p>kept</p></main>',
    '<section id="discussion"><h2>kept</h2></section>', '<div class="page-search" hidden="false"><p>kept</p></div>'])
def test_main_text_with_words_like_marks(kept):
    assert html.main_text(f"<body>{kept}</body>") == "kept"


@pytest.mark.parametrize("gone", [
    "<p hidden>no</p>", '<p HIDDEN="">no</p>', "<div aria-hidden=true>no</div>", '<div style="color:red; display : none">no</div>',
    '<div class="post sidebar">no</div>', "<div class=footer>no</div>", '<div id="comments">no</div>', '<div id="sidebar">no</div>', '<div class="site-footer">no</div>',
    '<div class="comments-area"><article class="comment-body">no</article></div>', '<article class="comment">no</article>',
    '<div role="navigation">no</div>', '<div class="ad-300x250">no</div>', '<div class="cookie_notice">no</div>'])
def test_main_text_without_marked_parts(gone):
    assert html.main_text(f"<body><article><p>kept</p>{gone}</article></body>") == "kept"


RAW_PAGES = [
    "<head><title>T</title><meta x><body><p>kept</p>", "<html><head><title>T</title><style>p {}</style><p>kept</p>",
    '<p>kept <svg viewBox="0 0 1 1"/></p><p>more</p>', '<p>kept</p><math/><p>more</p><svg><text>no</text></svg>',
    "<p>kept</p><svg><path d=1><p>more</p><svg><text>no</text></svg>", "<p>kept</p><iframe src=x> no <p>more</p>",
    "<p>kept</p><style> p {} <p>more</p><style>div {}</style>", "<p>kept</p><video src=x><div>more</div>",
    "<title>T<body><p>kept</p>", "<p>kept</p><select><option>no<p>more</p>", "<p>kept</p><!-- <script> --><p>more</p>"]


@pytest.mark.parametrize("page", RAW_PAGES)
def test_main_text_after_unclosed_raw_elements(page):
    assert html.main_text(page) == ("kept more" if "more" in page else "kept")


@pytest.mark.parametrize("gone", [
    "<script>if (a < b) x = '<p>no</p><svg><style>'</script>", "<style><!-- p {} <svg> </style>", "<title>The <select> tag</title>",
    "<svg><svg><text>no</text></svg><text>no</text></svg>", "<noscript><p>no</p></noscript>", "<template><div>no</div></template>",
    "<object><object><p>no</p></object><p>no</p></object>", "<textarea><p>no</textarea>", "<!-- <p>no</p> -->",
    "<SVG><text>no</text></Svg >"])
def test_main_text_without_raw_elements(gone):
    assert html.main_text(f"<p>kept</p>{gone}<p>more</p>") == "kept more"
    assert html.main_text(f"<p>kept</p><p>more</p><script>no {gone}") == "kept more" or "/script" in gone


@pytest.mark.parametrize("leaf,fanout", [(2500, 64), (40, 4)])
def test_cosine_links(spark, monkeypatch, leaf, fanout):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    monkeypatch.setattr(covertree, "FANOUT", fanout)
    rng = np.random.default_rng(leaf)
    centres = rng.normal(size=(25, 16))
    x = np.concatenate([centres[rng.integers(0, 25, 250)] + 0.35 * rng.normal(size=(250, 16)), rng.normal(size=(60, 16)),
                        np.repeat(rng.normal(size=(1, 16)), 50, 0), 1e-9 * rng.normal(size=(150, 16)) + centres[:1],
                        1e-4 * rng.normal(size=(300, 16)) + centres[1:2]])       # a hot group, counted as a whole
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [
        (900, None, 1), (901, [0.0] * 16, 1), (902, [math.nan] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [], 1),
        (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, [math.inf] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.linked_vectors(df).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(s, root[None, :], len(x)).min(1))
        if (new == root).all():
            break
        root = new
    want = {i: (int(s[i].sum()), int(root[i]), bool(root[i] == i)) for i in range(len(x))}
    want |= {i: (0, i, True) for i in (900, 901, 902, 903, 904, 907)} | {905: (1, 905, True), 906: (1, 905, False)}
    assert got == want
    assert covertree.linked_vectors(df.where("false")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("extra", F.lit(1))
    n = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        docs = stored(out, "test_stage")
        n.append(docs.count())
    assert n == sorted(n, reverse=True) and n[-1] > 0.7 * n[0] and n[2] == n[3]
    assert "pipeline" in E.queries() and set(QUERIES) <= set(E.queries())


def test_pipeline_stages_against_brute_force(spark):
    """Content of every filtering stage on its own input."""
    import re

    import corpus_pipeline
    from tests.llm.test_dedup import brute_fingerprint, brute_repeats, components
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(160)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leak = spark.createDataFrame([(5000, f"before it {items[0][1]} after it", "en", "s", 0), (None, items[1][1], "en", "s", 0),
                                  (5001, None, "en", "s", 0)], docs.schema)
    docs = stored(docs.union(leak), "test_stage")

    def rows(df):
        return Counter((r.doc_id, r.text) for r in df.collect())

    got = stages["simhash_near_dedup"](spark, docs, SF_SMALL)
    have = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in have]
    group = components(range(len(have)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    first = {}
    for k, (i, _) in enumerate(have):
        if i is not None:
            first[group[k]] = min(first.get(group[k], i), i)
    assert rows(got) == Counter((i, t) for k, (i, t) in enumerate(have) if i is None or first[group[k]] == i)
    docs = stored(got, "test_stage")

    got = stages["suffix_array_dedup"](spark, docs, SF_SMALL)
    have = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(got) == Counter((i, None if t is None else x[5].decode("utf-8", "ignore"))
                                for (i, t), x in zip(have, brute_repeats(have)))
    docs = stored(got, "test_stage")

    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    wanted = [shingles(t) for _, t in items]
    bad = [(r.doc_id, r.text) for r in docs.collect()
           if any(w and len(shingles(r.text) & w) >= 0.8 * len(w) - 1e-9 for w in wanted)]
    assert (None, items[1][1]) in bad
    assert rows(stages["benchmark_decontamination"](spark, docs, SF_SMALL)) == rows(docs) - Counter(bad)
    assert rows(stages["language_id"](spark, docs, SF_SMALL)) - rows(docs) == Counter()


def test_pipeline_of_an_empty_table(spark, no_docs):
    import corpus_pipeline
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0, name


@pytest.mark.parametrize("broken", ['<a "', "<svg ", "<a ", '<a "<a >" ', '<a x="', "<p title='", "<style>", '<a <a "x>"'])
def test_html_of_a_long_damaged_page(broken):
    """One forward scan: a megabyte of tags that never end takes seconds."""
    page = "<article><p>Some text here.</p>" + broken * ((1 << 20) // len(broken))
    began = time.time()
    assert html.main_text(page).startswith("Some text here.")
    assert time.time() - began < 10


PARAGRAPHS = ["A first paragraph of the text with enough words to surge over the threshold of the window.",
              "A short one.", "Another paragraph that goes on for a while, as the paragraphs of an article do.",
              "And a last one with some words, which ends the article before the footer of the page begins."]


def _paragraphs():
    return "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("part", [
    '<div class="cookieBanner">We use cookies</div>', '<div class="advertisement-block">Buy now</div>',
    '<div class="ad_slot">Buy now</div>', '<div id="social-share">Share this</div>',
    '<div class="c-promo__item">Subscribe today</div>', '<div class="related-posts"><p>Another page</p></div>'])
def test_html_names_of_boilerplate(part):
    first, second = _paragraphs()[:len(_paragraphs()) // 2].rsplit("<p>", 1)[0], ""
    second = _paragraphs()[len(first):]
    for page in (f"<article>{first}{part}{second}</article>", f"<main>{first}{part}{second}</main>",
                 f"<body>{first}{part}{second}</body>"):
        assert html.main_text(page) == " ".join(PARAGRAPHS)


def test_html_teasers_and_link_lines():
    links = "".join(f'<li><a href="/{i}">Some other page {i}</a></li>' for i in range(5))
    text = _paragraphs()
    half = text.index("<p>Another")
    assert html.main_text(f"<body><ul>{links}</ul>{text[:half]}<ul>{links}</ul>{text[half:]}</body>") == " ".join(PARAGRAPHS)
    teaser = '<article class="card"><h2>Other</h2><p>A teaser of another page.</p></article>'
    assert html.main_text(f"<article>{text}</article>{teaser}") == " ".join(PARAGRAPHS)
    assert "A teaser" in html.main_text(teaser)             # a page of cards only has no other text


def test_html_names_that_stay():
    for name in ("content has-sidebar", "post category-search", "overflow-hidden", "cardinal", "postbody", "readmore"):
        assert html.main_text(f'<article class="{name}">{_paragraphs()}</article>') == " ".join(PARAGRAPHS)
        assert html.main_text(f'<article><div class="{name}">{_paragraphs()}</div></article>') == " ".join(PARAGRAPHS)


def brute_range(mass):
    """Surge and dive by trying every line: a line is text if it has mass, starts and ends come from the runs
    of such lines whose own sum or a window of three lines beginning in them reaches the threshold."""
    n = len(mass)
    run = {k: (max([j for j in range(k + 1) if not mass[j]], default=-1) + 1,
               min([j for j in range(k, n) if not mass[j]], default=n)) for k in range(n) if mass[k]}
    strong = [k for k in run if sum(mass[slice(*run[k])]) >= html.SURGE
              or any(sum(mass[j:j + 3]) >= html.SURGE for j in range(*run[k]))]
    if not run:
        return 0, 0
    if strong:
        first, last = run[strong[0]][0], run[strong[-1]][1]
    else:
        first = max(range(n), key=lambda k: mass[k])
        last = first
        while first > 0 and any(mass[max(0, first - 3):first]):
            first -= 1 if mass[first - 1] else next(j for j in range(1, 4) if first - j >= 0 and mass[first - j])
        last = max(last, first)
    while last < n and any(mass[last:last + 3]):
        last += 1 + next(j for j in range(3) if mass[last + j:last + j + 1] and mass[last + j])
    return first, last


def test_main_range_against_brute_force():
    rnd = random.Random(7)
    for _ in range(3000):
        mass = [rnd.choice([0, 0, 0, 5, 20, 60, 120]) for _ in range(rnd.randint(0, 25))]
        assert html._main_range(mass) == brute_range(mass), mass


@pytest.mark.parametrize("ids, texts", [(1, 1), (1, 20_000), (20_000, 1), (20_000, 20_000)])
def test_training_samples_are_bounded(spark, ids, texts):
    """However many rows share an id, a text or both: at most the stated number of rows a group,
    equal rows once, and many where there are many."""
    from decisionops.llm.common import sample_bounds, sample_hash
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 50 == 0, "rare").otherwise("common").alias("g"), (F.col("id") % ids).alias("doc_id"),
        (F.col("id") % texts).cast("string").alias("text")).withColumn("u", sample_hash("doc_id", "text", salt="x"))
    bounds = sample_bounds(rows, "g", "u", 300)
    for g in ("rare", "common"):
        kept = rows.where(F.col("g") == g).select("u").distinct().where(F.col("u") < bounds[g])
        there = rows.where(F.col("g") == g).select("u").distinct().count()
        assert min(there, 140) <= kept.count() <= 300          # copies count towards the bound


def test_models_with_repeated_and_null_ids(spark):
    """Training rows that all share an id, or have none, give a model; ties of languages go to the
    more common one."""
    rows = [(5, f"the cat sat on mat number {i} and then it left the house", "en") for i in range(40)]
    rows += [(None, f"le chat est sur le tapis et il quitte la maison {i}", "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert set(model) == {"en", "fr"}
    tie = langid.Classifier({"b": [b"same words here"] * langid.DICTIONARIES, "a": [b"same words here"] * langid.DICTIONARIES})
    assert tie("same words here")[0] == "b" and tie("same words here")[2] == 0.0
    labels = spark.createDataFrame([(5, 0), (5, 1), (5, 1), (None, 1), (6, 0)], "label_id long, toxic int")
    sample = toxicity.training_sample(docs.union(docs), labels).collect()
    assert len(sample) == 80 and {r.toxic for r in sample} == {0.0, 1.0}            # forty texts, two labels, once each
    assert toxicity.fit(toxicity.training_sample(docs, labels)).score(docs.select("doc_id", "text")).count() == 80


def test_cover_tree_keeps_vectors_off_the_driver(spark, monkeypatch):
    """The driver gets numbers and the bytes of one pass's centres, no sampled vectors and no literal a leaf."""
    monkeypatch.setattr(covertree, "LEAF", 40)
    monkeypatch.setattr(covertree, "FANOUT", 4)
    x = np.random.default_rng(5).normal(size=(600, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    points = spark.createDataFrame([(i, 1, 8, v.tolist()) for i, v in enumerate(x)], "pid long, n long, dim int, x array<double>").persist()
    fetched, kind = [], type(points)
    real = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: fetched.append((df.columns, real(df))) or fetched[-1][1])
    placed, nodes, centres = covertree._build(points)
    assert all("x" not in columns for columns, _ in fetched) and centres.count() == len(nodes) > 20
    assert max(len(rows) for columns, rows in fetched if "raw" in columns) <= covertree.BATCH * 4
    counts = {r["node"]: r["count"] for r in real(placed.groupBy("node").count())}
    assert counts == {n.node: n.size for n in nodes if n.leaf} and sum(counts.values()) == 600
    plan = covertree.links(points)._jdf.queryExecution().optimizedPlan().toString()
    assert "map(keys" not in plan.lower() and "keys: [" not in plan.lower()
    points.unpersist()
