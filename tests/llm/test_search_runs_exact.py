"""Ranked search, periodic runs and streaming exact dedup against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionops.llm import exactdedup, periodic, ranked
from tests.llm.conftest import DOCS


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


# ---- ranked search ------------------------------------------------------------

ITEMS = [(1, "of OF words text"), (2, None), (3, "!!! ???"), (4, "İstanbul ß nothing"), (5, "same text for ties"),
         (5, "same text for ties"), (6, "unheard terms only"), (None, "shared passage bytes"), (7, "id"), (7, "text")]


def brute_ranked(docs, items, top=10):
    find = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+").findall
    counted = [(i, Counter(find(lower(t)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    N, L = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = defaultdict(Counter)
    for i, t in set(items):
        asked[i].update(find(lower(t)))
    out = []
    for item, q in asked.items():
        rows = []
        for i, c, n in counted:
            m = 25 + (75 * n * N) // L
            s = sum(k * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, k in q.items() if t in c)
            if s > 0:
                rows.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(rows)[:top])]
    return Counter(out)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, score string")


@pytest.mark.parametrize("chunk_terms, block_docs", [(200_000, 8192), (4, 3)])
def test_ranked_cases(spark, docs, chunk_terms, block_docs):
    got = ranked.ranked(docs, item_frame(spark, ITEMS), top=3, chunk_terms=chunk_terms, block_docs=block_docs)
    assert Counter(tuple(r) for r in got.collect()) == brute_ranked(DOCS, ITEMS, 3)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_many_terms_and_ties(spark):
    """Items of over 64 terms, long tails of equal scores, several tasks."""
    rnd = random.Random(3)
    vocabulary = [f"t{k}" for k in range(150)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 5, 200])))) for i in range(600)]
    docs += [(600 + i, "t0 t1 t2") for i in range(300)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=n))) for k, n in enumerate([1, 3, 40, 120, 400])] + [(9, "t0 t1 t2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = ranked.ranked(frame, item_frame(spark, items), block_docs=100)
    assert Counter(tuple(r) for r in got.collect()) == brute_ranked(docs, items)


def test_ranked_empty_tables(spark, docs, no_docs):
    items = item_frame(spark, ITEMS)
    assert ranked.ranked(no_docs, items).count() == 0
    assert ranked.ranked(docs, items.where("false")).count() == 0


def test_masks_are_left_out_safely():
    """A block scores fewer documents than it groups, with the same best list."""
    rnd = np.random.default_rng(0)
    n_docs, n_terms = 2000, 12
    held = rnd.random((n_docs, n_terms)) < np.linspace(0.02, 0.9, n_terms)
    doc, term = np.nonzero(held)
    tf = rnd.integers(1, 4, len(doc))
    weight = np.linspace(6000, 100, n_terms).astype(np.int64)
    n = np.full(n_docs, 50)
    block = ranked.Block(np.arange(n_docs), n, doc, term, tf, n_docs, n_docs * 50, weight)
    scored = []
    plain = block._scores
    block._scores = lambda chosen, *a: scored.append(len(chosen)) or plain(chosen, *a)
    every = np.arange(n_terms)
    best = block.search(every, np.ones(n_terms, np.int64), [], 10)
    full = plain(np.arange(n_docs), every, np.ones(n_terms, np.int64))
    assert best == sorted(((int(s), -i) for i, s in enumerate(full) if s > 0), reverse=True)[:10]
    assert sum(scored) < n_docs / 4


# ---- periodic runs --------------------------------------------------------------

def brute_runs(w):
    """All maximal stretches, by comparing words at every distance."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                s = w[i:i + size]
                if all(any(s[k] != s[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rnd = random.Random(12)
    for _ in range(300):
        docs = []
        for _ in range(rnd.randint(0, 6)):
            n, k = rnd.choice([0, 1, 3, 8, 30, 70]), rnd.choice([1, 2, 3])
            w = [rnd.randrange(k) for _ in range(n)]
            if n and rnd.random() < 0.5:
                p = rnd.randint(1, max(1, n // 4))
                w = [w[i % p] for i in range(n)]
                if rnd.random() < 0.5:
                    w[rnd.randrange(n)] = 9
            docs.append(w)
        assert periodic.batch_runs([np.array(d, np.int64) for d in docs]) == [brute_runs(d) for d in docs]


def fibonacci(n):
    a, b = "0", "01"
    while len(b) < n:
        a, b = b, b + a
    return [int(c) for c in b[:n]]


@pytest.mark.parametrize("words", [[0] * 40, [0, 1] * 30, fibonacci(150), [0, 0, 1] * 20 + [2] + [0, 1] * 9,
                                   ([0, 0, 0, 0, 0, 0, 1] * 8)[3:], [0] * 6, [0] * 5, [0, 1] * 4, [0, 1] * 4 + [0]])
def test_runs_of_special_words(words):
    assert periodic.batch_runs([np.array(words)]) == [brute_runs(words)]


def test_suffix_array_and_lcp():
    rnd = random.Random(5)
    for n in [1, 2, 50, 400]:
        s = [rnd.randrange(3) for _ in range(n)]
        sa = periodic.suffix_array(np.array(s))
        assert sa.tolist() == sorted(range(n), key=lambda i: s[i:])
        isa = np.empty(n, np.int64)
        isa[sa] = np.arange(n)
        lcp = periodic.lcp_array(np.array(s), sa, isa)
        for k in range(1, n):
            a, b = s[sa[k - 1]:], s[sa[k]:]
            assert lcp[k] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_long_periodic_documents():
    """Millions of windows agree; the work stays near linear."""
    assert periodic.batch_runs([np.zeros(300_000, np.int64)]) == [[(0, 300_000, 1)]]
    assert periodic.batch_runs([np.arange(300_000) % 1001]) == [[(0, 300_000, 1001)]]


def brute_report(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_run_report(spark, docs, no_docs):
    rnd = random.Random(8)
    short = [(i, t) for i, t in DOCS if t is None or len(t) < 5000]
    rows = short + [(i, " ".join(rnd.choices("abc", k=rnd.randint(0, 90)))) for i in range(100, 220)]
    rows += [(300, "x y   x y\x0b" * 12), (301, "la " * 7 + "\x00 " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).repartition(4)
    got = periodic.run_report(periodic.find_runs(frame, plant=True))
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute_report(i, t) for i, t in rows)
    assert dict(got.dtypes)["n_runs"] == dict(got.dtypes)["exponent_milli"] == "bigint"
    assert periodic.run_report(periodic.find_runs(docs, plant=True)).count() == len(DOCS)
    assert periodic.run_report(periodic.find_runs(no_docs, plant=True)).count() == 0


def test_collapsed_text_keeps_one_period(spark):
    frame = spark.createDataFrame([(1, "so very very very very very very good"), (3, "a b c d")], "doc_id long, text string")
    got = {r.doc_id: (r.collapsed, [tuple(x) for x in r.runs]) for r in periodic.find_runs(frame).collect()}
    assert got == {1: ("so very good", [(1, 6, 1)]), 3: ("a b c d", [])}


# ---- exact dedup ----------------------------------------------------------------

def brute_exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[lower(t)].append(i)
    return Counter((i, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)]),
                    hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in docs)


def written(df, path):
    df.write.parquet(str(path))
    return str(path)


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_exact_dedup_cases(spark, docs, tmp_path, broadcast_rows):
    got = exactdedup.deduplicate(spark, written(docs, tmp_path / "docs"), broadcast_rows=broadcast_rows).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_exact(DOCS)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in got}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_empty_table(spark, no_docs, tmp_path):
    assert exactdedup.deduplicate(spark, written(no_docs, tmp_path / "none")).count() == 0


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_collisions_are_told_apart_by_bytes(spark, tmp_path, broadcast_rows):
    """A digest of three values: nearly every hit differs in its bytes."""
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["Same", "same", "other", f"text {rnd.randrange(40)}", "", None])) for i in range(700)]
    source = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tmp_path / "docs")

    def weak(text):
        return F.unhex(F.lpad(F.hex(F.pmod(F.crc32(text), F.lit(3))), 2, "0"))

    state = str(tmp_path / "state")
    exactdedup.update_index(spark, source, state, digest=weak)
    got = exactdedup.decisions(spark, source, state, digest=weak, broadcast_rows=broadcast_rows).collect()
    want = {i: (k, n) for i, k, n, _ in brute_exact(rows)}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == want and len(got) == len(rows)
    assert {r.doc_id for r in got if r.kept} == {k for k, _ in want.values()}


def test_state_goes_on_with_new_files(spark, tmp_path):
    """Nothing expires: a later file's copies meet the texts of the first run."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    source, state = str(tmp_path / "docs"), str(tmp_path / "state")
    first = [(i, f"text {i % 50}") for i in range(200)]
    more = [(1000 + i, f"TEXT {i}") for i in range(60)]
    spark.createDataFrame(first, schema).write.parquet(source)
    exactdedup.deduplicate(spark, source, state).count()
    before = {bytes(r.digest): r.n for r in exactdedup.index(spark, state).collect()}
    spark.createDataFrame(more, schema).write.mode("append").parquet(source)
    got = exactdedup.deduplicate(spark, source, state, broadcast_rows=0).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_exact(first + more)
    after = {bytes(r.digest): r.n for r in exactdedup.index(spark, state).collect()}
    assert len(before) == 50 and len(after) == 60 and all(after[k] == n + 1 for k, n in before.items())


def test_hot_text_is_dealt_out(spark, tmp_path):
    rows = [(i, "the hot text" if i % 3 else f"text {i}") for i in range(6000)]
    source = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tmp_path / "docs")
    for broadcast_rows in (100_000, 0):
        got = exactdedup.deduplicate(spark, source, broadcast_rows=broadcast_rows)
        assert got.where("kept").count() == 2001
        assert got.agg(F.max("group_size")).first()[0] == 4000 and got.where("NOT kept").count() == 3999
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_exact_dedup_runs_no_python(spark, docs, tmp_path):
    source = written(docs, tmp_path / "docs")
    plan = exactdedup.deduplicate(spark, source)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
