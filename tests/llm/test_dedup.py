"""SimHash groups and repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from decisionops.llm import simhash, suffix
from decisionops.llm.components import connected_components
from decisionops.llm.suffixes import repeated_windows, suffix_array
from tests.llm.conftest import DOCS


def brute_fingerprint(text, shingle=3):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups(docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(DOCS)
    want = Counter((i, f"{brute_fingerprint(t):016x}") for i, t in DOCS)
    assert Counter((r.doc_id, r.fingerprint) for r in got) == want
    fp = {(i, t): brute_fingerprint(t) for i, t in DOCS}
    keys = list(fp)
    group = components(range(len(keys)), lambda a, b: (fp[keys[a]] ^ fp[keys[b]]).bit_count() <= 2)
    lowest = {}
    for k, root in group.items():
        if keys[k][0] is not None:
            lowest[root] = min(lowest.get(root, keys[k][0]), keys[k][0])
    by_fp = {f"{fp[keys[k]]:016x}": lowest.get(root) for k, root in group.items()}
    assert all(r.component_id == by_fp[r.fingerprint] for r in got)


@pytest.mark.parametrize("n_near", [5, 400])
def test_links_of_crowded_entries(spark, n_near):
    """A crowd of near fingerprints, chains, and far ones: components as by all pairs."""
    rnd = random.Random(n_near)
    base = rnd.getrandbits(64)
    fps = {base ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(n_near)}
    chain = rnd.getrandbits(64)
    fps |= {chain ^ ((1 << 2 * i) - 1) for i in range(12)} | {rnd.getrandbits(64) for _ in range(40)} | {0}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = dict((r.node, r.root) for r in connected_components(simhash.links(df)).collect())
    want = components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {x: got.get(x, x) for x in signed} == want


@pytest.mark.parametrize("chunk", [7, 10**6])
def test_components_of_chunks(spark, monkeypatch, chunk):
    from decisionops.llm import components as cc
    monkeypatch.setattr(cc, "CHUNK", chunk)
    rnd = random.Random(chunk)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rnd.randint(-50, 50), rnd.randint(-50, 50)) for _ in range(30)]
    edges += [(500, 500 + i) for i in range(60)] + [(7, 7), (-3, -3)]
    got = dict((r.node, r.root) for r in cc.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    ids = sorted({x for e in edges for x in e})
    joined = {frozenset(e) for e in edges}
    want = components(ids, lambda a, b: frozenset((a, b)) in joined)
    assert {x: got.get(x, x) for x in ids} == want
    assert cc.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first(docs, no_docs):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[12] == 0 and ids[11] == 1 and ids[7] == 1 and ids[8] == 0 and ids[None] == 2
    assert ids[16] == 0 and ids[6] == 1                  # the same words in other cases
    assert all(n == 1 for i, n in ids.items() if i not in (None, 18))
    assert simhash.keep_first(no_docs).count() == 0


def test_keep_first_of_an_id_in_two_groups(spark):
    one = "the first text of this document speaks about the weather at sea in the early spring of the year"
    two = "quite another matter is treated here namely how bread was baked in the villages of the hills"
    rows = [(5, one), (5, two), (5, two), (7, one), (8, two), (None, two), (9, "alone"), (9, "apart"), (9, "apart")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(5, one), (5, two), (None, two), (9, "alone"), (9, "apart")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 100)
    assert simhash.fingerprint(text) == whole


def test_suffix_array_by_sorting():
    rnd = random.Random(5)
    import numpy as np
    for _ in range(150):
        x = [rnd.randint(0, rnd.choice([1, 2, 200])) for _ in range(rnd.randint(1, 50))]
        assert list(suffix_array(np.array(x))) == sorted(range(len(x)), key=lambda i: x[i:])
    for _ in range(80):
        segs = [bytes(rnd.choice([0, 97, 98, 255]) for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 6))]
        n = rnd.choice([2, 3, 5, 9])
        c = Counter(s[i:i + n] for s in segs for i in range(len(s) - n + 1))
        for s, g in zip(segs, repeated_windows(segs, n)):
            assert list(g) == [i for i in range(len(s) - n + 1) if c[s[i:i + n]] > 1]


def brute_repeats(rows, n=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + n] for _, b in texts for k in range(len(b) - n + 1))
    out = []
    for i, b in texts:
        gone, end = bytearray(len(b)), 0
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                for j in range(max(k, end), k + n):
                    gone[j] = 1
                end = k + n
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("classes", [200, 0])       # 0: every group is dealt out by window
def test_repeat_report(docs, monkeypatch, classes):
    monkeypatch.setattr(suffix, "GROUP_CLASSES", classes)
    got = Counter(tuple(r) for r in suffix.repeat_report(docs).collect())
    assert got == Counter(x[:5] for x in brute_repeats(DOCS))


@pytest.mark.parametrize("hot", [4, 20, 300])
def test_hot_windows_are_marked_where_they_are(docs, monkeypatch, hot):
    """Windows over a bound of occurrences are never dealt out; the rest is as before."""
    monkeypatch.setattr(suffix, "GROUP_CLASSES", 0)
    monkeypatch.setattr(suffix, "HOT_WINDOWS", hot)
    monkeypatch.setattr(suffix, "LOCAL", 1)
    assert Counter(tuple(r) for r in suffix.repeat_report(docs).collect()) == Counter(x[:5] for x in brute_repeats(DOCS))


def test_very_long_periodic_text_and_a_common_edge(spark):
    """Millions of equal windows of one text, and a passage that ends differently in 2,000 documents."""
    passage = " ".join(f"common{i}" for i in range(60))
    rows = [(0, "ab" * 2_000_000 + "end")] + [(i, f"own{i} " + passage + f" tail{i} " + "z" * 40) for i in range(1, 2001)]
    got = {r.doc_id: r for r in suffix.repeat_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[0].n_bytes, got[0].n_removed, got[0].n_spans) == (4_000_003, 4_000_000, 1)
    shared = len((" " + passage + " tail").encode())
    assert {(r.n_spans, r.n_removed >= shared) for i, r in got.items() if i} == {(1, True)}


def test_blocks_of_long_texts(docs, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 1000)
    import pyarrow as pa
    text = ("abc " * 900 + "x" * 50 + "abc " * 300).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([text, None, text[:150]])], names=["key", "text"])
    starts = []
    for b in suffix._segment_batches(200)([batch]):
        for a, e in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
            starts += range(a, e + 1)
    assert sorted(starts) == list(range(len(text) - 199))       # every window in exactly one segment


def test_without_repeats(docs, no_docs):
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns
    want = Counter((i, None if t is None else x[5].decode("utf-8", "ignore"))
                   for (i, t), x in zip(DOCS, brute_repeats(DOCS)))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert suffix.repeat_report(no_docs).count() == 0
