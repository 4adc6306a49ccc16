"""Packing round trip and shard capacity against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from decisionops.llm import packing, sharding
from tests.llm.conftest import DOCS

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4")


def test_encoder_equals_tokenizer():
    rnd, enc = random.Random(1), packing.Encoder(PATH)
    assert enc.core is not None
    alphabet = ["a", "b", " ", " ", "\n", "\t", " ", "　", "é", "ß", "1", "23", "'s", "'ll", "!", "<|endoftext|>",
                "Ünder", "漢字", "🙂", "\x1c", "\u0085"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    for t in texts + [t or "" for _, t in DOCS]:
        assert enc(t) == ids_of(t).tobytes(), repr(t)


def test_pack_round_trip(docs):
    rows = packing.pack(docs, tokenizer=PATH).collect()
    tokens = defaultdict(list)
    for i, t in DOCS:
        tokens[i].append(np.append(ids_of(t), 0).astype("<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert any(len(d) == r.doc_tokens and zlib.crc32(d[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for d in tokens[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, own in tokens.items():                        # every id in one piece
        assert sum(n for _, n in pieces[i]) == sum(map(len, own))
        if len(own) == 1:
            at = 0
            for start, n in sorted(pieces[i]):
                assert start == at and n > 0
                at += n
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0         # no padding


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rest_once(seed):
    rnd = random.Random(seed)
    counts = {rnd.randint(1, 1023): rnd.choice([1, 2, 7, 500, 10_000]) for _ in range(rnd.choice([1, 3, 80, 600]))}
    plan = packing.Plan(counts)
    covered = Counter()
    filled = Counter()
    for n, lo, hi, cut, size, seq, off in plan.placed:
        covered[n] += (hi - lo) * size
        assert size > 0 and off + size <= 1024 and cut + size <= n
        for k in range(min(hi - lo, 50)):
            filled[seq + k] += size
    for n, lo, hi, cut, size, pos in plan.streamed:
        covered[n] += (hi - lo) * size
    assert covered == Counter({n: n * c for n, c in counts.items()})
    assert all(v & (v - 1) == 0 for v in filled.values())
    assert len(plan.placed) < 400_000                    # whatever the counts are


def brute_capacity(sizes, n):
    def fits(cap):
        runs, now = 1, 0
        for s in sizes:
            if s > cap:
                return False
            if now + s > cap:
                runs, now = runs + 1, 0
            now += s
        return runs <= n
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("n_groups,hot", [(3000, 1), (3000, 40_000), (25, 1), (1, 1)])
def test_minimax_capacity(spark, monkeypatch, n_groups, hot):
    monkeypatch.setattr(sharding, "FIRST_BITS", 6)       # several rounds on a small table
    rnd = random.Random(n_groups + hot)
    groups = [(rnd.getrandbits(62), rnd.randint(16, 4000) * (hot if k == 7 else 1), 1) for k in range(n_groups)]
    capacity, keys, n = sharding.minimax_bounds(spark.createDataFrame(groups, "gkey long, size long, n_docs long"), 40)
    groups.sort()
    assert n == n_groups and capacity == brute_capacity([s for _, s, _ in groups], 40)
    load = Counter(sum(k >= b for b in keys) for k, s, _ in groups for _ in range(1))
    size = Counter()
    for k, s, _ in groups:
        size[sum(k >= b for b in keys)] += s
    assert max(size.values()) <= capacity and max(load) <= 39
    if n_groups == 3000 and hot == 1:
        assert min(size[i] for i in range(40)) > 0.8 * capacity


def test_shard_documents(docs, no_docs):
    rows = sharding.shard_documents(docs, n_shards=4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in DOCS)
    of, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        of[r.gkey].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in of.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(4))
    assert sharding.shard_documents(no_docs).count() == 0
    assert packing.pack(no_docs, tokenizer=PATH).count() == 0


def test_steps_are_balanced(docs):
    out = packing.pack(docs, tokenizer=PATH, step_tokens=8192)
    tokens = [r.t for r in out.groupBy("step").agg(F.sum("length").alias("t")).collect()]
    assert len(tokens) > 1 and max(tokens) - min(tokens) <= 4 * 1024
