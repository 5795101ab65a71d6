"""Plans and packed pieces."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from qalathe.llm import packing

PATH = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("lengths", [
    [], [1024] * 3, [3] * 1000, [600] * 10, [700] * 100 + [400] * 50 + [1] * 5, [512, 512, 300, 300, 424],
    [random.Random(4).randint(1, 1024) for _ in range(3000)], [random.Random(5).randint(300, 400) for _ in range(900)]])
def test_plan_uses_every_piece_once(lengths):
    groups = packing.plan(Counter(lengths))
    used = Counter()
    for bins, content in groups:
        assert bins > 0 and sum(length * n for length, n in content) <= 1024
        for length, n in content:
            used[length] += bins * n
    assert used == Counter(lengths)
    gaps = []
    for x in sorted(lengths, reverse=True):  # plain best fit
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((1024 if fit is None else fit) - x)
    assert sum(bins for bins, _ in groups) <= len(gaps)


def test_plan_fills_exactly():
    assert [n for n, _ in packing.plan({1000: 5, 24: 5})] == [5]
    assert packing.plan({1000: 4, 20: 4, 4: 4}) == [(4, [(1000, 1), (20, 1), (4, 1)])]
    assert packing.plan({900: 2, 100: 2, 20: 2, 4: 2}) == [(2, [(900, 1), (100, 1), (20, 1), (4, 1)])]


def check(docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = packing.packed_documents(docs, PATH, 2, capacity).collect()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0) and len(r.ids) == r.length
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values())
    return len(at)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, 1024)
    assert packing.packed_documents(no_docs, PATH, 2).isEmpty()


def test_given_documents(given):
    check(given("documents").repartition(5), 64)


def test_sequences_hold_their_pieces(given):
    packed = packing.packed_documents(given("documents").limit(30), PATH, 2, 128)
    rows = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in rows) == sum(r.length for r in packed.collect())
    assert all(len(r.ids) <= 128 for r in rows)


def test_ids_of_pieces_stay_out_of_the_python_workers(spark, odd_docs):
    packed = packing.packed_documents(odd_docs, PATH, end_id=2)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1
    assert packed.where("size(ids) != length or offset + length > 1024 or sequence_id is null").count() == 0
    assert packed.groupBy("sequence_id", "offset").count().where("count > 1").count() == 0
