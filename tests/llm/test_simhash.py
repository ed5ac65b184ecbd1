"""SimHash near-dedup against all pairs; components against plain label spreading."""

import random

import numpy as np
import xxhash

from conftest import odd_rows
from seriesmill.llm import simhash
from seriesmill.llm.graph import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for i in range(64):
            bits[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(shingles))


def spread(nodes, linked):
    """Smallest reachable node of each, from a function that tells links."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_near_duplicates(odd, work):
    prints = [plain_fingerprint(t) for _, t, _ in odd_rows()]
    label = spread(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    want = []
    for i, (doc_id, _, _) in enumerate(odd_rows()):
        ids = [odd_rows()[j][0] for j in label if label[j] == label[i]]
        want.append((doc_id, f"{prints[i]:016x}", min([x for x in ids if x is not None], default=None)))
    for block in (simhash.BLOCK, 1):
        rows = simhash.near_duplicates(odd, work, block=block).collect()
        assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in rows], key=str) == sorted(want, key=str)
        assert sum(r.kept for r in rows) == len(set(label.values()))


def test_every_pair_within_three_bits_is_connected(spark, work):
    rng = random.Random(4)
    codes = set()
    for _ in range(60):
        code = rng.getrandbits(64)
        codes.add(code)
        for _ in range(rng.randrange(8)):
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                code ^= 1 << bit
            codes.add(code)
    codes = sorted(codes)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    frame = work.settle(spark.createDataFrame([(c,) for c in signed], "fp long"), "codes")
    want = spread(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    for block in (1024, 2):
        roots = {r.node: r.root for r in components(work.settle(simhash.near_pairs(frame, work, block=block), "pairs"), work).collect()}
        assert {c: roots.get(c, c) for c in signed} == want


def test_components_of_paths_stars_and_loops(spark, work):
    edges = [(i, i + 1) for i in range(100, 180)] + [(500, k) for k in range(501, 560)] + [(7, 7), (900, 10), (10, 900), (900, 11)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
    assert all(roots[i] == 100 for i in range(100, 181)) and all(roots[i] == 500 for i in range(500, 560))
    assert roots[900] == roots[11] == 10 and 7 not in roots
    assert components(spark.createDataFrame([], "a long, b long"), work).count() == 0


def test_keep_one(odd, work):
    left = simhash.keep_one(odd, work)
    assert left.columns == odd.columns
    kept = [r.doc_id for r in simhash.near_duplicates(odd, work).collect() if r.kept]
    assert sorted([r.doc_id for r in left.select("doc_id").collect()], key=str) == sorted(kept, key=str)


def test_empty_table(nothing, work):
    assert simhash.near_duplicates(nothing, work).count() == 0
    assert simhash.keep_one(nothing, work).count() == 0
