import random

import numpy as np
import pytest
from brute import hamming_groups, simhash, small_texts

from noticeflow.llm.components import components
from noticeflow.llm.gray_index import forest, gray_rank, linked
from noticeflow.llm.simhash import groups, links, op2_simhash_groups


def near_codes(rng, n):
    codes = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(codes) < n:
        code = rng.choice(codes)
        for _ in range(rng.randint(0, 6)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    return codes


def test_gray_rank():
    values = np.arange(1000, dtype=np.uint64)
    assert (gray_rank(values ^ (values >> np.uint64(1))) == values).all()


@pytest.mark.parametrize("seed", range(5))
def test_index_links_what_is_near(seed):
    rng = random.Random(seed)
    codes = near_codes(rng, 600)
    group = [rng.randint(0, 2) for _ in codes]
    a, b = linked(np.array(codes, np.uint64), np.array(group), 4)
    for x, y in zip(a.tolist(), b.tolist()):
        assert group[x] == group[y] and (codes[x] ^ codes[y]).bit_count() <= 4
    label = forest(len(codes), a, b)
    for g in range(3):
        own = [i for i in range(len(codes)) if group[i] == g]
        want = hamming_groups([codes[i] for i in own])
        assert [own[w] for w in want] == label[own].tolist()


@pytest.mark.parametrize("block", [7, 4096])
def test_links_over_all_layouts(spark, block):
    """Also with groups dealt into pairs of blocks."""
    rng = random.Random(3)
    codes = sorted(set(near_codes(rng, 500) + [7, 6, 5, 15, 31]))
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    frame = spark.createDataFrame(signed, "code long")
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links(frame, 4, block).collect()]
    at = {c: i for i, c in enumerate(codes)}
    label = forest(len(codes), np.array([at[a] for a, _ in pairs], int), np.array([at[b] for _, b in pairs], int))
    assert label.tolist() == hamming_groups(codes)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(300, 300), (7, 6)]
    pairs += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    nodes = sorted({n for p in pairs for n in p})
    at = {n: i for i, n in enumerate(nodes)}
    label = forest(len(nodes), np.array([at[a] for a, _ in pairs]), np.array([at[b] for _, b in pairs]))
    for n in nodes:
        assert found.get(n, n) == nodes[label[at[n]]]


def test_given_documents(spark):
    docs = small_texts()
    codes = [simhash(t) for _, t in docs]
    roots = hamming_groups(codes)
    members = {}
    for (doc_id, _), root in zip(docs, roots):
        members.setdefault(root, []).append(doc_id)
    want = {d: (f"{c:016x}", min(members[r])) for (d, _), c, r in zip(docs, codes, roots)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op2_simhash_groups(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_defined_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "A b", 1), (5, "a B", 1), (None, "one two three four five", 2), (4, "A b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, code int")
    got = sorted((r.doc_id or 0, r.code, r.component_id) for r in groups(frame).collect())
    one = simhash("a b")
    signed = one - (1 << 64) if one >> 63 else one
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, 0, 1) for i in (1, 2, 3)]
    assert [g for g in got if g[0] in (4, 5)] == [(4, signed, 4), (4, signed, 4), (5, signed, 4)]
    assert [g[2] for g in got if g[0] == 0] == [None]
    assert groups(frame.limit(0)).count() == 0
