import hashlib
import random
import zlib

import pandas as pd
import pytest
from brute import SMALL

from noticeflow.llm.prefix_trie import op13_prefix_trie, trie
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Rows of the contract from (conv_id, turn, role, text) without equal turns in a conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {(): []}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    if not own:
        return []
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        if node:
            children.setdefault(node[:-1], []).append(node)
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        sha = hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest()
        parent = members[node[:-1]][0] if node else None
        out.append((convs[0], len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], sha))
    return sorted(out, key=lambda r: r[:2])


def found(frame):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=lambda r: r[:2])


def corpus(seed, n=400):
    """Few kinds of turns, long chains, shared heads of blocks, missing blocks, turnless ones."""
    rng = random.Random(seed)
    rows = []
    chain = [(rng.choice("ab"), rng.choice(["x", "yé", "日本", ""])) for _ in range(60)]
    for c in rng.sample(range(n), n * 2 // 3):
        length = rng.choice([1, 2, 3, 5, 8])
        own = [(rng.choice("ab"), rng.choice(["x", "yy", None])) for _ in range(length)]
        if rng.random() < 0.3:
            own = chain[: rng.randint(1, 60)] + (own if rng.random() < 0.5 else [])
        first = rng.choice([0, 5, -3])
        rows += [(c, first + 2 * i if i or rng.random() < 0.7 else None, *t) for i, t in enumerate(own)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, limit", [(0, 1000), (1, 1), (2, 12)])
def test_trie_as_brute_force(spark, seed, limit):
    rows = corpus(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows)
    assert found(trie(frame, limit)) == want
    assert max(r[1] for r in want) >= 50 and want[0][:3] == (min(r[0] for r in rows), 0, None)


def test_given_conversations(spark):
    frame = pd.read_parquet(f"{SMALL}/conversations.parquet")
    rows = list(frame[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None))
    assert found(op13_prefix_trie(spark, SMALL)) == brute(rows)


def test_one_conversation_over_many_ranges(spark):
    """One conversation with most rows is spread; the others branch off it."""
    rows = [(100, i, "u", f"t{i % 3}") for i in range(3000)]
    rows += [(c, i, "u", f"t{i % 3}" if i < c else "other") for c in range(101, 130) for i in range(c)]
    assert found(trie(spark.createDataFrame(rows, SCHEMA).repartition(5), 40)) == brute(rows)


def test_turnless_conversations(spark):
    rows = [(c, 0, "u", f"only {c}") for c in range(101, 140)]
    want = brute(rows)
    assert found(trie(spark.createDataFrame(rows, SCHEMA))) == want
    alone = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 6]
    assert found(trie(spark.createDataFrame(alone, SCHEMA))) == brute(alone)
    assert len(brute(alone)) == 1 and brute(alone)[0][5] == 1


def test_nulls_ties_repeats_other_columns_and_empty(spark):
    rows = [(None, 1, "u", "x"), (200, None, None, None), (200, 1, "u", "a"), (200, 1, "u", "a"), (200, 1, "u", "b")]
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = frame.withColumn("place", F.lit(1)).withColumn("d", F.lit("x")).withColumn("part", F.lit(2))
    out = found(trie(extra))
    assert out == found(trie(frame.orderBy(F.desc("text"))))
    assert [r[1] for r in out] == [0, 1, 2, 3, 4] and {r[0] for r in out} == {200}
    assert trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_very_long_text(spark):
    rows = [(1, 0, "u", "é" * 3_000_000), (2, 0, "u", "é" * 3_000_000), (300, 0, "u", "z"), (301, 0, "u", "z")]
    assert found(trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
