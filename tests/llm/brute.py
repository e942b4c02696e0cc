"""Plain versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import random
import zlib

import pandas as pd
import xxhash

SMALL = "/root/testdata/sf0.001"


def small_texts(n: int = 10**9) -> list[tuple[int, str]]:
    frame = pd.read_parquet(f"{SMALL}/documents.parquet").head(n)
    return list(zip(frame.doc_id.tolist(), frame.text.tolist()))


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def crc_mod(value: int, divisor: int) -> int:
    return zlib.crc32(str(value).encode()) % divisor


def simhash(text: str | None, k: int = 4) -> int:
    parts = [w.decode() for w in (text or "").encode().lower().split()]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + k]) for i in range(max(1, len(parts) - k + 1))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def hamming_groups(codes: list[int], limit: int = 4) -> list[int]:
    """For each index the smallest index reachable."""
    label = list(range(len(codes)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def repeats(docs: list[tuple[int, str | None]], window: int = 20) -> dict[int, tuple[int, int, str]]:
    """doc_id: (n_words, n_removed, sha256 of kept words)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out[doc_id] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeated_corpus(seed: int, n: int = 60) -> list[tuple[int, str | None]]:
    """Random texts with passages shared in many ways, runs and tiny vocabularies."""
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(15, 60))) for _ in range(5)]
    docs: list[tuple[int, str | None]] = []
    for doc_id in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.randint(0, 5)
            if kind == 0:
                parts.append(rng.choice(pool))
            elif kind == 1:
                own = rng.choice(pool).split()
                a = rng.randrange(len(own))
                parts.append(" ".join(own[a : a + rng.randint(1, 40)]))
            elif kind == 2:
                parts.append(" ".join([rng.choice("xy")] * rng.randint(1, 70)))
            elif kind == 3:
                parts.append(" ".join(["p", "q"] * rng.randint(1, 30)))
            else:
                parts.append(" ".join(str(rng.randint(0, 3)) for _ in range(rng.randint(1, 50))))
        docs.append((doc_id, rng.choice([" ", "\n", "  "]).join(parts)))
    docs[3] = (3, None)
    docs[4] = (4, "")
    return docs
