import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from candela.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _rebuilt(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    by = {c: [said for _, said in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = by.get(c - c % 100, [])[:h] + own[h:]
    return out


def _nodes(built):
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def _found(df):
    turns, members = trie.with_openings(trie.ordered_turns(df))
    found = trie.prefix_trie(turns, members)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


def _conversations(seed):
    rng = random.Random(seed)
    said = [("user", "a"), ("assistant", "a"), ("user", "é😀"), (None, "x"), ("user", None), ("", "")]
    rows = []
    for c in [*range(0, 40), *range(100, 110), 307, 999, 1000]:
        n = rng.choice([1, 2, 3, 5, 8, 9, 13])
        for k in range(n):
            rows.append((c, rng.choice([None, k, k, k]), *(said[0] if k < 4 and rng.random() < 0.7 else rng.choice(said))))
    long = [(2000, k, "user", f"t{k % 5}") for k in range(300)]
    alike = [(c, k, "user", f"t{k % 5}") for c in range(2001, 2030) for k in range(300 - (c - 2001) // 3)]
    copies = [(c, k, "user", f"same {k}") for c in range(5000, 5099) for k in range(9)]
    return [*rows, *long, *alike, *copies, (None, 1, "user", "lost"), (7, 0, "user", "a"), (7, 0, "user", "a")]


@pytest.mark.parametrize("piece", [1 << 16, 5])
def test_trie_against_brute_force(spark, piece, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", piece)
    rows = _conversations(2)
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], SCHEMA + ", x string, DEPTH double").repartition(4)
    assert _found(df) == _nodes(_rebuilt(rows))


def test_trie_of_little(spark):
    for rows in ([], [(None, 0, "user", "a")]):
        assert _found(spark.createDataFrame(rows, SCHEMA)) == []
    # conversations without a turn left are members of the root
    empty = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(empty, 0, "user", "only")]
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _nodes(_rebuilt(rows)) == [
        (empty, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(empty).encode()).hexdigest())]
