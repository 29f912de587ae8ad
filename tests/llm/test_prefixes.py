"""The prefix trie against a plain one, and the decomposition against plain subtree sums."""
from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.frames import WORDS

SCHEMA = "conv_id long, turn int, role string, text string, depth long, node long, weight long, top long, parent long"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append((c, len(seq)))
    least = {k: min(c for c, _ in v) for k, v in members.items()}
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, v in members.items():
        w = (len(v) - 1) * (len(WORDS.findall(k[-1][1])) if k else 0)
        for d in range(len(k) + 1):
            saved[k[:d]] += w
            leaves[k[:d]] += k not in children
    return sorted((least[k], len(k), least[k[:-1]] if k else None, len(v), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c, n in v if n == len(k))).encode()).hexdigest())
                  for k, v in members.items())


def cases():
    rng = random.Random(4)
    rows = []
    for c in range(-30, 260):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, ["user", "bot"][t % 2], " ".join(rng.choice("a b c".split()) for _ in range(rng.randint(0, 2)))))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1150) for t in range(3)]     # a third share their turns
    rows += [(2000 + i, t, "user", f"long {min(t, 200 + i)}") for i in range(3) for t in range(260)]
    rows += [(3000 + i, 0, "user", "x") for i in range(40)]
    return rows + [(None, 1, "user", "lost"), (4000, None, None, None), (4000, 1, "b", None), (4000, 1, "a", "z"), (4000, 1, "a", "z"), (4001, None, "u", "  é\t日本"),
                   (5000, 0, "user", "word " * 20000)]


def got(df, monkeypatch):
    from oeeflow.llm import queries
    monkeypatch.setattr(queries, "table", lambda *_: df)
    return sorted(tuple(r) for r in queries.op13_prefix_trie(df.sparkSession, "").collect())


@pytest.mark.parametrize("piece", [60, 65_536])
def test_trie_equals_brute_force(spark, monkeypatch, piece):
    from oeeflow.llm import prefixes
    monkeypatch.setattr(prefixes, "PIECE", piece)           # 60: components are split by joins, round after round
    monkeypatch.setattr(prefixes, "PIECE_TURNS", 7)
    monkeypatch.setattr(prefixes, "END_IDS", 16)
    rows = cases()
    if piece == 60:
        rows = [r for r in rows if r[0] is None or r[0] < 60 or r[0] >= 1000]
    want = brute(rows)
    assert got(table_of(spark, rows), monkeypatch) == want


def test_no_rows(spark, monkeypatch):
    assert got(table_of(spark, cases()[:1]).limit(0), monkeypatch) == []
    assert got(table_of(spark, [(None, 1, "a", "b")]), monkeypatch) == []
    one = got(table_of(spark, [(7, 1, "a", "b c")]), monkeypatch)
    assert one == brute([(7, 1, "a", "b c")])


def test_decomposition_in_memory():
    from oeeflow.llm.prefixes import split_in_memory
    rng = random.Random(1)
    for n, reach in ((1, 1), (2, 1), (50, 1), (50, 50), (400, 4), (400, 400)):
        parent = np.array([-1 if i == 0 or rng.random() < 0.02 else rng.randrange(max(0, i - reach), i) for i in range(n)])
        own = np.array([[rng.randrange(5), rng.randrange(9)] for _ in range(n)])
        carried = np.array([rng.randrange(1, 6) for _ in range(n)])
        want, weight = own.copy(), carried.copy()
        for i in range(n - 1, 0, -1):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
                weight[parent[i]] += weight[i]
        assert (split_in_memory(parent, weight, own) == want).all()
