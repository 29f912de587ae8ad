"""The whole language model: every pair and every triple, against plain counts."""
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.frames import WORDS, documents, lower_az, sentence, texts


def test_find_stays_inside_its_range():
    from oeeflow.llm.eliasfano import EliasFano
    seq = EliasFano.build(np.array([1, 4, 6, 9, 20, 21], np.uint64), 30)
    at, found = seq.find(np.array([4, 4, 9, 20, 7], np.uint64), np.array([0, 2, 2, 2, 3]), np.array([2, 4, 3, 6, 3]))
    assert at.tolist() == [1, 2, 3, 4, 3] and found.tolist() == [True, False, False, True, False]


def test_every_pair_and_triple_counts(spark, monkeypatch):
    from oeeflow.llm import lm
    from oeeflow.llm.queries import op10_trie_scores
    rows = [*texts(), *((100 + i, sentence(i % 3, 30)) for i in range(20)), (200, "w1 w2 never w3 w1 w2 w3 seen"), (201, "w1 w2 w3 w1")]
    monkeypatch.setattr("oeeflow.llm.queries.table", lambda *_: documents(spark, rows))
    monkeypatch.setattr(lm, "SHARD_ROWS", 300)
    c1, c2, c3, tokens = Counter(), Counter(), Counter(), []
    for i, t in rows:
        w = [*WORDS.findall(lower_az(t or "")), None]
        tokens.append((i, w))
        if zlib.crc32(str(i if i is not None else "").encode()) % 5 != 1:
            c1.update(w)
            c2.update(zip([0, *w[:-1]], w))
            c3.update(zip([0, *w[:-2]], w, w[1:]))
    n, v, d = sum(c1.values()), len(c1), 0.75
    n2, t2, n3, t3 = Counter(), Counter(), Counter(), Counter()
    for (a, _), k in c2.items():
        n2[a] += k
        t2[a] += 1
    for (a, b, _), k in c3.items():
        n3[a, b] += k
        t3[a, b] += 1

    def p1(x):
        return (c1[x] + 0.5) / (n + 0.5 * (v + 1))

    def p2(a, x):
        return (max(c2[a, x] - d, 0) + d * t2[a] * p1(x)) / n2[a] if n2[a] else p1(x)

    def p3(a, b, x):
        return (max(c3[a, b, x] - d, 0) + d * t3[a, b] * p2(b, x)) / n3[a, b] if n3[a, b] else p2(b, x)
    assert abs(sum(p3("w1", "w2", x) for x in c1) - 1) < 0.01
    want = []
    for i, w in tokens:
        logs = [math.log10(p2(0, w[0])), *(math.log10(p3(a, b, x)) for a, b, x in zip([0, *w[:-2]], w, w[1:]))]
        want.append((i, len(w), sum(math.log10(p1(x)) for x in w), sum(logs)))
    got = [(r["doc_id"], r["n_tokens"], r["base_score"], r["score"]) for r in op10_trie_scores(spark, "").collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 and abs(a[3] - b[3]) < 2e-3 * a[1], (a, b)
