"""Small tables with the awkward rows that every operator must take: nulls, empty and long texts,
ties, repeated rows and extra columns with the operators' own column names."""

from __future__ import annotations

import re

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "size long, component_id long, kept boolean, id long, bucket int")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sentence(k: int, n: int) -> str:
    return " ".join(f"w{(k * 7919 + i * 104729) % 997}" for i in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    a, b = sentence(1, 60), sentence(2, 60)
    long = "\n".join(sentence(k, 300) for k in range(40))
    return [(1, a), (2, a), (3, a.replace("w1 ", "x1 ", 1)), (4, b), (5, None), (6, ""), (7, "   \n\t "), (8, "one two three"),
            (9, "One TWO three"), (10, long), (11, long + " tail"), (12, a), (12, a), (None, b), (13, "É ü 日本語 naïve the of and"),
            (14, "the same line\nthe same line\n" * 30), (15, "mail me: x.y@z.org, +1 (555) 010-9999 or 10.0.0.1, 4111 1111 1111 1111"),
            (16, "### $$$ %%% &&& || <<>> *** ### $$$ %%% &&& ||"), (17, "Licensed under the Apache License, Version 2.0.\n" + b)]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", ["s1", "s2", None, "s1"][k % 4], None if t is None else len(t), 7, 8, True, 9, 1)
                                  for k, (i, t) in enumerate(rows)], DOC_SCHEMA)


def brute_components(rows, shingle: int, percent: int) -> dict[int, int]:
    """Row number -> smallest id that links reach, by comparing all pairs of sets."""
    sets = []
    for _, t in rows:
        w = WORDS.findall(lower_az(t or ""))
        sets.append(frozenset(tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)) if len(w) >= shingle
                    else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = i if least.get(r) is None else (least[r] if i is None else min(least[r], i))
    return {k: least[root(k)] for k in range(len(rows))}
