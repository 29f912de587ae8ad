"""Operators on single texts: personal data, quality rules, licences, toxicity, language model."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import WORDS, documents, lower_az, sentence, texts

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    from oeeflow.llm.pii import _luhn
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and not all(int(x) <= 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("alphabet", ["0123456789. -+@a(", "1234.4 -", "4111 -", "+1 ().-x2", "ab@.c-@@%+"])
def test_base_spans_are_the_matches_of_the_patterns(alphabet):
    from oeeflow.llm.pii import BASE_KINDS, find_spans
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert [s for s in find_spans(text) if s[0] in BASE_KINDS] == brute_spans(text), text


def test_personal_data_rows_and_redaction(spark):
    from oeeflow.llm.pii import find_personal_data, redact
    docs = documents(spark)
    found = {(r["doc_id"], r["spans"]) for r in find_personal_data(docs).collect()}
    assert len(find_personal_data(docs).collect()) == len(texts())
    assert any(i == 15 and s.startswith("email:9:18,ip:") for i, s in found)
    out = redact(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    row = out.filter("doc_id = 15").first()
    assert row["text"] == "mail me: [EMAIL], [PHONE] or [IP], [CARD]" and row["n_chars"] == len(row["text"])
    assert out.filter("doc_id = 5").first()["text"] is None
    assert redact(docs.limit(0)).count() == 0


def test_cues_schemes_and_accounts():
    from oeeflow.llm.pii import find_spans, redact_text
    assert redact_text('token = "abcdefgh1234" see https://a.b/c?d=e.') == 'token = "[SECRET]" see [URL].'
    assert ("account", 6, 28) in find_spans("IBAN: DE89370400440532013000 ok") + find_spans("IBAN: GB82WEST12345698765432 ok")


def test_quality_counts_match_brute_force(spark):
    from oeeflow.llm.quality import quality_rules
    rows = [*texts(), (30, " ".join("abab"[i % 4] for i in range(50))), (31, "a b c d e x a b c d e"), (32, "\nx\n\nx\n x\n")]
    got = quality_rules(documents(spark, rows)).collect()
    assert len(got) == len(rows)

    def brute(text):
        t = text or ""
        w = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {p for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)
    for r in got:
        own = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert own == brute(r["text"]), r
        assert r["base_failed"] == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules(documents(spark, [])).count() == 0


def test_quality_runs_without_python_or_shuffle(spark):
    from oeeflow.llm.quality import quality_rules
    plan = quality_rules(spark.createDataFrame([(1, "x")], "doc_id long, text string").repartition(1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange") <= 1


def test_licences(spark):
    from oeeflow.llm.licenses import scan_licenses
    rows = [*texts(), (40, "Licensed under the apache license version 2.0"), (41, "All rights reserved"), (42, "prose of no licence at all")]
    got = {r["doc_id"]: r for r in scan_licenses(documents(spark, rows)).collect()}
    assert got[17]["license"] == "Apache-2.0" and got[17]["line"] == 0 and got[17]["dice"] == 1.0
    assert got[40]["license"] == "Apache-2.0" and got[40]["line"] == -1
    assert got[41]["license"] == "All-rights-reserved" and got[42]["license"] is None and got[5]["n_matches"] == 0
    assert scan_licenses(documents(spark, [])).count() == 0


def test_licences_in_word_windows(spark):
    """Windows against brute force: wrapped licence files, headers above code, notices in sentences."""
    import textwrap

    from oeeflow.llm.licenses import TEMPLATES, scan_licenses, template_bigrams, template_words
    mit = max((t for name, t in TEMPLATES if name == "MIT"), key=len)
    gpl = next(t for name, t in TEMPLATES if name == "GPL-3.0-or-later")
    code = "\n".join(f"def f{i}(x):\n    return x * {i} + len(str(x))" for i in range(40))
    rows = [*texts(),
            (50, "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + textwrap.fill(mit, 60)),
            (51, "\n".join("# " + line for line in textwrap.wrap(gpl, 70)) + "\n" + code),
            (52, "We wrote this parser in a week. Released under the MIT License. It has no parts that need a net " * 3),
            (53, "of the " * 500 + "all rights of the user"), (54, textwrap.fill(mit, 60) + "\n" + code + "\n" + textwrap.fill(gpl, 50))]
    got = {r["doc_id"]: r for r in scan_licenses(documents(spark, rows)).collect() if r["doc_id"] is not None}
    assert got[50]["window_license"] == "MIT" and got[50]["window_dice"] == 1.0
    assert got[51]["window_license"] == "GPL-3.0-or-later" and got[52]["window_license"] == "MIT" and got[52]["n_windows"] >= 3
    assert got[53]["n_windows"] == 0 and got[53]["window_license"] is None and got[54]["n_windows"] >= 2
    for doc_id, text in rows:
        words = template_words(text or "")
        grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
        hits = []
        for k, (name, template) in enumerate(TEMPLATES):
            own, size = set(template_bigrams(template)), len(template_words(template)) - 1
            for i, g in enumerate(grams):
                if g in own:
                    unit = set(grams[i:i + size])
                    dice = 2.0 * len(unit & own) / (len(unit) + len(own))
                    if dice >= 0.8 - 1e-9:
                        hits.append((dice, -k, -i))
        if doc_id is None or sum(1 for d, _ in rows if d == doc_id) > 1:
            continue
        r, top = got[doc_id], max(hits, default=None)
        assert r["n_windows"] == len(hits), doc_id
        assert (r["window_dice"], r["window_word"]) == ((top[0], -top[2]) if top else (None, None)), doc_id
        assert r["window_license"] == (TEMPLATES[-top[1]][0] if top else None)


def test_lexicon_automaton_is_edit_distance():
    from oeeflow.llm.toxicity import LexiconAutomaton
    terms = ["idiot", "clown", "scum", "moron", "morons"]
    automaton = LexiconAutomaton(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]
    rng = random.Random(3)
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            word[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
        word = "".join(word)
        best = min((distance(word, t), k) for k, t in enumerate(terms) if distance(word, t) <= (1 if len(t) >= 5 else 0)) \
            if any(distance(word, t) <= (1 if len(t) >= 5 else 0) for t in terms) else None
        got = automaton.match(word)
        assert (got == (-1, 0)) if best is None else (got == (best[1], best[0])), word


def test_toxicity_learns_and_leaves_clean_texts_alone(spark):
    from oeeflow.llm.toxicity import fit_toxicity, held_out, score_toxicity
    rng = random.Random(5)
    rows = [(i, " ".join([sentence(i, 40), *(rng.sample(["fool", "rotten", "vermin", "wretch"], 2) if i % 4 == 0 else [])])) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "rotten vermin"), (1002, "rottem vermim and a wretchh")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs, labels)
    got = {r["doc_id"]: r for r in score_toxicity(docs, model).withColumn("h", held_out(F.col("doc_id"))).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(400))
    assert got[None]["predicted"] == 1 and got[1000]["score"] == got[1001]["score"] < 0.5 and got[1002]["predicted"] == 1
    assert all(got[i]["h"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400))
    assert score_toxicity(documents(spark, []), model).count() == 0
    assert all(r["score"] < 1e-9 for r in score_toxicity(docs, fit_toxicity(docs, labels.limit(0))).collect())


def test_elias_fano_successor_and_access():
    from oeeflow.llm.eliasfano import EliasFano
    rng = np.random.default_rng(1)
    for universe, n in ((1 << 64, 1000), (5000, 1000), (1 << 40, 1), (10**12, 20000), (100, 0)):
        values = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
        seq = EliasFano.build(values, universe)
        wanted = np.concatenate([values, rng.integers(0, universe, 500, dtype=np.uint64)])
        at, found = seq.successor(wanted)
        assert (at == np.searchsorted(values, wanted)).all() and (found == np.isin(wanted, values)).all()
        assert not n or (seq.get(np.arange(len(values))) == values).all()


def test_language_model_matches_plain_counts(spark):
    from oeeflow.llm.lm import fit_trie, held_out, score_texts
    rows = [*texts(), *((100 + i, sentence(i % 3, 30)) for i in range(20))]
    docs = documents(spark, rows)
    model = fit_trie(docs.filter(~held_out(F.col("doc_id"))))
    words, pairs, tokens = Counter(), Counter(), []
    for i, t in rows:
        w = [*WORDS.findall(lower_az(t or "")), None]
        tokens.append((i, w))
        if zlib.crc32(str(i if i is not None else "").encode()) % 5 != 1:
            words.update(w)
            pairs.update(zip([0, *w[:-1]], w))
    n, v = sum(words.values()), len(words)
    assert (model.n, model.v) == (n, v)
    context, kept = Counter(), Counter()
    for (a, _), k in pairs.items():
        context[a] += k
        kept[a] += k - 0.75 if k >= 2 else 0
    want = []
    for i, w in tokens:
        one = [(words[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        two = [((k - 0.75) / context[a] if (k := pairs[a, x]) >= 2 else 0) + (1 - (kept[a] / context[a] if context[a] else 0)) * p
               for a, x, p in zip([0, *w[:-1]], w, one)]
        want.append((i, len(w), sum(words[x] > 0 for x in w), sum(map(math.log10, one)), sum(map(math.log10, two))))
    got = [tuple(r) for r in score_texts(docs, model).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 and abs(a[4] - b[4]) < 2e-3 * a[1]
    assert score_texts(documents(spark, []), model).count() == 0
    assert all(r["score"] == 0 for r in score_texts(docs, fit_trie(docs.limit(0))).collect())
