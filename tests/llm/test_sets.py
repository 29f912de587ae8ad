"""Operators on whole tables: mixing, packing, fingerprints, archives, similarity join, pipeline."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import WORDS, brute_components, documents, sentence, texts


def sized(docs):
    from oeeflow.llm.common import word_count
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def test_word_count(spark):
    got = Counter((r["doc_id"], r["size"]) for r in sized(documents(spark)).collect())
    assert got == Counter((i, len(WORDS.findall(t or ""))) for i, t in texts())


def test_mix_reaches_targets_and_caps(spark):
    from oeeflow.llm.mixing import mix_to_weights
    rng = random.Random(2)
    rows = [(i, f"s{min(3, int(rng.random() * 6))}" if i % 50 else None, rng.randint(0, 40)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mix_to_weights(docs).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in got)
    source = {i: s for i, s, _ in rows}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        s = source[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    budget = sum(size.values())
    order = sorted(x for x in size if x is not None) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    want, open_, left = {}, set(size), budget
    while True:  # share by weight, stop at the caps, share the excess again
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3 * size[s]
            left -= 3 * size[s]
        open_ -= over
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 * budget and abs(taken[s] - want[s]) <= 80, s
    assert sum(taken.values()) <= budget
    again = {r["doc_id"]: r["taken"] for r in mix_to_weights(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mix_awkward_rows(spark):
    from oeeflow.llm.mixing import apply_mix, mix_to_weights
    docs = documents(spark)
    assert mix_to_weights(sized(docs)).count() == len(texts())
    assert mix_to_weights(sized(docs.limit(0))).count() == 0
    assert all(r["taken"] == 0 for r in mix_to_weights(sized(documents(spark, [(1, ""), (2, None)]))).collect())
    assert apply_mix(docs, F.length(F.coalesce("text", F.lit("")))).columns == docs.columns


def check_packing(rows, capacity):
    bins: dict = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append(r)
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(bins)


def test_pieces_and_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from oeeflow.llm.packing import best_fit_pack, pieces
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [*texts(), (2**60 + 1, "a large id"), (50, "don't STOP <|endoftext|> İstanbul ß x<|y É É a..b w! 12 ½"), (51, "<|ENDOFTEXT|> \x1c\x85 q")]
    docs = documents(spark, rows)
    got = best_fit_pack(pieces(docs, path, capacity=256), capacity=256, shard_pieces=40).collect()
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        ids = np.asarray([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 256):
            want[i, k // 256, k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    n = check_packing(got, 256)
    assert n <= -(-sum(r["length"] for r in got) // 256) + 1
    assert best_fit_pack(pieces(documents(spark, []), path)).count() == 0


def test_grouping_genetic_search_improves_on_best_fit():
    from oeeflow.llm.packing import _crossover, _evolve, _fitness, _packed
    rng = np.random.default_rng(4)
    lengths = rng.integers(300, 700, 120).astype(np.int64)
    first = [_packed(lengths, 1000, np.random.default_rng(k), 0.2 * k) for k in range(4)]
    child = _crossover(first[0], first[1], lengths, 1000, rng)
    assert np.bincount(child, weights=lengths).max() <= 1000 and len(child) == len(lengths)
    best = _evolve(lengths, first, 1000, 60, rng)
    assert _fitness(best[0], lengths, 1000) >= max(_fitness(g, lengths, 1000) for g in first)


def test_fingerprints_and_edited_texts(spark):
    from oeeflow.llm.fingerprints import compare_with_edited
    rows = [(i, t) for i, t in dict(texts()).items() if i is not None] + [(100 + k, sentence(k % 9, 50)) for k in range(60)]
    for bucket_rows in (5, 5000):
        got = {r["doc_id"]: r for r in compare_with_edited(documents(spark, rows), bucket_rows=bucket_rows).collect()}
        assert len(got) == len(rows)
        order = sorted(rows, reverse=True)
        for k, (i, t) in enumerate(order):
            t, following = t or "", order[(k + 1) % len(order)][1] or ""
            m = len(t) // 2
            edited = t[:len(t) - m] + following[:m]
            r = got[i]
            assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            if t == edited:
                assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
        by_text: dict = {}
        for i, t in rows:
            assert by_text.setdefault(t or "", got[i]["fingerprint"]) == got[i]["fingerprint"]
    assert compare_with_edited(documents(spark, [])).count() == 0
    assert compare_with_edited(documents(spark, [*texts()])).count() == len(texts())


def test_document_frequencies_count_all_documents(spark):
    from oeeflow.llm.fingerprints import document_frequencies
    got = Counter(r["df"] for r in document_frequencies(documents(spark)).collect())
    want = Counter(Counter(w for _, t in texts() for w in {x.lower() if x.isascii() else x for x in WORDS.findall(t or "")}).values())
    assert got == want


PAGES = [(3, "u", "aé"), (1, "v", "aé"), (None, "w", "aé"), (7, None, None), (8, "q", ""), (9, "z", "x" * 100_000), (9, "z", "x" * 100_000)]


def test_archives_round_trip(spark, tmp_path):
    from oeeflow.llm.warc import archive_pages, page_number, read_archive
    pages = spark.createDataFrame([(*p, "e", 1) for p in PAGES], "page_id long, url string, html string, record_type string, first int")
    archive_pages(pages, str(tmp_path / "a"))
    rows = read_archive(spark, str(tmp_path / "a")).withColumns({"id": page_number(F.col("record_id")), "to": page_number(F.col("refers_to"))}).collect()
    assert Counter((r["id"], r["record_type"], r["to"]) for r in rows) == Counter(
        [(3, "revisit", 1), (1, "response", None), (None, "revisit", 1), (7, "response", None), (8, "revisit", 7), (9, "response", None), (9, "response", None)])
    for r in rows:
        html = next(h or "" for i, _, h in PAGES if i == r["id"]).encode()
        assert r["payload_bytes"] == len(html) and r["payload_digest"] == base64.b32encode(hashlib.sha1(html).digest()).decode()
        assert r["payload"] == (None if r["record_type"] == "revisit" else html)
    only = read_archive(spark, str(tmp_path / "a"), payload=False).filter("record_type = 'revisit' and target_uri in ('u', 'q')")
    assert {r["target_uri"] for r in only.collect()} == {"u", "q"} and all(r["payload"] is None for r in only.collect())
    # files of other writers: one gzip member, and none
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "a").glob("*.gz")))
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.warc.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "b/y.warc").write_bytes(raw)
    assert read_archive(spark, str(tmp_path / "b")).count() == 2 * len(PAGES)
    archive_pages(pages.limit(0), str(tmp_path / "c"))
    assert read_archive(spark, str(tmp_path / "c")).count() == 0


def test_a_spoilt_record_changes_its_row(spark, tmp_path):
    from oeeflow.llm.warc import archive_pages, page_number, read_measured
    archive_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"), str(tmp_path / "e"))
    (tmp_path / "f").mkdir()
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "e").glob("*.gz")))
    (tmp_path / "f/whole.warc").write_bytes(raw)
    (tmp_path / "g").mkdir()
    (tmp_path / "g/spoilt.warc").write_bytes(raw.replace(b"x" * 500, b"x" * 499 + b"y", 1))
    read = {k: Counter((r["id"], r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in
                       read_measured(spark, str(tmp_path / k)).withColumn("id", page_number(F.col("record_id"))).collect()) for k in "efg"}
    assert read["e"] == read["f"] and sum(read["e"].values()) == len(PAGES)
    assert [k[0] for k in (read["g"] - read["e"])] == [9] and sum((read["g"] - read["e"]).values()) == 1


def test_small_payloads_are_not_revisits(spark, tmp_path):
    from oeeflow.llm.warc import archive_pages, read_archive
    archive_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"), str(tmp_path / "d"), min_payload=3)
    assert read_archive(spark, str(tmp_path / "d")).filter("record_type = 'revisit' and payload_bytes < 3").count() == 0


def near_rows():
    rng = random.Random(11)
    rows = list(texts())
    base = [f"v{rng.randrange(5000)}" for _ in range(400)]
    passage = " ".join(f"p{i}" for i in range(60))
    for k in range(60):  # near copies of one text, some of them near the threshold
        w = list(base)
        for _ in range(k % 12):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        rows.append((200 + k, " ".join(w)))
    rows += [(300 + k, passage + " " + sentence(50 + k, 20 + k)) for k in range(40)]  # a passage that many share
    rows += [(400 + k, "a b c d e f g h".rsplit(" ", k)[0]) for k in range(8)]
    return rows


@pytest.mark.parametrize("shingle,percent", [(4, 85), (5, 80), (3, 50)])
def test_similarity_join_matches_all_pairs(spark, monkeypatch, shingle, percent):
    from oeeflow.llm import simjoin
    rows = near_rows()
    want = Counter((i, c) for (i, _), c in zip(rows, brute_components(rows, shingle, percent).values()))
    for weight in (1 << 21, 3000):  # one tree a block, and blocks cut into many chunks
        monkeypatch.setattr(simjoin, "CHUNK_WEIGHT", weight)
        got = simjoin.near_duplicates(documents(spark, rows), shingle=shingle, threshold=percent / 100).collect()
        assert Counter((r["doc_id"], r["component_id"]) for r in got) == want


def test_signature_tree_drops_no_link():
    from oeeflow.llm.simjoin import jaccard_links
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(300) < p], rng.integers(0, 2**63, int(rng.integers(0, 60)), dtype=np.uint64)]))
            for p in rng.uniform(0.6, 1, 150)]
    label = jaccard_links(sets, None, 0.8)
    want = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(x, sets[j]))
            if both >= 0.8 * (len(x) + len(sets[j]) - both):
                old, new = sorted((want[i], want[j]), reverse=True)
                want = [new if w == old else w for w in want]
    groups = lambda names: {frozenset(np.flatnonzero(np.array(names) == n).tolist()) for n in set(names)}
    assert groups(label.tolist()) == groups(want)


def test_keep_one_and_empty_tables(spark):
    from oeeflow.llm.simjoin import keep_one, near_duplicates
    docs = documents(spark)
    kept = keep_one(docs, shingle=4, threshold=0.85)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and not ids[2] and not ids[12] and ids[4] == 1 and not ids[None] and ids[5] == ids[6] == 1
    assert near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_judges_texts_not_ids(spark):
    from oeeflow.llm.simjoin import keep_one
    a, b, c = sentence(1, 80), sentence(2, 80), sentence(3, 80)
    rows = [(1, a), (2, a + " tail"), (2, b), (3, b + " end"), (3, b + " end"), (3, c), (None, c + " more"), (None, sentence(4, 80)),
            (None, sentence(4, 80) + " x"), (7, None), (7, ""), (7, None)]
    kept = Counter((r["doc_id"], r["text"]) for r in keep_one(documents(spark, rows), shingle=4, threshold=0.85).collect())
    want = Counter([(1, a), (2, b), (3, c), (7, None), (7, "")])
    assert {k: n for k, n in kept.items() if k[0] is not None} == want
    assert sum(n for k, n in kept.items() if k[0] is None) == 1          # one of the two near copies without id


def test_packing_survives_other_parallelism(spark, monkeypatch):
    """Each written table is read with other splits, as when executors come or go between jobs."""
    from oeeflow.llm import packing
    plain, calls = packing.written, []

    def written(df, name):
        calls.append(name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", ["64k", "8m", "16k", "128m"][len(calls) % 4])
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str([2, 7, 3][len(calls) % 3]))
        return plain(df, name)
    monkeypatch.setattr(packing, "written", written)
    rng = random.Random(8)
    rows = [(i, 0, 0, rng.randint(1, 4000), 1) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(6)
    try:
        got = packing.best_fit_pack(df, shard_pieces=2000).collect()
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism"):
            spark.conf.unset(k)
    assert sorted(r["doc_id"] for r in got) == list(range(9000)) and len(calls) > 4
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= 1.02 * -(-sum(r[3] for r in rows) // 4096) + 2


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    rows = [(i, f"the of and {t}") for i, t in near_rows() if i is not None]
    (tmp_path / "sf").mkdir()
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "sf/documents.parquet"))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path / "sf"))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
    check_packing(corpus_pipeline.run(spark, str(tmp_path / "sf")).collect(), 4096)


def test_packing_searches_where_best_fit_misses_the_bound(spark):
    from oeeflow.llm.packing import best_fit_pack
    lengths = np.random.default_rng(5).integers(900, 1900, 2000).tolist()
    df = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                               "doc_id long, piece int, start long, length long, ids_crc32 long").coalesce(1)
    found, short = best_fit_pack(df).collect(), best_fit_pack(df, generations=4, population=3).collect()
    assert len(found) == 2000
    assert len({r.sequence_id for r in found}) < len({r.sequence_id for r in short})  # as many as before: 4 steps, 3 genomes
