"""Document fingerprints by I-Match.

The lexicon is every term (lower-cased word) whose document frequency, counted over all documents,
lies in a band: in at least ``min_share`` and at most ``max_share`` of them. A text's terms in the
lexicon, sorted and distinct, are hashed once for each of several randomised subsets of the
lexicon, from the whole lexicon down to a 1024th of it; the list of hashes is the fingerprint, and
the share of equal ones (of those that are not empty in both) the likeness of two texts. A text
with fewer than ``MIN_TERMS`` lexicon terms is fingerprinted by all its terms.

The lexicon has at most ``(mean number of distinct terms of a text) / min_share`` terms; that bound
is what lets it be broadcast, and it is checked.

Defined results: a null text counts as empty; empty texts have the empty fingerprint and are alike
with likeness 1; equal texts have equal fingerprints; a null id sorts last. Ids are expected to be
unique (rows with one id are ordered by their text). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oeeflow.llm.common import on_workers, slices

MIN_TERMS = 4
#: Share of the lexicon in each subset. Few subsets are large (equal only for texts with the same
#: terms), many are small, so that the likeness falls gradually with the terms that differ.
SHARES = [1.0] * 2 + [1 / 4] * 2 + [1 / 16] * 4 + [1 / 64] * 8 + [1 / 256] * 12 + [1 / 1024] * 12
MAX_LEXICON = 8_000_000  # terms; reached only if texts have 8 million * min_share distinct terms on average


def _runs(texts: pa.Array):
    from oeeflow.llm.shingles import word_hashes
    return word_hashes(texts)


def _distinct_terms(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The distinct terms of each text of a run, one after another."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((words, doc))
    w, d = words[order], doc[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    return w[new]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): the hash of every term and the number of documents that have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts, counts):
            terms, where = np.unique(np.concatenate(parts), return_inverse=True)
            return terms, np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)

        held: list = [np.zeros(0, np.uint64)]
        sums: list = [np.zeros(0)]
        size = 0
        for batch in slices(batches):
            for _, words, at in _runs(batch.column(0)):
                terms = _distinct_terms(words, at)
                held.append(terms)
                sums.append(np.ones(len(terms)))
                size += len(terms)
                if size > 1_500_000:
                    terms, n = counted(held, sums)
                    held, sums, size = [terms], [n], 0
                    if len(terms) > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "df"])
                        held, sums = [np.zeros(0, np.uint64)], [np.zeros(0)]
        terms, n = counted(held, sums)
        yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "df"])

    on_workers(docs.sparkSession)
    return (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")))


def lexicon(docs: DataFrame, text_col: str = "text", min_share: float = 0.002, max_share: float = 0.2) -> np.ndarray:
    """The sorted hashes of the terms in the band."""
    n = docs.count()
    band = document_frequencies(docs, text_col).filter(
        (F.col("df") >= min_share * n) & (F.col("df") <= max_share * n)).select("term").limit(MAX_LEXICON + 1)
    terms = band.toArrow().column(0).to_numpy()
    if len(terms) > MAX_LEXICON:
        raise ValueError("the lexicon is too large to broadcast: choose a larger min_share")
    return np.sort(terms.view(np.uint64))


class Fingerprinter:
    """Signatures (uint32, one per subset; 0: no term in the subset) of many texts at once."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.values = self._subset_values(terms)

    @staticmethod
    def _subset_values(terms: np.ndarray) -> np.ndarray:
        """For each term and subset: the term's part of the subset's hash, 0 outside the subset."""
        from oeeflow.llm.shingles import mix
        out = np.zeros((len(terms), len(SHARES)), np.uint64)
        for k, share in enumerate(SHARES):
            dealt = mix(terms + np.uint64(0x1000 + k))
            inside = dealt <= np.uint64(min(2**64 - 1, int(share * 2**64)))
            out[inside, k] = mix(terms[inside] ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) | np.uint64(1)
        return out

    def signatures(self, texts: pa.Array) -> np.ndarray:
        from oeeflow.llm.shingles import mix
        out = np.zeros((len(texts), len(SHARES)), np.uint32)
        for first, words, at in _runs(texts):
            n = len(at) - 1
            doc = np.repeat(np.arange(n), np.diff(at))
            if len(self.terms):
                where = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
                inside = self.terms[where] == words
                key = np.unique(doc[inside] * np.int64(len(self.terms)) + where[inside])
                owner, term = key // len(self.terms), key % len(self.terms)
            else:
                owner = term = np.zeros(0, np.int64)
            sums = np.zeros((n, len(SHARES)), np.uint64)
            for lo in range(0, len(owner), 50_000):  # bounded blocks of (term, subset) values
                o = owner[lo:lo + 50_000]
                begins = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
                sums[o[begins]] += np.add.reduceat(self.values[term[lo:lo + 50_000]], begins, axis=0)
            for i in np.flatnonzero(np.bincount(owner, minlength=n) < MIN_TERMS):
                own = np.unique(words[at[i]:at[i + 1]])
                sums[i] = 0
                for lo in range(0, len(own), 50_000):
                    sums[i] += self._subset_values(own[lo:lo + 50_000]).sum(0, dtype=np.uint64)
            hashed = (mix(sums) >> np.uint64(32)).astype(np.uint32)
            out[first:first + n] = np.where(sums == 0, 0, np.maximum(hashed, 1))
        return out


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if (a == b).all():
        return 1.0
    some = (a != 0) | (b != 0)
    return float(((a == b) & some).sum() / some.sum())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = 0.002,
                max_share: float = 0.2) -> DataFrame:
    """(id, fingerprint) of every row."""
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_col, min_share, max_share))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Fingerprinter(terms.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([as_text(s) for s in printer.signatures(batch.column(1))], pa.string())],
                [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = 0.002,
                        max_share: float = 0.2, bucket_rows: int = 5_000) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is replaced by the
    beginning of the next document's text (by descending id, the first after the last).

    Documents are dealt to ranges of ids; each range also gets the first documents of the next
    one, so that one shuffle of the (compressed) texts brings every document to its successor.
    A task streams its range and holds two texts.
    """
    import zstandard  # noqa: F401  (needed by the tasks)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    terms = spark.sparkContext.broadcast(lexicon(rows, "text", min_share, max_share))
    ids = rows.select("doc_id")
    n = ids.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // bucket_rows))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 100 * parts) if parts > 1
                   else F.array()).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    def bucket_of(column: pa.Array) -> np.ndarray:  # falling ids, null last
        ids_ = np.asarray(column.fill_null(0))
        return np.where(np.asarray(column.is_null()), len(cuts) + 1, len(cuts) - np.searchsorted(cuts, ids_, "right"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0)), pa.int32()), batch.column(0)],
                                             ["bucket", "doc_id"])

    on_workers(spark)
    # one row per range: bounded by the number of ranges
    tops = (ids.mapInArrow(dealt, "bucket int, doc_id long").groupBy("bucket")
            .agg(F.max("doc_id").alias("top")).orderBy("bucket").collect())
    before = {r["bucket"]: tops[k - 1]["bucket"] for k, r in enumerate(tops)}
    top = {r["bucket"]: r["top"] for r in tops}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            buckets = bucket_of(batch.column(0)).tolist()
            keys = batch.column(0).to_pylist()
            blobs = [pack.compress((t or "").encode()) for t in texts]
            ties = [int.from_bytes(hashlib.blake2b((t or "").encode(), digest_size=8).digest(), "big", signed=True) for t in texts]
            guests = [i for i, (b, k) in enumerate(zip(buckets, keys)) if k == top[b]]
            pick = [*range(len(keys)), *guests]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*buckets, *(before[buckets[i]] for i in guests)], pa.int32()),
                 pa.array([False] * len(keys) + [True] * len(guests)), pa.array([keys[i] for i in pick], pa.int64()),
                 pa.array([ties[i] for i in pick], pa.int64()), pa.array([blobs[i] for i in pick], pa.binary())],
                ["bucket", "guest", "doc_id", "tie", "blob"])

    spread_rows = (rows.mapInArrow(spread, "bucket int, guest boolean, doc_id long, tie long, blob binary")
                   .repartitionById(len(cuts) + 2, "bucket")
                   .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), "tie"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        printer = Fingerprinter(terms.value)
        held = None  # the last document: (bucket, id, text, signature)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [unpack.decompress(b, max_output_size=1 << 31).decode() for b in part.column(4).to_pylist()]
                signed = printer.signatures(pa.array(texts, pa.large_string()))
                pairs = []
                for i, (b, guest, key) in enumerate(zip(*(part.column(k).to_pylist() for k in (0, 1, 2)))):
                    if held is not None and held[0] == b:
                        pairs.append((held, texts[i], signed[i]))
                    held = None if guest else (b, key, texts[i], signed[i])
                edited = []
                for (_, _, text, _), following, _ in pairs:
                    m = len(text) // 2
                    edited.append(text[:len(text) - m] + following[:m])
                marks = printer.signatures(pa.array(edited, pa.large_string()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([p[0][1] for p in pairs], pa.int64()), pa.array([len(p[0][2]) for p in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                    pa.array([as_text(p[0][3]) for p in pairs], pa.string()),
                    pa.array([as_text(m) for m in marks], pa.string()),
                    pa.array([likeness(p[0][3], m) for p, m in zip(pairs, marks)], pa.float64()),
                    pa.array([likeness(p[0][3], p[2]) for p in pairs], pa.float64())], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return spread_rows.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                           "edited_fingerprint string, near_edited double, near_next double")
