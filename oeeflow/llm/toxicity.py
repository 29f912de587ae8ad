"""Toxicity from a learned lexicon, misspelled terms included.

Fit, on a bounded sample of labelled rows: words whose presence speaks for the label (log odds with
a significance bound) become the lexicon, a trie. Words are matched by the intersection of the trie
with Levenshtein automata: the states of that product are made as they are met and kept, so a word
costs one step per letter until it can no longer match. A chunk between blanks is matched whole and
by its runs of letters and digits ("moron/clown", "idiot's"). Misspelled matches have a weight of their
own per term: the log odds of near matches in the same sample (one more toxic text than was seen),
never more than a share of the exact weight, so that ordinary words that lie near a term do not count. A window around each match tells quotation from
abuse (marks of quotation on both sides weaken a match, second-person words strengthen it). A
logistic model over the sums gives the score.

Defined results: null and empty texts have no matches and get the score of a text without any;
rows are scored one by one, so repeated rows get equal scores; a null id counts as held out and is
never learned from; without labelled rows of both classes every score is 0. An empty table gives an
empty result. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oeeflow.llm.common import on_workers, slices, written

SAMPLE_ROWS = 20_000   # labelled rows (about) that the model is fitted on
MAX_TERMS = 4_096      # size of the lexicon

#: Second-person words and words that report speech, in the four languages.
SECOND_PERSON = {"you", "your", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "tú", "te", "usted"}
REPORTING = {"said", "says", "called", "quoted", "wrote", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"}
_OPEN, _CLOSE = "\"“„«‘'", "\"”“»’'"


class LexiconAutomaton:
    """Best match of a word in a lexicon within Levenshtein distance 1 (exact only for terms under
    ``min_fuzzy`` letters). ``match`` gives (term, distance) or (-1, 0)."""

    def __init__(self, terms: list[str], min_fuzzy: int = 5):
        self.kids: list[dict[str, int]] = [{}]
        self.term = [-1]
        self.length = [len(t) for t in terms]
        for k, word in enumerate(terms):
            node = 0
            for c in word:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.term.append(-1)
                node = self.kids[node][c]
            self.term[node] = k
        self.min_fuzzy = min_fuzzy
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.accept: list[tuple[int, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        for n, e in list(nodes.items()):  # a letter of the term left out of the word
            if e == 0:
                for child in self.kids[n].values():
                    nodes.setdefault(child, 1)
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.term[n]) for n, e in key
                    if self.term[n] >= 0 and (e == 0 or self.length[self.term[n]] >= self.min_fuzzy)]
            e, t = min(ends, default=(0, -1))
            self.accept.append((t, e))
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}
        for n, e in self.sets[state]:
            same = self.kids[n].get(c)
            if same is not None and nodes.get(same, 2) > e:
                nodes[same] = e
            if e == 0:  # a letter too many, or another letter
                nodes.setdefault(n, 1)
                for child in self.kids[n].values():
                    nodes.setdefault(child, 1)
        self.steps[state][c] = to = self._state(nodes)
        return to

    def match(self, word: str) -> tuple[int, int]:
        at, steps = self.start, self.steps
        for c in word:
            to = steps[at].get(c)
            at = self._step(at, c) if to is None else to
            if at < 0:
                return -1, 0
        return self.accept[at]


@dataclass
class ToxicityModel:
    terms: list[str] = field(default_factory=list)
    exact: list[float] = field(default_factory=list)
    fuzzy: list[float] = field(default_factory=list)
    bias: float = -50.0
    coefficients: tuple[float, ...] = (0.0, 0.0)


_held: dict[tuple, tuple] = {}
_JOINTS = re.compile(r"[\W_]+")  # the same runs as [^\p{L}\p{N}]+, at which the lexicon's words are split


def _matcher(terms: tuple[str, ...]):
    """(table, found): the table gives each chunk a place in ``found``, the list of the sets of
    (term, distance) that chunks match, or -1."""
    from oeeflow.llm.chunks import PUNCTUATION, ChunkTable
    if terms not in _held:
        _held.clear()
        automaton = LexiconAutomaton(list(terms))
        found: list[tuple[tuple[int, int], ...]] = []
        places: dict[tuple[tuple[int, int], ...], int] = {}

        def learn(chunk: str) -> tuple[int]:
            whole = chunk.strip(PUNCTUATION).lower()
            best: dict[int, int] = {}
            for word in {whole, *_JOINTS.split(whole)} - {""}:  # whole: masked spellings ("id*ot")
                term, distance = automaton.match(word)
                if term >= 0:
                    best[term] = min(distance, best.get(term, distance))
            if not best:
                return (-1,)
            key = tuple(sorted(best.items()))
            if key not in places:
                places[key] = len(found)
                found.append(key)
            return (places[key],)
        _held[terms] = (ChunkTable(learn, 1), found)
    return _held[terms]


def _context(chunks: pa.Array, at: int, lo: int, hi: int, window: int, quoted: float, addressed: float) -> float:
    """Weight of a match by the words around it."""
    before = chunks.slice(max(lo, at - window), at - max(lo, at - window)).to_pylist()
    own = chunks[at].as_py()
    after = chunks.slice(at + 1, min(hi, at + 1 + window) - at - 1).to_pylist()
    opened = own[:1] in _OPEN and own[:1] != "" or any(w[:1] and w[:1] in _OPEN for w in before)
    closed = any(w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1:] in _CLOSE for w in [own, *after])
    weight = 1.0
    if (opened and closed) or any(w.strip(".,;:").lower() in REPORTING for w in before):
        weight *= quoted
    if any(w.strip(".,;:!?").lower() in SECOND_PERSON for w in [*before, *_JOINTS.split(own.lower()), *after]):
        weight *= addressed
    return weight


def lexicon_matches(docs: DataFrame, terms: list[str], id_col: str, text_col: str, window: int = 6,
                    quoted: float = 0.35, addressed: float = 1.2) -> DataFrame:
    """Per row: id, ``n_chunks`` (space-separated), and ``hits``: for each matched term, exact and
    misspelled apart, the largest context weight of its matches."""
    names = tuple(terms)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_chunks", T.LongType()),
                           *[T.StructField(n, T.ArrayType(T.IntegerType() if n != "weight" else T.DoubleType()))
                             for n in ("term", "distance", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, found = _matcher(names)
        for batch in slices(batches, 2048):
            chunks, values, at = table.look_up(batch.column(1))
            hits: list[dict] = [{} for _ in range(batch.num_rows)]
            where = np.flatnonzero(values[:, 0] >= 0)
            for p, i in zip(where.tolist(), (np.searchsorted(at, where, "right") - 1).tolist()):
                w = _context(chunks, p, int(at[i]), int(at[i + 1]), window, quoted, addressed)
                for key in found[int(values[p, 0])]:
                    hits[i][key] = max(w, hits[i].get(key, 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at), pa.int64()),
                 pa.array([[t for t, _ in h] for h in hits], pa.list_(pa.int32())),
                 pa.array([[d for _, d in h] for h in hits], pa.list_(pa.int32())),
                 pa.array([list(h.values()) for h in hits], pa.list_(pa.float64()))],
                ["id", "n_chunks", "term", "distance", "weight"])

    on_workers(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _sums(matches: DataFrame, model: ToxicityModel) -> DataFrame:
    """Over the matched terms, exact and misspelled: the sum of their weights and the largest."""
    def weighed(distance: int, weights: list[float]) -> Column:
        table = F.array(*[F.lit(float(w)) for w in weights]) if weights else F.array(F.lit(0.0))
        pairs = F.filter(F.arrays_zip("term", "distance", "weight"), lambda h: h["distance"] == distance)
        return F.transform(pairs, lambda h: h["weight"] * F.coalesce(F.get(table, h["term"]), F.lit(0.0)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    weights = F.concat(weighed(0, model.exact), weighed(1, model.fuzzy))
    return matches.select("id", "n_chunks", total(weights).alias("total"),
                          F.coalesce(F.array_max(weights), F.lit(0.0)).alias("strongest"))


FEATURES = ("total", "strongest")


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, max_terms: int = MAX_TERMS) -> ToxicityModel:
    """Fit on about ``sample_rows`` labelled rows that are not held out, chosen by hash of the id."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one_in = max(1, -(-usable.count() // sample_rows))
    chosen = (usable.filter(F.pmod(F.xxhash64(id_col), F.lit(one_in)) == 0)
              .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    sample = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                     .join(F.broadcast(chosen), "id"), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return ToxicityModel()
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    counts = (sample.select("label", F.explode(words).alias("w")).filter("length(w) >= 3").groupBy("w")
              .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")))
    a = 0.5
    odds = (F.log((F.col("pos") + a) / (n_pos + 2 * a)) - F.log((F.col("neg") + a) / (n_neg + 2 * a)))
    z = F.col("weight") / F.sqrt(1 / (F.col("pos") + a) + 1 / (F.col("neg") + a))
    lexicon = (counts.filter(F.col("pos") >= max(3, math.ceil(0.002 * n_pos))).withColumn("weight", odds)
               .withColumn("z", z).filter("weight > 2.5 and z > 3")
               .orderBy(F.col("z").desc(), "w").limit(max_terms).collect())
    if not lexicon:
        return ToxicityModel()
    model = ToxicityModel([r["w"] for r in lexicon], [r["weight"] for r in lexicon])
    matches = written(lexicon_matches(sample, model.terms, "id", "text"), "toxicity-matches").join(
        sample.select("id", "label"), "id")
    # weights of misspelled matches, in texts without an exact one of any term
    near = matches.filter(~F.array_contains("distance", 0)).select("label", F.explode("term").alias("t")).groupBy("t").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    seen = {r["t"]: (r["pos"], r["neg"]) for r in near.collect()}  # a row per term of the bounded lexicon
    model.fuzzy = []
    for k, weight in enumerate(model.exact):
        pos, neg = seen.get(k, (0, 0))
        own = math.log((pos + 1.5) / (n_pos + 2)) - math.log((neg + a) / (n_neg + 2 * a))
        model.fuzzy.append(max(0.0, min(0.85 * weight, own)))
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Matrices
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        _sums(matches, model).join(sample.select("id", "label"), "id"))
    at_least_0 = Matrices.dense(1, len(FEATURES), [0.0] * len(FEATURES))
    fitted = LogisticRegression(labelCol="label", maxIter=50, lowerBoundsOnCoefficients=at_least_0).fit(rows)
    model.bias, model.coefficients = float(fitted.intercept), tuple(float(c) for c in fitted.coefficients)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` (0 to 1) and ``predicted`` (score at least 0.5)."""
    sums = _sums(lexicon_matches(docs, model.terms, id_col, text_col), model)
    linear = F.lit(model.bias)
    for c, w in zip(FEATURES, model.coefficients):
        linear = linear + F.col(c) * F.lit(w)
    score = 1 / (1 + F.exp(-linear))
    return sums.select(F.col("id").alias(id_col), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
