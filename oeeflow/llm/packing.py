"""Best-fit packing of tokenised documents into fixed-length sequences: a grouping genetic
algorithm (Falkenauer) run as islands on Spark.

Pieces are dealt at random to shards of about ``shard_pieces`` pieces. Every shard has ``islands``
populations of packings; a genome says which bin each piece lies in. Crossover injects whole
well-filled bins of one parent into the other, drops the bins that then hold a piece twice and
best-fits the displaced pieces. After each epoch the best genome of an island migrates to the next
island of its shard (a shuffle). A shard that reaches its lower bound ``ceil(tokens / capacity)``
rests. The least-filled bins of each shard are then dissolved and packed again across shards,
until one shard is left.

Defined results: null text counts as empty (one piece that holds the end id alone); a null or
repeated ``doc_id`` is carried as it is, repeated rows are packed once each; a text of any length
is cut into whole ``capacity`` pieces and a rest; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oeeflow.llm.common import on_workers, slices, written

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
STATE_SCHEMA = "shard long, island int, lengths binary, population binary"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise every whole text, append ``end_id`` and cut what is longer than ``capacity``.
    ``with_ids`` adds the token ids of each piece (``ids``, little-endian uint32 bytes)."""
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from oeeflow.llm.tokenizing import tokenizer
        tok = tokenizer(tokenizer_path)
        last = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            ids, at = tok.ids(batch.column(1))
            raw, at = ids.astype("<u4", copy=False).tobytes(), at.tolist()
            row, piece, start, length, crc, blobs = [], [], [], [], [], []
            for i in range(batch.num_rows):
                lo, hi = at[i], at[i + 1]
                n = hi - lo + 1
                for k, s in enumerate(range(0, n, capacity)):
                    e = min(s + capacity, n)
                    part = raw[4 * (lo + s):4 * (lo + min(e, n - 1))] + (last if e == n else b"")
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        blobs.append(part)
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(blobs, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
        pa.default_memory_pool().release_unused()  # workers are reused by later stages

    on_workers(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(cut, schema))


# ------------------------------------------------------------------ one genome

def _best_fit(lengths, todo, assign: np.ndarray, fills: list[int], capacity: int) -> None:
    """Put the pieces ``todo`` (longest first) where the least room is left; opens new bins."""
    room = sorted((capacity - f, b) for b, f in enumerate(fills) if f < capacity)
    for i in todo:
        n = lengths[i]
        k = bisect.bisect_left(room, (n, -1))
        if k < len(room):
            left, b = room.pop(k)
        else:
            left, b = capacity, len(fills)
            fills.append(0)
        assign[i] = b
        fills[b] += n
        if left > n:
            bisect.insort(room, (left - n, b))


def _renumber(assign: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, assign = np.unique(assign, return_inverse=True)
    return assign.astype(np.int32), np.bincount(assign, weights=lengths).astype(np.int64)


def _fitness(assign: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    fills = np.bincount(assign, weights=lengths)
    return -len(fills), float(((fills / capacity) ** 2).sum())


def _packed(lengths: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """A first genome: best fit on the descending order, disturbed by ``noise``."""
    order = np.argsort(-lengths * (1 + noise * rng.random(len(lengths))), kind="stable")
    assign = np.zeros(len(lengths), dtype=np.int32)
    _best_fit(lengths.tolist(), order.tolist(), assign, [], capacity)
    return assign


def _crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int,
               rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``b`` go into ``a``; bins of ``a`` with a piece that came along
    are dropped, what they lose is placed again by best fit."""
    _, fills_b = _renumber(b, lengths)
    well = np.flatnonzero(fills_b >= np.quantile(fills_b, 0.5))
    chosen = well[rng.random(len(well)) < 0.3]
    injected = np.isin(b, chosen)
    kept = ~np.isin(a, np.unique(a[injected]))
    # now and then a badly filled bin is dissolved as well (mutation)
    fills_a = np.bincount(a, weights=lengths)
    worst = np.argsort(fills_a, kind="stable")[:1 + int(0.02 * len(fills_a))]
    kept &= ~np.isin(a, worst[rng.random(len(worst)) < 0.5])
    child = np.where(injected, b + len(a), np.where(kept, a, -1))
    placed = child >= 0
    _, child_bins = np.unique(child[placed], return_inverse=True)
    assign = np.zeros(len(a), dtype=np.int32)
    assign[placed] = child_bins
    fills = np.bincount(child_bins, weights=lengths[placed]).astype(np.int64).tolist() if placed.any() else []
    todo = np.flatnonzero(~placed)
    todo = todo[np.argsort(-lengths[todo], kind="stable")]
    _best_fit(lengths.tolist(), todo.tolist(), assign, fills, capacity)
    return _renumber(assign, lengths)[0]


def _evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int,
            rng: np.random.Generator) -> list[np.ndarray]:
    bound = -(-int(lengths.sum()) // capacity)
    ranked = sorted(((_fitness(g, lengths, capacity), k, g) for k, g in enumerate(population)),
                    key=lambda x: (x[0], -x[1]), reverse=True)
    for step in range(generations):
        if -ranked[0][0][0] <= bound:
            break
        i, j = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        i, j = min(i, j), max(i, j)
        child = _crossover(ranked[j][2], ranked[i][2], lengths, capacity, rng)
        ranked.append((_fitness(child, lengths, capacity), len(ranked) + step, child))
        ranked = sorted(ranked, key=lambda x: (x[0], -x[1]), reverse=True)[:len(population)]
    return [g for _, _, g in ranked]


# ------------------------------------------------------------------ islands on Spark

def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "row_key"], ascending=[False, True], kind="stable", ignore_index=True)


def _pack_level(rows: DataFrame, level: int, capacity: int, islands: int, epochs: int, generations: int,
                size: int) -> DataFrame:
    """Pack the rows of each ``shard``; adds ``bin`` and ``fill``."""

    def found(key, pdf):
        lengths = _ordered(pdf)["length"].to_numpy(np.int64)
        out = []
        for island in range(islands):
            rng = np.random.default_rng([level, int(key[0]), island])
            first = _packed(lengths, capacity, rng, 0.0 if island == 0 else 0.02)
            done = _fitness(first, lengths, capacity)[0] >= -(-(-int(lengths.sum()) // capacity))
            genomes = [first] if done else [first, *(_packed(lengths, capacity, rng, 0.1 * k) for k in range(1, size))]
            out.append((key[0], island, lengths.tobytes(), np.concatenate(genomes).astype(np.int32).tobytes()))
            if done:  # at the lower bound: nothing to search for
                break
        return pd.DataFrame(out, columns=["shard", "island", "lengths", "population"])

    def evolve(epoch: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    lengths = np.frombuffer(r.lengths, np.int64)
                    genomes = list(np.frombuffer(r.population, np.int32).reshape(-1, len(lengths)))
                    if r.elite is not None:  # the neighbour's best replaces the worst
                        elite = np.frombuffer(r.elite, np.int32)
                        genomes = [elite, *genomes[:-1]] if len(genomes) > 1 else genomes
                    rng = np.random.default_rng([level, int(r.shard), int(r.island), epoch])
                    best = _evolve(lengths, genomes, capacity, generations, rng)
                    out.append((r.shard, r.island, r.lengths, np.concatenate(best).astype(np.int32).tobytes()))
                yield pd.DataFrame(out, columns=["shard", "island", "lengths", "population"])
        return run

    state = rows.select("shard", "length", "row_key").groupBy("shard").applyInPandas(found, STATE_SCHEMA)
    # the first genome of the population: int32 genes against int64 lengths
    best = F.expr("substring(population, 1, cast(length(lengths) / 2 as int))")
    for epoch in range(epochs):
        elites = state.select("shard", ((F.col("island") + 1) % islands).alias("island"), best.alias("elite"))
        arrived = state.join(elites, ["shard", "island"], "left") if epoch else state.withColumn("elite", F.lit(None).cast("binary"))
        state = written(arrived.select("shard", "island", "lengths", "population", "elite")
                        .mapInPandas(evolve(epoch), STATE_SCHEMA), f"pack-islands-{level}-{epoch}")

    def choose(key, pdf):
        lengths = np.frombuffer(pdf["lengths"].iloc[0], np.int64)
        ranked = sorted(((_fitness(np.frombuffer(p, np.int32)[:len(lengths)], lengths, capacity), -i, p)
                         for i, p in zip(pdf["island"], pdf["population"])), key=lambda x: x[:2], reverse=True)
        return pd.DataFrame({"shard": [key[0]], "genome": [ranked[0][2][:4 * len(lengths)]]})

    chosen = state.groupBy("shard").applyInPandas(choose, "shard long, genome binary")

    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "row_key", "shard"]

    def settle(left, right):  # Arrow keeps whole numbers whole beside nulls
        lengths = left.column("length").to_numpy()
        order = np.lexsort((left.column("row_key").to_numpy(), -lengths))  # as in _ordered
        assign = np.frombuffer(right.column("genome")[0].as_py(), np.int32).astype(np.int64)
        fills = np.bincount(assign, weights=lengths[order]).astype(np.int64)
        out = left.select(cols).take(pa.array(order))
        return out.append_column("bin", pa.array(assign)).append_column("fill", pa.array(fills[assign]))

    schema = f"{PIECE_SCHEMA}, row_key long, shard long, bin long, fill long"
    return (rows.select(*cols).groupBy("shard").cogroup(chosen.groupBy("shard"))
            .applyInArrow(settle, schema))


def best_fit_pack(piece_rows: DataFrame, capacity: int = 4096, shard_pieces: int = 4000, islands: int = 2,
                  epochs: int = 2, generations: int = 40, population: int = 6,
                  well_filled: float = 0.995, dissolve_bins: int = 24) -> DataFrame:
    """Pack the rows of :func:`pieces` into sequences of ``capacity``: adds ``sequence_id`` and
    ``offset``. ``shard_pieces`` bounds what one task holds; of each shard at most
    ``dissolve_bins`` bins filled below ``well_filled`` are packed again at the next level."""
    # the key is written with the row: a number given while reading would change with the executors
    rows = written(piece_rows.select("doc_id", "piece", "start", "length", "ids_crc32", F.monotonically_increasing_id().alias("row_key")),
                   "pack-pieces")
    # whole pieces are sequences of their own
    full = rows.filter(F.col("length") >= capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.col("row_key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = rows.filter(F.col("length") < capacity)
    n_shards = max(1, -(-rest.count() // shard_pieces))
    out, level = full, 1
    todo = rest.withColumn("shard", F.pmod(F.xxhash64("row_key"), F.lit(n_shards)))
    while True:
        packed = written(_pack_level(todo, level, capacity, islands, epochs, generations, population),
                         f"pack-level-{level}")
        again = packed.filter(F.lit(False))
        if n_shards > 1:
            bins = packed.groupBy("shard", "bin").agg(F.first("fill").alias("fill"))
            emptiest = Window.partitionBy("shard").orderBy("fill", "bin")
            worst = (bins.filter(F.col("fill") < well_filled * capacity)
                     .withColumn("k", F.row_number().over(emptiest)).filter(F.col("k") <= dissolve_bins)
                     .select("shard", "bin"))
            again = packed.join(worst, ["shard", "bin"], "left_semi")
            packed = packed.join(worst, ["shard", "bin"], "left_anti")
        w = Window.partitionBy("shard", "bin").orderBy(F.col("length").desc(), "row_key")
        before = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        number = (F.lit(level).cast("long") * F.lit(1 << 56)) + F.col("shard") * F.lit(1 << 20) + F.col("bin")
        out = out.unionByName(packed.select("doc_id", "piece", "start", "length", "ids_crc32",
                                            number.alias("sequence_id"), before.cast("long").alias("offset")))
        if n_shards == 1:
            return out
        n_shards = -(-n_shards // 64)
        todo = again.select("doc_id", "piece", "start", "length", "ids_crc32", "row_key").withColumn(
            "shard", F.pmod(F.xxhash64("row_key"), F.lit(n_shards)))
        level += 1
