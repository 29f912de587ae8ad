"""Ordered windows that never put a whole group into one task.

Rows are cut into chunks by ranges of their full order key (group columns first). The boundaries
are keys of a bounded sample, so chunks are balanced by count however rows cluster in time or in
one group; they are constants of the plan, so a recomputed task makes the same cut.

``chunked_window`` evaluates look-back window expressions (``lag``, ``rowsBetween(-k, 0)``)
per (group, chunk). A chunk that begins inside a group also takes the rows just before it, from the
``lookback``-th sampled key before its boundary: at least ``lookback`` rows, which are dropped after the
window. The result equals the unchunked window exactly; it is one lazy pass, and nothing is written.

``global_position`` gives every row its 0-based position in a total order over the whole
table, without a single-partition sort: chunks are counted, offsets summed over the (small)
chunk table, and rows numbered inside their chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_CHUNK = 1_000_000
MIN_CHUNKS = 8             # the same path at every size: small tables are cut, too
SAMPLE_PER_CHUNK = 100     # sampled keys for each boundary

#: An order column: its name, or (name, ascending, nulls last).
Order = str | tuple[str, bool, bool]


def _spec(o: Order) -> tuple[str, bool, bool]:
    return (o, True, False) if isinstance(o, str) else o


def _sort(o: Order) -> Column:
    name, asc, last = _spec(o)
    if asc:
        return F.asc_nulls_last(name) if last else F.asc_nulls_first(name)
    return F.desc_nulls_last(name) if last else F.desc_nulls_first(name)


def _rising(df: DataFrame, o: Order) -> list[Column] | None:
    """Columns that put rows in the order ``o`` when each sorts ascending with NULL first (None for a type without any)."""
    name, asc, last = _spec(o)
    kind, c = df.schema[name].dataType, F.col(name)
    if asc:
        values = [c]
    elif isinstance(kind, T.BooleanType):
        values = [~c]
    elif isinstance(kind, T.IntegralType):
        values = [F.bitwise_not(c)]
    elif isinstance(kind, (T.DoubleType, T.FloatType)):  # NaN is greater than any number
        values = [~F.isnan(c), -F.nanvl(c, F.lit(0.0))]
    elif isinstance(kind, T.DecimalType):
        values = [-c]
    elif isinstance(kind, T.DateType):
        values = [-F.unix_date(c)]
    elif isinstance(kind, T.TimestampType):
        values = [-F.unix_micros(c)]
    elif isinstance(kind, T.TimestampNTZType):
        values = [F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'") - c]
    else:
        return None
    return [c.isNull(), *values] if last else values if asc else [c.isNotNull(), *values]


def _not_after(bound: Column, specs: list[tuple[str, bool, bool]]) -> Column:
    """The boundary sorts at or before the row."""
    out = F.lit(True)
    for i, (name, asc, last) in reversed(list(enumerate(specs))):
        b, k = bound[f"k{i}"], F.col(name)
        null_first = (b.isNotNull() & k.isNull()) if last else (b.isNull() & k.isNotNull())
        before = null_first | F.coalesce(b < k if asc else b > k, F.lit(False))
        out = before | (b.eqNullSafe(k) & out)
    return out


def _join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` with NULL = NULL, keeping one copy of each key column."""
    if not cols:
        return left.crossJoin(right)
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def _same_key(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _halo_starts(found: list, bounds: list, groups: int, lookback: int) -> list[tuple]:
    """For each boundary the ``lookback``-th sampled key of its group before it (None: the group's first row)
    and how many chunks further back that key may lie."""
    out, at, chunk_of, c = [], 0, [], 0
    for r in found:
        while c < len(bounds) and _same_key(r, bounds[c]):
            c += 1
        chunk_of.append(c)
    for k, b in enumerate(bounds):
        while not _same_key(found[at], b):
            at += 1
        first = at
        while first > 0 and at - first < lookback and _same_key(found[first - 1][:groups], b[:groups]):
            first -= 1
        if at - first == lookback:
            out.append((found[first], k + 1 - chunk_of[first]))
        else:  # the group's first rows may lie before its first sampled one
            out.append((None, k + 1 - (chunk_of[first - 1] if first else 0)))
    return out


def assign_chunks(df: DataFrame, partition_by: list[str], order_by: list[Order], rows_per_chunk: int, lookback: int = 0) -> DataFrame:
    """Add ``_chunk`` (rises along ``partition_by`` and then ``order_by``). With ``lookback`` a row is repeated, with
    ``_halo`` true, for each later chunk whose rows of the same group may look back at it.

    One narrow pass over the order columns counts the rows and samples ``SAMPLE_PER_CHUNK`` keys for each
    boundary (two passes where that gives too few keys); no row is shuffled here. A row finds its chunk by
    bisection, one projection a step.
    """
    spark = df.sparkSession
    specs = [(g, True, False) for g in partition_by] + [_spec(o) for o in order_by]
    rising = [_rising(df, spec) for spec in specs]
    plain = all(rising)
    parts = [c for some in rising for c in some] if plain else [F.col(name) for name, _, _ in specs]
    parts = [c.alias(f"k{i}") for i, c in enumerate(parts)]  # a group column is one part
    keys = df.select(*parts)
    drawn = F.collect_list(F.when(F.col("_u") < SAMPLE_PER_CHUNK / rows_per_chunk, F.struct(*keys.columns)))
    n, found = keys.withColumn("_u", F.rand(17)).agg(F.count(F.lit(1)), drawn).first()  # bounded by the number of chunks
    chunks = max(MIN_CHUNKS, -(-n // rows_per_chunk))
    if n <= 2 * MIN_CHUNKS * rows_per_chunk:
        fraction = min(1.0, chunks * SAMPLE_PER_CHUNK / max(n, 1))
        found = (keys if fraction >= 1.0 else keys.sample(fraction, seed=17)).collect()
    order = [F.asc_nulls_first(c) for c in keys.columns] if plain else [_sort((f"k{i}", asc, last)) for i, (_, asc, last) in enumerate(specs)]
    found = spark.createDataFrame(found, keys.schema).orderBy(*order).collect()
    picked = [found[len(found) * c // chunks] for c in range(1, chunks)] if found else []
    bounds = [r for k, r in enumerate(picked) if k == 0 or not _same_key(r, picked[k - 1])]
    starts = _halo_starts(found, bounds, len(partition_by), lookback) if lookback else []
    columns, values = [T.StructField("_bounds", T.ArrayType(keys.schema))], [bounds]
    if lookback:
        columns.append(T.StructField("_starts", T.ArrayType(keys.schema)))
        values.append([start for start, _ in starts])
    table = spark.createDataFrame([tuple(values)], T.StructType(columns))
    j = df.crossJoin(F.broadcast(table))  # one row
    if plain:  # structs compare column by column, NULL first
        j = j.withColumn("_key", F.struct(*parts))

    def passed(bound: Column) -> Column:
        return bound <= F.col("_key") if plain else _not_after(bound, specs)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def stepped(at: Column, step: int | Column) -> Column:
        bound = F.get("_bounds", (at + (step - 1)).cast("int"))
        return at + F.when(passed(bound) if plain else bound.isNotNull() & passed(bound), step).otherwise(0)
    if plain:
        # Spark puts the steps into one another: each names the one before twice, so that the whole grows like the number of chunks
        j = j.withColumn("_chunk", F.lit(0).cast("bigint"))
        for step in steps:
            j = j.withColumn("_chunk", stepped(F.col("_chunk"), step))
    else:
        at = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), stepped) if steps else F.lit(0)
        j = j.withColumn("_chunk", at.cast("bigint"))
    if lookback:
        j = j.withColumn("_from", F.col("_chunk"))
        targets = [F.col("_chunk")]
        for ahead in range(1, max((span for _, span in starts), default=0) + 1):
            at = (F.col("_chunk") + (ahead - 1)).cast("int")
            bound, start = F.get("_bounds", at), F.get("_starts", at)
            seen = bound.isNotNull() & (start.isNull() | F.coalesce(passed(start), F.lit(False)))
            for i, g in enumerate(partition_by):
                seen = seen & bound[f"k{i}"].eqNullSafe(F.col(g))
            targets.append(F.when(seen, F.col("_chunk") + ahead))
        j = (j.withColumn("_chunk", F.explode(F.array(*targets))).filter(F.col("_chunk").isNotNull())
             .withColumn("_halo", F.col("_chunk") != F.col("_from")))
    return j.drop("_bounds", "_starts", "_key", "_from")


def chunked_window(df: DataFrame, partition_by: list[str], order_by: list[str],
                   columns: dict[str, Callable[[WindowSpec], Column]], lookback: int,
                   rows_per_chunk: int | None = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add window columns defined by ``columns[name](window_spec)``.

    Each expression may only read rows at most ``lookback`` positions before the current
    one (``lag(c, k<=lookback)``, ``rowsBetween(-lookback.., ..0)``). ``rows_per_chunk=None``
    gives the plain window partitioned by ``partition_by`` only. The result is lazy: who reads it
    several times writes what he needs of it first.
    """
    order_cols = [F.col(c) for c in order_by]
    if rows_per_chunk is None:
        w = Window.partitionBy(*partition_by).orderBy(*order_cols)
        return df.withColumns({n: f(w) for n, f in columns.items()})
    c = assign_chunks(df, partition_by, list(order_by), rows_per_chunk, max(1, int(lookback)))
    w = Window.partitionBy(*partition_by, "_chunk").orderBy(*order_cols)
    return (c.withColumns({n: f(w) for n, f in columns.items()}).filter(~F.col("_halo"))
            .select(*df.columns, *columns.keys()))


def global_position(df: DataFrame, order_by: list[Order], name: str = "_pos",
                    partition_by: list[str] | None = None,
                    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add a 0-based position in the total order ``order_by`` (per ``partition_by`` group,
    or over the whole table) without a single-partition sort.

    Rows are cut into chunks of the whole order key, chunk sizes are counted, their
    offsets summed over the small chunk table, and rows numbered inside their chunk.
    """
    part = list(partition_by or [])
    c = assign_chunks(df, part, list(order_by), rows_per_chunk)
    counts = c.groupBy(*part, "_chunk").agg(F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy(*part).orderBy("_chunk")  # one row per chunk: n / rows_per_chunk rows
    counts = counts.withColumn("_off", F.coalesce(
        F.sum("_bn").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.drop("_bn")
    j = _join_on(c, counts if part else F.broadcast(counts), [*part, "_chunk"])  # without groups a row per chunk
    w = Window.partitionBy(*part, "_chunk").orderBy(*[_sort(o) for o in order_by])
    return j.withColumn(name, F.col("_off") + F.row_number().over(w) - 1).drop("_chunk", "_off")


def cumulative_sums(df: DataFrame, order_col: str, cols: list[str], prefix: str = "cum_",
                    rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Inclusive running sums of ``cols`` along a numeric ``order_col`` with unique values,
    computed per chunk plus the chunk offsets (no single-partition window)."""
    c = assign_chunks(df, [], [order_col], rows_per_chunk)
    tot = c.groupBy("_chunk").agg(*[F.sum(x).alias(f"_t_{x}") for x in cols])
    wb = Window.orderBy("_chunk")  # one row per chunk
    tot = tot.select("_chunk", *[F.coalesce(F.sum(f"_t_{x}").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)).alias(f"_o_{x}") for x in cols])
    j = c.join(tot, "_chunk", "inner")
    w = Window.partitionBy("_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = j.withColumns({f"{prefix}{x}": F.col(f"_o_{x}") + F.sum(x).over(w) for x in cols})
    return out.drop("_chunk", *[f"_o_{x}" for x in cols])
