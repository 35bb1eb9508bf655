"""Global order operators without a single-partition window.

Spark plans ``Window.orderBy(c)`` without a partition key as
``Exchange SinglePartition``: the whole table goes through one task.  Every
operator here instead uses a *distributed prefix sum*:

1. the sort key is mapped to one of ``B`` range buckets by boundaries computed
   once with ``percentile_approx`` (``B`` literals in the plan, so every
   re-execution - e.g. after an executor is lost - assigns the same bucket);
2. a running sum inside each bucket (a window partitioned by bucket: ``B``
   parallel tasks of about ``rows / B`` rows each);
3. bucket totals (at most ``B + 1`` rows, collected) turned into exclusive
   offsets applied as literals indexed by bucket (grouped sums: a table of
   offsets per group, broadcast only behind a count).

Callers pre-aggregate duplicate keys first (``groupBy(key).count()``), so a key
that holds a third of all rows is still one row here and cannot skew a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions

# Largest table (rows) that is broadcast after its size was counted.
BROADCAST_ROWS = 2_000_000

_BUCKET = "__bucket"


def _cols(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _width(t) -> int:
    """Rough bytes per value (Spark's own default sizes: 8 for numbers, 20 for text)."""
    from pyspark.sql import types as T

    if isinstance(t, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(t, (T.ShortType,)):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.DecimalType)):
        return 8
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 20
    if isinstance(t, T.StructType):
        return sum(_width(f.dataType) for f in t.fields)
    return 1024  # arrays, maps, vectors: about 128 doubles


def broadcast_if_small(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a counted size bound.

    Both the counted rows and the estimated bytes (rows x the schema's default
    width) must be small; the byte budget is 4x the session's
    ``spark.sql.autoBroadcastJoinThreshold`` (at least 32 MB); a threshold of
    -1 switches the hint off.
    """
    conf = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760") or "10485760")
    if conf.strip() == "-1":
        return df  # broadcasts are switched off
    width = sum(_width(f.dataType) for f in df.schema.fields) + 8
    plain = conf.strip().rstrip("bB")
    budget = max(4 * int(plain), 32 << 20) if plain.isdigit() else 32 << 20
    return F.broadcast(df) if (n_rows <= max_rows and n_rows * width <= budget) else df


def join_null_safe(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which NULL matches NULL; the keys come from ``left`` (once)."""
    keys = _cols(on)
    renamed = right.select(*[F.col(k).alias(f"__ns_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(F.col(f"__ns_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__ns_{k}" for k in keys])


def boundary_sketch(key: Column, n_buckets: int, accuracy: int = 20000) -> Column:
    """Aggregate expression: the ``n_buckets - 1`` equi-depth split points of ``key``
    (a bounded sketch per partition); combine with other aggregates in one pass."""
    qs = [i / n_buckets for i in range(1, max(2, n_buckets))]
    return F.percentile_approx(key.cast("double"), qs, accuracy)


def range_boundaries(df: DataFrame, key: Column, n_buckets: int, accuracy: int = 20000) -> list[float]:
    """Up to ``n_buckets - 1`` increasing split points of ``key`` (as double).

    One distributed pass (``percentile_approx`` keeps a bounded sketch per
    partition); only the split points reach the driver.
    """
    if n_buckets <= 1:
        return []
    row = df.select(boundary_sketch(key, n_buckets, accuracy).alias("q")).first()
    return increasing_points(row["q"] if row is not None else None)


def increasing_points(pts) -> list[float]:
    """Strictly increasing, non-NULL, non-NaN split points from a sketch result."""
    if not pts:
        return []
    out: list[float] = []
    for p in pts:
        if p is None or (isinstance(p, float) and math.isnan(p)):
            continue
        if not out or p > out[-1]:
            out.append(float(p))
    return out


def with_range_bucket(df: DataFrame, key: Column, boundaries: list[float], descending: bool = False) -> DataFrame:
    """Add ``__bucket``: a monotone function of ``key``; NULL keys get -1 (first)."""
    tmp = "__bkey"
    if not boundaries:
        bucket = F.lit(0)
        out = df.withColumn(_BUCKET, F.when(key.isNull(), F.lit(-1)).otherwise(bucket))
        return out
    splits = [-math.inf] + boundaries + [math.inf]
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=_BUCKET + "_d", handleInvalid="keep")
    with_key = df.withColumn(tmp, key.cast("double"))
    out = b.transform(with_key)
    n_b = len(splits) - 1
    bcol = F.col(_BUCKET + "_d").cast("int")
    if descending:
        bcol = F.lit(n_b - 1) - bcol
    # NaN sorts after every number in Spark: keep it in the last bucket.
    nan_bucket = F.lit(0) if descending else F.lit(n_b - 1)
    out = out.withColumn(
        _BUCKET,
        F.when(F.col(tmp).isNull(), F.lit(-1)).when(F.isnan(F.col(tmp)), nan_bucket).otherwise(bcol),
    )
    return out.drop(tmp, _BUCKET + "_d")


def prefix_sum(
    df: DataFrame,
    order_by: Sequence[Column],
    bucket_key: Column,
    values: Sequence[str],
    partition_by: str | Sequence[str] | None = None,
    descending: bool = False,
    n_buckets: int | None = None,
    suffix: str = "_cum",
    grand: dict | None = None,
) -> DataFrame:
    """Inclusive running sums of ``values`` in the total order ``order_by``.

    ``order_by`` must be a *total* order (distinct keys or key + unique id);
    ``bucket_key`` is a numeric expression that is monotone (non-decreasing,
    or non-increasing when ``descending``) in that order.  NULL keys sort first.
    Adds one ``<value><suffix>`` column per value.

    Without ``partition_by``, a dict passed as ``grand`` receives each value's
    grand total and the input's row count (key ``"rows"``) - read from the
    bucket totals this operator collects anyway, so callers need no extra job.
    """
    parts = _cols(partition_by)
    spark = df.sparkSession
    nb = n_buckets or max(2, shuffle_partitions(spark))
    bounds = range_boundaries(df, bucket_key, nb)
    bucketed = with_range_bucket(df, bucket_key, bounds, descending)

    w_in = (
        Window.partitionBy(*parts, _BUCKET)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = bucketed.select(
        "*", *[F.sum(F.col(v)).over(w_in).alias(f"__loc_{v}") for v in values]
    )

    totals = bucketed.groupBy(*parts, _BUCKET).agg(
        *[F.sum(F.col(v)).alias(f"__tot_{v}") for v in values], F.count(F.lit(1)).alias("__rows")
    )
    if not parts:
        # at most len(bounds) + 2 rows (a proven bound): offsets become literals
        # indexed by bucket - no single-partition window, no join
        tot = {r[_BUCKET]: r for r in totals.collect()}
        if grand is not None:
            grand["rows"] = sum(int(r["__rows"]) for r in tot.values())
            for v in values:
                grand[v] = sum((r[f"__tot_{v}"] or 0) for r in tot.values())
        n_b = len(bounds) + 1
        offs_exprs = []
        for v in values:
            acc, offs = 0, []
            for b in range(-1, n_b):
                offs.append(acc)
                row = tot.get(b)
                acc += (row[f"__tot_{v}"] or 0) if row is not None else 0
            arr = F.array(*[F.lit(o) for o in offs])
            offs_exprs.append((F.col(f"__loc_{v}") + F.element_at(arr, F.col(_BUCKET) + 2)).alias(f"{v}{suffix}"))
        return local.select(*[c for c in df.columns], *offs_exprs)
    w_off = Window.partitionBy(*parts).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts,
        _BUCKET,
        *[F.coalesce(F.sum(f"__tot_{v}").over(w_off), F.lit(0)).alias(f"__off_{v}") for v in values],
    )
    offsets = broadcast_if_small(offsets, offsets.count())
    joined = join_null_safe(local, offsets, [*parts, _BUCKET])
    out = joined.select(
        *[c for c in df.columns],
        *[(F.col(f"__loc_{v}") + F.col(f"__off_{v}")).alias(f"{v}{suffix}") for v in values],
    )
    return out


def value_counts_prefix(
    df: DataFrame,
    col: str,
    partition_by: str | Sequence[str] | None = None,
    descending: bool = False,
    extra_sums: dict[str, Column] | None = None,
    grand: dict | None = None,
) -> DataFrame:
    """Distinct values of ``col`` with counts and inclusive cumulative counts.

    Rows: ``partition..., col, n, n_cum`` (+ ``<name>, <name>_cum`` for each
    ``extra_sums`` expression).  Pre-aggregation happens before any shuffle of
    the value table, so duplicate keys collapse map-side.
    """
    parts = _cols(partition_by)
    extra = extra_sums or {}
    counts = df.groupBy(*parts, col).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(k) for k, e in extra.items()]
    )
    key = F.col(col)
    if descending:
        order = [F.col(col).desc_nulls_first()]
    else:
        order = [F.col(col).asc_nulls_first()]
    bucket_key = key
    if dict(counts.dtypes)[col] in ("string",):
        raise TypeError("value_counts_prefix needs a numeric/orderable-as-number column")
    return prefix_sum(counts, order, bucket_key, ["n", *extra.keys()], partition_by=parts, descending=descending,
                      grand=grand)


def percent_rank_global(df: DataFrame, col: str, out: str = "percent_rank") -> DataFrame:
    """``percent_rank() over (order by col)`` without a single-partition window.

    ``(rows with a smaller key) / (n - 1)``; NULLs first with rank 0 and counted
    in ``n`` (trap T6); ``n = 1`` gives 0.0.  Value counts are pre-aggregated,
    ranked with :func:`prefix_sum`, and joined back null-safely.  The value
    table is broadcast only when its counted size is small; otherwise the
    shuffle join relies on AQE skew-join splitting for hot keys.
    """
    grand: dict = {}
    vc = value_counts_prefix(df, col, grand=grand)  # fills the totals while planning
    total, distinct = int(grand.get("n") or 0), int(grand.get("rows") or 0)
    denom = F.lit(float(max(total - 1, 1)))
    ranks = vc.select(
        F.col(col).alias("__rk_key"),
        (F.when(F.lit(total) <= 1, F.lit(0.0)).otherwise((F.col("n_cum") - F.col("n")).cast("double") / denom)).alias(out),
    )
    ranks = broadcast_if_small(ranks, distinct)
    joined = df.join(ranks, df[col].eqNullSafe(ranks["__rk_key"]), "left").drop("__rk_key")
    return joined


def exact_quantiles(
    df: DataFrame,
    col: str,
    qs: Sequence[float],
    interpolate: bool = False,
    partition_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Exact quantiles of ``col`` (NULL and NaN ignored).

    ``interpolate=False``: the element at rank ``max(1, ceil(q*n))`` - what
    ``approxQuantile(col, [q], 0)`` returns (trap T2).  ``interpolate=True``:
    linear interpolation between ranks ``floor((n-1)q)`` and ``ceil((n-1)q)``
    (``percentile`` / numpy's default).

    Returns one row per partition group with columns ``q0, q1, ...`` (doubles).
    Distributed: value counts + prefix sums; no per-value map in one task.
    """
    parts = _cols(partition_by)
    return quantiles_from_counts(grouped_value_counts(df, col, parts), qs, interpolate, parts)


def grouped_value_counts(df: DataFrame, col: str, partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """``partition..., __v, n``: rows per value (NULL and NaN values left out), written once.

    Everything that follows (totals, boundaries, prefix sums, whiskers) reads
    this table, so the input is evaluated exactly once.
    """
    parts = _cols(partition_by)
    clean = df.select(*parts, F.col(col).cast("double").alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan(F.col("__v"))
    )
    return cut_lineage(clean.groupBy(*parts, "__v").agg(F.count(F.lit(1)).alias("n")))


def quantiles_from_counts(vc: DataFrame, qs: Sequence[float], interpolate: bool = False,
                          partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """The quantiles of :func:`exact_quantiles` from a :func:`grouped_value_counts` table."""
    parts = _cols(partition_by)
    cum = prefix_sum(vc, [F.col("__v").asc_nulls_first()], F.col("__v"), ["n"], partition_by=parts)
    if parts:
        n_by = vc.groupBy(*parts).agg(F.sum("n").alias("__N"))
        with_n = join_null_safe(cum, broadcast_if_small(n_by, n_by.count()), parts)
    else:
        total = int(vc.agg(F.sum("n").alias("n")).first()["n"] or 0)
        with_n = cum.withColumn("__N", F.lit(total))

    def element_at_rank(r: Column) -> Column:
        # smallest value whose inclusive cumulative count reaches rank r (1-indexed)
        return F.min(F.when(F.col("n_cum") >= r, F.col("__v")))

    aggs = []
    for i, q in enumerate(qs):
        N = F.col("__N")
        if not interpolate:
            r = F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * N))
            aggs.append(element_at_rank(r).alias(f"q{i}"))
        else:
            h = (N - 1) * F.lit(float(q))
            lo = F.floor(h) + 1
            hi = F.ceil(h) + 1
            aggs.append(element_at_rank(lo).alias(f"__lo{i}"))
            aggs.append(element_at_rank(hi).alias(f"__hi{i}"))
            aggs.append(F.first(h - F.floor(h)).alias(f"__fr{i}"))
    res = with_n.groupBy(*parts).agg(*aggs)
    if interpolate:
        res = res.select(
            *parts,
            *[
                (F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(f"q{i}")
                for i in range(len(qs))
            ],
        )
    return res


def row_index(df: DataFrame, order_by: Sequence[str], out: str = "index") -> DataFrame:
    """``df`` with the 0-based position of each row in the order of ``order_by`` (any orderable types).

    Rows are range-partitioned and sorted once, written with their partition and
    running id, and numbered after the (few) partitions before them: no
    single-partition window.
    """
    keys = list(order_by)
    spark = df.sparkSession
    ranged = cut_lineage(
        df.repartitionByRange(max(2, shuffle_partitions(spark)), *keys).sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__line"))
    )
    parts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__line").alias("first")).collect()  # one row per partition
    ahead, shift = 0, {}
    for r in sorted(parts, key=lambda r: r["__part"]):
        shift[r["__part"]] = ahead - r["first"]
        ahead += r["n"]
    top = max(shift, default=-1)
    table = F.array(*[F.lit(shift.get(i, 0)).cast("long") for i in range(top + 1)]) if shift else F.array(F.lit(0).cast("long"))
    return ranged.select(*df.columns, (F.col("__line") + F.element_at(table, F.col("__part") + 1)).alias(out))


# Largest (value, count) table resolved on the driver during quantile selection.
SELECT_LIMIT = 100_000


def _resolve_from_counts(rows: list[tuple[float, int]], ranks: list[int]) -> dict[int, float]:
    """Element at each 1-based rank from (value, count) pairs (a bounded list)."""
    out: dict[int, float] = {}
    acc = 0
    it = iter(sorted(set(ranks)))
    r = next(it, None)
    for val, cnt in sorted(rows):
        acc += cnt
        while r is not None and r <= acc:
            out[r] = val
            r = next(it, None)
    return out


def _rank_values(v: DataFrame, ranks: list[int], n_buckets: int, depth: int = 0,
                 approx_distinct: int | None = None, bounds: list[float] | None = None) -> dict[int, float]:
    """Element at each 1-based rank of the single double column ``__v``.

    Selection, not sorting: boundaries from a bounded sketch, a count per bucket
    (a tiny aggregate), then only the buckets holding a wanted rank are sized
    (one aggregate) and resolved together from one grouped collect when each
    has about ``SELECT_LIMIT / 4`` distinct values at most (by a sketch within
    5 %); wider buckets are narrowed again.
    """
    if not ranks:
        return {}
    if approx_distinct is None:
        approx_distinct = v.agg(F.approx_count_distinct("__v", 0.05).alias("d")).first()["d"] or 0
    if approx_distinct <= SELECT_LIMIT // 4 or depth >= 6:
        if depth >= 6 and approx_distinct > SELECT_LIMIT // 4:  # pragma: no cover - pathological sketch
            cum = value_counts_prefix(v, "__v")
            return {r: cum.where(F.col("n_cum") >= F.lit(r)).agg(F.min("__v").alias("x")).first()["x"] for r in ranks}
        rows = v.groupBy("__v").agg(F.count(F.lit(1)).alias("n")).collect()
        return _resolve_from_counts([(r["__v"], r["n"]) for r in rows], ranks)
    if bounds is None:
        bounds = range_boundaries(v, F.col("__v"), n_buckets)
    splits = [-math.inf] + bounds + [math.inf]
    bucketed = with_range_bucket(v, F.col("__v"), bounds)
    # size and distinct-count sketch of every bucket in one pass (<= n_buckets + 1 rows)
    per_bucket = bucketed.groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("__v", 0.05).alias("d")
    ).collect()
    counts = {row[_BUCKET]: row["n"] for row in per_bucket}
    widths = {row[_BUCKET]: row["d"] for row in per_bucket}
    offsets, acc = {}, 0
    for b in sorted(counts):
        offsets[b] = acc
        acc += counts[b]
    wanted: dict[int, list[int]] = {}
    for r in ranks:
        for b in sorted(counts):
            if offsets[b] < r <= offsets[b] + counts[b]:
                wanted.setdefault(b, []).append(r)
                break
    in_wanted = bucketed.where(F.col(_BUCKET).isin(list(wanted)))
    narrow = [b for b in wanted if widths.get(b, 0) <= SELECT_LIMIT // 4]
    out: dict[int, float] = {}
    if narrow:
        grouped: dict[int, list[tuple[float, int]]] = {b: [] for b in narrow}
        for row in (in_wanted.where(F.col(_BUCKET).isin(narrow)).groupBy(_BUCKET, "__v")
                    .agg(F.count(F.lit(1)).alias("n")).collect()):
            grouped[row[_BUCKET]].append((row["__v"], row["n"]))
        for b in narrow:
            local = _resolve_from_counts(grouped[b], [r - offsets[b] for r in wanted[b]])
            for r in wanted[b]:
                out[r] = local[r - offsets[b]]
    for b in wanted:
        if b in narrow:
            continue
        lo, hi = splits[b], splits[b + 1]
        cond = F.lit(True)
        if lo != -math.inf:
            cond = cond & (F.col("__v") >= F.lit(lo))
        if hi != math.inf:
            cond = cond & (F.col("__v") < F.lit(hi))
        local = _rank_values(v.where(cond), [r - offsets[b] for r in wanted[b]], n_buckets, depth + 1, widths.get(b))
        for r in wanted[b]:
            out[r] = local[r - offsets[b]]
    return out


def exact_quantile_values(df: DataFrame, col: str, qs: Sequence[float], interpolate: bool = False) -> list[float | None]:
    """A5/E1/A11 scalars: exact quantiles of ``col`` (NULL and NaN ignored).

    Same definitions as :func:`exact_quantiles`; computed by distributed
    selection so no task ever holds more than one bucket of distinct values.
    """
    v = df.select(F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan(F.col("__v")))
    nb = max(2, shuffle_partitions(df.sparkSession))
    # count, distinct sketch and bucket boundaries share one scan
    st = v.agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct("__v", 0.05).alias("d"),
        boundary_sketch(F.col("__v"), nb).alias("b"),
    ).first()
    n = int(st["n"] or 0)
    if n == 0:
        return [None] * len(qs)
    plan = []
    for q in qs:
        if not interpolate:
            plan.append((max(1, math.ceil(q * n)), None, 0.0))
        else:
            h = (n - 1) * q
            plan.append((math.floor(h) + 1, math.ceil(h) + 1, h - math.floor(h)))
    ranks = sorted({r for a, b, _ in plan for r in (a, b) if r is not None})
    vals = _rank_values(v, ranks, nb, approx_distinct=int(st["d"] or 0), bounds=increasing_points(st["b"]))
    res: list[float | None] = []
    for a, b, fr in plan:
        if b is None:
            res.append(vals[a])
        else:
            res.append(vals[a] + fr * (vals[b] - vals[a]))
    return res


def _hash_order_key(key_cols: Sequence[str], seed: int) -> tuple[Column, Column]:
    """md5 of the key and the seed; its first 60 bits as a monotone long."""
    h = F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    num = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    return h, num


def shuffle_position(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = 13,
    out: str = "position",
    partition_by: str | Sequence[str] | None = None,
    grand: dict | None = None,
) -> DataFrame:
    """Seeded global shuffle as a 1-based position per row.

    Rows are ordered by ``md5(key || '#' || seed)`` (ties by key), which is the
    same in any engine; positions come from :func:`prefix_sum` so no task sees
    the whole table.  ``key`` must identify a row.
    """
    keys = _cols(key)
    h, num = _hash_order_key(keys, seed)
    keyed = df.withColumn("__h", h).withColumn("__hn", num).withColumn("__one", F.lit(1))
    order = [F.col("__h")] + [F.col(k) for k in keys]
    pos = prefix_sum(keyed, order, F.col("__hn"), ["__one"], partition_by=partition_by, grand=grand)
    return pos.withColumnRenamed("__one_cum", out).drop("__h", "__hn", "__one")


def split_exact(
    df: DataFrame,
    key: str | Sequence[str],
    fractions: Sequence[float] = (0.7, 0.15, 0.15),
    seed: int = 13,
    names: Sequence[str] = ("train", "validation", "test"),
    stratify: str | None = None,
    out: str = "split",
) -> DataFrame:
    """Exact split at ``int(f1*n)``, ``int((f1+f2)*n)``, ... after the O4 shuffle.

    With ``stratify`` the cut points are applied per class (NULL is a class of
    its own), so a <1 % class is split in the same proportions.  Sizes are exact (``randomSplit`` is not).
    """
    cum = []
    acc = 0.0
    for f in fractions[:-1]:
        acc += f
        cum.append(round(acc, 12))  # 0.1 + 0.2 is the cut 0.3, not 0.30000000000000004
    grand: dict = {}
    pos = shuffle_position(df, key, seed, out="__pos", partition_by=stratify, grand=grand)
    if stratify:
        n_by = df.groupBy(stratify).agg(F.count(F.lit(1)).alias("__n"))
        pos = join_null_safe(pos, broadcast_if_small(n_by, n_by.count()), stratify)
        n_col = F.col("__n")
        cuts = [F.floor(F.lit(c) * n_col) for c in cum]
    else:
        n = int(grand.get("rows") or 0)  # the row count, from the position totals
        cuts = [F.lit(int(c * n)) for c in cum]
    expr = None
    for cut, name in zip(cuts, names):
        expr = (F.when(F.col("__pos") <= cut, F.lit(name))) if expr is None else expr.when(F.col("__pos") <= cut, F.lit(name))
    expr = expr.otherwise(F.lit(names[len(cuts)]))
    res = pos.withColumn(out, expr).drop("__pos")
    if stratify:
        res = res.drop("__n")
    return res


def running_total(df: DataFrame, order_col: str, value_col: str, out: str | None = None) -> DataFrame:
    """Public prefix-sum: inclusive running total of ``value_col`` over distinct ``order_col``.

    Duplicate ``order_col`` values are summed first; the result has one row per
    distinct value: ``order_col, value_col, <out>``.
    """
    agg = df.groupBy(order_col).agg(F.sum(value_col).alias(value_col))
    res = prefix_sum(agg, [F.col(order_col).asc_nulls_first()], F.col(order_col), [value_col])
    return res.withColumnRenamed(f"{value_col}_cum", out or f"{value_col}_cum")


def exact_quantile(df: DataFrame, col: str, q: float, interpolate: bool = False) -> float | None:
    """A5 in the signature of SURVEY §2.13: one exact quantile as a scalar."""
    return exact_quantile_values(df, col, [q], interpolate)[0]


def exact_quantiles_by_column(
    df: DataFrame, cols: Sequence[str], qs: Sequence[float], interpolate: bool = False
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns with a shared plan.

    The columns are unpivoted to ``(column, value)``; one aggregate gives each
    column's count and a distinct-count sketch; every column with few distinct
    values is resolved from one grouped ``(column, value, count)`` collect (at
    most ``SELECT_LIMIT`` rows per column - a counted bound); wider columns go
    through :func:`exact_quantile_values` (distributed selection).
    """
    cols = list(cols)
    if not cols:
        return {}
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)
    ]))
    long = df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    stats = {
        r["c"]: (int(r["n"]), int(r["d"]))
        for r in long.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("v", 0.05).alias("d")).collect()
    }
    small = [i for i, (_, d) in stats.items() if d <= SELECT_LIMIT // 4]
    counts: dict[int, list[tuple[float, int]]] = {i: [] for i in small}
    if small:
        grouped = long.where(F.col("c").isin(small)).groupBy("c", "v").agg(F.count(F.lit(1)).alias("k"))
        for r in grouped.collect():
            counts[r["c"]].append((r["v"], r["k"]))

    def resolve(vals: list[tuple[float, int]], n: int) -> list[float | None]:
        vals.sort()
        cum, acc = [], 0
        for v, k in vals:
            acc += k
            cum.append((acc, v))

        def at(rank: int) -> float:
            for c, v in cum:
                if c >= rank:
                    return v
            return cum[-1][1]

        out: list[float | None] = []
        for q in qs:
            if not interpolate:
                out.append(at(max(1, math.ceil(q * n))))
            else:
                h = (n - 1) * q
                lo, hi = at(math.floor(h) + 1), at(math.ceil(h) + 1)
                out.append(lo + (h - math.floor(h)) * (hi - lo))
        return out

    res: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        n = stats.get(i, (0, 0))[0]
        if n == 0:
            res[c] = [None] * len(qs)
        elif i in counts:
            res[c] = resolve(counts[i], n)
        else:
            res[c] = exact_quantile_values(df, c, qs, interpolate)
    return res
