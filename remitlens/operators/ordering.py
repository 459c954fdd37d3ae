"""Global order without a single-task window: ranks, running counts, exact quantiles, samples.

``Window.orderBy`` without ``partitionBy`` sends every row to one task. Here rows are range
partitioned on the full (unique) order, sorted inside each partition and written out once with
their partition number and position. Only one offset per partition is then needed to turn
positions into global ranks, so the only single-task work is over a number of rows bounded by
the number of shuffle partitions. The write is what makes it safe: range boundaries come from
a sample, so a partition re-derived after an executor loss could otherwise be cut differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.functions import scalars as S
from remitlens.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id = partition << 33 | position in partition


def _range_sorted(df: DataFrame, order: Sequence[Column], name: str, drop: Sequence[str] = ()) -> DataFrame:
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .drop(*drop)
    )
    stored = materialize(placed, name)
    return stored.withColumn("_part", F.shiftright("_slot", _POSITION_BITS)).withColumn(
        "_pos", F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )


def _offsets(stored: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sum over all earlier partitions, one row per partition (bounded by the partition count)."""
    per_part = stored.groupBy("_part").agg(*[v.alias(k) for k, v in totals.items()])
    # One row per range partition, so this unpartitioned window is over a bounded handful.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_before_{k}") for k in totals]
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", drop: Sequence[str] = ()) -> DataFrame:
    """1..N over the whole table. ``order`` must end in a unique key. Columns ``drop`` serve the order only."""
    stored = _range_sorted(df, order, "rank", drop)
    offsets = materialize(_offsets(stored, {"rows": F.count(F.lit(1))}), "offsets")
    # offsets has one row per range partition: a proven bound, so broadcasting it is safe.
    ranked = stored.join(F.broadcast(offsets), "_part")
    rank = (F.col("_before_rows") + F.col("_pos") + 1).cast("long")
    return ranked.select(rank.alias(name), *[F.col(f"`{c}`") for c in df.columns if c not in drop])


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Inclusive running totals ``{output: input column}`` of long columns in a total order."""
    stored = _range_sorted(df, order, "prefix")
    offsets = _offsets(stored, {out: F.sum(src) for out, src in sums.items()})
    upto = (
        Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = stored.join(F.broadcast(offsets), "_part")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            (F.sum(src).over(upto) + F.col(f"_before_{out}")).cast("long").alias(out)
            for out, src in sums.items()
        ],
    )


# Rank error of percentile_approx is at most rows / _SKETCH. Brackets reach two errors to each
# side of a wanted rank, so above _EXACT_BELOW rows they hold it with at least 4 ranks to spare.
_SKETCH = 10000
_EXACT_BELOW = 4 * _SKETCH


def _brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], groups: Sequence[str]) -> DataFrame:
    """Per group and column, value ranges ``[[low, high], ...]`` that hold the wanted ranks; NULL
    for small groups, which keep all their values. One scan, map-side sketches."""
    reach = 2.0 / _SKETCH
    points = [p for q in probs for p in (max(q - reach, 0.0), min(q + reach, 1.0))]
    aggs = []
    for i, c in enumerate(cols):
        x = F.when(~F.isnan(F.col(c)), F.col(c))
        aggs += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, points, _SKETCH).alias(f"p{i}")]
    sketched = df.select(*groups, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).groupBy(*groups).agg(*aggs)
    return sketched.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], *[
        F.when(F.col(f"n{i}") > _EXACT_BELOW, F.array(*[
            F.struct(F.col(f"p{i}")[2 * j].alias("low"), F.col(f"p{i}")[2 * j + 1].alias("high")) for j in range(len(probs))
        ])).alias(f"_b{i}")
        for i in range(len(cols))
    ])


def exact_quantiles(
    df: DataFrame,
    value_cols: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per (group, column): ``group..., column, n, q1, q2, ...``.

    A sketch first brackets the wanted ranks. Values outside every bracket only matter as counts,
    so they collapse to one row per gap on the map side; values inside keep their identity, with
    copies collapsed. The few rows left get running counts in (group, column, gap, value) order,
    which yields the exact order statistics. No task ever holds the values of a group, however
    hot, and the shuffle carries a small fraction of the rows.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    groups = list(group_cols)
    cols = list(value_cols)
    keys = [*groups, "_col"]
    bounds = _brackets(df, cols, probs, groups)
    if groups:
        bounds = materialize(bounds, "brackets")  # of known size: rows move only if there are very many groups
        same = None
        for k, g in enumerate(groups):
            hit = F.col(g).eqNullSafe(F.col(f"_g{k}"))
            same = hit if same is None else same & hit
        placed = df.join(bounds, same)
    else:
        row = bounds.first()  # one row of 2 x probs numbers per column, used as literals
        placed = df

    def ranges(i: int) -> list[tuple[Column, Column]]:
        if groups:
            return [(F.col(f"_b{i}")[j]["low"], F.col(f"_b{i}")[j]["high"]) for j in range(len(probs))]
        return [(F.lit(b["low"]), F.lit(b["high"])) for b in row[f"_b{i}"] or []]

    def cell(i: int, c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        gap, inside = F.lit(0), F.lit(False)
        for low, high in ranges(i):
            gap = gap + (x >= low).cast("int") + (x > high).cast("int")
            inside = inside | ((x >= low) & (x <= high))
        whole = F.col(f"_b{i}").isNull() if groups else F.lit(row[f"_b{i}"] is None)
        return F.struct(
            F.lit(i).alias("_col"), (x.isNotNull() & ~F.isnan(x)).alias("_ok"),
            F.when(whole, F.lit(0)).otherwise(gap).alias("_gap"), F.when(whole | inside, x).alias("value"),
        )

    counts = (
        placed.select(*groups, F.inline(F.array(*[cell(i, c) for i, c in enumerate(cols)])))
        .where("_ok")
        .groupBy(*keys, "_gap", "value")
        .agg(F.count(F.lit(1)).alias("_cnt"))
    )
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_gap").asc(), F.col("value").asc_nulls_first()]
    cum = running_sums(counts, order, {"_upto": "_cnt"})
    base = cum.groupBy(*[F.col(k).alias(f"_k{m}") for m, k in enumerate(keys)]).agg(
        F.sum("_cnt").alias("n"), F.min(F.col("_upto") - F.col("_cnt")).alias("_start")
    )
    same = None
    for m, k in enumerate(keys):
        hit = F.col(k).eqNullSafe(F.col(f"_k{m}"))
        same = hit if same is None else same & hit
    last = F.col("_upto") - F.col("_start") - 1      # zero-based positions this value covers
    first = last - F.col("_cnt") + 1
    spots = [(F.col("n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    covers = [(first <= F.floor(s)) & (F.floor(s) <= last) for s in spots]
    above = [(first <= F.ceil(s)) & (F.ceil(s) <= last) for s in spots]
    wanted = None
    for hit in covers + above:
        wanted = hit if wanted is None else wanted | hit
    out = cum.join(base, same).where(wanted).groupBy(*keys, "n").agg(*[
        agg
        for i in range(len(probs))
        for agg in (
            F.max(F.when(covers[i], F.col("value"))).alias(f"_lo{i}"), F.max(F.when(above[i], F.col("value"))).alias(f"_hi{i}"),
        )
    ])
    label = F.array(*[F.lit(c) for c in cols])[F.col("_col")].alias("column")
    missed = F.raise_error(F.lit("a quantile fell outside its bracket")).cast("double")

    def value(i: int) -> Column:
        low, high = F.coalesce(F.col(f"_lo{i}"), missed), F.coalesce(F.col(f"_hi{i}"), missed)
        return low + (high - low) * (spots[i] - F.floor(spots[i]))

    return out.select(*groups, label, "n", *[value(i).alias(names[i]) for i in range(len(probs))])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The n first rows (TakeOrderedAndProject: each task keeps at most n)."""
    return df.orderBy(*order).limit(n)


def top_n_ranked(df: DataFrame, order: Sequence[Column], n: int, name: str = "report_rank") -> DataFrame:
    """Top n with a 1..n rank; the window sees at most n rows because n is the report size."""
    window = Window.orderBy(*order)
    top = top_n(df, order, n)
    return top.select(F.row_number().over(window).cast("long").alias(name), *[F.col(f"`{c}`") for c in df.columns])


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42, small: int = 1000) -> DataFrame:
    """Exactly min(n, rows) rows, chosen by md5 of the keys: repeatable on any cluster.

    Small samples are a top-n by hash (its merge step sees at most n rows per task). Larger ones first drop rows that cannot be in the sample
    (a quantile sketch of the hash gives a cut-off with a guaranteed rank error), then rank the
    few candidates globally, so no task has to hold the sample.
    """
    hashed = df.withColumn("_hash", S.row_hash(keys, seed))
    order = [F.col("_hash"), *[F.col(k) for k in keys]]
    if n <= small:
        return top_n(hashed, order, n).drop("_hash")
    # 48 bits: the sketch works on doubles, so the number must be exact as a double too.
    number = F.conv(F.substring("_hash", 1, 12), 16, 10).cast("long")
    rows = hashed.count()
    if rows <= n:
        return df
    share = min(1.0, n / rows + 2.0 / _SKETCH)
    cut = hashed.agg(F.percentile_approx(number, share, _SKETCH).alias("cut")).first()["cut"]
    candidates = hashed.where(number <= F.lit(cut))
    ranked = global_rank(candidates, order, "_rank")
    return ranked.where(F.col("_rank") <= n).drop("_rank", "_hash")


def stratified_sample(df: DataFrame, label: str, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most n rows with the label's share kept: int(n * rate) positives, the rest negatives."""
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("long")).alias("pos")
    ).first()
    if stats["rows"] <= n:
        return df
    n_pos = int(n * (stats["pos"] / stats["rows"]))
    positives = sample_n(df.where(F.col(label) == 1), n_pos, keys, seed)
    negatives = sample_n(df.where(F.col(label) == 0), n - n_pos, keys, seed)
    return positives.unionByName(negatives)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in a stated order.

    ``min_by`` over a struct combines on the map side, so a key that holds a third of the rows
    reaches its reducer as one partial row per task instead of as all its copies.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*").select(*df.columns)
