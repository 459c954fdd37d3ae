"""Column profiles, disguised missing values and descriptive statistics.

Counter sets are one aggregate each. Per-value work is unpivoted and pre-aggregated, so hot
values combine on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators.ordering import exact_quantiles, top_n
from remitlens.operators.tables import one_to_rows

BLANKS = " \t\n\r\f\v"


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, non-null count, distinct count and a sample (smallest) value of every column."""
    dtypes = dict(df.dtypes)
    if approx:
        one = df.agg(*[
            agg
            for i, c in enumerate(df.columns)
            for agg in (
                F.count(f"`{c}`").alias(f"n{i}"),
                F.approx_count_distinct(f"`{c}`").alias(f"d{i}"),
                F.min(F.col(f"`{c}`").cast("string")).alias(f"s{i}"),
            )
        ])
        return one_to_rows(one, [
            {"column": F.lit(c), "dtype": F.lit(dtypes[c]), "non_null_count": F.col(f"n{i}"),
             "unique_count": F.col(f"d{i}"), "sample_value": F.col(f"s{i}")}
            for i, c in enumerate(df.columns)
        ])
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"`{c}`").cast("string").alias("value"))
        for c in df.columns
    ])
    # Two levels: copies collapse to one row per (column, value) before anything is counted.
    values = df.select(F.inline(cells)).groupBy("column", "dtype", "value").agg(F.count(F.lit(1)).alias("copies"))
    return values.groupBy("column", "dtype").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("copies"))), F.lit(0)).alias("non_null_count"),
        F.count("value").alias("unique_count"),
        F.min("value").alias("sample_value"),
    )


def missing_counts(df: DataFrame, top: int = 10) -> DataFrame:
    """NULLs per column, most first, columns without any left out."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = one_to_rows(one, [
        {"column": F.lit(c), "missing_count": F.col(f"`{c}`")} for c in df.columns
    ]).where(F.col("missing_count") > 0)
    return top_n(rows, [F.col("missing_count").desc(), F.col("column")], top)


def describe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles, max: one row per column."""
    one = df.agg(*[
        agg
        for i, c in enumerate(cols)
        for agg in (
            F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
            F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"),
        )
    ])
    moments = one_to_rows(one, [
        {"column": F.lit(c), "count": F.col(f"n{i}"), "mean": F.col(f"m{i}"), "std": F.col(f"s{i}"),
         "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}")}
        for i, c in enumerate(cols)
    ])
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"]).drop("n")
    return moments.join(quartiles, "column", "left")


def value_counts(df: DataFrame, col: str, by: str = "count") -> DataFrame:
    """Rows per value (NULL left out), most frequent first or in key order."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))
    order = [F.col("row_count").desc(), F.col(col)] if by == "count" else [F.col(col)]
    return counts.orderBy(*order)


def detect_missing(df: DataFrame, tokens: Sequence[str] = tuple(C.MISSING_TOKENS)) -> DataFrame:
    """NULLs, disguised-missing text and review-only signals, one row per kind with a count > 0.

    Text is compared after trimming, and a NULL also counts as the text 'nan', so the
    token counts overlap; the totals below follow that convention.
    """
    dtypes = dict(df.dtypes)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema.fields if _is_number(f.dataType)]
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    counters: dict[tuple[str, str], Column] = {
        (c, "Standard NaN/None"): F.col(f"`{c}`").isNull() for c in df.columns
    }
    counters.update({(c, "Zero (0) values - review only"): F.col(c) == 0 for c in numbers})
    counters.update({(c, "Negative values - review only"): F.col(c) < 0 for c in numbers})
    counters.update({(c, "Inf / -Inf"): F.abs(F.col(c)) == float("inf") for c in floats})
    kinds = list(counters)
    one = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(hit).alias(f"k{i}") for i, hit in enumerate(counters.values())
    ])
    plain = one_to_rows(one, [
        {"Column": F.lit(c), "Dtype": F.lit(dtypes[c]), "Null_Type": F.lit(kind),
         "Count": F.col(f"k{i}"), "n": F.col("n")}
        for i, (c, kind) in enumerate(kinds)
    ])
    wanted = sorted({"", *(t.strip() for t in tokens)})

    def trimmed_text(c: str) -> Column:
        return F.coalesce(F.btrim(F.col(f"`{c}`"), F.lit(BLANKS)), F.lit("nan"))

    # A cheap pass tells which text columns hold a token at all; clean columns stop here.
    dirty = []
    if text:
        hits = df.agg(*[F.count_if(trimmed_text(c).isin(wanted)).alias(f"h{i}") for i, c in enumerate(text)]).first()
        dirty = [c for i, c in enumerate(text) if hits[f"h{i}"]]
    if dirty:
        # Only cells that hold a token leave this stage, and they combine per (column, token).
        trimmed = F.array(*[
            F.struct(F.lit(c).alias("Column"), F.lit(dtypes[c]).alias("Dtype"), trimmed_text(c).alias("value"))
            for c in dirty
        ])
        hits = (
            df.select(F.inline(trimmed)).where(F.col("value").isin(wanted))
            .groupBy("Column", "Dtype", "value").agg(F.count(F.lit(1)).alias("Count"))
        )
        names = F.array(*[
            F.struct(F.lit(key).alias("key"), F.lit(name).alias("name"))
            for key, name in [*((t.strip(), f'String "{t}"') for t in tokens), ("", "Whitespace Only")]
        ])
        labelled = hits.select(
            "Column", "Dtype", "Count",
            F.explode(F.filter(names, lambda e: e["key"] == F.col("value"))).alias("token"),
        )
        total = one.select("n")
        tokens_long = labelled.select(
            "Column", "Dtype", F.col("token.name").alias("Null_Type"), "Count",
            total.scalar().alias("n"),
        )
        plain = plain.unionByName(tokens_long)
    return plain.where(F.col("Count") > 0).select(
        "Column", "Dtype", "Null_Type",
        F.when(F.col("Null_Type").contains("review only"), "Review Only")
        .otherwise("Null / Missing").alias("Flag_Category"),
        "Count",
        S.round_even(F.col("Count").cast("double") / F.col("n") * 100.0, 2).alias("Percentage"),
    )


def missing_by_column(detected: DataFrame, n_rows: Column) -> DataFrame:
    """True-missing signals summed per column, most first."""
    sums = detected.where(F.col("Flag_Category") == "Null / Missing").groupBy("Column").agg(
        F.sum("Count").alias("Count")
    )
    share = S.round_even(F.col("Count").cast("double") / n_rows * 100.0, 2)
    return sums.withColumn("Percentage", share).orderBy(F.col("Count").desc(), "Column")


def missing_totals(df: DataFrame, detected: DataFrame) -> DataFrame:
    """Cells, standard NULLs, and how many columns carry any true-missing signal."""
    nulls = None
    for c in df.columns:
        term = F.count_if(F.col(f"`{c}`").isNull())
        nulls = term if nulls is None else nulls + term
    width = len(df.columns)
    flagged = detected.where(F.col("Flag_Category") == "Null / Missing").agg(
        F.count_distinct("Column").alias("k")
    ).scalar()
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), nulls.alias("standard_nulls"))
    cells = (F.col("total_rows") * width).cast("long")
    return one.select(
        "total_rows", F.lit(width).cast("long").alias("total_columns"), cells.alias("total_cells"),
        "standard_nulls",
        S.round_even(F.col("standard_nulls").cast("double") / cells * 100.0, 4).alias("null_pct"),
        flagged.cast("long").alias("columns_with_nulls"),
        (F.lit(width) - flagged).cast("long").alias("columns_without_nulls"),
    )


def negative_share(df: DataFrame, cols: Sequence[str] = tuple(C.GAP_COLUMNS)) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c) < 0).alias(c) for c in cols])
    return one_to_rows(one, [
        {"column": F.lit(c), "negative_count": F.col(c),
         "negative_pct": F.try_divide(F.col(c).cast("double"), F.col("n")) * 100.0}
        for c in cols
    ])


def cardinalities(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and exact distinct counts of chosen columns."""
    wide = profile_columns(df.select(*cols)).select("column", "unique_count")
    return wide.withColumn("total_rows", df.agg(F.count(F.lit(1)).alias("n")).scalar())


def coercion_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that are present as text but not readable as a number."""
    lost = [
        F.count_if(F.col(f"`{c}`").isNotNull() & S.to_double(F.col(f"`{c}`").cast("string")).isNull()).alias(c)
        for c in cols
    ]
    gone = [F.count_if(S.to_double(F.col(f"`{c}`").cast("string")).isNull()).alias(f"{c}__all") for c in cols]
    return one_to_rows(df.agg(*lost, *gone), [
        {"column": F.lit(c), "coerced_to_null": F.col(f"`{c}`"), "total_null": F.col(f"`{c}__all`")} for c in cols
    ])
