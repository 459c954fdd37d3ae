"""One-hot vocabulary, smoothed target encoding and vector assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.operators.target import numeric_columns


def model_features(df: DataFrame, leakage: Sequence[str] = tuple(C.LEAKAGE_COLUMNS)) -> list[str]:
    """Numeric inputs: no leakage, no identifiers, no target; booleans are not numbers."""
    banned = {*leakage, *C.MODEL_ID_COLUMNS, C.TARGET}
    return [c for c in numeric_columns(df) if c not in banned]


def fit_onehot(df: DataFrame, cols: Sequence[str] = tuple(C.MODEL_CATEGORICALS)) -> dict[str, list[str]]:
    """Sorted levels per column without the first; kept with the model and reused when scoring."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols])
    levels = df.select(F.inline(cells)).where(F.col("v").isNotNull()).distinct()
    found = levels.collect()  # as many names as the model gets columns
    return {c: sorted(r["v"] for r in found if r["c"] == c)[1:] for c in cols}


def onehot_names(vocab: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{level}" for c, levels in vocab.items() for level in levels]


def apply_onehot(df: DataFrame, vocab: dict[str, list[str]]) -> DataFrame:
    """0/1 column per kept level. An unseen level is all zeros, in a batch of any size."""
    return df.withColumns({
        f"{c}_{level}": F.coalesce((F.col(c) == level).cast("double"), F.lit(0.0))
        for c, levels in vocab.items() for level in levels
    })


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Coerce to number, absent or missing -> 0, and pack into one vector."""
    ready = df.withColumns({
        f"_x{i}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
        for i, c in enumerate(cols)
    })
    names = [f"_x{i}" for i in range(len(cols))]
    packed = VectorAssembler(inputCols=names, outputCol=out).transform(ready)
    return packed.drop(*names)


def fit_target_encoding(train: DataFrame, col: str, target: str, smoothing: float = C.ENCODING_SMOOTHING) -> DataFrame:
    """(level, encoding): level means pulled towards the train mean by ``smoothing`` rows."""
    mean = train.agg(F.avg(target).alias("m")).scalar()
    n = F.count(target)
    return (
        train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level"))
        .agg(F.avg(target).alias("_mean"), n.alias("_n"))
        .select("level", ((F.col("_mean") * F.col("_n") + mean * smoothing) / (F.col("_n") + smoothing)).alias("encoding"))
    )


def apply_encoding(df: DataFrame, encoding: DataFrame, col: str, default: float, out: str | None = None) -> DataFrame:
    """Left lookup; unseen or NULL levels take the default. AQE decides on a broadcast by size."""
    out = out or f"{col}_target_enc"
    table = encoding.select(F.col("level").alias("_level"), F.col("encoding").alias("_encoding"))
    joined = df.join(table, F.col(col) == F.col("_level"), "left")
    return joined.withColumn(out, F.coalesce("_encoding", F.lit(float(default)))).drop("_level", "_encoding")
