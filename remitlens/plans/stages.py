"""Stage tables: each pipeline step composed from the operators, stored once where it is reused.

Only the claims and the queue are written. Flags, features and target are expressions over the stored claims and over small
stored lookups (repeated keys, provider, code and state context), so filters and column pruning reach the Parquet scans and
no wide row is shuffled or written a second time.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens import schemas
from remitlens.functions import scalars as S
from remitlens.operators import cleaning, features, models, pricing, queue, target, variance
from remitlens.session import materialize
from remitlens.sources import testtables


class Stages:
    """The pipeline over one set of inputs."""

    def __init__(self, rvu: DataFrame, gpci: DataFrame, payments: DataFrame) -> None:
        self.rvu, self.gpci, self.payments = rvu, gpci, payments
        self._cv: dict[str, DataFrame] = {}

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> Stages:
        return cls(
            testtables.rvu(spark, sf_dir), testtables.gpci(spark, sf_dir), testtables.payments(spark, sf_dir)
        )

    @property
    def expected(self) -> DataFrame:
        return pricing.expected_payment(self.rvu, self.gpci)

    @property
    def benchmark(self) -> DataFrame:
        """Every (code, state) pair, as listed by the reports."""
        return pricing.state_benchmark(self.rvu, self.gpci)

    @property
    def claim_benchmark(self) -> DataFrame:
        return pricing.claim_benchmark(self.payments, self.rvu, self.gpci)

    @property
    def joined(self) -> DataFrame:
        return variance.join_benchmark(self.payments, self.claim_benchmark)

    @property
    def claims_lazy(self) -> DataFrame:
        return variance.claims_with_variance(self.payments, self.claim_benchmark)

    @cached_property
    def claims(self) -> DataFrame:
        """Matched payments. Their own and the benchmark's columns are stored, gaps are computed when read."""
        matched, _ = variance.split_matched(self.joined)
        stored = materialize(matched.select(*[c for c in schemas.CLAIM_COLUMNS if c in matched.columns]), "claims")
        return S.with_variance(stored).select(*schemas.CLAIM_COLUMNS)

    @cached_property
    def flagged(self) -> DataFrame:
        return cleaning.flag_claims(self.claims)

    @property
    def cleaned(self) -> DataFrame:
        return cleaning.split_clean(self.flagged)[0]

    @property
    def excluded(self) -> DataFrame:
        return cleaning.split_clean(self.flagged)[1]

    @cached_property
    def modeling(self) -> DataFrame:
        return target.with_target(features.build_features(self.cleaned))

    @cached_property
    def queue(self) -> DataFrame:
        return materialize(queue.build_queue(self.modeling), "queue")

    @cached_property
    def model(self) -> tuple[models.Trained, DataFrame]:
        """The default classifier, fitted once for all queries that score, and its scored hold-out rows."""
        name = "Weighted_Gradient_Boosting"
        return models.fit_final(self.modeling, name, models.candidates()[name])

    @cached_property
    def training(self) -> DataFrame:
        return models.training_table(self.modeling, models.fit_features(self.modeling), stored=False)

    def cross_validated(self, *names: str) -> DataFrame:
        """Held-out scores of candidates in five folds, every fit on all rows of the other folds. Boosted ones are fitted together."""
        missing = {n: e for n, e in models.candidates().items() if n in names and n not in self._cv}
        if missing:
            scored = models.cross_validate(self.training, missing)
            self._cv.update({n: scored.where(F.col("Model") == n) for n in missing})
        found = self._cv[names[0]]
        for n in names[1:]:
            found = found.unionByName(self._cv[n])
        return found

    @property
    def scored(self) -> DataFrame:
        """Label and a fixed arithmetic score of the row: evaluation maths without a model."""
        mix = (
            F.col("Rndrng_NPI") * 7919 + F.col("Tot_Srvcs").cast("long") * 31
            + F.length("Rndrng_Prvdr_Type") * 17
        ) % 997
        cheap = 1.0 - F.least(F.lit(1.0), F.col("Avg_Sbmtd_Chrg") / 1500.0)
        score = S.round_even(0.5 * (mix.cast("double") / 997.0) + 0.5 * cheap, 3)
        return self.modeling.select(
            *C.CLAIM_KEY, "Rndrng_Prvdr_State_Abrvtn", F.col(C.TARGET).alias("label"), score.alias("score")
        )


_OPEN: dict[tuple, Stages] = {}
_SOURCES = ("part", "nation", "lineitem", "supplier")


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Change time and size of the input tables: stages of other inputs are other stages."""
    conf, fs = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs
    paths = [fs.Path(f"{sf_dir}/{t}.parquet") for t in _SOURCES]
    return tuple((p.getFileSystem(conf).getFileStatus(p).getModificationTime(), p.getFileSystem(conf).getContentSummary(p).getLength()) for p in paths)


def open_stages(spark: SparkSession, sf_dir: str) -> Stages:
    """Stages of the given tables, shared by all queries of one application."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir))
    if key not in _OPEN:
        _OPEN[key] = Stages.from_tables(spark, sf_dir)
    return _OPEN[key]
