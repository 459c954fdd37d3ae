"""Fee schedule x geographic index -> expected payments, and their state averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens import constants as C
from remitlens.functions import scalars as S


def clean_rvu(
    rvu: DataFrame,
    status_filter: Sequence[str] | None = None,
) -> DataFrame:
    """Usable schedule rows: a code, a work value and a malpractice value.

    The filter is off by default, so every schedule row of a code counts.
    """
    out = rvu.where(
        F.col("HCPCS").isNotNull() & F.col("WORK_RVU").isNotNull() & F.col("MP_RVU").isNotNull()
    )
    if status_filter is not None:
        out = out.where(F.col("STATUS_CODE").isin(list(status_filter)))
    return out


def resolve_conversion_factor(rvu: DataFrame, fallback: float = C.CONVERSION_FACTOR_FALLBACK) -> DataFrame:
    """One row: the file's factor when it holds exactly one value, else the fallback.

    min = max says the same as "one distinct value" without a distinct aggregate.
    """
    factor = F.col("CONVERSION_FACTOR_FROM_FILE")
    low, high = F.min(factor), F.max(factor)
    return rvu.agg(F.when(low == high, high).otherwise(F.lit(fallback)).alias("conversion_factor"))


def pair_all(left: DataFrame, right: DataFrame, left_parts: int | None = None, right_parts: int = 4) -> DataFrame:
    """Every left row with every right row, as an equi-join on a grid of fragments.

    Left rows fall into ``left_parts`` fragments and are copied once per right fragment, and the
    other way round, so each pair meets in exactly one grid cell. A small right side is still
    hash-broadcast by Catalyst; a large one is shuffled over left_parts x right_parts cells
    instead of being copied whole to every task. Without ``left_parts`` the grid has as many cells
    as the session has shuffle partitions.
    """
    left_parts = left_parts or max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")) // right_parts)
    def side(df: DataFrame, own: str, own_parts: int, other: str, other_parts: int) -> DataFrame:
        mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(own_parts)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1)))
        return df.withColumn(own, mine).withColumn(other, copies)

    a = side(left, "_row", left_parts, "_col", right_parts)
    b = side(right, "_col", right_parts, "_row", left_parts)
    return a.join(b, ["_row", "_col"]).drop("_row", "_col")


def expected_payment(rvu: DataFrame, gpci: DataFrame, factor: Column | None = None) -> DataFrame:
    """One row per (schedule row, locality) with both expected payments."""
    usable = clean_rvu(rvu)
    cf = resolve_conversion_factor(usable).scalar() if factor is None else factor
    codes = usable.select(
        "HCPCS", "DESCRIPTION", "STATUS_CODE", "WORK_RVU", "NON_FAC_PE_RVU", "FACILITY_PE_RVU", "MP_RVU"
    )
    pairs = pair_all(codes, gpci)
    return pairs.select(
        "HCPCS", "DESCRIPTION", "STATUS_CODE", "MAC", "State", "Locality_Number", "Locality_Name",
        "WORK_RVU", "NON_FAC_PE_RVU", "FACILITY_PE_RVU", "MP_RVU", "WORK_GPCI", "PE_GPCI", "MP_GPCI",
        S.expected_amount("NON_FAC_PE_RVU", cf).alias("Expected_Payment_NonFacility"),
        S.expected_amount("FACILITY_PE_RVU", cf).alias("Expected_Payment_Facility"),
    )


def _averages() -> list[Column]:
    nonfac, fac = "Expected_Payment_NonFacility", "Expected_Payment_Facility"
    return [
        F.avg(nonfac).alias("Expected_Payment_NonFacility_Avg"),
        F.avg(fac).alias("Expected_Payment_Facility_Avg"),
        F.min(nonfac).alias("Expected_Payment_NonFacility_Min"),
        F.max(nonfac).alias("Expected_Payment_NonFacility_Max"),
    ]


def state_average(expected: DataFrame) -> DataFrame:
    """Collapse localities: one benchmark row per (code, state)."""
    return (
        expected.where(F.col("HCPCS").isNotNull() & F.col("State").isNotNull())
        .groupBy("HCPCS", "State")
        .agg(*_averages(), F.count_distinct("Locality_Number").alias("Locality_Count"))
    )


def state_benchmark(rvu: DataFrame, gpci: DataFrame) -> DataFrame:
    """``state_average(expected_payment(rvu, gpci))`` in one shuffle.

    Every code meets every locality, so the locality count belongs to the state: it is counted
    on the small index table and carried through. That removes the distinct aggregate, and the
    remaining sums, minima and maxima combine on the map side right after the pairing, so the
    code x locality product is never shuffled.
    """
    # A state has a few dozen localities at most, so a set per state is a bounded window.
    places = F.collect_set("Locality_Number").over(Window.partitionBy("State"))
    counted = gpci.where(F.col("State").isNotNull()).withColumn("Locality_Count", F.size(places).cast("long"))
    usable = clean_rvu(rvu)
    cf = resolve_conversion_factor(usable).scalar()
    codes = usable.select("HCPCS", "WORK_RVU", "NON_FAC_PE_RVU", "FACILITY_PE_RVU", "MP_RVU")
    pairs = pair_all(
        # A schedule file of a few splits grows by the locality count: spread it first.
        codes.repartition(rvu.sparkSession.sparkContext.defaultParallelism),
        counted.select("State", "WORK_GPCI", "PE_GPCI", "MP_GPCI", "Locality_Count", "Locality_Number"),
    )
    priced = pairs.select(
        "HCPCS", "State", "Locality_Count",
        S.expected_amount("NON_FAC_PE_RVU", cf).alias("Expected_Payment_NonFacility"),
        S.expected_amount("FACILITY_PE_RVU", cf).alias("Expected_Payment_Facility"),
    )
    return priced.groupBy("HCPCS", "State").agg(*_averages(), F.max("Locality_Count").alias("Locality_Count"))


def claim_benchmark(payments: DataFrame, rvu: DataFrame, gpci: DataFrame) -> DataFrame:
    """``state_benchmark`` for the (code, state) pairs that occur in payments, by two equi-joins.

    The few schedule rows of a code and the few localities of a state travel as arrays; sums, minima and maxima
    over their combinations are folded inside the row, so no product of codes and localities is ever formed.
    """
    pairs = payments.select(F.col("HCPCS_Cd").alias("HCPCS"), F.col("Rndrng_Prvdr_State_Abrvtn").alias("State")).where(
        "HCPCS is not null and State is not null").distinct()
    usable = clean_rvu(rvu)
    cf = resolve_conversion_factor(usable).scalar()
    values = ["WORK_RVU", "NON_FAC_PE_RVU", "FACILITY_PE_RVU", "MP_RVU"]
    codes = usable.groupBy("HCPCS").agg(F.sort_array(F.collect_list(F.struct(*values))).alias("_rows"))
    states = gpci.where(F.col("State").isNotNull()).groupBy("State").agg(
        F.sort_array(F.collect_list(F.struct("WORK_GPCI", "PE_GPCI", "MP_GPCI"))).alias("_places"),
        F.size(F.collect_set("Locality_Number")).cast("long").alias("Locality_Count")).withColumn("_cf", cf)

    def amounts(pe: str) -> Column:
        one = lambda r, g: S.price(r["WORK_RVU"], r[pe], r["MP_RVU"], g["WORK_GPCI"], g["PE_GPCI"], g["MP_GPCI"], F.col("_cf"))
        priced = F.flatten(F.transform("_rows", lambda r: F.transform("_places", lambda g: one(r, g))))
        return F.filter(priced, lambda x: x.isNotNull())

    def mean(cells: str) -> Column:
        total = F.aggregate(cells, F.lit(0.0), lambda acc, x: acc + x)
        return F.when(F.size(cells) > 0, total / F.size(cells))

    joined = pairs.join(codes, "HCPCS").join(states, "State").withColumns(
        {"_nonfac": amounts("NON_FAC_PE_RVU"), "_fac": amounts("FACILITY_PE_RVU")})
    return joined.select(
        "HCPCS", "State", mean("_nonfac").alias("Expected_Payment_NonFacility_Avg"), mean("_fac").alias("Expected_Payment_Facility_Avg"),
        F.array_min("_nonfac").alias("Expected_Payment_NonFacility_Min"), F.array_max("_nonfac").alias("Expected_Payment_NonFacility_Max"),
        "Locality_Count")


def spot_check(expected: DataFrame, code: str = C.SPOT_CHECK_CODE, states: Sequence[str] = tuple(C.SPOT_CHECK_STATES)) -> DataFrame:
    """Known code in known states, to be compared with the published look-up."""
    return expected.where((F.col("HCPCS") == code) & F.col("State").isin(list(states))).select(
        "HCPCS", "DESCRIPTION", "State", "Locality_Name",
        "Expected_Payment_NonFacility", "Expected_Payment_Facility",
    )
