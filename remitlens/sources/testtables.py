"""The given star-schema tables viewed as fee schedule, geographic index and payments.

A claim's procedure code is a fixed function of its part key, so payments need no join with the
schedule: lines are aggregated to the claim grain first (map-side combine), and only the far
smaller result meets the supplier and nation dimensions. Join strategy is left to Catalyst and
AQE, which broadcast a side only below the session's size threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens import schemas

PROVIDER_TYPES = [
    "Ambulatory Surgical Center", "Nuclear Medicine", "Ophthalmology", "Optometry",
    "Diagnostic Radiology", "Cardiology", "Nurse Practitioner", "Orthopedic Surgery",
    "Physical Therapist", "Internal Medicine",
]
LETTERS = ["J", "G", "Q", "A", "K"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_of_part(partkey: Column) -> Column:
    block = F.floor(partkey / 20).cast("int")
    slot = partkey % 20
    letter_number = F.lpad((block % 10000).cast("string"), 4, "0")
    code = None
    for i, letter in enumerate(LETTERS):
        hit, value = slot == i, F.concat(F.lit(letter), letter_number)
        code = F.when(hit, value) if code is None else code.when(hit, value)
    code = code.when(
        slot == 5, F.concat(F.lit("99"), F.lpad((F.lit(201) + block % 299).cast("string"), 3, "0"))
    ).when(slot == 6, F.concat(F.lit("1004"), (block % 5).cast("string")))  # five codes with many claims each
    return code.otherwise(F.lpad(((partkey * 7919 + 11551) % 100000).cast("string"), 5, "0"))


def rvu(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    key = F.col("p_partkey")
    zero = key % 17 % 4 == 2  # whatever the kind of code
    size = F.col("p_size").cast("double")

    def unless_zero(value: Column) -> Column:
        return F.when(zero, F.lit(0.0)).otherwise(value)

    return part.select(
        code_of_part(key).alias("HCPCS"),
        F.col("p_name").alias("DESCRIPTION"),
        F.when(zero, "X").otherwise("A").alias("STATUS_CODE"),
        F.when(key % 23 == 0, F.lit(None).cast("double")).otherwise(unless_zero(size * 0.25)).alias("WORK_RVU"),
        unless_zero(F.col("p_retailprice") / 200.0).alias("NON_FAC_PE_RVU"),
        unless_zero(F.col("p_retailprice") / 300.0).alias("FACILITY_PE_RVU"),
        unless_zero(size * 0.02).alias("MP_RVU"),
        F.lit(33.8872).alias("CONVERSION_FACTOR_FROM_FILE"),
    ).to(schemas.RVU)


def gpci(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    n, k = F.col("n_nationkey"), F.col("k")
    return nation.select(
        "n_name", "n_nationkey", "n_regionkey", F.explode(F.sequence(F.lit(1), 1 + n % 4)).alias("k")
    ).select(
        F.concat(F.lit("MAC-"), F.col("n_regionkey").cast("string")).alias("MAC"),
        F.col("n_name").alias("State"),
        (n * 10 + k).cast("string").alias("Locality_Number"),
        F.concat_ws(" ", "n_name", k.cast("string")).alias("Locality_Name"),
        (F.lit(0.95) + k.cast("double") * 0.02 + n.cast("double") * 0.002).alias("WORK_GPCI"),
        (F.lit(0.9) + k.cast("double") * 0.03).alias("PE_GPCI"),
        (F.lit(0.8) + k.cast("double") * 0.05).alias("MP_GPCI"),
    ).to(schemas.GPCI)


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey", code_of_part(F.col("l_partkey")).alias("HCPCS_Cd"), "l_linestatus",
        "l_quantity", "l_linenumber", "l_extendedprice", "l_discount",
    )
    grain = lines.groupBy("l_suppkey", "HCPCS_Cd", "l_linestatus").agg(
        (F.sum("l_quantity") * 10.0).alias("Tot_Srvcs"),
        F.sum(F.col("l_linenumber") - 1).cast("double").alias("Tot_Benes"),
        (F.avg("l_extendedprice") / 50.0).alias("Avg_Sbmtd_Chrg"),
        (F.avg(F.col("l_extendedprice") * (1.0 - F.col("l_discount"))) / 100.0).alias("Avg_Mdcr_Alowd_Amt"),
    )
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    places = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    npi = F.col("l_suppkey")
    kind = F.element_at(F.array(*[F.lit(t) for t in PROVIDER_TYPES]), (npi % 10 + 1).cast("int"))
    return grain.join(places, npi == F.col("s_suppkey")).select(
        npi.alias("Rndrng_NPI"),
        F.col("n_name").alias("Rndrng_Prvdr_State_Abrvtn"),
        kind.alias("Rndrng_Prvdr_Type"),
        "HCPCS_Cd",
        F.col("l_linestatus").alias("Place_Of_Srvc"),
        "Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt",
        (F.col("Avg_Mdcr_Alowd_Amt") * 0.8).alias("Avg_Mdcr_Pymt_Amt"),
        F.when(npi % 7 == 0, "N").when(npi % 7 == 1, F.lit(None).cast("string")).otherwise("Y")
        .alias("Rndrng_Prvdr_Mdcr_Prtcptg_Ind"),
        F.when(npi % 4 == 0, "O").otherwise("I").alias("Rndrng_Prvdr_Ent_Cd"),
    )
