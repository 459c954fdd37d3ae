"""File scans: CSV with a preamble, the payments file, and column types fixed by schema."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens import schemas
from remitlens.functions import scalars as S

ENCODINGS = ("UTF-8", "ISO-8859-1")
# Header names of the published files -> our column names. A repeated header name
# gets a ".1" suffix at its second position.
RVU_COLUMNS = {
    "HCPCS": "HCPCS", "DESCRIPTION": "DESCRIPTION", "CODE": "STATUS_CODE", "RVU": "WORK_RVU",
    "PE RVU": "NON_FAC_PE_RVU", "PE RVU.1": "FACILITY_PE_RVU", "RVU.1": "MP_RVU",
    "FACTOR": "CONVERSION_FACTOR_FROM_FILE",
}
GPCI_COLUMNS = {
    "Medicare Administrative Contractor (MAC)": "MAC", "State": "State",
    "Locality Number": "Locality_Number", "Locality Name": "Locality_Name",
    "2023 PW GPCI (with 1.0 Floor)": "WORK_GPCI", "2023 PE GPCI": "PE_GPCI", "2023 MP GPCI": "MP_GPCI",
}
RVU_HEADER_LINE, GPCI_HEADER_LINE = 9, 2
PAYMENTS_GLOB = "*Prov_Svc.csv"


def unique_names(header: Sequence[str]) -> list[str]:
    """Header names by position; repeats become name.1, name.2, ..."""
    seen: dict[str, int] = {}
    out = []
    for i, raw in enumerate(header):
        name = raw.strip() or f"Unnamed: {i}"
        out.append(f"{name}.{seen[name]}" if name in seen else name)
        seen[name] = seen.get(name, 0) + 1
    return out


def _numbered(df: DataFrame) -> DataFrame:
    """Rows with their block start and an order inside it: the preamble is the first rows of block 0."""
    return df.withColumn("_block", F.col("_metadata.file_block_start")).withColumn("_at", F.monotonically_increasing_id())


def _header(spark: SparkSession, path: str, header_line: int) -> list[str]:
    lines = _numbered(spark.read.text(path)).where((F.col("_block") == 0) & (F.trim("value") != ""))
    first = lines.orderBy("_at").limit(header_line + 1).collect()  # header_line + 1 rows at most
    if len(first) <= header_line:
        raise ValueError(f"{path} has no line {header_line}")
    return next(csv.reader([first[header_line]["value"]]))


def read_preamble_csv(
    spark: SparkSession,
    path: str,
    header_line: int,
    columns: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
    encodings: Sequence[str] = ENCODINGS,
    null_tokens: Sequence[str] = tuple(C.CSV_NULL_TOKENS),
) -> DataFrame:
    """One CSV file whose header is the ``header_line``-th non-blank line (from 0).

    Every column is read as text, missing-value tokens become NULL, rows that are entirely empty
    are dropped, then columns are renamed and cast tolerantly to ``schema``. The first encoding
    under which no character is undecodable is used.
    """
    names = unique_names(_header(spark, path, header_line))
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    for encoding in encodings:
        raw = spark.read.schema(text).option("encoding", encoding).option("enforceSchema", True).csv(path)
        everything = F.concat_ws(" ", *[F.col(f"`{n}`") for n in names])
        if encoding == encodings[-1] or raw.where(everything.contains("�")).isEmpty():
            break
    numbered = _numbered(raw)
    # The header is found again by its place, so the same plan that skips it also reads the data.
    head = numbered.where(F.col("_block") == 0).orderBy("_at").limit(header_line + 1).agg(F.max("_at").alias("m")).first()["m"]
    data = numbered.where((F.col("_block") > 0) | (F.col("_at") > F.lit(head))).select(*[
        F.when(~F.col(f"`{n}`").isin(list(null_tokens)), F.col(f"`{n}`")).alias(n) for n in names
    ]).where(F.coalesce(*[F.col(f"`{n}`") for n in names]).isNotNull())  # not entirely empty
    if columns is not None:
        data = data.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])
    return data if schema is None else cast_to(data, schema)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Tolerant casts: text that is no number becomes NULL."""
    return df.select(*[
        (S.to_double(f"`{f.name}`") if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`").try_cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def read_rvu(spark: SparkSession, path: str) -> DataFrame:
    return read_preamble_csv(spark, path, RVU_HEADER_LINE, RVU_COLUMNS, schemas.RVU)


def read_gpci(spark: SparkSession, path: str) -> DataFrame:
    return read_preamble_csv(spark, path, GPCI_HEADER_LINE, GPCI_COLUMNS, schemas.GPCI)


def newest_payments_file(spark: SparkSession, root: str, glob: str = PAYMENTS_GLOB) -> str:
    """The last matching file name under a folder tree. A file that Spark wrote is a folder of parts, and counts as one file."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
        .select("path")
    )
    found = listing.agg(F.max("path").alias("p")).first()["p"]
    if found is None:
        raise FileNotFoundError(f"no {glob} under {root}")
    folder, name = found.rsplit("/", 1)
    return folder if name.startswith("part-") else found


def read_payments(spark: SparkSession, root: str, glob: str = PAYMENTS_GLOB) -> DataFrame:
    """The newest payments file with fixed column types; missing required columns are an error."""
    path = newest_payments_file(spark, root, glob)
    raw = spark.read.option("header", True).csv(path)
    absent = [f.name for f in schemas.PAYMENTS.fields if f.name not in raw.columns]
    if absent:
        raise KeyError(f"payments file lacks {absent}")
    wanted = raw.select(*[
        F.when(~F.col(f.name).isin(C.CSV_NULL_TOKENS), F.col(f.name)).alias(f.name) for f in schemas.PAYMENTS.fields
    ])
    return cast_to(wanted, schemas.PAYMENTS)
