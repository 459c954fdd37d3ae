"""CSV with a preamble, repeated headers, encodings, discovery of the payments file, sinks."""

import pytest
from pyspark.sql import functions as F

from remitlens import schemas
from remitlens.sources import files, sinks

PREAMBLE = "".join(f'"note {i}, with a comma",,\n' for i in range(9))


def test_fee_schedule_with_repeated_headers(spark, tmp_path):
    body = (
        "HCPCS,DESCRIPTION,CODE,RVU,PE RVU,PE RVU,RVU,FACTOR\n"
        '99213,"Visit, office",A,1.30,1.33,0.55,0.10,33.8872\n'
        "00100,Anesthesia,J,NA,,0.00,x,33.8872\n"
        ",,,,,,,\n"
        "NULL,footer,,,,,,\n"
    )
    path = tmp_path / "rvu.csv"
    path.write_text(PREAMBLE + body)
    df = files.read_rvu(spark, str(path))
    assert df.schema == schemas.RVU
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted([
        ("99213", "Visit, office", "A", 1.30, 1.33, 0.55, 0.10, 33.8872),
        ("00100", "Anesthesia", "J", None, None, 0.0, None, 33.8872),
        (None, "footer", None, None, None, None, None, None),
    ], key=str)


def test_header_names_by_position():
    assert files.unique_names(["A", "B", "A", "", "A"]) == ["A", "B", "A.1", "Unnamed: 3", "A.2"]


def test_latin_1_is_detected(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_bytes("t1\nt2\nState,Locality Name\nPR,Añasco\n".encode("latin-1"))
    df = files.read_preamble_csv(spark, str(path), 2)
    assert [tuple(r) for r in df.collect()] == [("PR", "Añasco")]


def test_a_large_file_keeps_every_row(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("a\nb\nx,y\n" + "".join(f"{i},{i * 2}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.read_preamble_csv(spark, str(path), 2)
        assert df.rdd.getNumPartitions() > 3
        assert tuple(df.agg(F.count("*"), F.sum(F.col("x").cast("long"))).first()) == (20000, 199990000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_newest_payments_file(spark, tmp_path):
    cols = [f.name for f in schemas.PAYMENTS.fields]
    for year, amount in (("2022", "1"), ("2023", "2")):
        folder = tmp_path / year
        folder.mkdir()
        row = {c: "" for c in cols} | {"Rndrng_NPI": "10", "HCPCS_Cd": "00100", "Avg_Mdcr_Alowd_Amt": amount, "Tot_Benes": "bad"}
        (folder / f"D{year}_Prov_Svc.csv").write_text(",".join(cols) + ",extra\n" + ",".join(row[c] for c in cols) + ",1\n")
    row = files.read_payments(spark, str(tmp_path)).first()
    assert (row["HCPCS_Cd"], row["Avg_Mdcr_Alowd_Amt"], row["Tot_Benes"], row["Rndrng_NPI"]) == ("00100", 2.0, None, 10)
    with pytest.raises(FileNotFoundError):
        files.newest_payments_file(spark, str(tmp_path), "*.nothing")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, k long")
    back = sinks.write_stage(df, str(tmp_path), "t", ["k"])
    assert back.where("k = 1").count() == 10
    sinks.write_report(df, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 30
    assert [r["id"] for r in sinks.audit_sample(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_shared_folder_is_the_sessions(spark):
    from remitlens.session import materialize, shared_dir

    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert materialize(spark.range(3)).inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(shared_dir(spark).lstrip("/"))
