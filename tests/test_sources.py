"""S2-S6, K1: reference tables, the price series and subset loads."""

from datetime import date

import pytest
from conftest import rows

from ledgerlake.sources import landing, reference


def test_s2_all_text_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a ""b"", c"\n')
    (tmp_path / "b.csv").write_text("x,y\n002,\n")
    (tmp_path / "c.txt").write_text("x,y\n3,z\n")
    assert rows(reference.read_csv_dir(spark, str(tmp_path))) == [("002", None), ("1", 'a "b", c')]


def test_s2_columns_go_by_each_files_header(spark, tmp_path):
    """Files with reordered, missing or further columns, a byte order mark or a hidden name are read by name."""
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\r\n4,3\r\n")
    (tmp_path / "c.csv").write_text("\ufeffx,y\n5,6\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("x,z\n7,8\n")
    (tmp_path / "_e.csv").write_text("y,x\n10,9\n")
    (tmp_path / "f.csv").write_text("")
    df = reference.read_csv_dir(spark, str(tmp_path))
    assert rows(df.select("x", "y", "z")) == [("1", "2", None), ("3", "4", None), ("5", "6", None), ("7", None, "8"), ("9", "10", None)]
    assert rows(reference.read_csv_dir(spark, str(tmp_path), "[ab].csv").select("x", "y")) == [("1", "2"), ("3", "4")]


def test_s5_prices_of_two_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("NDC,NADAC Per Unit,As of Date\n1,2.0,01/14/2026\n")
    (tmp_path / "b.csv").write_text("As of Date,NDC,OTC,NADAC Per Unit\n01/21/2026,1,Y,3.0\n")
    got = reference.prices(spark, str(tmp_path), "l").select("ndc", "nadac_per_unit", "as_of_date", "is_otc")
    assert rows(got) == [("1", 2.0, date(2026, 1, 14), False), ("1", 3.0, date(2026, 1, 21), True)]


def test_s3_pharmacies(spark, tmp_path):
    (tmp_path / "p.csv").write_text("npi,chain\n 1 ,\tNorth \n,South\n2,\n")
    assert rows(reference.pharmacies(spark, str(tmp_path), "l")) == [("1", "North", "l"), ("2", "", "l")]


def test_s4_zero_is_not_blank(spark, tmp_path):
    (tmp_path / "p.csv").write_text("partner,fee_cents,fee_percentage\na,0,\nb,,50.0\nc,x, 12.5 \n,1,\nd,100,\n")
    assert rows(reference.partners(spark, str(tmp_path), "l").drop("load_id")) == [
        ("a", 0.0, None), ("b", None, 50.0), ("c", None, 12.5), ("d", 100.0, None)
    ]


def test_s5_prices_with_byte_order_mark(spark, tmp_path):
    header = (
        "NDC Description,NDC,NADAC Per Unit,Effective Date,Pricing Unit,Pharmacy Type Indicator,OTC,Explanation Code,"
        "Classification for Rate Setting,Corresponding Generic Drug NADAC Per Unit,"
        "Corresponding Generic Drug Effective Date,As of Date"
    )
    lines = [
        'PILL 5 MG,00012345601,0.12345,1/7/2026,EA,C/I,y ,"1, 5",G,,,01/14/2026',
        "SYRUP,00012345602,,1/7/2026,ML,C/I,N,1,B,,,01/14/2026",
        "CREAM,00012345603,2.5,soon,GM,C/I,N,1,B,,,never",
    ]
    (tmp_path / "prices.csv").write_text("﻿" + "\n".join([header, *lines]) + "\n", encoding="utf-8")
    assert rows(reference.prices(spark, str(tmp_path), "l").drop("load_id")) == [
        ("00012345601", "PILL 5 MG", 0.12345, date(2026, 1, 7), date(2026, 1, 14), "EA", "G", True),
        ("00012345603", "CREAM", 2.5, None, None, "GM", "B", False),
    ]


def test_s5_reads_only_the_columns_in_use(spark, tmp_path):
    (tmp_path / "p.csv").write_text("NDC,NADAC Per Unit,Explanation Code,OTC\n1,2.0,x,Y\n")
    df = reference.prices(spark, str(tmp_path), "l").select("ndc", "is_otc")
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "Explanation Code" not in scan.split("ReadSchema")[1]


def test_s6_subset_and_k1_refresh(spark, tmp_path):
    (tmp_path / "pharmacies").mkdir()
    (tmp_path / "partners").mkdir()
    source = tmp_path / "pharmacies" / "p.csv"
    source.write_text("npi,chain\n1,a\n2,b\n")
    paths = {"pharmacies": str(tmp_path / "pharmacies"), "partners": str(tmp_path / "partners")}
    first = landing.ingest(spark, paths, str(tmp_path / "out"), "1", only={"pharmacies"})
    assert list(first) == ["pharmacies"] and first["pharmacies"].count() == 2
    source.write_text("npi,chain\n3,c\n")
    again = landing.ingest(spark, paths, str(tmp_path / "out"), "2", only={"pharmacies"})
    assert rows(again["pharmacies"]) == [("3", "c", "2")]


def test_s6_unknown_source(spark, tmp_path):
    with pytest.raises(ValueError, match="no such source"):
        landing.ingest(spark, {"pharmacies": str(tmp_path)}, str(tmp_path / "out"), "1", only={"pharmacy"})


def test_s5_one_price_file_is_split_over_tasks_on_request(spark, tmp_path):
    folder = tmp_path / "nadac"
    folder.mkdir()
    (folder / "p.csv").write_text("NDC,NADAC Per Unit\n" + "".join(f"{i},2.0\n" for i in range(2000)))
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, "2048")
        assert reference.prices(spark, str(folder), "l").rdd.getNumPartitions() == 1
        split = reference.prices(spark, str(folder), "l", multi_line=False)
        assert split.rdd.getNumPartitions() > 1 and split.count() == 2000
        landed = landing.ingest(spark, {"nadac": str(folder)}, str(tmp_path / "out"), "1", multi_line=False)
        assert landed["nadac"].count() == 2000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
