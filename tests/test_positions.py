"""A row's place in its files."""
import csv
import os

import pytest

from hrlens.sources.positions import with_position
from hrlens.sources.registry_csv import REGISTRY_HEADERS, read_registry_csv, read_text_csv


@pytest.fixture
def folder(tmp_path):
    """Three files of very different size, with repeated rows, headers and blank lines."""
    for name, rows in (("b.csv", 3000), ("a.csv", 40), ("c.csv", 1)):
        with open(tmp_path / name, "w") as f:
            f.write("name,v\n")
            for i in range(rows):
                f.write(f"{name[0]}{i // 3},{'x' * (i % 50)}\n" + ("\n" if i % 17 == 0 else ""))
    return tmp_path


def in_order(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.endswith(".csv"):
            with open(folder / name) as f:
                out += [r["name"] for r in csv.DictReader(f)]
    return out


@pytest.mark.parametrize("block", ["2k", "16k", "128m"])
def test_order_of_files_however_they_are_cut(spark, folder, block):
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = with_position(read_text_csv(spark, str(folder))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["name"] for r in sorted(rows, key=lambda r: r["position"])] == in_order(folder)
    assert sorted(r["position"] for r in rows) == list(range(3041))


def test_filtered_scan_and_edges(spark, folder):
    scan = read_text_csv(spark, str(folder))
    some = with_position(scan.where("name like 'b%'"), "place").orderBy("place").collect()
    assert [r["name"] for r in some] == [n for n in in_order(folder) if n[0] == "b"] and some[0].asDict().keys() == {"name", "v", "place"}
    assert with_position(scan.where("name = 'none'")).count() == 0
    with pytest.raises(ValueError):
        with_position(scan.withColumnRenamed("v", "position"))


def test_registry_rows_have_their_own_key(spark, tmp_path):
    """Exact duplicates are told apart, and ties go to the row that comes first in the files."""
    head = ",".join(REGISTRY_HEADERS)
    for name, lines in (("1.csv", ["가,1,300,900,11,7,2020-01-05,,1,1", "나,1,300,900,11,7,2020-01-05,,1,1"]), ("0.csv", ["다,1,300,900,11,7,2020-01-05,,1,1"] * 2)):
        (tmp_path / name).write_bytes(("\n".join([head, *lines]) + "\n").encode("cp949"))
    reg = read_registry_csv(spark, str(tmp_path))
    assert [(r["est_id"], r["est_name"]) for r in reg.orderBy("est_id").collect()] == [(0, "다"), (1, "다"), (2, "가"), (3, "나")]
    first = reg.orderBy(reg.billed_amount.desc(), "est_id").limit(1).first()
    assert first["est_name"] == "다"
