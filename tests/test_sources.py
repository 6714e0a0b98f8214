from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from siftwork.sources import (
    check_columns,
    load_dataset,
    load_datasets,
    publish_to_zone,
    scan_csv,
    scan_dataset_by_position,
    scan_zone,
    write_table,
    zone_uri,
)
from siftwork.sources.csv_files import CORRUPT_COLUMN, NULL_TOKENS

FAILURES = (PySparkException, Py4JJavaError)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_scan_reads_text_by_header_name(spark, tmp_path):
    uri = write(tmp_path / "t.csv", "b,a\n1,x\n,y\n")
    df = scan_csv(spark, uri)
    assert df.dtypes == [("b", "string"), ("a", "string")]
    assert sorted((r.a, r.b) for r in df.collect()) == [("x", "1"), ("y", None)]


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_csv(spark, str(tmp_path / "nowhere.csv"))


def test_null_tokens(spark, tmp_path):
    quoted = "".join(f'"{token}",x\n' for token in NULL_TOKENS)
    uri = write(tmp_path / "t.csv", "a,b\n" + quoted + "none,x\n-,x\n   ,x\n")
    values = [row.a for row in scan_csv(spark, uri).collect()]
    assert sorted(v for v in values if v is not None) == ["   ", "-", "none"]
    assert len(values) == len(NULL_TOKENS) + 3
    kept = [row.a for row in scan_csv(spark, uri, null_tokens=()).collect()]
    assert "NA" in kept


def test_row_with_too_many_fields_fails_even_for_a_narrow_query(spark, tmp_path):
    uri = write(tmp_path / "t.csv", "a,b\n1,2\n1,2,3\n")
    with pytest.raises(FAILURES):
        scan_csv(spark, uri).select("a").collect()


@pytest.mark.parametrize("long", ["1,2,3", "1,2,", "1,2,,", '1,"2,2",3', ",,", "1,2,3,4"])
def test_short_rows_are_padded_and_long_rows_fail(spark, tmp_path, long):
    short = write(tmp_path / "short.csv", 'a,b\n1,2\n4\n"5,5"\n6,\n')
    df = scan_csv(spark, short)
    assert {tuple(r) for r in df.collect()} == {("1", "2"), ("4", None), ("5,5", None), ("6", None)}
    assert df.columns == ["a", "b"]
    assert df.count() == 4
    assert df.select("b").count() == 4
    bad = scan_csv(spark, write(tmp_path / "long.csv", f"a,b\n1,2\n{long}\n"))
    for query in (bad, bad.select("b"), bad.groupBy().count()):
        with pytest.raises(FAILURES):
            query.collect()


def test_failfast_scan_fails_on_short_rows(spark, tmp_path):
    uri = write(tmp_path / "t.csv", "a,b\n1,2\n4\n")
    with pytest.raises(FAILURES):
        scan_csv(spark, uri, mode="FAILFAST").collect()


def test_permissive_scan_keeps_malformed_rows(spark, tmp_path):
    uri = write(tmp_path / "t.csv", "a,b\n1,2\n1,2,3\n4\n")
    rows = {tuple(r) for r in scan_csv(spark, uri, mode="PERMISSIVE").collect()}
    assert rows == {("1", "2", None), ("1", "2", "1,2,3"), ("4", None, "4")}
    assert scan_csv(spark, uri, mode="PERMISSIVE").columns[-1] == CORRUPT_COLUMN


def test_column_contract(spark, sample_folder):
    df = load_dataset(spark, "customers", f"{sample_folder}/customers.csv")
    assert check_columns(df.withColumn("more", df.email), "customers")
    with pytest.raises(ValueError, match="email"):
        check_columns(df.drop("email"), "customers")


def test_all_datasets(spark, sample_folder):
    loaded = load_datasets(spark, sample_folder)
    assert {name: df.count() for name, df in loaded.items()} == {
        "customers": 24,
        "products": 15,
        "orders": 40,
    }


def test_fixed_schema_rejects_another_header(spark, tmp_path):
    good = "product_id,product_name,category,price\n1,a,NA,3\n"
    df = scan_dataset_by_position(spark, "products", write(tmp_path / "good.csv", good))
    assert [tuple(r) for r in df.collect()] == [("1", "a", "NA", "3")]
    swapped = "product_name,product_id,category,price\na,1,b,3\n"
    with pytest.raises(FAILURES):
        scan_dataset_by_position(
            spark, "products", write(tmp_path / "bad.csv", swapped)
        ).collect()


def test_files_of_one_folder_must_share_their_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "1.csv", "a,b\n1,2\n")
    write(folder / "2.csv", "b,a\n1,2\n")
    with pytest.raises(FAILURES):
        scan_csv(spark, str(folder)).collect()


def test_text_survives_a_round_trip(spark, tmp_path):
    rows = [(" lead", 'q"uo"te'), ("tail ", "com,ma"), ("back\\slash", None), ("\\", "\\\""), ("é", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    uri = write_table(df, str(tmp_path / "out"))
    assert sorted(map(str, scan_csv(spark, uri).collect())) == sorted(map(str, df.collect()))


def test_line_breaks_inside_quotes(spark, tmp_path):
    uri = write(tmp_path / "t.csv", 'a,b\n"x\ny",1\n')
    assert [tuple(r) for r in scan_csv(spark, uri, multi_line=True).collect()] == [("x\ny", "1")]
    with pytest.raises(FAILURES):
        scan_csv(spark, uri).collect()


def test_zones(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    publish_to_zone(df, root, "processed", "first")
    publish_to_zone(df, root, "processed", "second")
    (tmp_path / "store/processed/second/notes.txt").write_text("not a table\n")
    assert scan_zone(spark, root, "processed").count() == 4
    assert scan_zone(spark, root, "processed", "first").count() == 2
    publish_to_zone(df.limit(1), root, "processed", "first")
    assert scan_zone(spark, root, "processed", "first").count() == 1
    with pytest.raises(ValueError):
        zone_uri(root, "elsewhere")
