import os

import pytest

from reelhouse.sources import bronze

RATINGS_HEADER = "Date,Name,Year,Letterboxd URI,Rating"


def write(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_csv_dialect(spark, tmp_dir):
    text = (
        "﻿Date,Name,Year,Letterboxd URI,Rating,Rewatch,Review,Tags,Watched Date\r\n"
        '2024-01-01,"A ""q"", b",2019,https://x/1,4,Yes,"line one\r\nline two",,2024-01-02\r\n'
        "\r\n"
        "2024-01-03,None,,https://x/2,NA,,ok, NA ,2024-01-04\r\n"
    )
    path = write(tmp_dir, "reviews.csv", text, encoding="utf-8")
    df = bronze.to_bronze(bronze.read_export(spark, path), "reviews")
    assert df.columns == [
        "list_date", "name", "year", "letterboxd_uri", "rating", "rewatch", "review", "tags",
        "watched_date",
    ]
    rows = df.orderBy("list_date").collect()
    assert len(rows) == 2
    assert rows[0].name == 'A "q", b'
    assert rows[0].review == "line one\r\nline two"
    assert rows[0].tags is None
    assert rows[1].name is None and rows[1].rating is None and rows[1].year is None
    assert rows[1].tags == " NA "


def test_short_row_padded_long_row_fails(spark, tmp_dir):
    short = write(tmp_dir, "s_ratings.csv", f"{RATINGS_HEADER}\n2024-01-01,A,2019\n")
    rows = bronze.read_export(spark, short).collect()
    assert rows[0]["Letterboxd URI"] is None and rows[0]["Rating"] is None
    long = write(tmp_dir, "l_ratings.csv", f"{RATINGS_HEADER}\n2024-01-01,A,2019,u,4\n2024,B,2019,u,4,extra\n")
    with pytest.raises(Exception, match="more fields than the header"):
        bronze.read_export(spark, long).collect()


def test_missing_and_extra_columns(spark, tmp_dir):
    missing = write(tmp_dir, "m_ratings.csv", "Date,Name,Year,Rating\n2024-01-01,A,2019,4\n")
    with pytest.raises(ValueError, match=r"ratings export lacks the columns \['Letterboxd URI'\]"):
        bronze.to_bronze(bronze.read_export(spark, missing), "ratings")
    extra = write(tmp_dir, "e_ratings.csv", f"{RATINGS_HEADER},Note\n2024-01-01,A,2019,u,4,hi\n")
    df = bronze.to_bronze(bronze.read_export(spark, extra), "ratings")
    assert df.columns[-1] == "Note" and df.collect()[0].Note == "hi"


def test_header_case_is_checked(spark, tmp_dir):
    path = write(tmp_dir, "c_ratings.csv", "date,Name,Year,Letterboxd URI,Rating\nx,A,2019,u,4\n")
    with pytest.raises(ValueError, match="Date"):
        bronze.to_bronze(bronze.read_export(spark, path), "ratings")


def test_unknown_dataset():
    with pytest.raises(ValueError, match="the datasets are diary"):
        bronze.bronze_table_name("films")


def test_inferred_numeric_text(spark):
    df = spark.createDataFrame(
        [("2019", "007", "4", "4"), (None, "12", "4.5", "5")],
        "year string, name string, rating string, whole string",
    )
    out = bronze.inferred_numeric_text(df).collect()
    assert [r.year for r in out] == ["2019.0", None]
    assert [r.name for r in out] == ["7", "12"]
    assert [r.rating for r in out] == ["4.0", "4.5"]
    assert [r.whole for r in out] == ["4", "5"]


def test_append_and_empty_skip(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_t")
    header_only = write(tmp_dir, "h_ratings.csv", f"{RATINGS_HEADER}\n")
    assert bronze.load_files(spark, header_only, "ratings", layer="bronze_t") is False
    one = write(tmp_dir, "o_ratings.csv", f"{RATINGS_HEADER}\n2024-01-01,A,2019,u,4\n")
    assert bronze.load_files(spark, one, "ratings", layer="bronze_t")
    assert bronze.load_files(spark, one, "ratings", layer="bronze_t")
    # append-only: the same file twice gives its rows twice
    assert spark.table("bronze_t.ratings").count() == 2


def test_bronze_shape_frozen_by_first_load(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_f")
    first = write(tmp_dir, "1_watched.csv", "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2019,u\n")
    assert bronze.load_files(spark, first, "watched", layer="bronze_f")
    wider = write(tmp_dir, "2_watched.csv", "Date,Name,Year,Letterboxd URI,Note\n2024-01-01,A,2019,u,x\n")
    with pytest.raises(Exception):
        bronze.load_files(spark, wider, "watched", layer="bronze_f")
    assert spark.table("bronze_f.watched").count() == 1


def test_headers_differing_only_in_case(spark, tmp_dir):
    # Spark renames such a pair (Name0, name1), so the required-column check fires.
    path = write(tmp_dir, "d_watched.csv", "Date,Name,name,Year,Letterboxd URI\n2024-01-01,A,a,2019,u\n")
    with pytest.raises(ValueError, match="watched export lacks the columns \\['Name'\\]"):
        bronze.to_bronze(bronze.read_export(spark, path), "watched")


def test_load_creates_missing_layer(spark, tmp_dir):
    path = write(tmp_dir, "n_watched.csv", "Date,Name,Year,Letterboxd URI\n2024-01-01,A,2019,u\n")
    assert bronze.load_files(spark, path, "watched", layer="bronze_new_layer")
    assert spark.table("bronze_new_layer.watched").count() == 1


def test_chosen_file_is_read_whatever_its_name(spark, tmp_dir):
    for name in ("2_ratings.csv", "[2024]_ratings.csv", "{x}_ratings.csv", "a*b?_ratings.csv"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(f"Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,{name},2001,u1,4.5\n")
    for name in os.listdir(tmp_dir):
        rows = bronze.read_files(spark, os.path.join(tmp_dir, name), "ratings").collect()
        assert [r.name for r in rows] == [name]


def test_files_are_put_together_by_column_name(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a_ratings.csv"), os.path.join(tmp_dir, "b_ratings.csv")
    with open(a, "w") as f:
        f.write("Date,Name,Year,Letterboxd URI,Rating\n2024-01-01,A,2001,u1,4.5\n")
    with open(b, "w") as f:
        f.write("Date,Name,Year,Rating,Letterboxd URI\n2024-01-02,B,2002,3,u2\n")
    rows = bronze.read_files(spark, [a, b], "ratings").collect()
    assert sorted((r.name, r.rating, r.letterboxd_uri) for r in rows) == [("A", "4.5", "u1"), ("B", "3", "u2")]


def test_inferred_text_equals_a_type_inferring_reader(spark):
    """Each column as pandas prints it after reading it from CSV."""
    import io

    import pandas as pd

    columns = [
        ["12345678", None, "20000000.5"], ["1e5", "2", "3.25"], ["007", "8", "-9"], ["True", "false", "TRUE"],
        ["True", None, "False"], ["1e16", "0.0001", "1.5e-5"], ["0", "-0.0", "123456789012345.5"],
        ["99999999999999999999999", "1", "2"], ["18446744073709551615", "1", "2"], ["x", "1", "2"],
        [".5", "5.", "+7"], ["1.5e300", "2.5E-300", "1"], ["10000000", None, "1e15"],
    ]
    for values in columns:
        text = "a,b\n" + "".join(f"{'' if v is None else v},z\n" for v in values)
        want = [None if pd.isna(v) else str(v) for v in pd.read_csv(io.StringIO(text))["a"].astype(object)]
        df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "i string, a string")
        from reelhouse.sources import bronze

        got = bronze.inferred_numeric_text(df.select("a", "i")).collect()
        assert [r.a for r in got] == want, values
