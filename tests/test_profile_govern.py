"""Profiles (T17) and governance."""
import pytest

from tidemark.operators import govern as G
from tidemark.operators import profile as PR


def test_profile_nulls_duplicates_empty(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, "x", None)], "a int, b string, c string")
    p = PR.profile(df, "t").first()
    assert (p["rows"], p["columns"], p["duplicate_rows"], p["worst_null_col"], str(p["worst_null_pct"])) == \
        (3, 3, 1, "c", "100.00")
    ties = spark.createDataFrame([(None, None), (1, 2)], "a int, b int")
    assert PR.profile(ties, "t").first()["worst_null_col"] == "a"          # first column on ties
    empty = spark.createDataFrame([], "a int")
    e = PR.profile(empty, "e").first()
    assert (e["rows"], e["duplicate_rows"], str(e["worst_null_pct"])) == (0, 0, "0.00")


def pii(spark):
    cust = spark.createDataFrame([("1", "QC"), ("2", ""), ("3", "ON"), ("4", None)], "customer_id string, province string")
    return G.synth_pii(cust)


def test_synthetic_people_are_stable_and_shaped(spark):
    a = {r["customer_id"]: r.asDict() for r in pii(spark).collect()}
    b = {r["customer_id"]: r.asDict() for r in pii(spark).collect()}
    assert a == b
    assert a["1"]["postal_code"][0] == "H" and a["2"]["province"] == "ON" and a["4"]["province"] == "ON"
    assert all(v["sin_test"].startswith("000-") for v in a.values())
    first, last = a["1"]["full_name"].split(" ")
    assert first in G.FIRST and last in G.LAST and a["1"]["email"].startswith(first.lower() + "." + last.lower())


def test_roles(spark):
    reg = G.default_registry(["dim_date"])
    tables = {"customer_pii": pii(spark)}
    analyst = G.query_as(spark, reg, "analyst", "SELECT * FROM {customer_pii}", tables)
    assert analyst.columns == ["customer_id", "postal_code", "province"]
    assert {r["province"] for r in analyst.collect()} == {"ON"}
    with pytest.raises(G.AccessDenied):
        G.query_as(spark, reg, "analyst", "SELECT email FROM {customer_pii}", tables)
    with pytest.raises(G.AccessDenied):
        G.query_as(spark, reg, "nobody", "SELECT * FROM {customer_pii}", tables)
    reg.revoke("fraud", "customer_pii")
    with pytest.raises(G.AccessDenied):
        G.query_as(spark, reg, "fraud", "SELECT * FROM {customer_pii}", tables)
    cmp = G.compare_roles(spark, reg, ["SELECT email FROM {customer_pii}"], ["analyst", "fraud"], tables)
    assert {r["role"]: r["state"] for r in cmp.collect()} == {"analyst": "DENIED", "fraud": "DENIED"}


def test_mask(spark):
    df = spark.createDataFrame([("555-123-4567", "a@b.c")], "phone string, email string")
    m = G.mask(df, {"phone": "partial", "email": "hash"}).first()
    assert m["phone"] == "***-***-4567" and len(m["email"]) == 64


def test_profile_dir_csv_then_parquet(spark, tmp_dir):
    import os
    d = tmp_dir + "/data"
    os.makedirs(d)
    with open(d + "/b.csv", "w") as fh:
        fh.write("x,y\n1,\n1,\n2,z\n")
    spark.createDataFrame([(1,)], "a int").toPandas().to_parquet(d + "/a.parquet")
    rows = [(r["table"], r["rows"], r["duplicate_rows"], r["worst_null_col"]) for r in PR.profile_dir(spark, d).collect()]
    assert rows == [("b", 3, 1, "y"), ("a", 1, 0, "a")]


def test_profile_of_records_with_line_breaks(spark, tmp_dir):
    from tidemark.operators.profile import profile_dir
    with open(tmp_dir + "/notes.csv", "w") as f:
        f.write('id,note\n1,"two\nlines and ""quotes"""\n2,plain\n')
    r = profile_dir(spark, tmp_dir).first()
    assert (r["rows"], r["duplicate_rows"], float(r["worst_null_pct"])) == (2, 0, 0.0)


def test_a_role_reads_nothing_but_its_views(spark, tmp_dir):
    import pytest

    from tidemark.operators import govern as G
    people = spark.createDataFrame([("1", "secret", "QC"), ("2", "secret", "ON")], "customer_id string, full_name string, province string")
    people.write.parquet(tmp_dir + "/people")
    people.createOrReplaceTempView("people_as_they_are")
    registry, tables = G.default_registry(()), {"customer_pii": people}
    for sql in (f"SELECT full_name FROM parquet.`{tmp_dir}/people`", "SELECT full_name FROM people_as_they_are",
                "SELECT p.* FROM {customer_pii} v JOIN people_as_they_are p ON v.customer_id = p.customer_id"):
        with pytest.raises(G.AccessDenied):
            G.query_as(spark, registry, "analyst", sql, tables).collect()
    ok = G.query_as(spark, registry, "analyst", "WITH mine AS (SELECT * FROM {customer_pii}) SELECT customer_id FROM mine", tables)
    assert [r[0] for r in ok.collect()] == ["2"]
