"""Projected folders by pattern; folder profiles in one plan; role queries by their plans."""
import os
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import govern as G
from tidemark.operators import profile as PR
from tidemark.sources import events as EV

ENUMS = {"event_type": ["a", "odd{name}*"]}


def test_the_pattern_lists_what_exists_only(spark, tmp_dir):
    for k in ("a/2024/01/05/13", "odd{name}*/2024/01/05/13", "a/2031/01/05/13", "b/2024/01/05/13"):
        os.makedirs(f"{tmp_dir}/{k}")
        with open(f"{tmp_dir}/{k}/part-0.json", "w") as f:
            f.write('{"event_id": "%s"}\n' % k[:1])
    ranges = {"y": (2000, 2029, 4), "m": (1, 12, 2), "d": (1, 31, 2), "h": (0, 23, 2)}  # half a million folders
    start = time.time()
    found = EV.projected_folders(spark, tmp_dir, EV.projected_glob(ENUMS, ranges))
    assert sorted(p.split(tmp_dir.rsplit("/", 1)[1] + "/")[1] for p in found) == ["a/2024/01/05/13", "odd{name}*/2024/01/05/13"]
    assert time.time() - start < 20
    assert EV.projected_glob(ENUMS, ranges, {"y": "2031"}) is None and EV.projected_folders(spark, tmp_dir, None) == []
    one = EV.read_projected(spark, tmp_dir, {"event_type": ["a"]}, ranges, {"h": "13"})
    assert [(r["event_type"], r["y"], r["h"]) for r in one.collect()] == [("a", "2024", "13")]
    assert EV.read_projected(spark, tmp_dir, {"event_type": ["c"]}, ranges).count() == 0


def test_folder_profile_is_one_plan(spark, tmp_dir):
    with open(tmp_dir + "/notes.csv", "w") as f:
        f.write('id,note\n1,"two\nlines, ""quoted"""\n1,"two\nlines, ""quoted"""\n2,\n')
    spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, "1")], "a int, b string").toPandas().astype({"a": "Int64"}).to_parquet(tmp_dir + "/t.parquet")
    spark.createDataFrame([(b"\x00", 1.5)], "raw binary, x double").toPandas().to_parquet(tmp_dir + "/notes.parquet")
    got = [tuple(r) for r in PR.profile_dir(spark, tmp_dir).collect()]
    assert [(t, n, c, d, w, float(p)) for t, n, c, d, w, p in got] == [
        ("notes", 3, 2, 1, "note", 33.33), ("notes", 1, 2, 0, "raw", 0.0), ("t", 4, 2, 1, "b", 50.0)]
    assert PR.profile_dir(spark, tmp_dir + "/..").columns == [x.split()[0] for x in PR.PROFILE_SCHEMA.replace("(18,2)", "").split(", ")]
    pair = spark.createDataFrame([(None, "x"), ("x", None), (None, "x")], "a string, b string")
    assert PR.profile(pair, "p").first()["duplicate_rows"] == PR.duplicate_rows(pair).first()[0] == 1


def test_role_queries_are_judged_by_their_plans(spark, tmp_dir):
    from tidemark.registry_jobs import role_attacks
    people = spark.createDataFrame([("1", "secret", "e1", "QC"), ("2", "secret", "e2", "ON")],
                                   "customer_id string, full_name string, email string, province string")
    people.write.parquet(tmp_dir + "/people")
    people.createOrReplaceTempView("attacked_view")
    spark.sql(f"CREATE TABLE attacked_table USING parquet LOCATION '{tmp_dir}/people'")
    registry, tables = G.default_registry(()), {"customer_pii": spark.read.parquet(tmp_dir + "/people")}
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    for name, sql in role_attacks(tmp_dir + "/people", "attacked_view", "attacked_table").items():
        if name.startswith("granted"):
            assert G.query_as(spark, registry, "analyst", sql, tables).count() >= 1, name
        else:
            with pytest.raises(G.AccessDenied):
                G.query_as(spark, registry, "analyst", sql, tables).collect()
    assert spark.catalog.tableExists("attacked_table") and spark.conf.get("spark.sql.ansi.enabled") == ansi
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("granted_")]
    spark.sql("DROP TABLE attacked_table")
    # the very plan that was judged is the result, whatever happens to names later
    seen = G.query_as(spark, registry, "analyst", "SELECT * FROM {customer_pii}", tables)
    spark.createDataFrame([("9",)], "customer_id string").createOrReplaceTempView("customer_pii")
    assert [r["customer_id"] for r in seen.collect()] == ["2"]
    assert seen.where(F.col("customer_id") == "2").count() == 1
