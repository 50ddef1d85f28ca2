"""The adapters reproduce the numbers measured in FIXTURES.md (sf0.01)."""
from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.plans import business as B
from tidemark.plans import curated as CU

SF = "/root/testdata/sf0.01"


def test_adapter_numbers(spark):
    fact = CU.fact(spark, SF)
    c = CU.curated(spark, SF)
    r = fact.agg(F.count("*").alias("n"), F.count_if("is_late").alias("late"), F.count_if("at_risk").alias("risk"),
                 F.min("price").alias("pmin"), F.max("price").alias("pmax"),
                 F.min("freight_value").alias("fmin"), F.max("freight_value").alias("fmax")).first()
    assert (r["n"], r["late"], r["risk"]) == (45832, 7490, 26665)
    assert (str(r["pmin"]), str(r["pmax"]), str(r["fmin"]), str(r["fmax"])) == ("901.82", "104997.88", "0.25", "12.50")
    assert B.clv_by_cohort(fact, c.dim_customer, 20, 1000).count() == 13
    # FIXTURES.md counts cohorts on the provinces before any change batch
    assert B.clv_by_cohort(fact, c.dim_runs[0], 2, 1000).count() == 177
    assert B.total(fact, "1998-06-01 00:00:00", "1998-07-01 00:00:00").first()["lines"] == 568
    ops = {k: [] for k in (1, 2, 3)}
    for k in (1, 2, 3):
        latest = C.prepare(c.change_batches[k], ["customer_id"])
        got = {r["Op"]: r["n"] for r in latest.groupBy("Op").agg(F.count("*").alias("n")).collect()}
        ops[k] = (got.get("I", 0), got.get("U", 0), got.get("D", 0))
    assert ops == {1: (37, 83, 30), 2: (33, 91, 26), 3: (31, 89, 30)}
