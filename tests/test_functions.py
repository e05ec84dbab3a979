"""Scalar cleaning expressions."""

from pyspark.sql import functions as F

from cohortlens.functions import cleaning as cl


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("V05.3", "icd9_40390_30d", "19400101", " 0389 ", None, "20090101.0")],
                               "code string, feat string, birth string, dx string, blank string, d string")
    r = df.select(cl.remove_dots("code").alias("nodots"), cl.feature_code("feat").alias("fc"),
                  cl.age_in_year(cl.parse_date("birth"), 2009).alias("age"),
                  cl.normalize_key("dx").alias("norm"), cl.clean_code("blank").alias("blank"),
                  cl.parse_date("d").alias("d"), cl.parse_date(F.lit("2009-13-01")).alias("bad"),
                  cl.any_slot_equals(["dx", "blank"], " 0389 ").alias("hit"),
                  cl.age_in_year(F.lit(None).cast("date"), 2009).alias("age0")).first()
    assert r.nodots == "V053" and r.fc == "40390" and r.age == 69 and r.age0 == 0
    assert r.norm == "389" and r.blank == "" and str(r.d) == "2009-01-01" and r.bad is None and r.hit is True
