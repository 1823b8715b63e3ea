from pyspark.sql import Observation

from tidemark.operators.quality import measure, observe_rules, observed_counts, tag
from tidemark.schemas import PARTNER_RULES

RULES = {"known": "v IN ('a', 'b')", "short": "v IS NULL OR length(v) = 1"}


def rows(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "long"), (2, None)], "g int, v string"
    )


def test_every_row_is_counted_and_null_fails(spark):
    counted = {tuple(r) for r in measure(rows(spark), RULES).collect()}
    assert counted == {("known", 2, 2), ("short", 3, 1)}


def test_counts_per_group(spark):
    counted = {tuple(r) for r in measure(rows(spark), RULES, by=["g"]).collect()}
    assert counted == {(1, "known", 2, 0), (2, "known", 0, 2), (1, "short", 2, 0), (2, "short", 1, 1)}


def test_no_rows_give_zero_counts(spark):
    counted = measure(rows(spark).where("g > 9"), RULES).collect()
    assert {tuple(r) for r in counted} == {("known", 0, 0), ("short", 0, 0)}


def test_all_rules_share_one_pass(spark, plan, folder):
    df = spark.createDataFrame([("x",) * 5], "bp_number string, bp_category string, "
                               "country_code string, event_type string, sap_client string")
    df.write.parquet(folder)
    text = plan(measure(spark.read.parquet(folder), PARTNER_RULES))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1


def test_rows_are_tagged_with_the_rules_they_break(spark):
    tagged = {(r.g, r.v): r.failed_rules for r in tag(rows(spark), RULES).collect()}
    assert tagged == {(1, "a"): [], (1, "b"): [], (2, "long"): ["known", "short"],
                      (2, None): ["known"]}


def test_counts_are_observed_while_writing(spark, folder):
    seen = Observation()
    observe_rules(rows(spark), RULES, seen).write.parquet(folder)
    assert observed_counts(seen, RULES) == [("known", 2, 2), ("short", 3, 1)]
    assert spark.read.parquet(folder).count() == 4
