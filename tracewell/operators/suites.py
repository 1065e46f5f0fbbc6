"""Declared expectations over results: every check is a row, and all checks of all cases are evaluated in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a check may ask of the values of a field. A check without an expected value holds.
OPERATORS = ("equal", "contains", "prefix", "all", "minimum", "at_most", "absent")


def facts(results: DataFrame, case: str, fields: dict[str, Column]) -> DataFrame:
    """(case_id, field, value): a row for each value of each field; arrays give a row for each element."""
    kinds = dict(results.select(*[c.alias(n) for n, c in fields.items()]).dtypes)
    one = lambda n, c: F.transform(c, lambda x: x.cast("string")) if kinds[n].startswith("array") else F.array(c.cast("string"))
    named = lambda n, c: F.transform(one(n, c), lambda v: F.struct(F.lit(n).alias("field"), v.alias("value")))
    pairs = F.concat(*[named(n, c) for n, c in fields.items()])
    return results.select(F.col(case).alias("case_id"), F.explode(pairs).alias("f")).select("case_id", "f.field", "f.value").where("value IS NOT NULL")


def evaluate(checks: DataFrame, found: DataFrame) -> DataFrame:
    """(case_id, check_id, op, ok) of checks(case_id, check_id, field, op, expected array<string>) against facts.

    equal: some value is one of the expected; contains, prefix: some value has one inside or at its beginning; all: each expected is a value;
    minimum, at_most: the largest or smallest value is at least or at most the expected number; absent: no value is one of the expected.
    """
    values = found.join(F.broadcast(checks.select("case_id", "field").distinct()), ["case_id", "field"], "left_semi").groupBy("case_id", "field")
    values = values.agg(F.collect_set("value").alias("v"), F.max(F.col("value").try_cast("double")).alias("high"), F.min(F.col("value").try_cast("double")).alias("low"))
    rows = checks.join(values, ["case_id", "field"], "left").withColumn("v", F.coalesce("v", F.array().cast("array<string>")))
    some = lambda test: F.exists("v", lambda v: F.exists("expected", lambda e: test(v, e)))
    number = F.try_element_at("expected", F.lit(1)).try_cast("double")
    tests = {
        "equal": F.arrays_overlap("v", "expected"),
        "contains": some(lambda v, e: F.lower(v).contains(F.lower(e))),
        "prefix": some(lambda v, e: v.startswith(e)),
        "all": F.size(F.array_except("expected", "v")) == 0,
        "minimum": F.col("high") >= number,
        "at_most": F.col("low") <= number,
        "absent": ~F.arrays_overlap("v", "expected"),
    }
    ok = F.lit(False)
    for name, test in tests.items():
        ok = F.when(F.col("op") == name, F.coalesce(test, F.lit(False))).otherwise(ok)
    return rows.select("case_id", "check_id", "op", (ok | F.col("expected").isNull() | (F.size("expected") == 0)).alias("ok"))


def summary(evaluated: DataFrame) -> DataFrame:
    """(case_id, checks, passed, failed, ok)."""
    out = evaluated.groupBy("case_id").agg(F.count("*").alias("checks"), F.count_if("ok").alias("passed"))
    return out.withColumn("failed", F.col("checks") - F.col("passed")).withColumn("ok", F.col("failed") == 0)


def expected_ranks(expected: DataFrame, results: DataFrame) -> DataFrame:
    """(query_id, post_id, rank): the best rank of each expected post, null where it isn't among the results; url_part may narrow it down."""
    r = results.select("query_id", "post_id", F.col("rank").alias("r"), "source_url")
    both = F.broadcast(expected).join(r, ["query_id", "post_id"], "left")
    fits = F.col("url_part").isNull() | F.col("source_url").contains(F.col("url_part"))
    return both.groupBy("query_id", "post_id").agg(F.min(F.when(fits, F.col("r"))).alias("rank"))


def edges_there(expected: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, from_node, to_node, there) of expected edges."""
    key = ["kind", "from_node", "to_node"]
    found = edges.join(F.broadcast(expected.select(*key).distinct()), key, "left_semi").select(*key).distinct().withColumn("there", F.lit(True))
    return expected.join(found, key, "left").withColumn("there", F.coalesce("there", F.lit(False)))


def proof(checks: DataFrame) -> DataFrame:
    """One row (checks, passed, ok) of checks(name, ok)."""
    return checks.agg(F.count("*").alias("checks"), F.count_if("ok").alias("passed"), F.bool_and("ok").alias("ok"))
