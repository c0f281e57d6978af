"""Term matching and containment against regular expressions and plain search."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lodestead.functions.terms import counts, term_index, term_matches
from lodestead.operators import classify, taxonomy


def plain_matches(text, terms):
    return {name: re.findall(classify.term_pattern(tuple(own)), text, re.ASCII) for name, own in terms.items()}


def test_matches_are_those_of_the_expression(spark):
    rnd = random.Random(4)
    words = ["tax", "code", "tax_code", "a", "order", "no", "é", "x1"]
    terms = {
        "one": ("tax", "tax code", "code", "order no", "sales order", "a"),
        "two": ("tax-code", "code order no", "a a", "a a a", "x1"),
        "three": ("c'est", "tax\\x1", "order  no"),
    }
    texts = ["", "sales order no", "a a a a a", "c'est tax\\x1 order  no", "tax-code tax_code"] + ["".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "-", "_", "."]) for _ in range(rnd.randint(1, 25))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("m", term_matches(F.col("text"), terms))
    got = {r["text"]: r for r in df.select("text", "m", *[c.alias(n) for n, c in counts(F.col("m"), terms).items()]).collect()}
    for t in texts:
        want = plain_matches(t, terms)
        assert {n: [m["term"] for m in got[t]["m"] if m["list"] == k] for k, n in enumerate(terms)} == want
        assert {n: got[t][n] for n in terms} == {n: len(v) for n, v in want.items()}
    assert spark.range(1).select(term_matches(F.lit(None).cast("string"), terms)).first()[0] is None
    with pytest.raises(ValueError, match="begin and end"):
        term_index({"x": ("-a",)})


def test_ten_times_the_terms_cost_about_the_same(spark):
    words = spark.range(0, 20_000, 1, 8).select(F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(9_000))) for k in range(40)]).alias("text")).cache()
    words.count()
    seconds = {}
    for n in (400, 4_000):
        terms = {f"list_{k}": tuple(f"w{i}" for i in range(k, n, 8)) for k in range(8)}
        found = words.select(F.size(term_matches(F.col("text"), terms)).alias("n"))
        found.agg(F.sum("n")).first()  # plans and compiles
        began = time.time()
        total = found.agg(F.sum("n")).first()[0]
        seconds[n] = time.time() - began
        assert total > n * 80
    assert seconds[4_000] < 4 * seconds[400] + 1


def test_containment_without_a_nested_loop(spark):
    rnd = random.Random(5)
    texts = sorted({"".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12))) for _ in range(400)})
    aliases = sorted({"".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 5))) for _ in range(150)} | {"zzz"})
    pairs = taxonomy.contained(spark.createDataFrame([(t,) for t in texts * 2] + [(None,)], "text string"), spark.createDataFrame([(a, a.upper()) for a in aliases] + [(None, "N")], "alias string, target string"))
    assert sorted((r["text"], r["alias"]) for r in pairs.collect()) == sorted((t, a) for t in texts for a in aliases if a and a in t)
    known = spark.createDataFrame([("x", "y")], "prefix string, target string")
    plan = taxonomy.remapped(spark.createDataFrame([(1, "rh", "A")], "id int, label_raw string, technical_name string"), spark.createDataFrame([("rh", "RH")], "alias string, target string"), known, known)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
