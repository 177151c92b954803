from fractions import Fraction

import pytest

from termloom.operators import units

A = units.automaton()
CASES = [
    (("(15 mg)", "see amount", ""), ("15", "mg")),
    (("5000.0 ppm", None, None), ("5000", "ppm")),
    (("2,5percent", None, None), ("2.5", "percent")),
    (("10 million CFU", None, None), ("10000000", "cfu")),
    (("50 x 10^6 cfu", None, None), ("50000000", "cfu")),
    (("50", "x 10^9 CFU", "milliards UFC"), ("50000000000", "cfu")),
    (("85.0 milligrams (mg)", None, None), ("85", "mg")),
    (("2 000", None, "UI"), ("2000", "iu")),
    (("2,000", None, "milligramme"), ("2000", "mg")),
    (("0,5", None, "L"), ("0.5", "l")),
    (("1.250e+01 percent", None, None), ("12.5", "percent")),
    (("1/2", "liters", "L"), ("0.5", "l")),
    (("(125.0 mcg RAE)", "", ""), ("125", "ug")),
    ((".25 gram", None, None), ("0.25", "g")),
    (("400 mg/capsule", "", ""), ("400", "mg")),
    (("3", "g per serving", "g"), ("3", "g")),
    (("7", "thousand IU", "thousand IU"), ("7000", "iu")),
    (("95 µg", "", ""), ("95", "ug")),
    (("8μg", "", ""), ("8", "ug")),
    (("5", "Int. Units", "UI"), ("5", "iu")),
]
NONE = [("up to 100", "mg", "mg"), ("< 5", "mg", ""), ("10 - 20", "mg", ""), ("5 to 8", "mg", ""), ("~", "mg", ""), ("q.s.", "mg", ""), ("12", "ZKU", "ZKU"), ("2", "drops", "drops"), ("2", None, None), ("", "mg", ""), (None, "mg", "mg"), ("5", "NTU activity", ""), ("2", "Not Applicable", "")]


@pytest.mark.parametrize("said, want", CASES)
def test_amounts(said, want):
    number, unit, divisor = units.read_amount(*said, A)
    assert (number, unit, divisor) == (Fraction(want[0]), want[1], 0)


@pytest.mark.parametrize("said", NONE)
def test_no_amounts(said):
    assert units.read_amount(*said, A) is None


def test_longest_match_and_word_bounds():
    assert units.read_unit("grams", A)[1] == "g"
    assert units.read_unit("grains", A)[1] == "gr"
    assert units.read_unit("gramophone", A) is None


def rows(spark, data):
    kinds = "row_id bigint, potency_amount string, potency_unit_of_measure string, potency_unit_of_measure_f string"
    return spark.createDataFrame(data, kinds)


KIND = {"potency": units.KINDS["potency"]}


def test_common_units(spark):
    data = [(1, "5", "mg/g", None), (1, "5", "mg/g", None), (2, "1", "lb", None), (3, "2", "grains", None), (4, "9" * 40, "mg", None), (5, "1e6", "kg", None), (6, None, None, None), (7, "x" * 100_000, "mg", None), (8, "0.4", "ng", None), (9, "0.5", "ng", None)]
    df = units.common_units(rows(spark, data).withColumnRenamed("nothing", "unit"), "row_id", KIND)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(1, "potency", "ppm", 5000), (1, "potency", "ppm", 5000), (2, "potency", "ng", 453592370000), (3, "potency", "ng", 129597820), (5, "potency", "ng", 10**18), (8, "potency", "ng", 0), (9, "potency", "ng", 1)]


def test_empty_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    empty = rows(spark, []).withColumn("amount", F.lit(1)).withColumn("unit", F.lit("x"))
    assert units.common_units(empty, "row_id", KIND).collect() == []
    full = rows(spark, [(1, "5", "g", None)]).withColumn("amount", F.lit(1)).withColumn("unit", F.lit("x")).withColumn("factor", F.lit(2)).withColumn("__row", F.lit(9))
    assert [tuple(r) for r in units.common_units(full, "row_id", KIND).collect()] == [(1, "potency", "ng", 5 * 10**9)]


def test_batches_without_any_amount(spark):
    assert units.common_units(rows(spark, [(1, "q.s.", "mg", None), (2, None, None, None)]), "row_id", KIND).collect() == []


def test_amounts_are_exact_at_any_size(spark):
    said = [("100 trillion cfu", 10**14), ("1/3 kg", 333333333333), ("0.00000000123 kg", 1230), ("9223372036854775807 iu", 2**63 - 1), ("9223372036854775808 iu", None), ("2/3 oz", 18899682083), ("1/16 oz", 1771845195), ("0.12345678901234567890123456789 kg", 123456789012), ("1 trillion mg", 10**18)]
    got = {r["row_id"]: r["amount"] for r in units.common_units(rows(spark, [(k, t, None, None) for k, (t, _) in enumerate(said)]), "row_id", KIND).collect()}
    assert got == {k: n for k, (_, n) in enumerate(said) if n is not None}
