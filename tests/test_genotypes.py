import pytest
from pyspark.sql import functions as F

from genoeval.functions import genotypes as g


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize(
    "gt,ab,problem",
    [("0/0", "A/A", None), ("0|1", "A|B", None), ("1/1", "B/B", None), ("./.", "./.", None), ("./1", "./.", None), ("2/0", "./.", "unknown_allele"), ("./2", "./.", None), ("2/.", "./.", "unknown_allele"), ("0", "./.", "not_diploid"), (".", "./.", "not_diploid"), ("0/1/1", "./.", "not_diploid"), ("0/1|1", "./.", "unknown_allele"), (None, "./.", "not_diploid")],
)
def test_translation(spark, gt, ab, problem):
    c = g.translate_by_bases(F.col("gt"), F.lit("A"), F.lit("C"))
    assert values(spark, [(gt,)], "gt string", c["gt"], c["problem"]) == [(ab, problem)]


def test_translation_follows_bases_only_on_imputed_side(spark):
    by_bases, by_index = g.translate_by_bases(F.col("gt"), F.lit("C"), F.lit("A")), g.translate_by_index(F.col("gt"))
    assert values(spark, [("0/0",), ("1/1",)], "gt string", by_bases["gt"], by_index["gt"]) == [("B/B", "A/A"), ("A/A", "B/B")]
    odd = g.translate_by_bases(F.col("gt"), F.lit("N"), F.lit("A"))
    assert values(spark, [("0/1",), ("1/1",)], "gt string", odd["gt"], odd["problem"], odd["extra"]) == [("./.", "base_group", "?,A"), ("A/A", None, None)]


def test_calls(spark):
    gts = ["./1", ".", "0", "1|0", "0/2", "./.", "", None, "1/1"]
    got = values(spark, [(x,) for x in gts], "gt string", g.is_missing(F.col("gt")), g.is_invalid(F.col("gt")), g.alt_dosage(F.col("gt")))
    assert got == [(False, True, None), (True, False, None), (False, True, None), (False, False, 1), (False, True, None), (True, False, None), (True, False, None), (True, False, None), (False, False, 2)]


def test_numbers(spark):
    assert values(spark, [("1.5",), (".",), ("NaN",), ("",), (None,)], "v string", g.lenient_double(F.col("v"))) == [(1.5,), (None,), (None,), (None,), (None,)]
    assert values(spark, [("0.1,0.2,0.7",), ("0.1,0.9",), (".,.,.",)], "gp string", g.dosage_from_probabilities(F.col("gp"))) == [(pytest.approx(1.6),), (None,), (None,)]
    assert values(spark, [(1.5,), (0.5,), (0.6,), (None,)], "d double", g.hard_call(F.col("d"))) == [(2,), (0,), (1,), (None,)]


def test_correlation_edges(spark):
    cols = [F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    rows = [(3, 3, 3, 5, 5, 5), (3, 3, 3, 3, 3, 3), (1, 1, 1, 1, 1, 1), (0, 0, 0, 0, 0, 0), (3, 3, 3, 5, 5, 1)]
    assert values(spark, rows, "n long, sx long, sy long, sxx long, syy long, sxy long", g.correlation(*cols, least=2)) == [(1.0,), (None,), (None,), (None,), (-1.0,)]


def test_maf_bins_are_exact_on_edges(spark):
    rows = [(n, ac) for n in range(0, 41) for ac in range(0, 2 * n + 1)]
    got = values(spark, rows, "n long, ac long", "n", "ac", g.maf_bin(F.col("ac"), F.col("n")))
    assert all(b == (min(4, 10 * min(ac, 2 * n - ac) // (2 * n)) if n else None) for n, ac, b in got)


def test_canonical_chrom(spark):
    names = ["1", "chr1", "Chr01", "chr017", "Chr100", "chrX", "scaffold_1", "", "99999999999999", None]
    assert [r[0] for r in values(spark, [(n,) for n in names], "c string", g.canonical_chrom(F.col("c")))] == ["Chr01", "Chr01", "Chr01", "Chr17", None, None, None, None, None, None]
