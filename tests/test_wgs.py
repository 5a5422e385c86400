"""Whole-genome evaluation of VCF text against hand-derived values."""

import pytest
from pyspark.sql import functions as F

from genoeval.operators.sites import Thresholds
from genoeval.plans.wgs import evaluate_vcf

BASE = ["0/0", "0/1", "1/1", "0/0", "0/1", "1/1"]
SAMPLES = [f"S{i}" for i in range(1, 7)]
QC = dict(QUAL="100", QD="10", SOR="1", FS="1", MQ="60", MQRankSum="0", ReadPosRankSum="0")


def line(chrom, pos, ref, alt, name, calls, fmt, qual=".", info="."):
    return "\t".join([chrom, str(pos), name, ref, alt, qual, "PASS", info, fmt, *calls])


def imputed(chrom, pos, calls=BASE, alt="C"):
    return line(chrom, pos, "A", alt, f"v{pos}", calls, "GT")


def truth(chrom, pos, calls=BASE, alt="C", gq=None, dp=None, drop=(), **qc):
    q = {**QC, **qc}
    info = ";".join(f"{k}={q[k]}" for k in QC if k != "QUAL" and k not in drop) or "."
    full = [f"{c}:{(gq or {}).get(i, 99)}:{(dp or {}).get(i, 20)}" for i, c in enumerate(calls)]
    return line(chrom, pos, "A", alt, f"t{pos}", full, "GT:GQ:DP", q["QUAL"], info)


@pytest.fixture(scope="module")
def vcfs(tmp_path_factory):
    phased = [c.replace("/", "|") for c in BASE]
    het, mixed, low = ["0/1"] * 6, ["0/0", "1/1", "0/1", "0/0", "0/1", "1/1"], ["1/1", "0/1", "0/0", "1/1", "0/1", "0/0"]
    ours = [imputed("Chr01", 100, phased), *[imputed("Chr01", p) for p in (110, 120, 130, 140, 150, 160)], imputed("Chr01", 170, alt="G"), imputed("Chr01", 175), imputed("Chr01", 175, alt="G"), imputed("Chr01", 180), imputed("Chr01", 200, alt="C,G"), imputed("Chr01", 210, ["./.", "0", *BASE[2:]]), imputed("Chr01", 220, het), imputed("Chr01", 230, mixed), imputed("Chr01", 240), imputed("Chr02", 100, phased), imputed("Chr02", 110, low), imputed("Chr02", 120, ["0/1", "0/0", "0/1", "0/1", "1/1", "1/1"])]
    theirs = [truth("Chr01", 100), truth("Chr01", 110, gq={0: 59, 1: 60}), truth("Chr01", 120, dp={0: 9, 1: 10}), truth("Chr01", 130, QUAL="29"), truth("Chr01", 140, QUAL="30", QD="2", SOR="3", FS="60", MQ="40", MQRankSum="-12.5", ReadPosRankSum="-8"), truth("Chr01", 150, drop=("MQRankSum", "ReadPosRankSum")), truth("Chr01", 160, drop=("QD",)), truth("Chr01", 170), truth("Chr01", 175), truth("Chr01", 190), truth("Chr01", 200, alt="C,G"), truth("Chr01", 210), truth("Chr01", 220, het), truth("Chr01", 230, mixed, gq={2: 59, 3: 59, 4: 59, 5: 59}), truth("Chr01", 240, ["0", "./.", *BASE[2:]]), truth("Chr02", 100), truth("Chr02", 110, low), truth("Chr02", 120, ["0/0", "0/0", "0/1", "0/1", "1/1", "1/1"])]
    folder = tmp_path_factory.mktemp("vcf")
    for name, rows in (("imputed", ours), ("truth", theirs)):
        head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(SAMPLES)]
        (folder / f"{name}.vcf").write_text("\n".join(head + rows) + "\n")
    return str(folder / "imputed.vcf"), str(folder / "truth.vcf")


def test_variants(spark, vcfs):
    out = evaluate_vcf(spark, *vcfs)
    got = {(r["chrom"], r["pos"]): r for r in out.variant_metrics.collect()}
    expected = {100: (6, 0.5, 0.5, 1.0, 1.0), 110: (5, 0.6, 0.4, 1.0, 1.0), 120: (5, 0.6, 0.4, 1.0, 1.0), 140: (6, 0.5, 0.5, 1.0, 1.0), 150: (6, 0.5, 0.5, 1.0, 1.0), 175: (6, 0.5, 0.5, 1.0, 1.0), 210: (4, 0.5, 0.5, 1.0, 1.0), 220: (6, 0.5, 0.5, None, 1.0), 230: (2, 0.5, 0.5, None, 1.0), 240: (4, 0.625, 0.375, 1.0, 1.0)}
    assert {p for c, p in got if c == "Chr01"} == set(expected)
    for pos, (n, af, maf, r, agree) in expected.items():
        row = got["Chr01", pos]
        assert (row["n_pairs"], row["truth_alt_frequency"], row["truth_maf"], row["concordance"]) == (n, af, pytest.approx(maf, abs=1e-12), agree)
        assert row["r"] is None if r is None else row["r"] == pytest.approx(r, abs=1e-12)
    assert (got["Chr01", 100]["id"], got["Chr01", 100]["id_truth"]) == ("v100", "t100")
    assert got["Chr02", 120]["r"] == pytest.approx(0.8911327886790069, abs=1e-12) and got["Chr02", 120]["concordance"] == pytest.approx(5 / 6)
    reasons = {r["pos"]: r["site_filter_reasons"] for r in out.site_filtered.filter("chrom = 'Chr01'").collect()}
    assert reasons == {130: "QUAL_below_min", 160: "missing_QD"}
    assert sorted((r["pos"], r["alt"]) for r in out.imputed_only.collect()) == [(170, "G"), (175, "G"), (180, "C")]
    assert sorted((r["pos"], r["alt"]) for r in out.truth_only.collect()) == [(170, "C"), (190, "C")]
    assert out.allele_mismatches.count() == 2


def test_counts(spark, vcfs):
    got = {(r["chromosome"], r["reason"]): r["count"] for r in evaluate_vcf(spark, *vcfs).filter_summary.collect()}
    names = ("imputed_structural", "truth_structural", "exact_matches", "retained_exact_matches", "imputed_only", "truth_only", "allele_mismatch_pairs")
    assert [got.get(("Chr01", n)) for n in names] == [15, 14, 12, 10, 3, 2, 2]
    assert [got.get(("Chr02", n)) for n in names] == [3, 3, 3, 3, 0, 0, 0]
    assert (got["Chr01", "QUAL_below_min"], got["ALL", "missing_QD"], got["Chr01", "sites_failed"]) == (1, 1, 2)
    values = {r["reason"]: r["value"] for r in evaluate_vcf(spark, *vcfs, t=Thresholds(gq=59)).filter_summary.filter("section = 'config'").collect()}
    assert (values["filter_enabled"], values["min_gq"], values["min_qual"], values["min_mq_rank_sum"]) == ("true", "59", "30", "-12.5")
    off = {(r["chromosome"], r["reason"]): r["count"] for r in evaluate_vcf(spark, *vcfs, t=Thresholds(enabled=False)).filter_summary.collect()}
    assert (off["ALL", "sites_failed"], off["ALL", "QUAL_below_min"], off["ALL", "missing_QD"], off["ALL", "missing_MQ"]) == (0, 0, 0, 0) and off["Chr01", "sites_passed"] == 12


def test_samples(spark, vcfs):
    rows = evaluate_vcf(spark, *vcfs).sample_metrics.collect()
    assert rows[0]["sample"] == "S1"
    got = {r["sample"]: r for r in rows}
    assert got["S1"]["n_variants"] == 9 and got["S1"]["r_overall"] == pytest.approx(0.8922178162191939, abs=1e-12)
    assert (got["S1"]["n_maf_3"], got["S1"]["n_maf_4"]) == (0, 9)
    assert got["S2"]["n_variants"] == 11 and got["S2"]["r_overall"] == pytest.approx(1.0)
    for s in ("S3", "S4", "S5", "S6"):
        assert (got[s]["n_variants"], got[s]["n_maf_3"], got[s]["r_maf_3"], got[s]["n_maf_4"]) == (12, 1, None, 11)


def masks(out, sample):
    return {r["reason"]: r["count"] for r in out.masking_summary.filter(f"sample = '{sample}' and chromosome = 'ALL'").collect()}


def test_masks_and_switches(spark, vcfs):
    got = masks(evaluate_vcf(spark, *vcfs), "S1")
    assert [got[k] for k in ("imputed_missing_GT", "truth_GQ_below_min", "truth_DP_below_min", "truth_invalid_GT")] == [1, 1, 1, 1]
    assert masks(evaluate_vcf(spark, *vcfs), "S2")["imputed_invalid_GT"] == 1
    off = evaluate_vcf(spark, *vcfs, t=Thresholds(enabled=False))
    got = masks(off, "S1")
    assert [got[k] for k in ("truth_GQ_below_min", "truth_DP_below_min", "truth_invalid_GT")] == [0, 0, 1]
    assert {130, 160} <= {r["pos"] for r in off.variant_metrics.collect()}
    loose = masks(evaluate_vcf(spark, *vcfs, t=Thresholds(gq=59, dp=9)), "S1")
    assert (loose["truth_GQ_below_min"], loose["truth_DP_below_min"]) == (0, 0)


def test_restriction(spark, vcfs):
    out = evaluate_vcf(spark, *vcfs, samples=["S3", "S1"], region="chr2:1-115")
    assert {r["pos"] for r in out.variant_metrics.collect()} == {100, 110}
    assert {r["sample"] for r in out.sample_metrics.collect()} == {"S1", "S3"}
    for wrong in (dict(samples=["S9"]), dict(samples=["S1", "S1"]), dict(region="scaffold_1"), dict(region="Chr05")):
        with pytest.raises(ValueError):
            evaluate_vcf(spark, *vcfs, **wrong)


def rewritten(vcfs, tmp_path, change):
    """The imputed file with its record lines changed."""
    with open(vcfs[0]) as f:
        lines = f.read().splitlines()
    path = tmp_path / "changed.vcf"
    path.write_text("\n".join(x if x.startswith("#") else change(x) for x in lines) + "\n")
    return str(path), vcfs[1]


def test_inputs_that_are_refused(spark, vcfs, tmp_path):
    no_gt = rewritten(vcfs, tmp_path, lambda x: x.replace("\tGT\t", "\tDS\t"))
    with pytest.raises(ValueError, match="no GT in FORMAT"):
        evaluate_vcf(spark, *no_gt)
    two = rewritten(vcfs, tmp_path, lambda x: x.replace("Chr01", "chr1") if "\t140\t" in x else x)
    with pytest.raises(ValueError, match="Chr01, chr1 are all Chr01"):
        evaluate_vcf(spark, *two)
    bases = spark.createDataFrame([(f"Chr0{i}", 0, "A" * 1000) for i in (1, 2)], "chrom string, block long, bases string")
    assert evaluate_vcf(spark, *vcfs, bases=bases).variant_metrics.count() == 13
    with pytest.raises(ValueError, match="REF differs"):
        evaluate_vcf(spark, *vcfs, bases=bases.withColumn("bases", F.regexp_replace("bases", "^.{109}A", "C" * 110)))
    for wrong in (dict(gq=100), dict(gq=-1), dict(dp=-1), dict(gq=1.5)):
        with pytest.raises(ValueError):
            Thresholds(**wrong)
