"""Array evaluation, sample matching and resumable runs from VCF text."""

import gzip
import os
import shutil

import pytest
from test_wgs import vcfs  # noqa: F401

from genoeval.operators.sites import Thresholds
from genoeval.plans.array import evaluate_array, match_samples, run_array
from genoeval.plans.panel import prepare_panel
from genoeval.plans.run import dataset, run_wgs
from genoeval.plans.wgs import evaluate_vcf
from genoeval.sources import files


def write(path, samples, lines):
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(samples)]
    path.write_text("\n".join(head + ["\t".join(map(str, x)) for x in lines]) + "\n")
    return str(path)


def site(chrom, pos, ref, alt, *calls):
    return (chrom, pos, f"v{pos}", ref, alt, ".", "PASS", ".", "GT", *calls)


@pytest.fixture
def sides(tmp_path):
    imputed = [
        site("chr1", 10, "A", "C", "0|0", "0|1", "1|1"), site("chr1", 20, "C", "A", "1|1", "0|1", "0|0"), site("chr1", 30, "A", "T", "0|0", "0|1", "1|1"),
        site("chr1", 40, "A", "C", "0|0", "1|1", "./."), site("chr1", 40, "A", "G", "1|1", "1|1", "1|1"), site("chr1", 50, "A", "C", "0|0", "0|0", "0|0"), site("chr18", 10, "A", "C", "0|0", "0|0", "0|0"),
    ]
    truth = [
        site("1", 10, "A", "C", "0/0", "0/1", "1/1"), site("1", 20, "A", "C", "0/0", "0/1", "1/1"), site("1", 30, "A", "C", "0/0", "0/1", "1/1"),
        site("1", 40, "A", "C", "0/0", "1/1", "2/0"), site("1", 60, "A", "C", "0/0", "0/0", "0/0"),
    ]
    return write(tmp_path / "i.vcf", ["s1", "s2", "s3"], imputed), write(tmp_path / "t.vcf", ["s1", "s2", "s3"], truth)


def test_array_evaluation(spark, sides):
    out = evaluate_array(spark, *sides)
    variants = {r["pos"]: (r["n_non_missing"], r["r"], r["concordance"]) for r in out.variant_metrics.collect()}
    assert set(variants) == {10, 20, 40} and variants[10] == (3, pytest.approx(1.0), 1.0) and variants[20] == (3, pytest.approx(1.0), 1.0) and variants[40] == (2, pytest.approx(1.0), 1.0)
    assert [(r["pos"], r["alt"], r["source"]) for r in out.duplicates_removed.collect()] == [(40, "G", "imputed")]
    assert [(r["pos"], r["source"]) for r in out.ambiguous_removed.collect()] == [(30, "imputed")]
    assert [(r["source"], r["pos"], r["context"], r["gt"], r["extra"]) for r in out.exceptions.collect()] == [("truth", 40, "sample_col=8", "2/0", "2")]
    assert {r["sample"]: r["n_variants"] for r in out.sample_metrics.collect()} == {"s1": 3, "s2": 3, "s3": 2}
    assert {r["pos"]: r["agree"] for r in out.concordance.collect()}[40] == [1, 1, None]


def test_matching(spark, sides):
    ranked, best = match_samples(spark, *sides)
    assert ranked.count() == 9
    assert {r["query"]: r["best_target"] for r in best.collect()} == {"s1": "s1", "s2": "s2", "s3": "s3"}


def table(spark, path):
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def newest(root, chrom):
    """The version that holds a chromosome."""
    return max(v for v in os.listdir(f"{root}/versions") if os.path.isdir(f"{root}/versions/{v}/variant_metrics/CHROM={chrom}"))


def text_scans(spark, since, *paths):
    """How many executed plans read text, or block-gzipped text, of each path."""
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(since, store.executionsCount())]
    return [sum(p in plan and ("Scan text" in plan or "bgzf_lines" in plan) for plan in plans) for p in paths]


def test_resumed_run(spark, vcfs, tmp_path):  # noqa: F811
    root = str(tmp_path / "out")
    os.makedirs(root)
    assert run_wgs(spark, *vcfs, root, ["Chr01"]) == ["Chr01"]
    assert run_wgs(spark, *vcfs, root, ["Chr01", "Chr02"]) == ["Chr02"]
    assert run_wgs(spark, *vcfs, root) == []
    assert dataset(spark, root, "variant_metrics").filter("CHROM = 'Chr02'").count() == 3
    # A file of one chromosome is lost: only that chromosome is made again.
    folder = f"{root}/versions/{newest(root, 'Chr02')}/variant_metrics/CHROM=Chr02"
    os.remove(next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")))
    assert run_wgs(spark, *vcfs, root) == ["Chr02"]
    assert dataset(spark, root, "variant_metrics").filter("CHROM = 'Chr02'").count() == 3
    with pytest.raises(ValueError):
        run_wgs(spark, *vcfs, root, ["Chr01"], t=Thresholds(gq=1))
    assert run_wgs(spark, *vcfs, root, ["Chr01", "Chr02"], t=Thresholds(gq=1), force=True) == ["Chr01", "Chr02"]
    assert run_wgs(spark, *vcfs, root, ["Chr01"], t=Thresholds(gq=1)) == []


def test_outputs_of_a_run(spark, vcfs, tmp_path):  # noqa: F811
    root = str(tmp_path / "out")
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    assert run_wgs(spark, *vcfs, root) == ["Chr01", "Chr02"]
    assert text_scans(spark, since, *vcfs) == [1, 1]
    direct = evaluate_vcf(spark, *vcfs)
    samples = table(spark, f"{root}/per_sample_metrics")
    assert samples.columns[:4] == ["sample", "r_overall", "r2_overall", "n_variants"] and samples.columns[-3:] == ["r_maf_[0.4,0.5]", "r2_maf_[0.4,0.5]", "n_maf_[0.4,0.5]"] and len(samples.columns) == 19
    assert {r["sample"]: int(r["n_variants"]) for r in samples.collect()} == {r["sample"]: r["n_variants"] for r in direct.sample_metrics.collect()}
    got = {(r["section"], r["chromosome"], r["reason"]): (r["count"], r["value"]) for r in table(spark, f"{root}/qc/filter_summary").collect()}
    assert got == {(r["section"], r["chromosome"], r["reason"]): (str(r["count"]) if r["count"] is not None else "NA", r["value"] or "NA") for r in direct.filter_summary.collect()}
    assert table(spark, f"{root}/qc/genotype_masking_summary").count() == direct.masking_summary.count()
    kept = {r["key"]: r["value"] for r in table(spark, f"{root}/run_manifest").collect()}
    assert kept["min_gq"] == "60" and kept["imputed"] == vcfs[0] and kept["output_variant_metrics"] == "variant_metrics" and kept["outputs"] == f"{root}/versions"
    assert table(spark, f"{root}/output_manifest").count() == 11
    assert {r["step"]: (r["count_before"], r["count_after"]) for r in table(spark, f"{root}/audit").collect()}["matched sites retained"] == ("15", "13")
    assert dataset(spark, root, "site_filtered").filter("site_filter_pass").isEmpty()


def test_runs_without_rows_of_a_kind(spark, tmp_path):
    """No failing site, no mismatch, no site of one side only; then the filter off: each such dataset is empty, and resumes."""
    head = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3"]
    calls = (["0|0", "0|1", "1|1"], ["0|1", "1|1", "0|0"])
    ours = [f"Chr01\t{p}\tv\tA\tC\t.\tPASS\t.\tGT\t" + "\t".join(c) for p, c in zip((10, 20), calls)]
    theirs = [f"Chr01\t{p}\tt\tA\tC\t{q}\tPASS\tQD=10;MQ=60\tGT:GQ:DP\t" + "\t".join(f"{x}:99:20" for x in c) for p, c, q in zip((10, 20), calls, (100, 100))]
    bad = [x.replace("\t100\t", "\t1\t") for x in theirs]
    for name, lines in (("i", ours), ("t", theirs), ("b", bad)):
        (tmp_path / name).write_text("\n".join(head + lines) + "\n")
    for name, t in (("t", Thresholds()), ("b", Thresholds(enabled=False))):
        root = str(tmp_path / f"out-{name}")
        assert run_wgs(spark, str(tmp_path / "i"), str(tmp_path / name), root, t=t) == ["Chr01"]
        assert run_wgs(spark, str(tmp_path / "i"), str(tmp_path / name), root, t=t) == []
        assert {n: dataset(spark, root, n).count() for n in ("site_filtered", "imputed_only", "truth_only", "allele_mismatches", "variant_metrics")} == {"site_filtered": 0, "imputed_only": 0, "truth_only": 0, "allele_mismatches": 0, "variant_metrics": 2}
        assert table(spark, f"{root}/per_sample_metrics").count() == 3
    # A run that dies while it writes leaves the published state as it is, and an unfinished manifest is not followed.
    os.makedirs(f"{root}/versions/00000002/variant_metrics/CHROM=Chr01")
    os.makedirs(f"{root}/manifests/00000002")
    assert dataset(spark, root, "variant_metrics").count() == 2
    assert run_wgs(spark, str(tmp_path / "i"), str(tmp_path / "b"), root, t=Thresholds(enabled=False), force=True) == ["Chr01"]
    assert dataset(spark, root, "variant_metrics").count() == 2


def test_chunks_and_truth_folder(spark, vcfs, tmp_path):  # noqa: F811
    """Overlapping chunks by chromosome, and a truth file a chromosome, give what whole files give."""
    texts = [open(p).read().splitlines() for p in vcfs]

    def put(path, lines, keep):
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt") as f:
            f.write("\n".join(x for x in lines if x.startswith("#") or keep(*x.split("\t")[:2])) + "\n")

    for c, start, end in (("Chr01", 1, 175), ("Chr01", 150, 300), ("Chr02", 1, 300)):
        put(tmp_path / "chunks" / c / f"run.{c}.{start}-{end}.vcf.gz", texts[0], lambda chrom, pos: chrom == c and start <= int(pos) <= end)  # noqa: B023
    for c in ("Chr01", "Chr02"):
        put(tmp_path / "truth" / f"{c}_consolidated.vcf.gz", texts[1], lambda chrom, pos: chrom == c)  # noqa: B023
    root = str(tmp_path / "out")
    assert run_wgs(spark, None, None, root, samples=["S1", "S2", "S3"], chunks_dir=str(tmp_path / "chunks"), truth_dir=str(tmp_path / "truth")) == ["Chr01", "Chr02"]
    rows = lambda df, c: sorted((r[c], r["pos"], r["ref"], r["alt"], r["n_pairs"]) for r in df.collect())
    assert rows(dataset(spark, root, "variant_metrics"), "CHROM") == rows(evaluate_vcf(spark, *vcfs, samples=["S1", "S2", "S3"]).variant_metrics, "chrom")
    with pytest.raises(ValueError):
        run_wgs(spark, vcfs[0], None, root)
    # Another truth file for one chromosome makes that one stale, and it alone.
    put(tmp_path / "truth" / "Chr02_consolidated.vcf.gz", texts[1][:-1], lambda chrom, pos: chrom == "Chr02")
    with pytest.raises(ValueError, match="for Chr02;"):
        run_wgs(spark, None, None, root, samples=["S1", "S2", "S3"], chunks_dir=str(tmp_path / "chunks"), truth_dir=str(tmp_path / "truth"))


def test_array_run_on_disk(spark, sides, tmp_path):
    root = str(tmp_path / "array")
    steps = ["samples", "translation", "reports", "metrics", "concordance"]
    assert run_array(spark, *sides, root) == steps and run_array(spark, *sides, root) == []
    ab = files.read_wide(spark, f"{root}/truth_ab", "ab")
    assert {r["sample"]: r["ab"] for r in ab.filter("pos = 10").collect()} == {"s1": "A/A", "s2": "A/B", "s3": "B/B"}
    assert {r["sample"]: r["n_variants"] for r in table(spark, f"{root}/per_sample_metrics").collect()} == {"s1": "3", "s2": "3", "s3": "2"}
    assert table(spark, f"{root}/qc/translation_exceptions").count() == 1 and {r["step"] for r in table(spark, f"{root}/audit").collect()} == set(steps)
    shutil.rmtree(f"{root}/truth_ab")
    assert run_array(spark, *sides, root) == ["translation"] and files.read_wide(spark, f"{root}/truth_ab", "ab").count() == 9
    assert run_array(spark, *sides, root, force=True) == steps
    with pytest.raises(ValueError):
        run_wgs(spark, *sides, root)


def test_panel_preparation(spark, tmp_path):
    (tmp_path / "panel").mkdir()
    for c, calls in (("Chr01", (["0|1"] * 20, ["0|1"] * 19 + [".|."], ["0/1"] * 20)), ("Chr02", (["1|1"] * 20,))):
        text = write(tmp_path / "x.vcf", [f"s{i}" for i in range(20)], [site(c[3:].lstrip("0"), 10 * k, "A", "C", *x) for k, x in enumerate(calls, 1)])
        with open(text) as f, gzip.open(tmp_path / "panel" / f"{c}_chr.vcf.gz", "wt") as g:
            g.write(f.read())
    out = str(tmp_path / "out")
    report = prepare_panel(spark, str(tmp_path / "panel"), out, ["Chr01", "Chr02"]).collect()
    assert [(r["chrom"], r["total"], r["removed"], r["kept"]) for r in report] == [("Chr01", 3, 2, 1), ("Chr02", 1, 0, 1)]
    assert report[0]["input_vcf"].endswith("/panel/Chr01_chr.vcf.gz") and report[0]["output"] == f"{out}/panel/CHROM=Chr01"
    assert files.read_metrics(spark, out, "panel").filter("CHROM = 'Chr01'").count() == 1
    with pytest.raises(ValueError, match="Chr05"):
        prepare_panel(spark, str(tmp_path / "panel"), out, ["Chr05"])
