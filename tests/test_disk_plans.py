"""Stitching and sample matching on disk, and array evaluation by dosages."""

import gzip
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_plans import sides, site, table, write  # noqa: F401

from genoeval.functions import genotypes as g
from genoeval.operators import metrics, pairwise
from genoeval.plans.array import evaluate_array, match_samples, run_matching
from genoeval.plans.maps import prepare_maps
from genoeval.plans.stitch import run_stitch, stitched
from genoeval.sources.files import read_genetic_map


def chunk(path, chrom, positions):
    path.parent.mkdir(parents=True, exist_ok=True)
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
    with gzip.open(path, "wt") as f:
        f.write(head + "".join(f"{chrom}\t{p}\tv\tA\tC\t.\tPASS\t.\tGT\t0|0\t0|{p % 2}\n" for p in positions))


def test_stitching(spark, tmp_path):
    for c, start, end in (("Chr01", 1, 60), ("Chr01", 51, 100), ("Chr02", 1, 60)):
        chunk(tmp_path / "chunks" / c / f"run.{c}.{start}-{end}.vcf.gz", c, range(start, end + 1, 5))
    (tmp_path / "manifest").write_text("a|Chr01|1|60|5\nb|Chr01|51|100|5\nc|Chr02|1|60|5\n")
    folder, root, listed = str(tmp_path / "chunks"), str(tmp_path / "out"), str(tmp_path / "manifest")
    assert run_stitch(spark, folder, root, ["Chr01", "Chr09"], listed) == ["Chr01"]
    assert run_stitch(spark, folder, root, manifest=listed) == ["Chr02"] and run_stitch(spark, folder, root) == []
    calls, samples = stitched(spark, root)
    got = {(r["CHROM"], r["pos"]): r["calls"] for r in calls.collect()}
    assert set(got) == {("Chr01", p) for p in range(1, 101, 5)} | {("Chr02", p) for p in range(1, 61, 5)}
    assert calls.count() == len(got) and got["Chr01", 51] == ["0|0", "0|1"] and [r["sample"] for r in samples.orderBy("sample_idx").collect()] == ["s1", "s2"]
    assert run_stitch(spark, folder, str(tmp_path / "other"), ["Chr01", "Chr09"]) == ["Chr01"]
    audit = {r["step"]: (r["count_before"], r["count_after"]) for r in table(spark, str(tmp_path / "other" / "audit")).collect()}
    assert audit["records"] == ("22", "20") and audit["Chr01_1_60 trimmed"] == ("60", "50") and "Chr09 skipped" in audit
    # A listed chunk without content is refused, before anything is written.
    os.remove(tmp_path / "chunks" / "Chr02" / "run.Chr02.1-60.vcf.gz")
    with pytest.raises(ValueError, match="without a file: c"):
        run_stitch(spark, folder, root, manifest=listed, force=True)
    assert stitched(spark, root)[0].count() == len(got)
    with pytest.raises(ValueError, match="no chunk"):
        run_stitch(spark, folder, str(tmp_path / "none"), ["Chr07"])


def test_matching_on_disk(spark, sides, tmp_path):  # noqa: F811
    root = str(tmp_path / "m")
    assert run_matching(spark, *sides, root) == ["sites", "pairs", "best"] and run_matching(spark, *sides, root) == []
    assert {r["query"]: r["best_target"] for r in table(spark, f"{root}/best_matches").collect()} == {"s1": "s1", "s2": "s2", "s3": "s3"}
    assert spark.read.parquet(f"{root}/pairs").count() == 9 and table(spark, f"{root}/output_manifest").count() == 4
    assert {r["step"]: r["count_after"] for r in table(spark, f"{root}/audit").collect()} == {"query sites kept": "3", "truth sites kept": "3", "pairs": "9", "best matches": "3"}
    assert [(r["query"], r["match_rank"]) for r in spark.read.parquet(f"{root}/pairs").collect()] == [(f"s{q}", k) for q in (1, 2, 3) for k in (1, 2, 3)]
    ranked, best = match_samples(spark, *sides, queries=["s3", "s1"])
    assert ranked.count() == 6 and {r["query"]: r["best_target"] for r in best.collect()} == {"s1": "s1", "s3": "s3"}
    with pytest.raises(ValueError, match="query: samples not in input: nobody"):
        match_samples(spark, *sides, queries=["s1", "nobody"])
    shutil.rmtree(f"{root}/best")
    assert run_matching(spark, *sides, root) == ["best"]
    with pytest.raises(ValueError, match="other inputs"):
        run_matching(spark, sides[1], sides[0], root)
    assert run_matching(spark, sides[1], sides[0], root, force=True) == ["sites", "pairs", "best"]


def test_pairs_of_many_samples(spark):
    """More samples than a tile and more sites than a tile, against plain counting; samples without a call."""
    rng = np.random.default_rng(4)
    q, t = rng.integers(0, 4, (3000, 9)), rng.integers(0, 4, (3000, 300))
    q[:, 3] = 3
    none = lambda row: [int(v) if v < 3 else None for v in row]
    sites = spark.createDataFrame([(none(a), none(b)) for a, b in zip(q, t, strict=True)], "q array<int>, t array<int>").repartition(3)
    names = lambda p, n: spark.createDataFrame([(f"{p}{i}", i) for i in range(n)], "sample string, sample_idx int")
    got = {(r["query"], r["target"]): (r["n_compared"], r["mismatch_count"]) for r in pairwise.pairwise_concordance(sites, names("q", 9), names("t", 300)).collect()}
    for i in range(9):
        both = (q[:, [i]] < 3) & (t < 3)
        n, m = both.sum(axis=0), (both & (q[:, [i]] != t)).sum(axis=0)
        assert all(got[f"q{i}", f"t{j}"] == (n[j], m[j] if n[j] else None) for j in range(300))
    assert len(got) == 2700


def fields(chrom, pos, ref, alt, fmt, *calls):
    return (chrom, pos, f"v{pos}", ref, alt, ".", "PASS", ".", fmt, *calls)


def test_dosages_instead_of_calls(spark, tmp_path):
    rng = random.Random(1)
    ds = [[round(rng.random() * 2, 3) for _ in range(6)] for _ in range(4)]
    truth = [[rng.choice(["0/0", "0/1", "1/1"]) for _ in range(6)] for _ in range(4)]
    truth[3] = ["0/1"] * 6
    gp = lambda d: f"0,{min(d, 2 - d):.3f},{max(0.0, d - 1):.3f}"
    names = [f"s{i}" for i in range(6)]
    text = lambda pos, row, miss: fields("chr1", pos, "A", "C", "GT:DS:GP", *[f"0|1:{'.' if i == miss else d}:{gp(d)}" for i, d in enumerate(row)])
    ours = write(tmp_path / "i.vcf", names, [text(10 * k + 10, row, k) for k, row in enumerate(ds)])
    theirs = write(tmp_path / "t.vcf", names, [site("1", 10 * k + 10, "A", "C", *row) for k, row in enumerate(truth)])
    number = {"0/0": 0, "0/1": 1, "1/1": 2}
    for field, usable in (("DS,GP", lambda k, i: True), ("DS", lambda k, i: i != k), ("GP", lambda k, i: True)):
        out = evaluate_array(spark, ours, theirs, field=field)
        rows = {r["pos"]: r for r in out.variant_metrics.collect()}
        for k in range(4):
            pairs = [(ds[k][i], number[truth[k][i]]) for i in range(6) if usable(k, i)]
            r = rows[10 * k + 10]
            assert r["n_non_missing"] == len(pairs) and r["concordance"] == pytest.approx(np.mean([round(a) == b for a, b in pairs]))
            x, y = np.array(pairs).T
            assert r["r"] is None if k == 3 else r["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
        metric = {r["sample"]: r for r in out.sample_metrics.collect()}
        for i in range(6):
            pairs = [(ds[k][i], number[truth[k][i]]) for k in range(4) if usable(k, i)]
            x, y = np.array(pairs).T
            assert metric[f"s{i}"]["n_variants"] == len(pairs)
            assert metric[f"s{i}"]["r_overall"] is None if len(set(y)) == 1 else metric[f"s{i}"]["r_overall"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    bare = write(tmp_path / "b.vcf", names, [fields("chr1", 10, "A", "C", "GT:DS", *["0|1:."] * 6)])
    with pytest.raises(ValueError, match="no dosage"):
        evaluate_array(spark, bare, theirs, field="DS,GP")


def test_sums_of_large_scaled_dosages(spark):
    """Scaled sums pass 64 bits when they are multiplied; r does not."""
    rows = spark.range(20_000).select(F.lit("Chr01").alias("chrom"), F.array((F.col("id") % 3 * g.UNIT).cast("long")).alias("x"), F.array((F.col("id") % 3).cast("int")).alias("y"))
    names = spark.createDataFrame([("s", 0)], "sample string, sample_idx int")
    assert metrics.sample_metrics(rows, names, g.UNIT).first()["r_overall"] == pytest.approx(1.0, abs=1e-12)


def test_maps_on_disk(spark, tmp_path):
    head, folder = "position COMBINED_rate.cM.Mb. Genetic_Map.cM.\n", tmp_path / "maps"
    folder.mkdir()
    (folder / "Chr01.txt").write_text(head + "1 1.0 0.0\n5 1.5 0.25\n")
    (folder / "genetic_map_Chr02.txt").write_text(head + "7 2.0 0.5\n")
    got = prepare_maps(spark, str(tmp_path / "a"), ["Chr01", "Chr02"], folder=str(folder)).collect()
    assert [(r["chrom"], r["source"].rsplit("/", 1)[1], r["rows"], r["last_cm"]) for r in got] == [("Chr01", "Chr01.txt", 2, 0.25), ("Chr02", "genetic_map_Chr02.txt", 1, 0.5)]
    text = read_genetic_map(spark, f"{tmp_path}/a/text/CHROM=Chr01").orderBy("position").collect()
    assert [(r["position"], r["rate"], r["cm"]) for r in text] == [(1, 1.0, 0.0), (5, 1.5, 0.25)]
    # One map for all chromosomes, an index at a constant rate, and a panel's positions.
    assert [r["rows"] for r in prepare_maps(spark, str(tmp_path / "b"), ["Chr01", "Chr07"], one_file=str(folder / "Chr01.txt")).collect()] == [2, 2]
    (tmp_path / "r.fai").write_text("Chr01\t3500\t7\t60\t61\nChr02\t900\t9\t60\t61\n")
    assert [(r["rows"], r["last_cm"]) for r in prepare_maps(spark, str(tmp_path / "c"), ["Chr01", "Chr02"], fai=str(tmp_path / "r.fai")).collect()] == [(3, 0.002), (0, None)]
    panel = write(tmp_path / "p.vcf", ["s"], [site("1", p, "A", "C", "0|1") for p in (100, 100, 400)])
    assert [(r["rows"], r["last_cm"]) for r in prepare_maps(spark, str(tmp_path / "d"), ["Chr01"], sites_vcf=panel).collect()] == [(2, 0.0003)]
    with pytest.raises(ValueError, match="Chr05"):
        prepare_maps(spark, str(tmp_path / "e"), ["Chr05"], folder=str(folder))
    (folder / "Chr03.txt").write_text(head + "1 1.0 0.5\n5 1.5 0.25\n")
    with pytest.raises(ValueError, match="Chr03:5"):
        prepare_maps(spark, str(tmp_path / "f"), ["Chr03"], folder=str(folder))


def test_best_matches_are_merged(spark):
    """Two best targets and ties, whatever lies in which task, nulls last; against sorting all pairs."""
    rng = random.Random(8)
    rows = []
    for q in range(40):
        for t in range(rng.choice([1, 2, 3, 30])):
            n = rng.choice([0, 4, 4, 8])
            m = rng.randrange(3) if n else None
            rows.append((f"q{q}", f"t{t:02d}", 1 - m / n if n else None, n, m))
    last = lambda v, sign: (v is None, sign * (v or 0))
    key = lambda r: (last(r[2], -1), last(r[3], -1), last(r[4], 1))
    expected = {}
    for q in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (key(r), r[1]))
        second = mine[1] if len(mine) > 1 else (None,) * 5
        delta = mine[0][2] - second[2] if mine[0][2] is not None and second[2] is not None else None
        expected[q] = (*mine[0], second[1], second[2], sum(key(r) == key(mine[0]) for r in mine) > 1, delta)
    for tasks in (1, 3, 11):
        rng.shuffle(rows)
        pairs = spark.createDataFrame(rows, "query string, target string, concordance double, n_compared long, mismatch_count long").repartition(tasks)
        assert {r["query"]: tuple(r) for r in pairwise.best_matches(pairs).collect()} == expected
