import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from genoeval.operators import chunks, contigs, incremental, joins, maps, metrics, pairwise, panel
from genoeval.operators import sites as site_ops
from genoeval.sources import files, sinks
from genoeval.streaming import merge


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_overlap_trim(spark):
    c = spark.createDataFrame([("a", "Chr01", 1, 5000000), ("b", "Chr01", 4990000, 8990000), ("c", "Chr01", 8980000, 12980000)], "chunk_id string, chrom string, start long, end long")
    assert rows(chunks.trim_chunks(c), "chunk_id", "trim_end", "trimmed") == [("a", 4989999, True), ("b", 8979999, True), ("c", 12980000, False)]
    sites = spark.createDataFrame([("a", "Chr01", 4989999), ("a", "Chr01", 4990000), ("b", "Chr01", 4989000), ("b", "Chr01", 4990000), ("c", "Chr01", 13000000)], "chunk_id string, chrom string, pos long")
    assert rows(chunks.stitch_chunks(sites, c), "chunk_id", "pos") == [("a", 4989999), ("b", 4990000), ("c", 13000000)]


def test_trim_refuses_a_swallowed_chunk(spark):
    c = spark.createDataFrame([("a", "Chr01", 10, 20), ("b", "Chr01", 10, 30)], "chunk_id string, chrom string, start long, end long")
    with pytest.raises(PySparkException):
        chunks.trim_chunks(c).collect()


def test_chunk_lines(spark):
    lines = ["Chr01 1 5000000", "0 Chr01 1 5000000 9", "7 1 1 5000000", "1 1 900", "", "# note", "chr start end"]
    got = chunks.parse_chunk_lines(spark.createDataFrame(list(enumerate(lines)), "ord long, value string"))
    assert [tuple(r) for r in got.orderBy("ord").drop("ord").collect()] == [("Chr01_1_5000000", "Chr01", 1, 5000000, 500000), ("0", "Chr01", 1, 5000000, 9), ("7", "1", 1, 5000000, 500000), ("1_1_900", "1", 1, 900, 500000)]
    with pytest.raises(PySparkException):
        chunks.parse_chunk_lines(spark.createDataFrame([(0, "Chr01 one 900")], "ord long, value string")).collect()


def test_constant_rate_map(spark):
    got = maps.constant_rate_map(spark.createDataFrame([("Chr01", 3500), ("Chr02", 999)], "chrom string, length long"))
    assert rows(got, "chrom", "position", "cm") == [("Chr01", 1000, 0.0), ("Chr01", 2000, 0.001), ("Chr01", 3000, 0.002)]


def test_matching_ties_and_empty_pairs(spark):
    q = spark.createDataFrame([("Q", 0)], "sample string, sample_idx int")
    t = spark.createDataFrame([("A", 0), ("B", 1), ("C", 2)], "sample string, sample_idx int")
    sites = spark.createDataFrame([([0], [0, 0, None]), ([1], [1, 1, None])], "q array<int>, t array<int>")
    ranked = pairwise.rank_matches(pairwise.pairwise_concordance(sites, q, t))
    assert rows(ranked, "match_rank", "target", "concordance", "n_compared", "mismatch_count") == [(1, "A", 1.0, 2, 0), (2, "B", 1.0, 2, 0), (3, "C", None, 0, None)]
    best = pairwise.best_matches(ranked).first()
    assert (best["best_target"], best["second_target"], best["concordance_delta"], best["tie_flag"]) == ("A", "B", 0.0, True)


def test_panel(spark):
    s = spark.createDataFrame([("Chr01", ["0|1"] * 20), ("Chr01", ["0|1"] * 18 + ["0/1"] * 2), ("Chr01", ["0|1"] * 19 + ["./."]), ("Chr01", ["0|1"] * 19 + [".|1"])], "chrom string, gt array<string>")
    assert rows(panel.panel_report(s)) == [("Chr01", 4, 3, 1, 0.95)]
    files = ["Chr01.phased.vcf.gz", "Chr01_chr.vcf.gz", "Chr1.phased.vcf.gz", "Chr10.beagle.vcf.gz", "Chr10.vcf.gz", "x.Chr02.phased.vcf.gz", "standardised/Chr02_chr.vcf.gz", "Chr02.vcf.gz", "Chr03-b.vcf.gz", "Chr03-a.vcf.gz"]
    listing = spark.createDataFrame([(f"/p/{f}", 10) for f in files] + [("/p/Chr10.phased.vcf.gz", 0)], "path string, length long")
    chosen = panel.choose_panel_files(listing, spark.createDataFrame([(f"Chr{i:02d}",) for i in (1, 2, 3, 4, 10)], "chrom string"))
    assert rows(chosen) == [("Chr01", "/p/Chr01.phased.vcf.gz"), ("Chr02", "/p/standardised/Chr02_chr.vcf.gz"), ("Chr03", "/p/Chr03-a.vcf.gz"), ("Chr10", "/p/Chr10.beagle.vcf.gz")]


def test_map_files(spark):
    files = ["Chr01.txt.gz", "genetic_map.Chr01.txt", "other.Chr02.v1.txt", "an.Chr02.map", "Chr02.bed", "Chr03_genetic_map.txt", "genetic_map_Chr03.txt"]
    listing = spark.createDataFrame([(f"/m/{f}",) for f in files], "path string")
    chosen = maps.choose_map_files(listing, spark.createDataFrame([("Chr01",), ("Chr02",), ("Chr03",), ("Chr04",)], "chrom string"))
    assert rows(chosen) == [("Chr01", "/m/Chr01.txt.gz"), ("Chr02", "/m/an.Chr02.map"), ("Chr03", "/m/genetic_map_Chr03.txt")]


def test_small_inputs_and_outputs(spark, tmp_path):
    sinks.write_tsv(sinks.manifest(spark, {"b": "2", "a": "1"}), str(tmp_path / "m"))
    assert files.manifest_value(spark, str(tmp_path / "m"), "b") == "2" and files.manifest_value(spark, str(tmp_path / "m"), "c") is None
    ab = spark.createDataFrame([("Chr01", 5, "A", "C", "v", ["A/A", "A/B"])], "chrom string, pos int, ref string, alt string, id string, ab array<string>")
    sinks.write_ab(ab, ["s1", "s2"], str(tmp_path / "ab"))
    assert rows(files.read_wide(spark, str(tmp_path / "ab"), "ab")) == [("Chr01", 5, "A", "C", "v", "s1", "A/A"), ("Chr01", 5, "A", "C", "v", "s2", "A/B")]
    sinks.write_calls(ab.union(ab.withColumn("chrom", F.lit("Chr02"))), str(tmp_path / "calls"))
    assert spark.read.parquet(str(tmp_path / "calls")).filter("CHROM = 'Chr02'").count() == 1
    both = joins.genome_wide([ab, ab.drop("ab").withColumn("x", F.lit(1))])
    assert both.count() == 2 and both.filter("x is null").count() == both.filter("ab is null").count() == 1
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "sample string")
    assert [r["sample"] for r in joins.missing_samples(names("c", "a", "b"), names("b")).collect()] == ["a", "c"]
    ds = spark.createDataFrame([("Chr01", 5, "s", None)], "chrom string, pos int, sample string, ds double")
    gp = ds.withColumn("ds", F.lit(1.5))
    joins.assert_dosages(joins.ds_with_gp(ds, gp), "imputed")
    with pytest.raises(ValueError):
        joins.assert_dosages(joins.ds_with_gp(ds, ds), "imputed")
    with pytest.raises(ValueError, match="Chr02"):
        joins.assert_same_positions(ab, ab.union(ab.withColumn("chrom", F.lit("Chr02"))))


def test_contigs(spark):
    s = spark.createDataFrame([("chr1", 0), ("chr01", 1), ("chr17", 2), ("chr18", 3)], "chrom string, rec_ord long")
    assert contigs.contig_style(s) == "chrN"
    assert rows(contigs.normalize_contigs(s, "chrN"), "chrom") == [("Chr01",), ("Chr17",), ("chr01",), ("chr18",)]
    assert rows(contigs.clashing_contigs(s)) == [("Chr01", ["chr01", "chr1"])]
    assert contigs.contig_style(s.limit(0)) is None
    assert rows(contigs.standardise_panel(s), "chrom") == rows(s, "chrom")
    one = spark.createDataFrame([("Chr00",), ("Chr02",), ("Chr01",)], "chrom string")
    assert [r[0] for r in contigs.select_chroms(one, one).collect()] == ["Chr01", "Chr02"]
    assert [r[0] for r in contigs.select_chroms(one, one, ["Chr00"]).collect()] == ["Chr00"]


def test_align_refuses_missing_loci(spark):
    a = spark.createDataFrame([("c", 1, "x")], "chrom string, pos int, id string")
    assert rows(joins.align(a, a), "id", "id_imputed") == [("x", "x")]
    with pytest.raises(PySparkException):
        joins.align(a, a.limit(0)).collect()


def test_regions():
    assert site_ops.parse_region("Chr01") == ("Chr01", None, None)
    assert site_ops.parse_region("Chr01:1e6-2e6") == ("Chr01", 1000000, 2000000)
    with pytest.raises(ValueError):
        site_ops.parse_region("Chr01:5")


def test_guards(spark):
    df = spark.createDataFrame([("c", 1), ("c", 1)], "chrom string, pos int")
    with pytest.raises(ValueError):
        site_ops.assert_unique(df, ["chrom", "pos"], "imputed")
    with pytest.raises(ValueError):
        site_ops.require(df, ["ref"], "imputed")
    with pytest.raises(ValueError):
        site_ops.require(df.limit(0), ["pos"], "imputed")


def test_filter_off(spark):
    s = spark.createDataFrame([(None, None, None, None, None, None, None)], "qual double, qd double, sor double, fs double, mq double, mq_rank_sum double, read_pos_rank_sum double")
    assert rows(site_ops.site_filter(s), "site_filter_reasons") == [("missing_QUAL;missing_QD;missing_MQ",)]
    assert rows(site_ops.site_filter(s, site_ops.Thresholds(enabled=False)), "site_filter_pass", "site_filter_reasons") == [(True, "PASS")]


def test_sample_lists(spark):
    lines = spark.createDataFrame([("b x", 0), ("", 1), ("a", 2), ("b x", 3)], "value string, ord long")
    assert rows(files.number_samples(lines, "first")) == [("a", 1), ("b x", 0)]
    with pytest.raises(ValueError):
        files.number_samples(lines, "unique")


def test_sinks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([("Chr01", 1, 0.5), ("Chr02", 2, None)], "chrom string, pos int, r2 double")
    sinks.write_partitioned(df, str(tmp_path / "m"))
    sinks.write_partitioned(df.filter("chrom = 'Chr02'").withColumn("r2", F.lit(0.1)), str(tmp_path / "m"))
    back = files.read_metrics(spark, str(tmp_path), "m").filter("CHROM = 'Chr02' and r2 < 0.8")
    assert rows(back, "pos", "r2") == [(2, 0.1)] and files.read_metrics(spark, str(tmp_path), "m").count() == 2
    sinks.write_tsv(df, str(tmp_path / "t"), "NA")
    text = next((tmp_path / "t").glob("part-*")).read_text()
    assert text == "chrom\tpos\tr2\nChr01\t1\t0.5\nChr02\t2\tNA\n"
    long = spark.createDataFrame([("Chr01", 1, "A", "C", "v", "s1", "A/B"), ("Chr01", 1, "A", "C", "v", "s2", None)], "chrom string, pos int, ref string, alt string, id string, sample string, gt string")
    wide = sinks.wide_calls(long, ["s2", "s1"], "gt")
    assert wide.columns[5:] == ["s2", "s1"] and rows(wide, "s1", "s2") == [("A/B", None)]
    sinks.write_tsv(wide, str(tmp_path / "w"), ".")
    assert rows(files.read_wide(spark, str(tmp_path / "w"), "gt"), "sample", "gt") == [("s1", "A/B"), ("s2", None)]
    m = maps.constant_rate_map(spark.createDataFrame([("Chr01", 2500)], "chrom string, length long"))
    files.write_genetic_map(m, str(tmp_path / "map"))
    assert rows(files.read_genetic_map(spark, str(tmp_path / "map"), "Chr01"), "position", "cm") == [(1000, 0.0), (2000, 0.001)]
    (tmp_path / "x.fai").write_text("Chr01\t2500\t7\t60\t61\n")
    assert rows(files.read_fai(spark, str(tmp_path / "x.fai"))) == [("Chr01", 2500)]
    with pytest.raises(ValueError):
        files.read_fai(spark, str(tmp_path / "x.fai"), ["Chr02"])
    (tmp_path / "chunks").write_text("0|Chr01|1|500|9\n")
    assert rows(files.read_chunk_manifest(spark, str(tmp_path / "chunks"))) == [("0", "Chr01", 1, 500, 9)]


def test_incremental(spark, tmp_path):
    listing = spark.createDataFrame([("b", 2, 20), ("a", 1, 10)], "path string, length long, modified long")
    one = incremental.run_signature(listing, {"gq": "60"}).first()[0]
    assert one == incremental.run_signature(listing.orderBy("path"), {"gq": "60"}).first()[0] != incremental.run_signature(listing, {"gq": "59"}).first()[0]
    incremental.assert_mode(spark, str(tmp_path / "o"), "wgs")
    incremental.assert_mode(spark, str(tmp_path / "o"), "wgs")
    with pytest.raises(ValueError):
        incremental.assert_mode(spark, str(tmp_path / "o"), "array")
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x").write_text("x")
    with pytest.raises(ValueError):
        incremental.assert_mode(spark, str(tmp_path / "p"), "wgs")
    log = incremental.AuditLog()
    log.step("filter", 10, 4)
    log.step("read", None, 10)
    assert rows(log.frame(spark), "step", "count_removed") == [("filter", 6), ("read", None)]


def test_running_metrics_equal_one_pass(spark, tmp_path):
    s = spark.createDataFrame([("Chr01", [0, 1, 2], [0, 1, 1]), ("Chr02", [2, 1, 0], [2, 0, None]), ("Chr02", [1, 1, 1], [0, 2, 1])], "chrom string, x array<int>, y array<int>")
    stats = metrics.sample_stats(s)
    stats.select(*[c.split()[0] for c in merge.STATS_SCHEMA.split(", ")]).repartition(3).write.parquet(str(tmp_path / "s"))
    q = merge.running_metrics(merge.stats_stream(spark, str(tmp_path / "s"), 1)).writeStream.outputMode("complete").format("memory").queryName("running").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("running"), "sample_idx", "maf_bin", "n", "r") == rows(metrics.finalize_stats(stats), "sample_idx", "maf_bin", "n", "r")
    assert rows(metrics.finalize_stats(metrics.sample_stats(s.repartition(7)))) == rows(metrics.finalize_stats(stats))
