"""Block-gzipped text, heads of files, and reference bases."""

import gzip
import io
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from genoeval.plans.wgs import common
from genoeval.sources import bgzf, sinks, vcf
from genoeval.sources.fasta import read_fasta


def block_gzip(data, size):
    """Members of up to ``size`` bytes of text, and the empty one at the end."""
    out = b""
    for part in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_ranges_give_every_line_once(seed):
    """Any split of the compressed bytes gives the lines of the text, in order; lines shorter and longer than members."""
    rng = random.Random(seed)
    lines = ["x" * rng.choice([0, 1, 5, 40, 900]) + str(i) + rng.choice(["", "ä"]) for i in range(300)]
    text = "\n".join(lines) + rng.choice(["", "\n"])
    packed = block_gzip(text.encode(), rng.choice([7, 64, 500, 5000]))
    assert gzip.decompress(packed) == text.encode()
    for split in (1 << 20, len(packed) // 3 + 1, 700, 61):
        got = [x for a in range(0, len(packed), split) for some in bgzf.lines(io.BytesIO(packed), a, min(a + split, len(packed))) for x in some]
        assert got == lines


def vcf_text(n):
    head = ["##fileformat=VCFv4.2", "##source=x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb"]
    return "\n".join(head + [f"Chr0{1 + i % 3}\t{i}\tv{i}\tA\tC\t.\tPASS\t.\tGT\t0|{i % 2}\t1|1" for i in range(n)]) + "\n"


def test_one_file_many_tasks(spark, tmp_path):
    text = vcf_text(4000)
    (tmp_path / "b.vcf.gz").write_bytes(block_gzip(text.encode(), 3000))
    with gzip.open(tmp_path / "p.vcf.gz", "wt") as f:
        f.write(text)
    packed, plain = vcf.read_vcf(spark, str(tmp_path / "b.vcf.gz"), split=4000), vcf.read_vcf(spark, str(tmp_path / "p.vcf.gz"))
    assert packed.rdd.getNumPartitions() > 5 and plain.rdd.getNumPartitions() == 1
    rows = lambda df: [tuple(r) for r in df.orderBy("rec_ord").drop("rec_ord").collect()]
    assert rows(packed) == rows(plain) and len(rows(packed)) == 4000
    for name in ("b", "p"):
        assert [tuple(r) for r in vcf.read_vcf_samples(spark, str(tmp_path / f"{name}.vcf.gz")).collect()] == [("a", 0), ("b", 1)]


def test_heads_of_many_files(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.vcf").write_text(vcf_text(i))
    assert vcf.read_vcf_samples(spark, str(tmp_path / "*.vcf")).count() == 2
    (tmp_path / "9.vcf").write_text(vcf_text(1).replace("\ta\tb\n", "\tb\ta\n"))
    with pytest.raises(ValueError, match="different samples"):
        vcf.read_vcf_samples(spark, str(tmp_path / "*.vcf"))


def test_many_samples_are_one_expression(spark):
    """Twenty thousand samples: places are one array, so the plan stays small."""
    names = spark.createDataFrame([(f"s{i}", i) for i in range(20_000)], "sample string, sample_idx int")
    sites = spark.createDataFrame([("Chr01", [str(i) for i in range(20_000)])], "chrom string, calls array<string>")
    wanted = [f"s{i}" for i in range(19_999, -1, -1)]
    calls = vcf.select_samples(sites, names, wanted).first()["calls"]
    assert calls[:2] == ["19999", "19998"] and len(calls) == 20_000
    with pytest.raises(ValueError, match="nobody"):
        vcf.select_samples(sites, names, ["nobody"])


def test_names_instead_of_scans(spark, tmp_path):
    for name in ("run.Chr01.1-100.vcf.gz", "Chr02/run.Chr02.50-90.vcf.gz", "other.vcf.gz"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(vcf_text(1))
    assert [f[:4] for f in vcf.chunk_files(spark, str(tmp_path))] == [("Chr01_1_100", "Chr01", 1, 100), ("Chr02_50_90", "Chr02", 50, 90)]
    for name in ("Chr1_consolidated.vcf.gz", "Chr02_consolidated.vcf.gz"):
        (tmp_path / name).write_bytes(b"")
    assert sorted(vcf.truth_files(spark, str(tmp_path))) == ["Chr01", "Chr02"]
    (tmp_path / "Chr01_consolidated.vcf.gz").write_bytes(b"")
    with pytest.raises(ValueError, match="Chr01"):
        vcf.truth_files(spark, str(tmp_path))


def test_reference_bases(spark, tmp_path):
    rng, text, index, expected = random.Random(2), b"", [], {}
    for name, length, width in (("Chr01", 2503, 60), ("scaffold_1", 90, 60), ("chr2", 1000, 71), ("Chr03", 1, 60)):
        bases = "".join(rng.choice("ACGTn") for _ in range(length))
        text += f">{name} some words\n".encode()
        index.append(f"{name}\t{length}\t{len(text)}\t{width}\t{width + 1}")
        text += b"".join(bases[i : i + width].encode() + b"\n" for i in range(0, length, width))
        expected[name] = bases
    (tmp_path / "r.fa").write_bytes(text)
    (tmp_path / "r.fa.fai").write_text("\n".join(index) + "\n")
    got = read_fasta(spark, str(tmp_path / "r.fa"), run=2).groupBy("chrom").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "bases"))), lambda b: b["bases"]), "").alias("bases"), F.max("block").alias("last"))
    assert {r["chrom"]: (r["bases"], r["last"]) for r in got.collect()} == {"Chr01": (expected["Chr01"], 2), "Chr02": (expected["chr2"], 0), "Chr03": (expected["Chr03"], 0)}


def test_files_of_a_chromosome_do_not_overlap(spark, tmp_path):
    import pyarrow.parquet as pq

    rng = random.Random(6)
    sites = spark.createDataFrame([(f"Chr0{1 + i % 2}", rng.randrange(900), "A", "C", i) for i in range(600)], "chrom string, pos int, ref string, alt string, x int").repartition(4)
    parts = sinks.position_parts(sites, rows=60, window=10)
    sinks.write_partitioned(sites, str(tmp_path / "d"), parts=parts, window=10)
    assert spark.read.parquet(str(tmp_path / "d")).count() == 600
    for chrom in ("Chr01", "Chr02"):
        ranges = []
        for f in (tmp_path / "d" / f"CHROM={chrom}").glob("*.parquet"):
            pos = pq.read_table(f, columns=["pos"])["pos"].to_pylist()
            assert pos == sorted(pos) and len(pos) <= 60
            ranges.append((pos[0], pos[-1]))
        ranges.sort()
        assert len(ranges) >= 5 and all(a[1] // 10 < b[0] // 10 for a, b in zip(ranges, ranges[1:], strict=False))


def test_absent_samples_are_named(spark):
    names = lambda *n: spark.createDataFrame([(x, i) for i, x in enumerate(n)], "sample string, sample_idx int")
    assert common(names("a", "b"), names("b", "a"), None) == ["a", "b"]
    with pytest.raises(ValueError, match="truth: samples not in input: b"):
        common(names("a", "b"), names("a"), ["a", "b"])
