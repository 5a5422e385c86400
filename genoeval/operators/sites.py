"""Filters over sites."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotypes import is_missing


@dataclass(frozen=True)
class Thresholds:
    """Quality bounds, inclusive. ``enabled=False`` passes every site and masks invalid calls only."""

    qual: float = 30.0
    qd: float = 2.0
    sor: float = 3.0
    fs: float = 60.0
    mq: float = 40.0
    mq_rank_sum: float = -12.5
    read_pos_rank_sum: float = -8.0
    gq: int = 60
    dp: int = 10
    enabled: bool = True

    def __post_init__(self) -> None:
        if int(self.gq) != self.gq or not 0 <= self.gq <= 99:
            raise ValueError(f"the least GQ is an integer from 0 to 99, not {self.gq}")
        if int(self.dp) != self.dp or self.dp < 0:
            raise ValueError(f"the least DP is a nonnegative integer, not {self.dp}")


def biallelic_snps(sites: DataFrame) -> DataFrame:
    """One ALT, and REF and ALT of one base each, in any case."""
    return sites.filter(F.col("ref").rlike("^[ACGTNacgtn]$") & F.col("alt").rlike("^[ACGTNacgtn]$"))


def parse_region(region: str) -> tuple[str, int | None, int | None]:
    """``chrom`` or ``chrom:start-end``; numbers may be written as 1e6."""
    m = re.fullmatch(r"([^:]+)(?::([^-]+)-(.+))?", region)
    if not m:
        raise ValueError(f"not a region: {region}")
    return m[1], int(float(m[2])) if m[2] else None, int(float(m[3])) if m[3] else None


def canonical_region(region: str | None, chroms: list[str] | None = None) -> str | None:
    """A region with its chromosome's canonical name; unknown or unselected chromosomes raise."""
    if not region:
        return None
    chrom, start, end = parse_region(region)
    m = re.fullmatch(r"(?:chr|Chr)?([0-9]+)", chrom)
    if not m or int(m[1]) > 99:
        raise ValueError(f"not a chromosome: {chrom}")
    name = f"Chr{int(m[1]):02d}"
    if chroms and name not in chroms:
        raise ValueError(f"region {region} is not on a selected chromosome")
    return name if start is None else f"{name}:{start}-{end}"


def in_region(sites: DataFrame, region: str | None) -> DataFrame:
    if not region:
        return sites
    chrom, start, end = parse_region(region)
    kept = sites.filter(F.col("chrom") == chrom)
    return kept if start is None else kept.filter(F.col("pos").between(start, end))


def filter_reasons(t: Thresholds) -> list[tuple[str, Column]]:
    """Reasons to drop a site in reporting order: QUAL, QD and MQ must be there, the others may be missing.

    With the filter off they are there and never hold, so that reports keep their rows.
    """
    out = []
    for name, column, bound in (("QUAL", "qual", t.qual), ("QD", "qd", t.qd)):
        out += [(f"missing_{name}", F.col(column).isNull()), (f"{name}_below_min", F.coalesce(F.col(column) < bound, F.lit(False)))]
    out += [("SOR_above_max", F.coalesce(F.col("sor") > t.sor, F.lit(False))), ("FS_above_max", F.coalesce(F.col("fs") > t.fs, F.lit(False)))]
    out += [("missing_MQ", F.col("mq").isNull()), ("MQ_below_min", F.coalesce(F.col("mq") < t.mq, F.lit(False)))]
    out += [("MQRankSum_below_min", F.coalesce(F.col("mq_rank_sum") < t.mq_rank_sum, F.lit(False))), ("ReadPosRankSum_below_min", F.coalesce(F.col("read_pos_rank_sum") < t.read_pos_rank_sum, F.lit(False)))]
    return out if t.enabled else [(name, F.lit(False)) for name, _ in out]


def site_filter(sites: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds ``site_filter_pass`` and ``site_filter_reasons`` (joined by ``;``, or PASS)."""
    if not t.enabled:
        return sites.withColumn("site_filter_pass", F.lit(True)).withColumn("site_filter_reasons", F.lit("PASS"))
    reasons = F.concat_ws(";", *[F.when(failed, name) for name, failed in filter_reasons(t)])
    return sites.withColumn("site_filter_reasons", F.when(reasons == "", "PASS").otherwise(reasons)).withColumn("site_filter_pass", F.col("site_filter_reasons") == "PASS")


def is_phased(gt: Column) -> Column:
    return gt.contains("|")


def is_half_missing(gt: Column) -> Column:
    """Missing, or half of it."""
    return is_missing(gt) | gt.contains(".")


def filter_panel(sites: DataFrame, rate: float = 0.95) -> DataFrame:
    """Adds ``keep``: enough phased calls and none missing (a half-missing call counts as missing)."""
    phased = F.size(F.filter("gt", is_phased))
    return sites.withColumn("keep", (phased >= rate * F.size("gt")) & ~F.exists("gt", is_half_missing))


def filter_panel_calls(calls: DataFrame, keys: list[str], rate: float = 0.95) -> DataFrame:
    """``keep`` of each site from rows of calls with ``phased`` and ``missing``."""
    counts = calls.groupBy(*keys).agg(F.count_if("phased").alias("phased"), F.count_if("missing").alias("missing"), F.count("*").alias("n"))
    return counts.withColumn("keep", (F.col("phased") >= rate * F.col("n")) & (F.col("missing") == 0))


def filter_panel_counts(sites: DataFrame, texts: dict[str, Column], rate: float = 0.95) -> DataFrame:
    """``keep`` of each site from columns that count its calls by text, with what each text is at that site."""
    total = lambda holds: sum((F.when(holds(t), F.col(n)).otherwise(0) for n, t in texts.items()), F.lit(0))
    phased, missing, n = total(is_phased), total(is_half_missing), sum((F.col(n) for n in texts), F.lit(0))
    return sites.withColumn("keep", (phased >= rate * n) & (missing == 0))


def check_ref(sites: DataFrame, bases: DataFrame, block: int = 1000) -> DataFrame:
    """Sites whose REF is not the reference base: ``bases`` is (chrom, block, bases), ``block`` bases a row, from position 1.

    The sites, narrow rows, are what a task holds; the blocks' texts stream past them, neither sorted nor broadcast.
    """
    at = sites.withColumn("block", F.expr(f"(pos - 1) div {block}"))
    base = F.substring(F.col("bases"), ((F.col("pos") - 1) % block + 1).cast("int"), F.lit(1))
    return at.hint("shuffle_hash").join(bases, ["chrom", "block"], "left").withColumn("base", base).filter("base is null or upper(base) <> upper(ref)").drop("bases", "block")


def require(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Fail early on missing columns or an empty table."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{what}: missing columns {', '.join(absent)}")
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df


def assert_format(sites: DataFrame, field: str, what: str) -> None:
    """Every record's FORMAT must name ``field``."""
    without = sites.filter(F.col("format").isNull() | ~F.array_contains(F.split("format", ":"), field)).select("chrom", "pos").limit(5).collect()
    if without:
        raise ValueError(f"{what}: no {field} in FORMAT, e.g. at {', '.join(f'{r[0]}:{r[1]}' for r in without)}")


def assert_reference(sites: DataFrame, bases: DataFrame, what: str) -> None:
    """REF must be the reference base; the first examples are named."""
    wrong = check_ref(sites.select("chrom", "pos", "ref"), bases).orderBy("chrom", "pos").limit(5).collect()
    if wrong:
        raise ValueError(f"{what}: REF differs from the reference, e.g. {[(r['chrom'], r['pos'], r['ref'], r['base']) for r in wrong]}")


def assert_unique(df: DataFrame, keys: list[str], what: str) -> None:
    twice = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{what}: repeated keys, e.g. {[tuple(r)[:-1] for r in twice]}")
