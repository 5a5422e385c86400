"""Genotype and allele expressions. All are built-in column functions; none raises on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: pairs of alleles that read the same on both strands.
AMBIGUOUS = ("AT", "TA", "CG", "GC")
MISSING_CALLS = (".", "./.", ".|.")


def base_group(base: Column) -> Column:
    """A for A and T, B for C and G, else ``?``; upper case only."""
    return F.when(base.isin("A", "T"), "A").when(base.isin("C", "G"), "B").otherwise("?")


def is_ambiguous(ref: Column, alt: Column) -> Column:
    return F.concat(ref, alt).isin(*AMBIGUOUS)


def call_parts(gt: Column) -> Column:
    """Alleles of a diploid call: split at ``/`` first, else at ``|``; null unless that gives exactly two."""
    by_slash, by_bar = F.split(gt, "/"), F.split(gt, r"\|")
    return F.when(F.size(by_slash) == 2, by_slash).when(F.size(by_bar) == 2, by_bar)


def separator(gt: Column) -> Column:
    return F.when(gt.contains("/"), "/").otherwise("|")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _coded(gt: Column, code) -> Column:
    """Struct (gt, problem, extra): the two alleles coded left to right; a missing one first makes the call missing."""
    missing, no = F.lit("./."), F.lit(None).cast("string")

    def out(value: Column, problem: Column, extra: Column) -> Column:
        return F.struct(value.alias("gt"), problem.alias("problem"), extra.alias("extra"))

    def decide(c: Column) -> Column:
        a, b, ca, cb = (c[n] for n in ("a", "b", "ca", "cb"))
        group = F.concat(ca, F.lit(","), cb)
        return (
            F.when(a.isNull() | b.isNull(), out(missing, F.lit("not_diploid"), no))
            .when(a == ".", out(missing, no, no)).when(ca.isNull(), out(missing, F.lit("unknown_allele"), a))
            .when(b == ".", out(missing, no, no)).when(cb.isNull(), out(missing, F.lit("unknown_allele"), b))
            .when((ca == "?") | (cb == "?"), out(missing, F.lit("base_group"), group))
            .otherwise(out(F.concat(ca, c["sep"], cb), no, no))
        )

    def split(p: Column) -> Column:
        a, b = F.try_element_at(p["x"], F.lit(1)), F.try_element_at(p["x"], F.lit(2))
        return F.struct(a.alias("a"), b.alias("b"), code(a).alias("ca"), code(b).alias("cb"), separator(gt).alias("sep"))

    return _let(_let(F.struct(call_parts(gt).alias("x")), split), decide)


def translate_by_bases(gt: Column, ref: Column, alt: Column) -> Column:
    """Imputed side: allele 0 is the group of REF, 1 that of ALT; only called bases are checked."""
    return _coded(gt, lambda x: F.when(x == "0", base_group(ref)).when(x == "1", base_group(alt)))


def translate_by_index(gt: Column) -> Column:
    """Truth side: 0 is A, 1 is B, whatever REF and ALT say."""
    return _coded(gt, lambda x: F.when(x == "0", F.lit("A")).when(x == "1", F.lit("B")))


def ab_dosage(ab: Column) -> Column:
    """Copies of B in an A/B call; null if missing."""
    return F.when(ab.isin("A/A", "A|A"), 0).when(ab.isin("A/B", "B/A", "A|B", "B|A"), 1).when(ab.isin("B/B", "B|B"), 2)


def alt_dosage(gt: Column) -> Column:
    """Copies of ALT of a biallelic call; null if missing or malformed."""
    return F.when(gt.isin("0/0", "0|0"), 0).when(gt.isin("0/1", "1/0", "0|1", "1|0"), 1).when(gt.isin("1/1", "1|1"), 2)


def is_missing(gt: Column) -> Column:
    return gt.isNull() | (gt == "") | gt.isin(*MISSING_CALLS)


def is_invalid(gt: Column) -> Column:
    """Neither missing nor a biallelic diploid call; half-missing calls are invalid."""
    return ~is_missing(gt) & alt_dosage(gt).isNull()


def lenient_double(text: Column) -> Column:
    """Number, or null for anything else, NaN included."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x), x)


def dosage_from_probabilities(gp: Column) -> Column:
    """P(one ALT) + 2 P(two ALT) of a comma-joined triple; null if it has fewer than three values."""
    p = F.split(gp, ",")
    return F.when(F.size(p) >= 3, lenient_double(F.try_element_at(p, F.lit(2))) + 2 * lenient_double(F.try_element_at(p, F.lit(3))))


def hard_call(dosage: Column) -> Column:
    return F.when(dosage >= 1.5, 2).when(dosage <= 0.5, 0).when(dosage.isNotNull(), 1).cast("int")


def maf_bin(alt_copies: Column, calls: Column) -> Column:
    """Minor-allele bin 0 to 4 from integers, so that edges are exact; null without calls."""
    minor = F.least(alt_copies, 2 * calls - alt_copies)
    return F.when(calls > 0, F.least(F.lit(4), (F.floor(10 * minor / (2 * calls))).cast("int"))).cast("int")


#: Fractional dosages are whole numbers of millionths, so that their sums are exact too.
UNIT = 1_000_000


def scaled_dosage(dosage: Column) -> Column:
    return F.bround(dosage * UNIT).cast("long")


def dosages_in_row(ds: Column, gp: Column) -> Column:
    """Scaled dosages by sample from the texts of DS, and of GP where DS has no number; null where neither does."""
    one = lambda d, p: scaled_dosage(F.coalesce(lenient_double(d), dosage_from_probabilities(p)))
    return F.zip_with(ds, gp, one)


def correlation(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column, least: int, clamp: bool = True, wide: bool = False) -> Column:
    """Pearson's r from integer sums; null under ``least`` pairs or without variance. ``wide`` sums need more than 64 bits."""
    if wide:
        n, sx, sy, sxx, syy, sxy = (c.cast("decimal(38,0)") for c in (n, sx, sy, sxx, syy, sxy))
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    ok = (n >= least) & (vx > 0) & (vy > 0)
    # The divisor is kept off zero for rows that the condition leaves out.
    r = (n * sxy - sx * sy).cast("double") / F.sqrt(F.when(ok, vx).otherwise(1).cast("double") * F.when(ok, vy).otherwise(1).cast("double"))
    return F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)) if clamp else r)


def canonical_chrom(name: Column) -> Column:
    """ChrNN for 0 to 99 with or without a chr/Chr prefix; null for anything else."""
    bare = F.regexp_replace(F.regexp_replace(name, "^chr", ""), "^Chr", "")
    number = F.when(bare.rlike("^[0-9]+$"), bare).try_cast("int")
    return F.when(number.between(0, 99), F.format_string("Chr%02d", number))


def concordance(n: Column, mismatches: Column) -> Column:
    return F.when(n > 0, 1 - mismatches / F.when(n > 0, n).otherwise(1))
