"""The dataset manifest against a plain hash tree."""

import hashlib
import zlib

import pytest

from genoeval.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i // 8 * 8
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
        at = [i // 8 for i in at]
        nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    root, tops = tree([b[0] for b in built])
    out = []
    for g, (subroot, paths), top in zip(names, built, tops, strict=True):
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), paths, strict=True):
            claimed = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                claimed = leaf((*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)})))
            for left, right in path + top:
                claimed = digest(left + claimed + right)
            out.append((r[0], own, subroot, root, digest("".join(a + b for a, b in path + top)), claimed, claimed == root))
    return out


def check(spark, rows, schema=SCHEMA, docs=None):
    docs = docs if docs is not None else spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in merkle.verify_digest(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain([r[:5] for r in rows]), key=repr)


def test_trees_of_all_heights(spark):
    sizes = {None: 1, "": 9, "a": 8, "b": 64, "Z": 65, "ä": 2, "hot": 600} | {f"g{i}": 1 for i in range(100)}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 7
            rows.append((i % 1009 * 3 + i, f"src{i % 5}", lang, i, f"Text ÄB {i} " * (i % 4)))
    check(spark, rows)


def test_nulls_ties_repeats_and_odd_texts(spark):
    rows = [(None, None, None, None, None), (3, None, None, None, None), (None, "s", "en", 3, "ABC"), (5, "s", "en", 0, ""), (5, "s", "en", 0, ""), (5, "t", "en", None, "Ü" * 9), (6, "s", "1:x", 1, "A" * 300_000), (-4, "-", "-", 1, "q")]
    check(spark, rows)
    check(spark, rows[1:2])


def test_more_columns_and_no_rows(spark):
    rows = [(i, "s", "en", 1, "Tx", "left", i) for i in range(20)]
    check(spark, rows, SCHEMA + ", `lo` string, `tree` int")
    assert merkle.verify_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_general_manifest(spark):
    """Any group and order, with the rows' own columns; a changed leaf does not fold to the root."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(f"k{i % 3}", float(i), f"v{i}", digest(f"v{i}")) for i in range(50)], "part string, rank double, value string, leaf string")
    out = merkle.manifest(rows, "part", ["rank"])
    assert set(rows.columns) < set(out.columns)
    right = out.filter(merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).count()
    wrong = out.filter(merkle.folded(F.sha2("value", 224), F.col("path")) == F.col("root")).count()
    assert (right, wrong) == (50, 0)
    with pytest.raises(Exception, match="absent"):
        merkle.manifest(rows, "absent", ["rank"])
