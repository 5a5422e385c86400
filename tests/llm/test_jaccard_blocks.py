"""Rows of a large bucket grow with its members, not with their square."""

from genoeval.llm import jaccard

SCHEMA = "doc_id long, text string"


def test_rows_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    kept, keep = [], jaccard.Scratch.keep

    def noted(self, name, df):
        out = keep(self, name, df)
        if name == "left":
            kept.append(out.count())
        return out

    monkeypatch.setattr(jaccard.Scratch, "keep", noted)
    base = [f"w{i}" for i in range(120)]
    for n in (30, 60):
        rows = [(i, " ".join([*base[:i], f"own{i}", *base[i:]])) for i in range(n)]
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {i: (0, n - 1) for i in range(n)}
    assert kept[1] <= 3 * kept[0]
