"""Corpus operators against brute force on small fixtures with nulls, empty and long texts, ties and clashing columns."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from genoeval.llm import chat, common, decontamination, jaccard, language, licenses, media, pieces, sharding, suffix_dedup, token_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def corpus():
    """Random prose with exact and near copies, shared passages, nulls, empties, one long text, hot and multi-byte words."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghié") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(90)
    texts = [None, "", " \n!?", "one", "Mit License", "one two three", "one two three", prose(5), prose(4000)]
    for i in range(40):
        t = prose(rng.randint(20, 200))
        texts.append(t)
        if i % 3 == 0:
            texts.append(t)
        if i % 4 == 0:
            w = t.split(" ")
            w[len(w) // 2] = "changed"
            texts.append(" ".join(w))
        if i % 5 == 0:
            texts.append(prose(rng.randint(0, 30)) + " " + passage + " " + prose(rng.randint(0, 30)))
    texts += [t.upper() if t and i % 2 else t for i, t in enumerate(texts[9:15])]
    return [(i, t, rng.choice(["en", None]), "src0", 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """More columns than needed, with names that operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("key", "rep", "row", "id", "size", "samples"):
        df = df.withColumn(c, F.lit("x"))
    return df.cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df):
    got = {r["doc_id"]: r for r in df.collect()}
    return got


def test_sharding(docs, rows, none):
    got = by_id(sharding.shard_contiguous(docs, 5))
    assert len(got) == len(rows) and sharding.shard_contiguous(none, 5).count() == 0
    load, slots, groups = Counter(), {}, {}
    for d, t, *_ in rows:
        r = got[d]
        assert r["size"] == len((t or "").encode()) + 16 and r["text_crc32"] == zlib.crc32((t or "").encode()) and r["law"] == "bytes" and r["grown_shard"] is None
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(t, set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    # The best capacity by trying all of them on the same order of groups.
    sizes = Counter()
    for _, t, *_ in rows:
        sizes["" if t is None else hashlib.md5(t.encode()).hexdigest()] += len((t or "").encode()) + 16
    order = [sizes[k] for k in sorted(sizes)]

    def runs(capacity):
        n, now = 1, 0
        for s in order:
            if now + s > capacity:
                n, now = n + 1, 0
            now += s
        return n

    best = next(c for c in range(max(order), sum(order) + 1) if runs(c) <= 5)
    assert max(load.values()) == best


def test_sharding_can_be_aggregated(docs, rows):
    """Any column alone, and groups by a derived one."""
    found = sharding.shard_contiguous(docs, 5)
    assert sum(r["sum(size)"] for r in found.groupBy("shard").sum("size").collect()) == sum(len((t or "").encode()) + 16 for _, t, *_ in rows)
    assert all(found.select(c).count() == len(rows) and found.select(c).distinct().collect() for c in found.columns)


def test_sharding_refines_its_histogram(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 5000) for _ in range(300)]
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    df = spark.createDataFrame([(e,) for e in ends], "end long")
    capacity, cuts = sharding.smallest_capacity(df, ends[-1], max(sizes), 7, bins=20)

    def walk(c):
        out = [0]
        for _ in range(7):
            out.append(max([e for e in [0, *ends] if e <= out[-1] + c]))
        return out

    best = next(c for c in range(max(sizes), ends[-1] + 1) if walk(c)[-1] == ends[-1])
    assert capacity == best and cuts == walk(best)
    again, even = sharding.even_cuts(df, ends[-1], max(sizes), 7, bins=20)
    assert again == best and set(even) <= {0, *ends} and max(b - a for a, b in zip(even, even[1:])) <= best
    assert min(b - a for a, b in zip(even, even[1:])) >= ends[-1] / 7 - max(sizes)


def test_sharding_refines_at_the_origin(spark):
    sizes = [5000] + [7] * 300
    df = spark.createDataFrame([(sum(sizes[: i + 1]),) for i in range(len(sizes))], "end long")
    capacity, cuts = sharding.even_cuts(df, sum(sizes), 5000, 7, bins=20)
    assert capacity == 5000 and cuts[:2] == [0, 5000] and max(b - a for a, b in zip(cuts[1:], cuts[2:])) <= 357


def test_sharding_with_a_huge_group(spark):
    """One group larger than all fair shares has a shard to itself, and no shard stays empty."""
    rows = [(i, "x" * 1000, None, None, 0) for i in range(50)] + [(100 + i, f"text {i} " * 10, None, None, 0) for i in range(200)]
    load = Counter()
    for r in sharding.shard_contiguous(spark.createDataFrame(rows, SCHEMA), 10).collect():
        load[r["shard"]] += r["size"]
    rest = sorted(load.values())[:-1]
    assert len(load) == 10 and max(rest) - min(rest) <= 250


def test_chat_folds_events(spark):
    log = [
        (1, 0, "message", 0, "user", "hel"), (1, 1, "delta", 0, "user", "lo"), (1, 2, "message", 1, "assistant", ""), (1, 3, "delta", 1, "assistant", "bad"),
        (1, 4, "message", 2, "user", "gone"), (1, 5, "regenerate", 1, "assistant", None), (1, 6, "delta", 1, "assistant", "go"), (1, 7, "delta", 1, "assistant", "od"),
        (1, 8, "edit", 0, "user", "hi"), (1, 9, "message", 3, "user", None), (None, None, "message", 0, None, "x"),
    ]
    got = chat.fold_events(spark.createDataFrame(log, "conv_id long, seq long, kind string, message long, role string, text string"))
    found = [(r["conv_id"], r["role"], r["text"]) for r in got.orderBy("conv_id", "opened").collect()]
    assert found == [(None, "", "x"), (1, "user", "hi"), (1, "assistant", "good"), (1, "user", "")]


def test_chat_long_conversation(spark):
    """Thousands of turns, of which regenerations take some away, beside a conversation without any."""
    events = [(1, 2 * i, "message", i, "user" if i % 2 else "assistant", f"t{i} ") for i in range(3000)] + [(1, 2 * i + 1, "delta", i, None, "d") for i in range(3000)]
    events += [(1, 4001, "regenerate", 1000, None, None), (1, 4002, "delta", 1000, None, "new")] + [(2, i, "message", i, "user", "x") for i in range(5)]
    got = chat.fold_events(spark.createDataFrame(events, "conv_id long, seq long, kind string, message long, role string, text string").repartition(4))
    found = {(r["conv_id"], r["message"]): r["text"] for r in got.collect()}
    # Message 1000 was opened at 2000 and made again at 4001: those opened from 2001 to 4001 go.
    assert set(found) == {(1, i) for i in range(3000) if i <= 1000 or 2 * i > 4001} | {(2, i) for i in range(5)}
    assert found[1, 1000] == "new" and found[1, 2500] == "t2500 d" and found[2, 0] == "x"


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\n", "<|end|>\\<s>", None, "<<SYS>>a<</SYS>>", "<|turn|>\n<", "é\n\n"]
    rows = [(c, t, ["user", "assistant", "sys\ntem"][(c + t) % 3], texts[(c * 3 + t) % len(texts)], "x") for c in range(6) for t in range(5)] + [(7, 0, "user", "a", "x"), (7, 0, "user", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    got = {r["conv_id"]: r for r in chat.chat_digest(spark, df).collect()}
    assert set(got) == {*range(6), 7, -1} and got[7]["n_turns"] == 2
    for c in range(6):
        own = [(r[2], r[3] or "") for r in rows if r[0] == c]
        loss = "".join(t for role, t in own if role == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for t in texts:
        masked = chat.escape(t or "")
        assert chat.unescape(masked) == (t or "") and not any(x in masked for x in chat.CONTROL)
    assert set(r["conv_id"] for r in chat.chat_digest(spark, df.limit(0)).collect()) == {-1}


def brute_contamination(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for d, t, *_ in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[k]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark, docs, rows, none, monkeypatch):
    full = [t for _, t, *_ in rows if t and len(words(t)) > 60]
    items = [(1, " ".join(full[0].split(" ")[5:20])), (2, " ".join(full[1].split(" ")[3:40]).upper()), (10, "one two three"), (3, None), (4, ""), (5, full[2]), (5, full[3]), (6, "never " * 12), (7, "mit license")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1))
    expected = brute_contamination(rows, items)
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert {d: tuple(r[n] for n in names) for d, r in by_id(decontamination.contamination_digest(docs, bench)).items()} == expected
    monkeypatch.setattr(common, "FILTER_BITS", 1 << 15)  # a filter that lets strangers through
    assert {d: tuple(r[n] for n in names) for d, r in by_id(decontamination.contamination_digest(docs, bench)).items()} == expected
    assert all(r["n_hit"] == 0 for r in decontamination.contamination(docs, bench.limit(0)).collect())
    assert decontamination.contamination(none, bench).count() == 0
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, e in expected.items() if not e[1]}


def brute_classes(rows):
    sets = {}
    for d, t, *_ in rows:
        w = words(t)
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    links, parent = Counter(), {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both * 10 >= 8 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (root(d), links[d]) for d in sets}


def test_jaccard(docs, rows, none):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(docs).collect()}
    expected = brute_classes(rows)
    assert got == expected and any(n for _, n in expected.values())
    assert jaccard.jaccard_classes(none).count() == 0
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, (c, _) in expected.items() if c == d}


def test_jaccard_large_bucket(spark, monkeypatch):
    """A bucket of several blocks: near copies of one text, each with a word of its own."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: 3 * i], f"own{i}", *base[3 * i :]]), None, None, 0) for i in range(40)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_classes(rows) and got[39] == (0, 39)


def test_dropping_is_by_row(spark):
    """Repeated rows, shared ids and null ids through stages 2 to 4: of each text one row, with its bytes."""
    import corpus_pipeline

    rng = random.Random(6)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(120))
    repeated, near, clean, shared, nulls, bad, good, copies = (prose() for _ in range(8))
    change = lambda t, w: t.replace(t.split(" ")[60], w)
    rows = [
        (1, repeated), (1, repeated), (2, near), (3, change(near, "other")), (3, clean), (3, shared), (4, change(shared, "next")),
        (None, nulls), (None, change(nulls, "more")), (None, nulls), (None, bad), (5, change(bad, "worse")), (6, good), (6, copies), (None, copies), (7, None), (7, " !"),
    ]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    expected = [(1, repeated), (2, near), (3, clean), (3, shared), (5, change(bad, "worse")), (6, good), (6, copies), (7, None), (7, " !")]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    order = lambda x: sorted(x, key=str)
    assert kept.columns == df.columns and order(r for r in got if r[0]) == order(expected)
    assert [t for d, t in got if d is None] in ([nulls], [change(nulls, "more")]) and len(got) == len(expected) + 1
    cut = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(kept.collect(), SCHEMA), "").collect()
    assert order((r["doc_id"], r["text"]) for r in cut) == order(x for x in got if x[1])
    items = spark.createDataFrame([(1, " ".join(bad.split(" ")[20:40])), (2, " ".join(shared.split(" ")[70:90])), (3, " ".join(nulls.split(" ")[:30]))], "item_id long, text string")
    after = [(r["doc_id"], r["text"]) for r in decontamination.drop_contaminated(df, items).collect()]
    assert order(after) == order((d, t) for d, t in rows if not t or not any(t.startswith(x[:100]) for x in (bad, shared, nulls)))


def test_pruning_rule():
    assert jaccard.posterior_below(64, 64, 0.8) > 0.99 and jaccard.posterior_below(0, 8, 0.8) < 1e-4
    least = jaccard.least_matches(0.8, 1e-4)
    assert all(0 < least[n] < 0.8 * n for n in least if n >= 16) and list(least) == list(range(8, 81, 8))


def test_jaccard_loss():
    """Bands and all pruning steps together lose a pair at the threshold with a probability below 1e-8."""
    from math import comb

    least = jaccard.least_matches(jaccard.THRESHOLD, jaccard.TOLERANCE)
    pruned = sum(comb(n, i) * 0.8**i * 0.2 ** (n - i) for n, m in least.items() for i in range(m))
    assert pruned < 5e-9 and (1 - 0.8**jaccard.ROWS) ** jaccard.BANDS < 5e-9 and any(least.values())


def test_licenses(spark, none):
    texts = ["Released under the MIT License. mit-LICENSE, permit license", "GNU Lesser General Public License v3", "SPDX-License-Identifier: Apache-2.0", None, "", "the apache license and the GENERAL\npublic  license", "nothing here", "Licensed under the Apache License, Version 2.0"]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA)
    got = by_id(licenses.scan_licenses(df))
    for i, t in enumerate(texts):
        w = words(t)
        places = [(k, label) for phrase, label in licenses.BASE for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.decode().split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[1]["labels"] == "gpl,lgpl-3.0" and got[2]["labels"] == "apache-2.0" and got[7]["labels"] == "apache,apache-2.0" and got[6]["labels"] == ""
    assert len(licenses.RULES) >= 200 and licenses.scan_licenses(none).count() == 0


def test_license_suppression():
    assert [d[2] for d in licenses.detect(b"under the gnu affero general public license v3 and gnu general public license version 2")] == ["agpl-3.0", "gpl-2.0"]


def test_license_suppression_against_all_pairs(monkeypatch):
    rng = random.Random(8)
    words = [b"mit", b"license", b"gnu", b"general", b"public", b"lesser", b"gpl", b"v3", b"apache", b"under", b"licensed", b"the", b"creative", b"commons", b"attribution", b"share-alike", b"see", b"for", b"more", b"details", b"bsd", b"two-clause", b"cc0"]
    for _ in range(150):
        low = b" ".join(rng.choice(words) for _ in range(60))
        found = [(m.start(), m.end(), r, i) for i, r in enumerate(licenses.RULES) for m in r.pattern.finditer(low) if m.end() > m.start()]
        beats = lambda x, y: x[0] <= y[0] and x[1] >= y[1] and (x[2].priority, x[1] - x[0], -x[3]) > (y[2].priority, y[1] - y[0], -y[3])
        assert licenses.detect(low) == sorted((s, e, r.label, r.weight) for s, e, r, i in found if not any(beats(o, (s, e, r, i)) for o in found))
    many = [(i, i + 30 - i % 7, b"x") for i in range(100_000)]
    rule = licenses.RULES[0]
    pattern = type("P", (), {"finditer": lambda self, low: (type("M", (), {"start": lambda m, a=a: a, "end": lambda m, z=z: z})() for a, z, _ in many)})()
    monkeypatch.setattr(licenses, "RULES", (licenses.Rule(rule.label, 1, 0.5, (), pattern),))
    began = time.process_time()  # all pairs would take minutes
    assert licenses.detect(b"", prefilter=False) and time.process_time() - began < 4


def examples(parsed, rng):
    """A random text that a parsed regex matches."""
    from re import _constants as sre

    out = b""
    for op, value in parsed:
        if op is sre.LITERAL:
            out += bytes([value])
        elif op is sre.ANY:
            out += b"x"
        elif op is sre.IN:
            kind, first = rng.choice(value)
            out += rng.choice([b" ", b"\n", b"\t"]) if kind is sre.CATEGORY else bytes([first if kind is sre.LITERAL else first[0]])
        elif op is sre.SUBPATTERN:
            out += examples(value[-1], rng)
        elif op is sre.BRANCH:
            out += examples(rng.choice(value[1]), rng)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            out += b"".join(examples(value[2], rng) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2))))
        elif op is sre.ASSERT:
            out += examples(value[1], rng)
        else:
            assert op is sre.ASSERT_NOT
    return out


def test_license_prefilter_loses_nothing():
    from re import _parser

    rng = random.Random(4)
    for rule in licenses.RULES:
        parsed = _parser.parse(rule.pattern.pattern, re.S)
        assert rule.keywords and all(len(k) >= 3 for group in rule.keywords for k in group)
        for _ in range(8):
            text = b"pre " + examples(parsed, rng) + b" post"
            assert rule.pattern.search(text)
            assert licenses.detect(text) == licenses.detect(text, prefilter=False) != []
    texts = ("this code is released under gpl v3", "available under apache 2.0", "creative commons attribution-sharealike 4.0", "two-clause bsd", "cc0", "wtfpl", "placed in the public \n domain", "copyright x all rights\n reserved")
    assert [licenses.detect(t.encode())[0][2] for t in texts] == ["gpl-3.0", "apache-2.0", "cc-by-sa", "bsd-2-clause", "cc0-1.0", "wtfpl", "public-domain", "all-rights-reserved"]


def fuzz(seed, n=300):
    rng = random.Random(seed)
    parts = ["a", "b", "the ", " ", "  ", "    ", "\n", "\t", "é", "ß", "漢", "😀", "ﬁ", "▁", "er", "ing", "aaaa", "=", "--", "<s>", "<|endoftext|>", "'s", "x\x00", "2024", "́", "   \n", "ق"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)] + [c * k for c in "a =-\n▁" for k in (1, 2, 3, 17, 100)]


def test_pieces(spark, docs, rows, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    more = [(1000 + i, t, None, None, 0) for i, t in enumerate(fuzz(1))]
    got = by_id(pieces.encode_digest(spark.createDataFrame(rows + more, SCHEMA)))
    for d, t, *_ in rows + more:
        ids = library.encode(t or "")
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    some = by_id(pieces.encode(docs))
    assert all(some[d]["ids"] == library.encode(t or "") and some[d]["decoded"] == library.decode(library.encode(t or "")) for d, t, *_ in rows)
    assert pieces.encode(none).count() == 0


def test_media(spark, docs, rows, none):
    got = by_id(media.media_digest(docs))
    for d, t, *_ in rows:
        raw = (t or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = got[d]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    probed = media.probe(media.store_texts(docs)).filter("crc_bad > 0 or crc_good <> n_frames or table_frames <> n_frames or junk_bytes > 0 or seconds <> n_frames * 1152 / 48000D")
    assert probed.count() == 0 and media.media_digest(none).count() == 0


def test_media_streams():
    payload = bytes(range(256)) * 20
    data = media.store_payload(payload)
    s = media.parse_stream(data)
    assert media.read_payload(data, s) == payload and s.tags["payload_bytes"] == str(len(payload)) and s.table == "Xing"
    assert s.table_bytes == len(data) - s.seek[0] + 576 and len(s.toc) == 100
    tag = b"TAG" + b"a title".ljust(125, b"\0")
    cut = data[: s.seek[1]] + b"\xff\xff junk " * 5 + data[s.seek[1] :] + tag
    again = media.parse_stream(cut)
    assert len(again.seek) == len(s.seek) and again.junk == 40 and again.tags["TIT2"] == "a title" and media.read_payload(cut, again) == payload
    broken = bytearray(data)
    broken[s.seek[0] + 10] ^= 1
    assert media.parse_stream(bytes(broken)).crc_bad == 1
    with pytest.raises(ValueError):
        media.read_payload(bytes(broken), media.parse_stream(bytes(broken)))
    assert not media.parse_stream(b"").seek and not media.parse_stream(b"plain text " * 99).seek
    assert media.parse_header(bytes([0xFF, 0xF3, 0x90, 0xC0])).samples == 576 and media.parse_header(bytes([0xFF, 0xFF, 0x90, 0xC0])).layer == 1


def test_media_tags_and_tables():
    frame = lambda k, fill=b"": (bytes([0xFF, 0xFB, 0x90, 0xC0]) + fill).ljust(417, b"\0")
    assert media.parse_header(frame(0)[:4]).length == 417
    vbri = b"VBRI" + bytes(6) + (1668).to_bytes(4, "big") + (3).to_bytes(4, "big") + b"".join(x.to_bytes(2, "big") for x in (3, 3, 2, 1)) + b"".join(x.to_bytes(2, "big") for x in (139, 139, 139))
    s = media.parse_stream(frame(0, bytes(32) + vbri) + frame(1) * 3)
    assert (s.table, s.table_frames, s.table_bytes, s.table_seek, s.table_step, len(s.seek)) == ("VBRI", 3, 1668, [417, 834, 1251], 1, 3)
    body = b"\x01\xff\xfea\0\xff\0"  # utf-16: a and U+00FF
    safe = lambda n: bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])
    guard = lambda x: x.replace(b"\xff\0", b"\xff\0\0").replace(b"\xff\xfe", b"\xff\0\xfe")
    old = guard((6).to_bytes(4, "big") + bytes(6) + b"TIT2" + len(body).to_bytes(4, "big") + b"\0\0" + body)
    new = safe(6) + b"\1\0" + b"TIT2" + safe(4 + len(guard(body))) + b"\0\3" + safe(len(body)) + guard(body)
    for version, flags, tag in ((3, 0xC0, old), (4, 0x40, new)):
        s = media.parse_stream(b"ID3" + bytes([version, 0, flags]) + safe(len(tag)) + tag + frame(1) * 2)
        assert s.tags == {"TIT2": "a\xff"} and len(s.seek) == 2 and s.junk == 0


def test_media_payloads_like_tags():
    """Payloads of all lengths made of the mark of an ID3v1 tag, at each phase."""
    for n in [*range(0, 1400), 64 * 100, 64 * 1000]:
        for phase in range(3):
            payload = (b"TAG" * (n // 3 + 2))[phase : phase + n]
            data = media.store_payload(payload)
            s = media.parse_stream(data)
            assert media.read_payload(data, s) == payload and (s.junk, s.table_frames) == (0, len(s.seek))


def test_token_counts(spark, rows, none, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_counts.default_tokenizer())
    every = rows + [(1000 + i, t, None, None, 0) for i, t in enumerate(fuzz(2))]
    df = spark.createDataFrame(every, SCHEMA).withColumn("digest", F.lit("x"))
    cache = str(tmp_path / "cache")
    expected = {d: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for d, t, *_ in every}
    half = df.filter("doc_id < 1010")
    assert token_counts.token_counts(half, cache).count() == half.count()
    before = spark.read.parquet(cache)
    n = before.count()
    assert n == before.select("digest").distinct().count() == half.select(F.coalesce("text", F.lit(""))).distinct().count()
    got = by_id(token_counts.token_counts(df, cache))
    assert {d: (r["n_bytes"], r["n_tokens"]) for d, r in got.items()} == expected and all(r["over_limit"] == (r["n_tokens"] > 512) for r in got.values())
    after = spark.read.parquet(cache)
    assert after.count() == after.select("digest").distinct().count() == df.select(F.coalesce("text", F.lit(""))).distinct().count() > n
    assert token_counts.token_counts(none).count() == 0


def brute_repeats(rows, length):
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = {}
    for d, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,cover", [(400, 64, False), (50, 16, False), (20, 20, False), (400, 64, True), (100, 24, True), (20, 20, True)])
def test_repeats(docs, rows, none, length, gram, cover):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = {d: tuple(r[n] for n in names) for d, r in by_id(suffix_dedup.remove_repeats(docs, length=length, gram=gram, cover=cover)).items()}
    assert got == brute_repeats(rows, length) and any(g[1] for g in got.values())
    assert suffix_dedup.remove_repeats(none, length=length, gram=gram).count() == 0


def test_difference_cover():
    for most, expected in ((12, (1, 1)), (13, (13, 4)), (337, (337, 22)), (400, (337, 22))):
        v, cover = suffix_dedup.difference_cover(most)
        assert (v, len(cover)) == expected and {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_repeats_inside_a_text(spark):
    """Periodic texts, overlaps, passages at both ends of a text, and copies under one id."""
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p = noise(130)
    texts = ["ab" * 200, "z" * 500, p + noise(50) + p, noise(70) + p, p + noise(60), noise(40) + p[10:] + noise(5), p, noise(300)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = by_id(suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), length=100, gram=32))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in got.items()} == brute_repeats(rows, 100)
    twice = spark.createDataFrame([(1, p, None, None, 0), (1, p, None, None, 0), (2, noise(150), None, None, 0)], SCHEMA)
    assert sorted(r["n_removed"] for r in suffix_dedup.remove_repeats(twice, length=100, gram=32).collect()) == [0, 130, 130]


@pytest.mark.parametrize("length,gram", [(400, 64), (100, 32)])
def test_periodic_stretches(spark, length, gram):
    """Several periodic stretches, shorter and longer than a window, at the head, in the middle and at the tail; rows twice."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    periods = ["Der ", "xyzzy ", "ab", "z", noise(37)]
    stretch = lambda n: (p := rng.choice(periods)) * (n // len(p))
    texts = ["Der " * 98 + "xyzzy " * 200 + noise(700)]
    for _ in range(30):
        parts = [stretch(rng.choice((30, length - 5, length + 1, length + 60, 3 * length))) if rng.random() < 0.6 else noise(rng.randint(1, length)) for _ in range(rng.randint(1, 5))]
        texts.append("".join(parts))
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    for given in (rows, [*rows, rows[0], rows[7], rows[7]], rows[:1]):
        expected = brute_repeats(given, length)
        got = suffix_dedup.remove_repeats(spark.createDataFrame(given, SCHEMA).repartition(3), length=length, gram=gram, cover=given is rows).collect()
        assert len(got) == len(given) and all((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected[r["doc_id"]] for r in got)


@pytest.mark.parametrize("length,gram", [(400, 64), (50, 16)])
def test_repeats_without_ids(spark, rows, length, gram):
    """Null ids beside ids: every row has the result of its text, also where only a row without an id repeats it."""
    given = [(d if d % 3 == 0 else 0 if d % 7 == 0 else None, *r) for d, *r in rows]
    expected = brute_repeats(rows, length)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(given, SCHEMA).repartition(3), length=length, gram=gram).collect()
    found = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got)
    assert found == Counter((g[0], *expected[r[0]]) for g, r in zip(given, rows, strict=True)) and any(k[0] is None and k[2] for k in found)


def test_cut_texts_keep_columns(docs):
    cut = suffix_dedup.without_repeats(docs, length=50, gram=16)
    assert cut.columns == docs.columns and cut.count() == docs.count()


def test_very_long_texts(spark):
    """One text of 60,000 words beside short ones, through the operators on whole texts."""
    rng = random.Random(21)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    long = prose(60_000)
    w = long.split(" ")
    rows = [(1, long, None, None, 0), (2, " ".join(w[50_000:50_200]), None, None, 0), (3, long + " more", None, None, 0), (4, prose(300), None, None, 0), (5, None, None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    items = [(1, " ".join(w[59_000:59_030])), (2, " ".join(w[3:20]))]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = by_id(decontamination.contamination_digest(df, spark.createDataFrame(items, "item_id long, text string")))
    assert {d: tuple(r[n] for n in names) for d, r in got.items()} == brute_contamination(rows, items)
    assert {d: r["class_id"] for d, r in by_id(jaccard.jaccard_classes(df)).items()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    got = by_id(suffix_dedup.remove_repeats(df))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in got.items()} == brute_repeats(rows, 400)


def test_language_parts():
    table = language.automaton_table([2, 3, 2, 3, 4], 6)
    import numpy as np

    def count(symbols):
        return int(language.phrases(np.array(symbols, np.uint8), np.array([0, len(symbols)]), table, 6)[0])

    def brute(symbols):
        text, n, i = "23234", 0, 0
        s = "".join(map(str, symbols))
        while i < len(s):
            k = 0
            while i + k < len(s) and s[i : i + k + 1] in text:
                k += 1
            i, n = i + max(k, 1), n + 1
        return n

    rng = random.Random(1)
    for _ in range(300):
        symbols = [rng.choice([2, 2, 3, 3, 4, 5]) for _ in range(rng.randint(0, 30))]
        assert count(symbols) == brute(symbols), symbols
    # Phrases run on over pieces, in random and in periodic texts, whatever lies beside them.
    texts = [[rng.choice([2, 3, 4]) for _ in range(1500)], [2, 3] * 700 + [4], [], [2, 3, 2, 3, 4] * 300, [5, 2, 3, 2] * 200, [2] * 256 + [3] * 257]
    ends = np.cumsum([0, *map(len, texts)])
    got = language.phrases(np.array([s for t in texts for s in t], np.uint8), ends, table, 6)
    assert got.tolist() == [brute(t) for t in texts]


def test_language_of_large_scripts(spark):
    """Languages of some hundred letters each, beside one of few, and letters beyond those with symbols of their own."""
    rng = random.Random(4)
    scripts = {"aa": "abcdefgh", "dd": [chr(0x4E00 + i) for i in range(400)], "ee": [chr(0x4E00 + 200 + i) for i in range(400)], "ff": [chr(0xAC00 + i) for i in range(150)]}
    lexicon = {k: ["".join(rng.choice(v) for _ in range(rng.randint(1, 3))) for _ in range(300)] for k, v in scripts.items()}
    rows = [(i, " ".join(rng.choice(lexicon[k]) for _ in range(rng.randint(5, 80))), k, "s", 0) for i in range(800) for k in [sorted(scripts)[i % 4]]]
    got = by_id(language.predict_languages(spark.createDataFrame(rows, SCHEMA)))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held)


def test_language(spark, none):
    rng = random.Random(2)
    syllables = {"aa": ["th", "er", "ing", "on"], "bb": ["eau", "ou", "é", "ment"], "cc": ["sch", "ung", "ü", "keit"]}
    say = lambda k, n: " ".join("".join(rng.choice(syllables[k]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, say(k, 5 + i % 60), k if i % 7 else None, "s", 0) for i in range(600) for k in [sorted(syllables)[i % 3]]]
    odd = [(1000, None, "aa", "s", 0), (1001, "", None, "s", 0), (1002, "12 34 !?", "bb", "s", 0), (1003, say("bb", 30_000), None, "s", 0), (1004, "ИЖ", None, "s", 0)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("row", F.lit(1)).withColumn("score", F.lit(2))
    got = by_id(language.predict_languages(df))
    assert len(got) == len(rows) + len(odd)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[r[0]]["held_out"] for r in held) and not any(got[r[0]]["held_out"] for r in rows if r not in held)
    right = sum(got[i]["lang_pred"] == sorted(syllables)[i % 3] for i, *_ in held)
    assert right >= 0.98 * len(held)
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"] and got[1004]["lang_pred"] in syllables
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.predict_languages(none.select("doc_id", "text", "lang")).count() == 0
    assert {r["lang_pred"] for r in language.identify(df, df.limit(0)).collect()} == {"und"}


def test_language_bytes_are_those_of_the_letters():
    texts = ["Ab, ÇÉ 12 zz", "", "...", "日本 語\U00020000x", "é"]
    data, offsets = language._without_gaps(texts)
    expected = []
    for t in texts:
        kept = "".join(c if c.isalpha() else " " for c in t.lower())
        while "  " in kept:
            kept = kept.replace("  ", " ")
        expected.append(kept.encode())
    assert [bytes(data[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)] == expected


def test_language_sample(spark):
    """Whole rows; a language of long texts gives its shortest; a dirty column gives the most frequent labels; repeated ids count once."""
    long = "abc " * 3000
    rows = [(i, "wort " * (i % 50 + 1), "de") for i in range(300)] + [(1000, long + "x", "xx"), (1001, long, "xx")] + [(2000 + i, f"w{i}", f"l{i}") for i in range(100)] + [(5, "wort", "de")] * 50 + [(6, None, "de"), (7, "x", None)]
    sample = language.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    by_lang = {}
    for name, text in sample:
        by_lang.setdefault(name, []).append(text)
    texts = {t for _, t, n in rows if n == "de"}
    assert len(by_lang) == language.LANGUAGES and 5 < len(by_lang["de"]) <= language.ROWS and set(by_lang["de"]) <= texts
    assert by_lang["xx"] == [long]
