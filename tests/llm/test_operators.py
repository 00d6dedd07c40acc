"""The operators on edge rows and against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import (chat_format, components, decontaminate, exact_dedup, hilbert, license_scan, lm_score, mixing,
                           ngram_join, quality, warc)

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(df):
    return [r.asDict() for r in df.collect()]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in rows(df)}


# exact dedup ---------------------------------------------------------------------------------------


def test_exact_dedup_edges(odd_documents):
    got = rows(exact_dedup.exact_dedup(odd_documents))
    assert len(got) == odd_documents.count()
    d = defaultdict(list)
    for r in got:
        d[r["doc_id"]].append((r["keep_id"], r["group_size"], r["kept"]))
    assert d[4] == [(5, 4, False)] * 2 and d[5] == [(5, 4, True)]
    assert d[1] == [(2, 3, False)] and d[2] == [(2, 3, True)]
    assert sorted(d[None], key=str) == [(2, 3, False), (5, 4, False)]
    assert d[9] == [(9, 1, True)] and d[10] == [(10, 1, True)]  # only A-Z are lowered
    assert d[6] == [(6, 1, True)] and d[7] == [(7, 1, True)]


def test_exact_dedup_same_prefix_and_length(documents):
    a, b = "x" * 200 + "a", "x" * 200 + "b"
    got = by_id(exact_dedup.exact_dedup(documents([(1, a), (2, b), (3, a.upper()), (4, a)])))
    assert {i: r["keep_id"] for i, r in got.items()} == {1: 4, 2: 2, 3: 4, 4: 4}


def test_exact_dedup_empty(documents):
    assert exact_dedup.exact_dedup(documents([(1, "a")]).where("false")).count() == 0


# licence scan --------------------------------------------------------------------------------------


def license_scores(text, threshold=0.8):
    """Brute force: the best Dice coefficient of the windows at which a bigram of the template is in its place."""
    import regex

    def pairs(x):
        w = regex.findall(r"[\p{L}\p{N}]+", x.lower())
        return [f"{a} {b}" for a, b in zip(w, w[1:])]

    own, best = pairs(text or ""), {}
    for t in license_scan.templates():
        place = dict(zip(t.marks, t.places))
        for s in {i - place[b] for i, b in enumerate(own) if b in place}:
            window = set(own[max(s, 0):s + t.size])
            score = 2 * len(window & set(t.marks)) / (len(window) + len(t.marks))
            if score >= threshold:
                best[t.name] = max(score, best.get(t.name, 0))
    return best


def test_license_scan(documents):
    full = license_scan.FULL_TEXTS["MIT"]
    data = [
        (1, "Text.\nReleased under the MIT License.\nmore"), (2, "released UNDER the mit licence."), (3, None), (4, ""),
        (5, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License!"),
        (6, "The river runs under the old stone bridge."), (7, "Released under the MIT License. " * 3000),
        (8, "Copyright (c) 2020 Jane Doe. Released under the MIT License."),
        (9, "# Licensed under the Apache\n# License, Version 2.0 (the thing)"),
        (10, "Some words before. " * 20 + full.replace(". ", ".\n\n * ") + " and some behind" * 30),
        (11, full.replace("merge, publish, ", "").replace("tort", "error")), (12, "MIT"), (13, "the mit license"),
        (14, "this license is for the use of the software and the rights of the author " * 50), (14, "Released under the MIT License"),
        (None, "Released under the ISC License"), (15, "under the mit license, version 2")]
    got = [(r["doc_id"], r["licenses"], r["n_matches"], r["best_license"], r["best_score"])
           for r in license_scan.license_scan(documents(data)).collect()]
    want = []
    for doc_id, text in data:
        best = license_scores(text)
        top = max(best.values(), default=None)
        want.append((doc_id, ",".join(sorted(best)), len(best), min((n for n in best if best[n] == top), default=None), top))
    assert sorted(got, key=str) == sorted(want, key=str)
    found = {g[0]: g[1] for g in got}
    assert found[8] == found[10] == found[11] == found[7] == "MIT" and found[9] == "Apache-2.0" and found[5] == "Apache-2.0,MIT"
    assert license_scan.license_scan(documents(data).where("false")).count() == 0


def test_license_templates_of_equal_windows_and_long_lines(documents):
    """Ties go by name; a very long line is one text like any other."""
    texts = {"b": "alpha beta gamma delta", "a": "beta gamma delta epsilon"}
    line = "w " * 200_000 + "alpha beta gamma delta epsilon"
    got = license_scan.license_scan(documents([(1, line)]), texts=texts).first()
    assert (got["licenses"], got["best_license"], got["best_score"], got["n_words"]) == ("a,b", "a", 1.0, 200_005)


def test_license_bounds_lose_nothing():
    for n in range(1, 40):
        lo, hi = license_scan.size_bounds(n, "0.8")
        for m in range(1, 90):
            assert (lo <= m <= hi) == (10 * 2 * min(m, n) >= 8 * (m + n))


# n-gram Jaccard join -------------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def linked(texts, k, num, den):
    """Brute force: the smallest id that links lead to."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    at = {i: i for i in sets}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and den * both >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                at[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(seed, groups=6, members=25, n=60, edits=3):
    rng = np.random.default_rng(seed)
    texts = {}
    passage = [f"p{i}" for i in range(12)]
    for g in range(groups):
        base = [f"v{rng.integers(400)}" for _ in range(n)]
        for _ in range(members):
            w = list(base)
            for _ in range(rng.integers(edits + 1)):
                w[rng.integers(len(w))] = f"e{rng.integers(5)}"
            if rng.random() < 0.3:
                w = passage + w
            texts[len(texts)] = " ".join(w)
    return texts


@pytest.mark.parametrize("k,threshold,num,den", [(4, "0.85", 85, 100), (5, "0.8", 4, 5)])
def test_ngram_join_equals_brute_force(documents, monkeypatch, k, threshold, num, den):
    monkeypatch.setattr(ngram_join, "PART", 7)  # several parts per group
    texts = near_copies(1) | {1000: "a b", 1001: "A b", 1002: "a b c", 1003: "", 1004: "x"}
    got = by_id(ngram_join.ngram_jaccard_join(documents(list(texts.items())), k, threshold))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == linked(texts, k, num, den)


def test_ngram_join_search_tasks_are_bounded(documents, monkeypatch):
    """A task's rows don't grow with the group, however many partitions there are."""
    search_task = ngram_join._search_task

    def watched(num, den):
        inner = search_task(num, den)

        def run(key, t):
            assert t.num_rows <= 60, t.num_rows
            return inner(key, t)
        return run
    monkeypatch.setattr(ngram_join, "_search_task", watched)
    monkeypatch.setattr(ngram_join, "PART", 7)
    monkeypatch.setattr(ngram_join, "PART_CELLS", 3000, raising=False)
    texts = near_copies(2, groups=2, members=150, edits=8)
    got = by_id(ngram_join.ngram_jaccard_join(documents(list(texts.items()))))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == linked(texts, 4, 85, 100)


def test_search_tasks_meet_all_but_linked(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART", 5)
    monkeypatch.setattr(ngram_join, "PART_CELLS", 3000)
    rng = np.random.default_rng(0)
    # component 0: many of one leader; 1000: all for themselves; 2000: small; 3000: one leader, nothing to search
    data = [(i, 0, 0 if i < 60 else i, 300) for i in range(90)] + [(i, 1000, i, 300) for i in range(1000, 1060)]
    data += [(2000, 2000, 2000, 300), (2001, 2000, 2000, 300), (2002, 2000, 2002, 300), (3000, 3000, 3000, 9), (3001, 3000, 3000, 9)]
    known = spark.createDataFrame([data[i] for i in rng.permutation(len(data))], "cid long, component long, leader long, cells long")
    tasks = defaultdict(list)
    for r in ngram_join.search_tasks(known, 4).collect():
        tasks[r["component"], r["i"], r["j"]].append(r)
    met = Counter()
    for (_, i, j), rs in tasks.items():
        assert len(rs) <= 2 * 25
        for x in rs:
            for y in rs:
                if x["cid"] < y["cid"] and (i == j or x["part"] != y["part"]):
                    met[x["cid"], y["cid"]] += 1
    assert set(met.values()) == {1}
    assert {c for c, _, _ in tasks} == {0, 1000, 2000}
    for a in data[:-2]:
        for b in data[:-2]:
            if a[0] < b[0] and a[1] == b[1] and a[2] != b[2]:
                assert met[a[0], b[0]] == 1
    assert not any(a < 60 and b < 60 for a, b in met)


def test_ngram_join_exact_boundary(documents):
    # 17 of 20 shingles in common with 17 + 3 in the union: 85 of 100 links, one fewer doesn't
    base = [f"w{i}" for i in range(20)]
    texts = {1: " ".join(base), 2: " ".join(base + ["y1", "y2", "y3"]), 3: " ".join(base + ["z1", "z2", "z3", "z4"])}
    got = by_id(ngram_join.ngram_jaccard_join(documents(list(texts.items()))))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == linked(texts, 4, 85, 100)
    assert got[2]["component_id"] == 1


def test_ngram_join_edges(odd_documents):
    got = defaultdict(list)
    for r in rows(ngram_join.ngram_jaccard_join(odd_documents)):
        got[r["doc_id"]].append((r["n_shingles"], r["component_id"]))
    assert got[4] == [(1, 4)] * 2 and got[5] == [(1, 4)]
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert sorted(got[None]) == [(0, None), (1, None)]
    assert got[6] == [(5000, 6)] and got[7] == [(5001, 6)]


def test_ngram_join_empty(documents):
    assert ngram_join.ngram_jaccard_join(documents([(1, "a")]).where("false")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (60, 50), (60, 55)]
    got = {r["node"]: r["component"] for r in rows(components.components(spark.createDataFrame(chain, "a long, b long"), "a", "b"))}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 50: 50, 55: 50, 60: 50}


# decontamination -----------------------------------------------------------------------------------


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contaminated(texts, items, n=10):
    """Brute force: (words, hit words, items) of each text."""
    out = {}
    for d, t in texts.items():
        w = bench_words(t)
        hit, found = set(), set()
        for name, item in items:
            v = bench_words(item)
            size = min(n, len(v))
            for i in range(len(v) - size + 1 if v else 0):
                for j in range(len(w) - size + 1):
                    if w[j:j + size] == v[i:i + size]:
                        hit |= set(range(j, j + size))
                        found.add(str(name))
        out[d] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontaminate_equals_brute_force(spark, documents, block_bytes):
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"q{rng.integers(6)}" for _ in range(rng.integers(9, 16)))) for i in range(6)]
    items += [(10, "Two words"), (11, ""), (12, None), (2, "third of two, words")]
    texts = {}
    for d in range(25):
        parts = [f"q{rng.integers(6)}" for _ in range(20)]
        if d % 3 == 0:
            parts += items[d % 6][1].split()
        if d % 5 == 0:
            parts += ["TWO--words"]
        texts[d] = "; ".join(parts)
    texts |= {100: None, 101: "", 102: "third OF two words", 103: " ".join(t for _, t in items[:6])}
    bench = spark.createDataFrame([(i, t, "junk") for i, t in items] + [(None, "two words", "")],
                                  "item_id long, text string, spans string")
    got = by_id(decontaminate.decontaminate(documents(list(texts.items())), bench, block_bytes=block_bytes))
    assert {d: (r["n_words"], r["n_hit"], r["items"]) for d, r in got.items()} == contaminated(texts, items)


def test_decontaminate_edges(spark, odd_documents):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = rows(decontaminate.decontaminate(odd_documents, bench))
    assert len(got) == odd_documents.count() and sum(r["n_hit"] == 3 for r in got) == 4
    assert sum(r["n_hit"] for r in rows(decontaminate.decontaminate(odd_documents, bench.where("false")))) == 0
    assert decontaminate.decontaminate(odd_documents.where("false"), bench).count() == 0
    digest = decontaminate.items_digest("items")
    first = decontaminate.decontaminate(odd_documents, bench).where("n_hit > 0").select(digest.alias("d")).first()
    assert first["d"] == decontaminate.digest_of([1])


# quality -------------------------------------------------------------------------------------------


def test_flat_trees_equal_walking():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    y = (x[:, 3] * x[:, 5] > 0).astype(float)
    m = quality.fit(x, y)

    def walk(row):
        total = m.base
        for node in m.roots:
            while m.feature[node] >= 0:
                node = m.left[node] + (row[m.feature[node]] > m.cut[node])
            total += m.value[node]
        return 1 / (1 + np.exp(-total))
    got = m.scores(x)
    assert np.allclose(got[:50], [walk(r) for r in x[:50]])
    assert ((got > 0.5) == y).mean() > 0.95


def test_quality_held_out(spark, sf01):
    docs, labels = spark.read.parquet(f"{sf01}/documents.parquet"), spark.read.parquet(f"{sf01}/labels.parquet")
    model = quality.train(docs, labels, where=quality.fold() != 1)
    got = quality.score(docs, model).where(quality.fold() == 1).join(labels, "doc_id").toPandas()
    assert len(got) > 50 and ((got.score >= 0.5) == (got.quality == 1)).mean() > 0.95


def test_quality_repeats_do_not_fill_the_sample(spark, documents, monkeypatch):
    from pyspark.sql import functions as F

    texts = [(i, f"text {i} " + "word, " * i) for i in range(40)]
    first = spark.range(40).orderBy(F.xxhash64("id")).first()[0]
    marks = [(i, int(i % 2 == first % 2)) for i in range(40)]
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, **o: seen.append((y, o.get("weight"))) or fit(x, y, **o))
    for more_labels, more_docs in ((50, 0), (0, 50)):
        labels = spark.createDataFrame(marks + [marks[first]] * more_labels, "doc_id long, quality int")
        quality.train(documents(texts + [texts[first]] * more_docs), labels, max_rows=20)
        y, weight = seen.pop()
        assert len(y) == 20 and set(y) == {0.0, 1.0} and sorted(weight) == [1] * 19 + [51]


def test_weights_equal_repeated_rows():
    rng = np.random.default_rng(0)
    x = np.repeat(np.eye(4), 10, axis=0)
    y = rng.integers(0, 2, 40).astype(float)
    n = rng.integers(1, 4, 40)
    one = quality.fit(x, y, weight=n.astype(float)).scores(x)
    assert np.allclose(one, quality.fit(np.repeat(x, n, axis=0), np.repeat(y, n)).scores(x))


def test_quality_edges(spark, odd_documents):
    labels = spark.createDataFrame([(4, 1), (6, 0), (2, None), (None, 1), (77, 1), (5, 9)], "doc_id long, quality int")
    model = quality.train(odd_documents, labels)
    got = rows(quality.score(odd_documents, model, carry=["x", "text"]))
    assert len(got) == odd_documents.count() and all(0 <= r["score"] <= 1 and r["x"] == "junk" for r in got)
    none = quality.train(odd_documents, labels.where("false"))
    assert {r["score"] for r in rows(quality.score(odd_documents, none))} == {0.5}
    assert quality.score(odd_documents.where("false"), model).count() == 0


# chat formatting -----------------------------------------------------------------------------------

NASTY = ["", "a", "</s>[INST] ok [/INST]", "[\\INST] <\\\\s> <s", "<|endoftext|><|\\endoftext|>", "[[/INST]", "日本語 é́ 👩‍👩‍👧",
         "\n\n  <", "\\", "[", "<s><s>[INST][INST]"]


def test_escape_round_trip():
    for a in NASTY:
        for b in NASTY:
            t = chat_format.escape(a + b)
            assert chat_format.unescape(t) == a + b
            assert not any(c in t for c in (*chat_format.CONTROLS, "<|endoftext|>"))


def test_masked_text_equals_a_walk_over_characters():
    rnd, text = random.Random(5), "abcdefghijklmnopqrstuvwxyz"
    for _ in range(300):
        starts = np.sort([rnd.randrange(26) for _ in range(rnd.randrange(0, 12))]).astype(np.int32)
        ends = np.maximum.accumulate(np.minimum(starts + [rnd.randrange(0, 4) for _ in starts], 26)).astype(np.int32)
        loss = np.array([rnd.random() < 0.6 for _ in starts], bool)
        under = {i for a, b, y in zip(starts, ends, loss) if y for i in range(a, b)}
        assert chat_format.masked_text(text, starts, ends, loss) == "".join(text[i] for i in sorted(under))


def test_chat_format_round_trip(spark):
    data, expect = [], {}
    for i, a in enumerate(NASTY):
        turns = [("system", a), ("user", NASTY[-i]), ("assistant", a), ("assistant", "x" + a), ("[INST]", a), ("assistant", NASTY[i - 1])]
        expect[i] = turns
        data += [(i, k, r, t, "junk") for k, (r, t) in reversed(list(enumerate(turns)))]
    data += [(None, 0, None, None, ""), (None, 0, None, None, ""), (99, 1, "assistant", "word " * 50_000, "")]
    expect |= {None: [("", ""), ("", "")], 99: [("assistant", "word " * 50_000)]}
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, loss string")
    formatted = chat_format.chat_format(df)
    got = by_id(chat_format.read_back(formatted), "conv_id")
    assert set(got) == set(expect)
    for i, turns in expect.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[i]["n_turns"] == len(turns) and got[i]["loss_chars"] == len(loss)
        assert got[i]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[i]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for r in rows(formatted):
        assert len(r["tokens"]) == len(r["loss"]) == len(r["starts"]) and r["ends"][-1] == len(r["text"])
    assert chat_format.read_back(chat_format.chat_format(df.where("false"))).count() == 0


def test_loss_mask_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        cuts = np.unique(rng.integers(0, 40, 12))
        starts, ends = cuts[:-1], cuts[1:]
        edges = np.unique(rng.integers(0, 40, 4))
        spans = edges[:len(edges) // 2 * 2].reshape(-1, 2)
        want = [any(a < e and s < b for a, b in spans) for s, e in zip(starts, ends)]
        assert chat_format.loss_mask(spans, starts, ends).tolist() == want


# sharding ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4)])
def test_curve_is_a_hilbert_curve(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.curve_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    path = points[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()  # each step goes to a neighbour


def shard_input(docs):
    from pyspark.sql import functions as F

    return docs.select("doc_id", F.length("text").cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                       hilbert.text_level("source").alias("a"), hilbert.size_level(F.length("text")).alias("b"))


def test_shards_by_brute_force(spark, sf01, tmp_path):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    df = hilbert.hilbert_shards(shard_input(docs), ["a", "b"], ["doc_id", "size", "text_crc32"])
    got = rows(df)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)  # shards are runs of the curve
    assert {r["curve"] for r in got} <= set(range(256))
    for r in got[:50]:
        assert r["curve"] == hilbert.curve_index(np.array([[r["a"], r["b"]]]), hilbert.BITS)[0]
    hilbert.write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(got)
    assert back.where(f"a = {got[0]['a']}").select("shard").distinct().count() < 40


def test_shards_edges(odd_documents):
    got = rows(hilbert.hilbert_shards(shard_input(odd_documents), ["a", "b"], ["doc_id", "size", "text_crc32"], n_shards=5))
    counts = Counter(r["shard"] for r in got)
    assert len(got) == odd_documents.count() and max(counts.values()) - min(counts.values()) <= 1
    few = odd_documents.where("doc_id <= 2")
    assert sorted(r["slot"] for r in rows(hilbert.hilbert_shards(shard_input(few), ["a", "b"], ["doc_id"]))) == [0, 0]
    assert hilbert.hilbert_shards(shard_input(odd_documents.where("false")), ["a", "b"], ["doc_id"]).count() == 0


@pytest.mark.parametrize("ranges", [48, 400, 4000])
def test_ngram_messages_follow_the_text(ranges):
    """What a block of short texts sends doesn't grow with the number of hash ranges."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x:05d}" for x in rng.integers(0, 90_000, 20)) for _ in range(5000)]
    batch = pa.record_batch({"doc_id": list(range(5000)), "text": texts})
    sent = sum(len(v) for m in ngram_join._block_messages(batch, 0, 4, ranges) for v in m.values() if isinstance(v, bytes))
    assert sent < 2 * sum(map(len, texts))


def test_ngram_join_over_many_ranges(documents, monkeypatch):
    rng = np.random.default_rng(1)
    texts = {i: " ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for i in range(60)}
    texts |= {100 + i: texts[i] + " more" for i in range(0, 60, 2)} | {200 + i: texts[i] for i in range(0, 60, 3)}
    few = by_id(ngram_join.ngram_jaccard_join(documents(list(texts.items()))))
    monkeypatch.setattr(ngram_join, "RANGE_BYTES", 100)
    many = by_id(ngram_join.ngram_jaccard_join(documents(list(texts.items()))))
    assert few == many and all(many[100 + i]["component_id"] == i for i in range(0, 60, 2))


# LM scores -----------------------------------------------------------------------------------------


def test_lm_scores_by_brute_force(spark, sf001, monkeypatch):
    """Every word of every text from plain dictionaries of the whole corpus; several blocks and ranges."""
    monkeypatch.setattr(lm_score, "RANGE_WORDS", 1000)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 8192)
    docs = spark.read.parquet(f"{sf001}/documents.parquet").limit(60)
    docs = docs.unionAll(docs.limit(5).selectExpr("doc_id + 9000", "text", "lang", "source", "n_chars"))
    docs = spark.createDataFrame(docs.collect(), docs.schema).coalesce(1)
    vocabulary, net = lm_score.train(docs)
    got = by_id(lm_score.lm_scores(docs))
    import pyarrow as pa
    from meterline.llm.words import SPACED, Words
    texts = {r["doc_id"]: Words(pa.array([r["text"]]), SPACED) for r in docs.collect()}
    words = {d: [bytes(w.bytes[a:b]) for a, b in zip(w.starts, w.ends)] for d, w in texts.items()}
    bucket = {x: int(k) for d, w in texts.items() for x, k in zip(words[d], lm_score.buckets(w))}
    cls = {x: int(vocabulary.cls[k]) for x, k in bucket.items()}
    pairs, by_class, in_bucket = Counter(), Counter(), Counter()
    for ws in words.values():
        for a, x, b in zip([None, *ws], ws, [*ws[1:], None]):
            in_bucket[bucket[x]] += 1
            pairs[a, x, b] += 1
            by_class[a, cls[x], b] += 1
    in_class = Counter()
    for k in range(lm_score.BUCKETS):
        in_class[int(vocabulary.cls[k])] += in_bucket[k] + 0.5
    assert len(got) == len(words) and max(in_bucket.values()) > 100
    for d, ws in words.items():
        around = [0, 0, *[cls[x] for x in ws], 0, 0]
        total = 0.0
        for i, (a, x, b) in enumerate(zip([None, *ws], ws, [*ws[1:], None])):
            sides = [around[i], around[i + 1], around[i + 3], around[i + 4]]
            hidden = np.tanh(sum(net.embed[j][c].astype(float) for j, c in enumerate(sides)))
            logits = hidden @ net.out.astype(float) + net.bias
            k = bucket[x]
            p = (in_bucket[k] - 0.5) / (in_class[cls[x]] - 1)
            if cls[x] > lm_score.CLASSES - lm_score.SHARED - 1:
                p = (pairs[a, x, b] - 1 + lm_score.PRIOR * p) / (by_class[a, cls[x], b] - 1 + lm_score.PRIOR)
            total += logits[cls[x]] - np.log(np.exp(logits).sum()) + np.log(p)
        assert got[d]["n_tokens"] == len(ws)
        assert got[d]["log_likelihood"] == pytest.approx(total, rel=1e-4, abs=0.05)


def test_lm_sets_texts_of_the_corpus_apart(spark, sf001):
    """Texts that occur twice are likelier, word by word, than texts of the same words that occur once."""
    rng = np.random.default_rng(0)
    base = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    words = [f"rare{i}" for i in range(600)]
    once = [(10_000 + i, " ".join(rng.choice(words, 40))) for i in range(20)]
    twice = [(20_000 + i, " ".join(rng.choice(words, 40))) for i in range(20)]
    extra = spark.createDataFrame(once + twice + [(i + 10_000, t) for i, t in twice], "doc_id long, text string")
    got = by_id(lm_score.lm_scores(base.unionAll(extra)))
    mean = {d: r["mean_log_likelihood"] for d, r in got.items()}
    assert max(mean[d] for d, _ in once) + 1 < min(mean[d] for d, _ in twice)


def test_lm_learns_from_both_sides(documents):
    rng = np.random.default_rng(0)
    follow = {f"a{i}": (f"b{i}", f"c{i}") for i in range(8)}
    texts = []
    for d in range(300):
        w = []
        for _ in range(40):
            a = f"a{rng.integers(8)}"
            w += [a, *follow[a]]
        texts.append((d, " ".join(w)))
    shuffled = " ".join(rng.permutation(texts[0][1].split()))
    docs = documents(texts).coalesce(1)
    vocabulary, net = lm_score.train(docs, rounds=3, stride=2)
    import pyarrow as pa
    from meterline.llm.words import SPACED, Words
    w = Words(pa.array([texts[0][1], shuffled]), SPACED)
    good, bad = lm_score.class_likelihood(w, vocabulary.cls[lm_score.buckets(w)], net)
    assert good > bad + 50


def test_lm_learns_every_word(documents):
    """With the production parameters: pairs that never stand at a multiple of 16 of their text are learned too."""
    import pyarrow as pa
    from meterline.llm.words import SPACED, Words

    rng = np.random.default_rng(0)
    texts = []
    for d in range(5000):
        w = ["z"]
        for _ in range(7):
            i = rng.integers(8)
            w += [f"a{i}", f"b{i}"]
        texts.append((d, " ".join(w + ["z"])))
    vocabulary, net = lm_score.train(documents(texts).coalesce(1))
    pairs = [f"a{i} b{j}" for i in range(8) for j in (i, (i + 1) % 8)]
    w = Words(pa.array(pairs), SPACED)
    score = lm_score.class_likelihood(w, vocabulary.cls[lm_score.buckets(w)], net)
    assert score[0::2].mean() > score[1::2].mean() + 1


@pytest.mark.parametrize("stride,rounds", [(1, 1), (2, 2), (5, 5)])
def test_lm_rounds_cover_all_words(monkeypatch, stride, rounds):
    import pyarrow as pa
    from types import SimpleNamespace

    texts = [" ".join(f"w{d}_{i}" for i in range(d % 7)) for d in range(60)]
    vocabulary = lm_score.Vocabulary.of(np.zeros(lm_score.BUCKETS, np.int64))
    net = lm_score.Network.fresh(vocabulary.prior)
    targets = []
    monkeypatch.setattr(lm_score.Network, "learn", lambda self, sides, target, rate: targets.append(len(target)))
    batches = pa.table({"text": texts}).to_batches(max_chunksize=11)
    for r in range(rounds):
        list(lm_score._learn(SimpleNamespace(value=vocabulary), SimpleNamespace(value=net.flat()), stride, r % stride, 0.1)(iter(batches)))
    assert sum(targets) == sum(d % 7 for d in range(60))


def test_lm_edges(odd_documents):
    got = rows(lm_score.lm_scores(odd_documents, carry=["x"]))
    assert len(got) == odd_documents.count()
    for r in got:
        assert (r["n_tokens"] == 0) == (r["mean_log_likelihood"] is None) and r["log_likelihood"] <= 0
    assert lm_score.lm_scores(odd_documents.where("false")).count() == 0


# mixing --------------------------------------------------------------------------------------------


def test_targets():
    t = mixing.targets([("a", 100), ("b", 100), ("c", 10), (None, 1000)])
    assert sum(t) == pytest.approx(1210) and t[0] == 300 and t[2] == 30
    assert all(x <= 3 * n + 1e-9 for x, (_, n) in zip(t, [("a", 100), ("b", 100), ("c", 10), (None, 1000)]))
    assert mixing.targets([("a", 0), (None, 0)]) == [0.0, 0.0] and mixing.targets([]) == []


def test_mix_by_brute_force(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    got = rows(mixing.mix_sources(docs))
    taken, largest, goal = Counter(), Counter(), {}
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        goal[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1 for s in goal)
    # copies fall with the hash: at most one step inside a source
    for s in goal:
        own = sorted((int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16), r["copies"]) for r in got if r["source"] == s)
        steps = [c for _, c in own]
        assert steps == sorted(steps, reverse=True) and len(set(steps)) <= 2


def test_mix_edges(documents):
    docs = documents([(1, "a b c", None), (1, "a b c", None), (2, None, "z"), (3, "", "z"), (None, "a " * 100_000, "y"), (4, "b", "")])
    got = rows(mixing.mix_sources(docs, carry=["text", "x"]))
    assert len(got) == 6 and {r["size"] for r in got if r["source"] == "z"} == {0}
    assert {r["target"] for r in got if r["source"] == "z"} == {0.0}
    assert len({(r["doc_id"], r["copies"]) for r in got if r["doc_id"] == 1}) == 1
    assert mixing.mix_sources(docs.where("false")).count() == 0


@pytest.mark.parametrize("kind", ["one id", "null ids", "equal rows", "one id, few texts"])
def test_mix_divides_rows_that_repeat_an_id(documents, kind):
    """What a source takes comes near its target whatever its ids are, and equal reruns agree."""
    text = {"equal rows": lambda i: "a b", "one id, few texts": lambda i: f"{i % 3} b c d"}.get(kind, lambda i: f"{i} " + "w " * (i % 7))
    one = [(None if kind == "null ids" else 7, text(i), "one") for i in range(1000)]
    docs = documents(one + [(i, "x y z", "other") for i in range(300)] + [(i, "x y z", "third") for i in range(30)]).repartition(6)
    got = [r.asDict() for r in mixing.mix_sources(docs, carry=["text"]).collect()]
    assert len(got) == docs.count()
    for source in ("one", "other", "third"):
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert {r["copies"] for r in own} <= {own[0]["target"] // own[0]["source_size"] + d for d in (0, 1)}
    again = mixing.mix_sources(docs, carry=["text"]).collect()
    key = lambda r: (str(r["doc_id"]), r["source"], r["text"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))


# WARC ----------------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "word " * 400
    data = [(i, f"http://a/{i}?q=é y\r\n", f"<html>{i} " + "text " * (i * 7), "junk") for i in range(60)]
    data += [(100, None, big, ""), (101, "u", big, ""), (101, "u", big, ""), (None, "n", big, ""), (102, "e", None, ""), (103, "e", "", ""),
             (104, "s", "x" * 999, ""), (105, "s", "x" * 999, ""), (106, "l", "é" * 1_000_000, "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, archive string").repartition(3)
    manifest = warc.write_warc(df, f"file://{tmp_path}/w", archive_bytes=20_000)
    got = rows(warc.read_warc(manifest))
    assert len(got) == len(data) and sum(r["records"] for r in manifest.collect()) == len(data)
    want = {(i, u): (h or "").encode() for i, u, h, _ in data}
    kinds = Counter()
    for r in got:
        payload = want[r["page_id"], r["url"]]
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == hashlib.sha1(payload).hexdigest()
        assert r["payload"] == (payload if r["record_type"] == "response" else None)
        kinds[r["page_id"], r["record_type"], r["refers_to"]] += 1
    assert kinds[101, "response", None] == 2 and kinds[100, "revisit", 101] == 1 and kinds[None, "revisit", 101] == 1
    assert all(kinds[i, "response", None] == 1 for i in (102, 103, 104, 105, 106))
    for r in manifest.collect():
        with open(r["archive"].removeprefix("file://"), "rb") as f:
            assert int.from_bytes(f.read(4), "little") == warc.DICTIONARY_MAGIC
    none = warc.write_warc(df.where("false"), f"file://{tmp_path}/none")
    assert warc.read_warc(none).count() == 0


def test_crc_of_text_is_unsigned(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.crc32(F.lit("é").cast("binary"))).first()[0] == zlib.crc32("é".encode())


def test_join_of_texts_that_share_an_id(documents):
    """An id's texts are nodes of their own: they neither merge two groups nor lend a group their id."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    data = [(5, a), (2, a + " more"), (5, b), (3, b + " more"), (5, "alone in the world of words"), (9, a + " more"), (9, "x")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_jaccard_join(documents(data)).collect())
    assert got == sorted([(5, 57, 2), (2, 58, 2), (5, 57, 3), (3, 58, 3), (5, 3, 5), (9, 58, 2), (9, 1, 9)])
