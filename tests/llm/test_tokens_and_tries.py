"""Token alignment, packing and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from meterline.llm import align, encode, pack, prefix_trie, queries
from meterline.llm.encode import BYTE_BPE, PIECE_BPE, tokenizer_path

ODD = ["it's <|endoftext|> x", "  lead", "trail \n", "a  <|endoftext|>", "x\x85y  z  q", "日本 語。 テ ス", "é's è. Ж, Ж's ×! ÷? ё",
       "tab\tone \x1c two", "don't 'tis 12.5% a-b\n\n c", "▁ mark", "end ▁", "\x00 nul \x00", "👍🏽 ok 👍", "🇩🇪", " ", "\n", "҂ ҉ x҉ y",
       "A" * 3000, "a \n b\n\nc", "x" + " " * 50 + "y", "　 全角 　", "<0x41> <s> </s> <unk> [INST]", "ß. ſ, µ!"]


def texts_of(spark, sf):
    return [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]


def whole_ids(plain=False):
    t = encode.open_byte_bpe(tokenizer_path(BYTE_BPE), plain)
    return t, lambda text: t.encode(text, add_special_tokens=False).ids


def test_words_encode_as_whole_texts(spark, sf001):
    t, ids = whole_ids()
    sizes = np.array([len(b) for b in encode.byte_tokens(t)])
    texts = texts_of(spark, sf001) + ODD + ["", "é", "è x"]
    rng = random.Random(1)
    signs = "ab1 .,'\n\té×Ж҂ 日▁<|>s"
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for fine in (False, True):
        plain = [x.replace("<|endoftext|>", "") for x in texts]
        words = encode.cut(pa.array(plain, pa.large_string()), fine=fine)
        got = encode.encode_bytes(t, sizes, words.distinct)
        for i, x in enumerate(plain):
            own = got.take(words.codes[words.first[i]:words.first[i + 1]]).flat
            assert own.tolist() == ids(x), repr(x)


def test_cut_of_sliced_and_empty_arrays():
    texts = pa.array(["zero", "one two", "", "three"], pa.large_string())
    words = encode.cut(texts.slice(1))
    listed = words.distinct.to_pylist()
    assert [[listed[c] for c in words.codes[a:b]] for a, b in zip(words.first, words.first[1:])] == [["one", " two"], [], ["three"]]
    assert len(encode.cut(texts.slice(2, 1)).codes) == 0 and len(encode.cut(texts.slice(0, 0)).first) == 1


# ---- packing

def check_packed(pieces, docs, ids, size=pack.SIZE, slack=pack.SLACK):
    """pieces: rows with ids as bytes; docs: list of (doc_id, text)."""
    by_doc, sequences, want = defaultdict(list), defaultdict(list), Counter()
    for doc_id, text in docs:
        want[(doc_id, tuple(ids(text or "") + [0]))] += 1
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for doc_id, own in by_doc.items():
        tokens = Counter()
        for (d, all_ids), times in want.items():
            if d == doc_id:
                tokens.update({(k, x): times for k, x in enumerate(all_ids)})
        got = Counter()
        for p in own:
            values = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
            assert len(values) == p["length"] > 0
            got.update((p["start"] + k, x) for k, x in enumerate(values))
        assert got == tokens
    assert set(by_doc) == {d for d, _ in want}
    loose = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
        loose += size - at > slack
    assert loose <= 1


def as_rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("size, windows, group", [(1024, 64, 4096), (64, 3, 5), (16, 1, 4)])
def test_pack(spark, sf001, monkeypatch, size, windows, group):
    monkeypatch.setattr(pack, "GROUP", group)
    docs = spark.read.parquet(f"{sf001}/documents.parquet").repartition(7, "doc_id")
    rows = as_rows(pack.pack(docs, size=size, windows=windows, slack=2))
    check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], whole_ids()[1], size, 2)


def test_pack_edges(spark, odd_documents, documents):
    odd = documents([(i, x) for i, x in enumerate(ODD)]).unionByName(odd_documents)
    out = pack.pack(odd)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    check_packed(as_rows(out), [(r["doc_id"], r["text"]) for r in odd.collect()], whole_ids()[1])
    assert pack.pack(odd.where("false")).count() == 0


def test_best_fit_and_the_fullest_goes():
    p = pack.Packer(10, 2, 0, 0)
    for n in (6, 5, 4):         # 4 fits both windows; the one with 4 left is the better
        p.add((n, 0, n, n, b"\0" * 4 * n))
    assert [r[2] for r in p.take_closed()] == [6, 4]
    p.add((7, 0, 7, 7, b"\0" * 28))
    p.add((8, 0, 8, 8, b"\0" * 32))     # none fits: its front fills the fullest, which goes; the rest fits the other
    assert [r[:3] for r in p.take_closed()] == [(7, 0, 7), (8, 0, 3), (5, 0, 5), (8, 3, 5)]


def test_op13_query(spark, sf001):
    rows = [r.asDict() for r in queries.op13_pack(spark, sf001).collect()]
    _, ids = whole_ids()
    want = {r["doc_id"]: ids(r["text"] or "") + [0] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    for r in rows:
        own = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes()) and r["doc_tokens"] == len(want[r["doc_id"]])
    assert sum(r["length"] for r in rows) == sum(map(len, want.values()))


# ---- alignment

def aligned(docs):
    """Brute force: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each text in order."""
    import sentencepiece

    t, ids = whole_ids(plain=True)
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    a_bytes, b_bytes = encode.byte_tokens(t), encode.piece_tokens(pieces)
    made, total = [], Counter()
    for text in docs:
        a, b = (ids(" " + text), pieces.encode(text)) if text else ([], [])
        want = (" " + text).encode() if text else b""
        if b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            a, b = [], []
        ends = [dict(zip(np.cumsum([len(of[i]) for i in side]).tolist(), range(1, len(side) + 1)))
                for side, of in ((a, a_bytes), (b, b_bytes))]
        groups, links, i, j = [], [], 0, 0
        for at in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0][at], ends[1][at]
            groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        made.append((len(a), len(b), links, ";".join(groups)))
        total.update(links)
    most = defaultdict(int)
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return total, [(n_a, n_b, len(links), len(links), sum(total[p] == most[p[1]] for p in links),
                    sum(total[p] for p in links), groups) for n_a, n_b, links, groups in made]


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("fan, chunk", [(32, 8 << 20), (2, 1 << 12)])
def test_align(spark, sf001, documents, odd_documents, monkeypatch, fan, chunk):
    monkeypatch.setattr(align, "CHUNK", chunk)     # many runs: rounds of merges, several tasks for a radix
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    docs = documents(texts + [(1000 + i, x) for i, x in enumerate(ODD)]).unionByName(odd_documents).repartition(5)
    rows = docs.select("doc_id", "text").collect()
    total, want = aligned([r["text"] for r in rows])
    out = align.align(docs, groups=True, fan=fan).collect()
    got = Counter(tuple([r["doc_id"]] + [r[c] for c in ALIGNED]) for r in out)
    assert got == Counter((r["doc_id"], *w) for r, w in zip(rows, want))
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "") for r in out)
    listed = {(r["a_id"], r["b_id"]): r["n"] for r in align.linked_ids(docs, fan=fan).collect()}
    assert listed == dict(total)


def test_align_texts_that_end_in_a_space(documents):
    texts = ["one ", "two  ", ". ", "é ", " ", " x ", "one", "<|endoftext|> ", "end\n "]
    want = aligned(texts)[1]
    out = sorted(align.align(documents(list(enumerate(texts))), groups=True).collect())
    assert [tuple(r[c] for c in ALIGNED) for r in out] == want and all(r["n_b"] for r in out)


def test_align_empty(spark, documents):
    docs = documents([(1, None), (None, ""), (2, "▁")])
    assert {tuple(r)[1:] for r in align.align(docs).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    assert align.align(docs.where("false")).count() == 0 and align.linked_ids(docs).count() == 0


def test_heap_merge_and_highest():
    runs = [align._sums(np.array(p, np.uint64), np.array(n)) for p, n in
            (([1, 5, 1 << 32], [1, 2, 3]), ([5, (1 << 32) + 1], [4, 3]), ([], []))]
    pairs, counts = align.merged(runs)
    assert pairs.tolist() == [1, 5, 1 << 32, (1 << 32) + 1] and counts.tolist() == [1, 6, 3, 3]
    assert align.highest(pairs, counts).tolist() == [False, True, True, True]


# ---- prefix trie

def brute_trie(sequences):
    """sequences: conv_id -> list of (role, text); rows as those of op12, without the ends' digest but with the ids."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    inner = {k[:-1] for k in members if k}
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, own in members.items():
        value = (len(own) - 1) * len(k[-1][1].split()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += value
            leaves[k[:d]] += k not in inner
    return sorted((min(own), len(k), min(members[k[:-1]]) if k else -1, len(own), kids[k], leaves[k], saved[k],
                   ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(k))) for k, own in members.items())


def trie_rows(nodes, members):
    ends = defaultdict(list)
    for r in members.collect():
        ends[bytes(r["name"])].append(r["conv_id"])
    digests = {bytes(r["name"]): r["ends_sha256"] for r in prefix_trie.ends_digest(members).collect()}
    out = []
    for r in nodes.collect():
        ids = ",".join(map(str, sorted(ends[bytes(r["name"])])))
        assert digests.get(bytes(r["name"]), hashlib.sha256().hexdigest()) == hashlib.sha256(ids.encode()).hexdigest()
        out.append((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
                    r["n_children"], r["n_leaves"], r["saved_tokens"], ids))
    return sorted(out)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "junk", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, name string, pos long")


@pytest.mark.parametrize("bits", [10, 2])
def test_trie(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows, want = [], {}
    for c in range(60):
        turns = [("user" if i % 2 else "assistant", " ".join(rng.choice("ab") for _ in range(rng.randint(0, 2))))
                 for i in range(rng.choice([1, 2, 3, 5, 9, 17, 40]))]
        if c % 3 == 0 and want:      # copies and continuations
            turns = list(want[rng.choice(list(want))]) + turns[:rng.randint(0, 3)]
        want[c] = turns
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    assert trie_rows(*prefix_trie.prefix_trie(conversations(spark, rows))) == brute_trie(want)


def test_trie_edges(spark):
    long = "w " * 50_000
    rows = [(1, None, None, None), (1, 0, "user", "a b"), (2, 0, "", ""), (2, 1, "user", "a b"), (None, 0, "user", "x"),
            (3, 0, "user", long), (3, 0, "user", long), (4, 0, "u", "sera"), (5, 0, "us", "era"), (-4, 7, "user", long)]
    want = {1: [("", ""), ("user", "a b")], 2: [("", ""), ("user", "a b")], 3: [("user", long)] * 2, 4: [("u", "sera")],
            5: [("us", "era")], -4: [("user", long)]}
    df = conversations(spark, rows)
    assert trie_rows(*prefix_trie.prefix_trie(df)) == brute_trie(want)
    assert prefix_trie.prefix_trie(df.where("false"))[0].count() == 0


def test_trie_of_one_long_conversation(spark, monkeypatch):
    """A conversation of most rows, whose turns repeat, spreads over blocks."""
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 4)
    rows = [(7, i, "user", f"t{i % 3}") for i in range(700)] + [(8, i, "user", f"t{i % 3}") for i in range(650)] + [(9, 0, "user", "t0")]
    want = {c: [("user", f"t{i % 3}") for i in range(n)] for c, n in ((7, 700), (8, 650), (9, 1))}
    assert trie_rows(*prefix_trie.prefix_trie(conversations(spark, rows))) == brute_trie(want)


def test_shared_openings(spark):
    rng = random.Random(5)
    own = {c: [("user", f"c{c}t{i}") for i in range(rng.randint(1, 5))] for c in [0, 1, 2, 3, 4, 7, 19, 21, 22, 40, 41, 45, 59]}
    rows = [(c, i, *t) for c, turns in own.items() for i, t in enumerate(turns)]
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        want[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = trie_rows(*prefix_trie.build(*prefix_trie.with_shared_openings(conversations(spark, rows))))
    assert got == brute_trie(want)
