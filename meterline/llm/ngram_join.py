"""N-gram Jaccard join: documents whose sets of word shingles are alike, by T-occurrence search.

Two sets x, y with ``J(x, y) >= t`` share at least ``T = ceil(t * |x|)`` members of x, so y occurs on T
of x's inverted lists.  The join finds those y in five steps:

1. **Counts.**  Blocks of documents (some MB of text each) are shingled in numpy, equal sets of a block
   become one class, and the shingles go to ``ranges`` by hash range.  Each range adds up in how many
   classes a shingle occurs and answers every block for those of its own that occur in two or more.
   A shingle that repeats inside a block is sent once per block with its count, so none is sent once per
   document of a hot group.  A class with fewer than T repeated shingles has no partner and ends
   here; the rest go on with their repeated shingles only.
2. **Rarity.**  Each class sorts its own by (count, hash).  With T of n needed, two partners share one of
   the ``n - T + 1`` rarest of either.  Equal sets of different blocks become one class.
3. **Candidate groups.**  Classes that share such a rare shingle are joined to the smallest class on
   the list, and the components of these edges hold every candidate pair.
4. **One leader each.**  A class is compared exactly with the leader that it meets most often.
5. **T-occurrence search** (DivideSkip; Li, Lu, Lu 2008).  In a candidate group the lists of a query
   are split by length: short ones are merged and counted, and what reaches ``T - L`` there is looked
   up in the L long ones by binary search.  Groups are cut into parts of bounded size, so their number
   grows with the group, and a task searches one pair of parts.  Classes that step 4 linked to the
   group's commonest leader have parts of their own, which meet only those of the others, and a search returns only links that join two parts of the graph, never all pairs of a group.

Components of the links follow in Spark (:mod:`.components`).

Defined results: a null or empty text, or one without words, has an empty set and links with nothing.  A
text of fewer than k words has its whole sequence as the one shingle.  Sets are the nodes: rows that
repeat an id are linked by their own texts only, and a null id stays unlinked with a null component.  Equality of
shingles is equality of their range and 40 more bits of their hash; the number of ranges follows the bytes of text,
whatever the number of shuffle partitions, so a range's group is bounded.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, keep, partitions, ratio, spread
from .components import components
from .words import SPACED, Words, batch_texts, shingles

NO_ID = -(1 << 63)  # stands for a null id inside numpy
_MESSAGE = "range int, block long, counts binary, cells binary, dups binary, dup_counts binary, info binary, inner binary"
_ANSWER = "range int, block long, counts binary, cells binary, often binary, dups binary, dup_often binary, info binary, inner binary"
_ROW = ("doc_id long, class long, rep long, n_shingles long, sig_a long, sig_b long, "
        "tokens array<long>")
_INFO = np.dtype([("id", "<i8"), ("class", "<i4"), ("n", "<i4"), ("a", "<u8"), ("b", "<u8")])

BLOCK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20  # text whose shingles one hash range gets, about
_CELL = 40  # bits of a shingle's hash beside its range
_MOST = 65535  # counts are kept up to this

#: Classes of a candidate group that one side of a search task holds, at least.
PART = 96
#: Shingles that one side of a search task holds, at most (about: parts are dealt by hash), where each class counts
#: as ``CLASS_CELLS`` more.
PART_CELLS = 1 << 20
CLASS_CELLS = 256
#: Weight of the longest list in the number of lists set aside, as in the published search.
MU = 0.01


def needed(n, num: int, den: int):
    """ceil(t * n): the overlap that a partner of a set of n members must reach."""
    return -(-num * n // den)


def _sets(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    w = Words(batch.column(1), SPACED)
    hashes, begin = shingles(w.hashes(), w.first, k)
    return [np.unique(hashes[begin[i]:begin[i + 1]]) for i in range(batch.num_rows)]


def _pack(cells: np.ndarray) -> bytes:
    """The low five bytes of each number."""
    return np.ascontiguousarray(cells.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_CELL // 8]).tobytes()


def _unpack(data: bytes | None) -> np.ndarray:
    out = np.zeros((len(data or b"") * 8 // _CELL, 8), np.uint8)
    out[:, :_CELL // 8] = np.frombuffer(data or b"", np.uint8).reshape(-1, _CELL // 8)
    return out.view("<u8").ravel().astype(np.int64)


def _runs(ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where equal values of a sorted array begin, and how many they are."""
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(ranked)))


def _block_messages(batch: pa.RecordBatch, block: int, k: int, ranges: int):
    """The messages of one block of documents, one per hash range that it has shingles in."""
    sets = _sets(batch, k)
    ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    info = np.zeros(len(sets), _INFO)
    info["id"], info["n"] = ids, [len(s) for s in sets]
    classes, members = {}, []
    for i, s in enumerate(sets):
        if len(s):
            info["a"][i] = np.add.reduce(s * np.uint64(0x9E3779B97F4A7C15))
            info["b"][i] = np.bitwise_xor.reduce(s * (s >> np.uint64(7)))
        key = (int(info["n"][i]), int(info["a"][i]), int(info["b"][i])) if len(s) and ids[i] != NO_ID else i
        c = classes.setdefault(key, len(members))
        if c == len(members):
            members.append(s)
        info["class"][i] = c
    of = np.repeat(np.arange(len(members), dtype=np.int64), [len(s) for s in members])
    cells = np.concatenate(members) if members else np.zeros(0, np.uint64)
    low = (cells & np.uint64((1 << _CELL) - 1)).astype(np.int64)
    cells = (((cells >> np.uint64(_CELL)).astype(np.int64) % ranges) << _CELL) | low
    order = np.argsort(cells, kind="stable")
    ranked, of = cells[order], of[order]
    at, times = _runs(ranked)
    inner = np.repeat(times > 1, times)
    dups, dup_times = ranked[at[times > 1]], np.minimum(times[times > 1], _MOST).astype(np.uint16)
    inside = of[inner].astype(np.uint32).tobytes() + ranked[inner].tobytes()
    of, cells = of[~inner], ranked[~inner]
    steps = np.arange(ranges + 1, dtype=np.int64) << _CELL
    cut, dup_cut = np.searchsorted(cells, steps), np.searchsorted(dups, steps)
    home = block % ranges
    for r in sorted({home, *np.flatnonzero(np.diff(cut) + np.diff(dup_cut)).tolist()}):
        a, b, c, d = cut[r], cut[r + 1], dup_cut[r], dup_cut[r + 1]
        order = np.argsort(of[a:b], kind="stable")
        yield {"range": r, "block": block, "cells": _pack(cells[a:b][order]), "dups": _pack(dups[c:d]),
               "dup_counts": dup_times[c:d].tobytes(),
               "counts": _counted(of[a:b][order]),
               "info": info.tobytes() if r == home else None, "inner": inside if r == home else None}


def _counted(of: np.ndarray) -> bytes:
    """Members of a sorted array, then how often each occurs: only those that do, so that a message is no longer than
    its shingles make it, however many members the block has."""
    at, times = _runs(of)
    return np.concatenate([of[at], times]).astype(np.uint32).tobytes()


def _members(data: bytes) -> np.ndarray:
    who, times = np.frombuffer(data, np.uint32).reshape(2, -1).astype(np.int64)
    return np.repeat(who, times)


def _to_ranges(k: int, ranges: int, schema: pa.Schema):
    def run(batches):
        task = TaskContext.get().partitionId()
        n = 0
        for batch in batches:
            for part in batch_texts(batch, "text", BLOCK_BYTES):
                rows = list(_block_messages(part, (task << 20) + n, k, ranges))
                n += 1
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _arrays(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) if x else np.zeros(0, dtype) for x in column.to_pylist()]


def _answer(schema: pa.Schema):
    """Of one hash range: which of its shingles each block shares with another set, and their counts."""
    def run(t):
        cells = [_unpack(x) for x in t["cells"].to_pylist()]
        dups = [_unpack(x) for x in t["dups"].to_pylist()]
        dup_counts = _arrays(t["dup_counts"], np.uint16)
        every = np.concatenate(cells + dups)
        weight = np.concatenate([np.ones(sum(map(len, cells)), np.int64), *dup_counts])
        order = np.argsort(every, kind="stable")
        at, times = _runs(every[order])
        total = np.add.reduceat(weight[order], at) if len(at) else np.zeros(0, np.int64)
        often = np.empty(len(every), np.uint16)
        often[order] = np.repeat(np.minimum(total, _MOST), times)
        rows = {n: [] for n in ("counts", "cells", "often", "dup_often")}
        begin = 0
        for own, per in zip(cells, t["counts"].to_pylist()):
            mine = often[begin:begin + len(own)]
            begin += len(own)
            again = mine > 1
            rows["counts"].append(_counted(_members(per)[again]))
            rows["cells"].append(_pack(own[again]))
            rows["often"].append(mine[again].tobytes())
        for own in dups:
            rows["dup_often"].append(often[begin:begin + len(own)].tobytes())
            begin += len(own)
        return pa.table([pa.array(rows[f.name], f.type) if f.name in rows else t[f.name].combine_chunks()
                         for f in schema], schema=schema)
    return run


def _assemble(num: int, den: int, schema: pa.Schema):
    """Of one block: the rows of its documents, with the repeated shingles, rarest first, of classes that
    have enough of them."""
    def run(t):
        home = next(i for i, x in enumerate(t["info"].to_pylist()) if x)
        info, inside = np.frombuffer(t["info"][home].as_py(), _INFO), t["inner"][home].as_py()
        n_inside = len(inside) // 12
        classes = int(info["class"].max()) + 1
        high = t["range"].to_numpy().astype(np.int64) << _CELL
        dups = np.concatenate([_unpack(x) + h for x, h in zip(t["dups"].to_pylist(), high)])
        dup_often = np.concatenate(_arrays(t["dup_often"], np.uint16))
        order = np.argsort(dups)
        dups, dup_often = dups[order], dup_often[order]
        inner = np.frombuffer(inside, np.int64, n_inside, 4 * n_inside)
        of = [_members(c) for c in t["counts"].to_pylist()]
        of = np.concatenate([*of, np.frombuffer(inside, np.uint32, n_inside).astype(np.int64)])
        cells = np.concatenate([*[_unpack(x) + h for x, h in zip(t["cells"].to_pylist(), high)], inner])
        often = np.concatenate([*_arrays(t["often"], np.uint16), dup_often[np.searchsorted(dups, inner)]])
        order = np.lexsort((cells, often, of))
        cells = cells[order]
        found = np.bincount(of, minlength=classes)
        begin = np.concatenate([[0], np.cumsum(found)])
        # one row of a class, the first, carries the tokens
        _, first = np.unique(info["class"], return_index=True)
        n = info["n"][first].astype(np.int64)
        live = (n > 0) & (found >= needed(n, num, den)) & (info["id"][first] != NO_ID)
        rep = np.full(classes, np.iinfo(np.int64).max)
        np.minimum.at(rep, info["class"], info["id"])
        carries = np.zeros(len(info), bool)
        carries[first[live]] = True
        tokens = pa.array([cells[begin[c]:begin[c + 1]] if y else None
                           for c, y in zip(info["class"], carries)], pa.list_(pa.int64()))
        block = t["block"][0].as_py()
        lost = info["id"] == NO_ID
        return pa.table([pa.array(info["id"], mask=lost), pa.array((block << 24) + info["class"].astype(np.int64)),
                         pa.array(rep[info["class"]], mask=lost), pa.array(info["n"].astype(np.int64)),
                         pa.array(info["a"].view(np.int64)), pa.array(info["b"].view(np.int64)), tokens],
                        schema=schema)
    return run


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def repeated_shingles(docs: DataFrame, k: int, threshold) -> DataFrame:
    """One row per document: its class in its block, the class's smallest id, the set's size and
    signature; the first row of a class with enough repeated shingles carries those as ``tokens``."""
    num, den = ratio(threshold)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    ranges = 1 + (size or 0) // RANGE_BYTES
    sent = in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                    _to_ranges(k, ranges, _arrow_schema(_MESSAGE)), _MESSAGE)
    answers = sent.groupBy("range").applyInArrow(_answer(_arrow_schema(_ANSWER)), _ANSWER)
    return answers.groupBy("block").applyInArrow(_assemble(num, den, _arrow_schema(_ROW)), _ROW)


def search(part: int, other: int, side: np.ndarray, ids, group, sizes, tokens, num: int, den: int):
    """T-occurrence search among the sets of one task.

    ``side`` says which part a set belongs to (``part`` or ``other``; equal when a part meets itself) and
    ``group`` what is linked already.  Yields links (i, j) that join two groups not joined before.
    """
    parent = np.arange(len(ids))
    lead = {}
    for i, g in enumerate(group):
        parent[i] = lead.setdefault(g, i)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    marks, times = np.unique(group, return_counts=True)
    common = marks[np.argmax(times)]
    listed = np.flatnonzero(group != common)  # two sets of the commonest group need no link
    if not len(listed):
        return
    of = np.repeat(listed, [len(tokens[i]) for i in listed])
    flat = np.concatenate([tokens[i] for i in listed])
    order = np.lexsort((of, flat))
    flat, of = flat[order], of[order]
    begin, length = _runs(flat)
    keys, n = flat[begin], len(ids)
    entry = np.repeat(np.arange(len(keys)), length) * n + of  # (list, set) as one sorted number
    for x in range(n):
        t = int(needed(sizes[x], num, den))
        at = np.searchsorted(keys, tokens[x]).clip(max=len(keys) - 1)
        at = at[keys[at] == tokens[x]]
        if len(at) < t:
            continue
        at = at[np.argsort(length[at], kind="stable")]
        aside = min(t - 1, int(t / (MU * np.log2(length[at[-1]] + 1) + 1)))
        short, long = at[:len(at) - aside], at[len(at) - aside:]
        per = length[short]
        step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        merged = np.bincount(of[np.repeat(begin[short], per) + step], minlength=n)
        ok = merged >= t - aside
        if part != other:
            ok &= side != side[x]
        ok &= (sizes >= t) & (sizes <= sizes[x] * den // num)
        ok[x] = False
        found = np.flatnonzero(ok)
        if not len(found):
            continue
        wanted = long[:, None] * n + found[None, :]
        where = np.searchsorted(entry, wanted).clip(max=len(entry) - 1)
        hits = merged[found] + (entry[where] == wanted).sum(axis=0)
        for y in found[den * hits >= num * (sizes[x] + sizes[found] - hits)]:
            a, b = root(x), root(int(y))
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield x, int(y)


def _search_task(num: int, den: int):
    schema = _arrow_schema("a long, b long")

    def run(key, t):
        part, other = key[1].as_py(), key[2].as_py()
        ids = t["cid"].to_numpy()
        lists = t["tokens"].combine_chunks()
        length = pc.list_value_length(lists).to_numpy()
        flat = lists.flatten().to_numpy()
        flat = flat[np.lexsort((flat, np.repeat(np.arange(len(length)), length)))]
        tokens = np.split(flat, np.cumsum(length)[:-1])
        links = list(search(part, other, t["part"].to_numpy(), ids, t["leader"].to_numpy(),
                            t["n_shingles"].to_numpy(), tokens, num, den))
        a = np.array([ids[i] for i, _ in links], np.int64)
        b = np.array([ids[j] for _, j in links], np.int64)
        return pa.table([pa.array(a), pa.array(b)], schema=schema)
    return run


def search_tasks(known: DataFrame, n_parts: int) -> DataFrame:
    """(cid, component, leader, part, i, j): the pairs of parts that each class of ``known`` (cid, component,
    leader, cells) is searched in.

    Parts 0 to s - 1 hold the strays, which meet all parts; the others hold the classes of the commonest leader.
    """
    led = known.groupBy("component", "leader").agg(F.count(F.lit(1)).alias("n"), F.sum("cells").alias("cells"))
    size = (led.groupBy("component")
            .agg(F.count(F.lit(1)).alias("leaders"), F.sum("n").alias("n"), F.sum("cells").alias("cells"),
                 F.max(F.struct("n", "leader", "cells")).alias("top")).where("leaders > 1"))
    # a leader of few classes isn't worth parts of its own
    own = F.when((F.col("top.n") >= PART) & (F.col("n") > PART), F.col("top.n")).otherwise(0)
    own_cells = F.when(F.col("own") > 0, F.col("top.cells")).otherwise(0)
    wanted = F.least(F.ceil(F.col("n") / PART), F.lit(max(2, int((2 * n_parts) ** 0.5))))

    def parts(n, cells):
        return F.greatest(F.ceil(F.col("wanted") * n / F.col("n")), F.ceil(cells / PART_CELLS)).cast("int")

    size = (size.withColumn("own", own).withColumn("own_cells", own_cells).withColumn("wanted", wanted)
            .select("component", F.when(F.col("own") > 0, F.col("top.leader")).alias("common"),
                    parts(F.col("n") - F.col("own"), F.col("cells") - F.col("own_cells")).alias("strays"),
                    parts(F.col("own"), F.col("own_cells")).alias("commons")))
    code = F.xxhash64("cid")
    linked = F.coalesce(F.col("leader") == F.col("common"), F.lit(False))
    part = F.when(linked, F.col("strays") + F.pmod(code, F.col("commons"))).otherwise(F.pmod(code, F.col("strays")))
    last = F.when(F.col("part") >= F.col("strays"), F.col("strays")).otherwise(F.col("strays") + F.col("commons")) - 1
    return (known.join(spread(size), "component").withColumn("part", part.cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), last)))
            .select("cid", "component", "leader", "part", F.least("part", "with").alias("i"),
                    F.greatest("part", "with").alias("j")))


def links_of_classes(classes: DataFrame, threshold) -> DataFrame:
    """(a, b): links between classes (cid, n_shingles, tokens) that connect all that are linked; tokens
    are the class's repeated shingles, rarest first."""
    num, den = ratio(threshold)
    n_parts = partitions(classes)
    must = F.expr(f"cast(ceil({num} * n_shingles / {den}BD) as int)")
    ranked = classes.withColumn("rare", F.size("tokens") - must + 1)
    # Step 3: the lists of rare shingles, and their leaders
    lists = ranked.select("cid", F.explode(F.slice("tokens", F.lit(1), F.col("rare"))).alias("token"))
    leaders = (lists.groupBy("token").agg(F.min("cid").alias("leader"), F.count(F.lit(1)).alias("on"))
               .where("on > 1"))
    met = keep(lists.join(spread(leaders), "token").groupBy("cid", "leader")
               .agg(F.count(F.lit(1)).alias("times")))
    groups = components(met, "cid", "leader")
    # Step 4: each class against one leader
    best = (met.where("cid != leader").groupBy("cid")
            .agg(F.max_by("leader", F.struct("times", F.negate("leader"))).alias("leader")))
    side = ranked.select(F.col("cid").alias("leader"), F.col("tokens").alias("l_tokens"),
                         F.col("n_shingles").alias("l_n"))
    both = F.size(F.array_intersect("tokens", "l_tokens"))
    tried = (ranked.join(best, "cid").join(side, "leader").withColumn("both", both)
             .where(den * F.col("both") >= num * (F.col("n_shingles") + F.col("l_n") - F.col("both")))
             .select("cid", "leader"))
    tried = keep(tried)
    # Step 5: search in what isn't linked yet
    cells = ranked.select("cid", (F.size("tokens") + CLASS_CELLS).cast("long").alias("cells"))
    known = (groups.withColumnRenamed("node", "cid").join(cells, "cid").join(tried, "cid", "left")
             .withColumn("leader", F.coalesce("leader", "cid")))
    todo = search_tasks(known, n_parts)
    found = (todo.join(ranked.select("cid", "n_shingles", "tokens"), "cid")
             .groupBy("component", "i", "j").applyInArrow(_search_task(num, den), "a long, b long"))
    return found.unionByName(tried.select(F.col("cid").alias("a"), F.col("leader").alias("b")))


def ngram_jaccard_join(docs: DataFrame, k: int = 4, threshold: float | str = "0.85") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text); see the module text.

    ``component_id`` is the smallest doc_id that links lead to, the row's own included.
    """
    rows = keep(repeated_shingles(docs, k, threshold))
    live = rows.where("tokens is not null")
    signature = ["n_shingles", "sig_a", "sig_b"]
    # A class is a node of its own, whatever ids its rows have: texts that share an id don't meet through it.
    classes = live.groupBy(*signature).agg(F.min("class").alias("cid"), F.min("rep").alias("lowest"), F.first("tokens").alias("tokens"))
    classes = keep(classes)  # few: what has no partner is gone
    found = components(links_of_classes(classes.select("cid", "n_shingles", "tokens"), threshold), "a", "b")
    at = keep(classes.select(*signature, "cid", "lowest")
              .join(found.withColumnRenamed("node", "cid"), "cid", "left")
              .select(*signature, F.coalesce("component", "cid").alias("component"), "lowest"))
    lowest = at.groupBy("component").agg(F.min("lowest").alias("label"))
    label = at.drop("lowest").join(spread(lowest), "component").drop("component")
    named = live.select("class", *signature).join(label, signature).select("class", "label")
    return (rows.join(spread(named), "class", "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id")))
