"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprint.  A-Z lower-cased, words between ASCII white space, shingles of
``shingle`` words with repeats (a shorter text is one shingle), XXH64 with seed
42 of each; a bit is 1 if it is set in over half of the hashes.  A text without
words, null included, has fingerprint zero.

Index.  Equal fingerprints are one entry, so copies cost nothing.  The upper
level of the index spreads over the cluster: the 64 bits are cut into segments,
and an entry goes under each *masked bit pattern* that any near entry must share
(two entries that differ in at most d bits agree on m - d of m segments).  The
rows below one pattern are sorted by Gray rank, where neighbours share long runs
of bits, and a tree is built over that order: a node holds the bits in which all
its entries agree.  The tree is joined with itself from the root down; the
differences between two nodes in the bits that both have fixed count against
every pair below them, so pairs of whole groups are pruned as soon as they add
up to more than d, and accepted whole once no pair can exceed d.  The result is
exact.

Hot patterns.  A pattern with over ``leaf`` entries is replaced by the patterns
one step finer (a segment of its free bits more), until it holds at most
``leaf``; with few free bits that is certain, as entries are distinct.  Each
pattern returns a spanning forest, never all its pairs.

Defined results.  Rows of equal or near texts get the smallest id of their
component; null ids never name one unless the component has no other, and get
the component's name like any row.  Repeated rows stay.  Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, connected_components, materialize

SHINGLE, DISTANCE, LEAF, PATTERN_ENTRIES = 4, 4, 1 << 14, 256
FANOUT = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    votes, n = np.zeros((8, 8), np.int64), len(words) - k + 1
    for at in range(0, n, 1 << 16):  # long texts in pieces of flat memory
        to = min(n, at + (1 << 16))
        starts = [ends[i - 1] if i else 0 for i in (at,)] + ends[at:to - 1]
        parts = [joined[s:e - 1] for s, e in zip(starts, ends[at + k - 1:to + k - 1])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), "<u8", len(parts))
        cells = h.view(np.uint8).reshape(-1, 8) + (np.arange(8, dtype=np.int32) << 8)
        seen = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
        votes += seen @ (np.arange(256)[:, None] >> np.arange(8) & 1)
    return int.from_bytes(np.packbits(2 * votes > n, axis=1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                             np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a number in reflected Gray order (as unsigned bits)."""
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, by))
    return fp


def masks(free: int, distance: int, segments: int) -> list[int]:
    """Masks over the free bits such that entries within ``distance`` agree on one."""
    bits = [i for i in range(64) if free >> i & 1]
    cuts = [len(bits) * i // segments for i in range(segments + 1)]
    parts = [sum(1 << b for b in bits[cuts[i]:cuts[i + 1]]) for i in range(segments)]
    return [sum(c) for c in combinations(parts, segments - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _routes(entries: DataFrame, distance: int, leaf: int) -> DataFrame:
    """(mask, pattern, fp): every entry under each pattern it has to meet near ones in."""
    n, segments = entries.count(), distance + 1
    while n / 2 ** (64 // segments * (segments - distance)) > PATTERN_ENTRIES and segments < 4 * distance:
        segments += 1
    spread = lambda ms: F.explode(F.array(*[F.lit(_signed(m)) for m in ms]))
    used = masks((1 << 64) - 1, distance, segments)
    rows = entries.select("fp", spread(used).alias("mask"))
    rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"))
    done = []
    while True:
        hot = rows.groupBy("mask", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > leaf)
        hot = checkpointed(hot.select("mask", "pattern", F.lit(True).alias("hot")))
        if hot.isEmpty():
            return rows if not done else done[0].unionByName(rows) if len(done) == 1 else \
                _union([*done, rows])
        marked = rows.join(hot, ["mask", "pattern"], "left")
        done.append(marked.where("hot is null").drop("hot"))
        finer = {m: [m | x for x in masks(~m & (1 << 64) - 1, distance, distance + 1)] for m in used
                 if bin(~m & (1 << 64) - 1).count("1") > distance}
        step = F.create_map(*[x for m, f in finer.items() for x in
                              (F.lit(_signed(m)), F.array(*[F.lit(_signed(y)) for y in f]))])
        used = sorted({y for f in finer.values() for y in f})
        rows = marked.where("hot").select("fp", F.explode(step[F.col("mask")]).alias("mask"))
        rows = materialize(rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"))
                           .distinct(), "simhash-finer")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _tree(group: np.ndarray, fp: np.ndarray) -> list[dict]:
    """Levels of the index over entries sorted by group and Gray rank, leaves
    first.  A node: its group, the bits all its entries have set, the bits in
    which they agree, its first child and their number, and its first leaf."""
    n = len(fp)
    level = {"group": group, "set": fp, "fixed": np.full(n, ~np.uint64(0)), "child": np.arange(n),
             "children": np.zeros(n, np.int64), "leaf": np.arange(n), "leaves": np.ones(n, np.int64)}
    levels = [level]
    while True:
        g = level["group"]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        if len(start) == len(g):
            return levels
        size = np.diff(np.r_[start, len(g)])
        place = np.arange(len(g)) - np.repeat(start, size)
        at = np.flatnonzero(place % FANOUT == 0)
        ones = np.bitwise_and.reduceat(level["set"], at)
        agree = np.bitwise_and.reduceat(level["fixed"], at)
        some = np.bitwise_or.reduceat(level["set"], at)
        level = {"group": g[at], "set": ones & agree, "fixed": agree & (ones | ~some), "child": at,
                 "children": np.diff(np.r_[at, len(g)]), "leaf": level["leaf"][at],
                 "leaves": np.add.reduceat(level["leaves"], at)}
        levels.append(level)


def _pairs_below(below: dict, here: dict, a: np.ndarray, b: np.ndarray):
    """Child pairs of node pairs (a, b), a <= b; each unordered pair once."""
    na, nb = here["children"][a], here["children"][b]
    n = na * nb
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    of = np.repeat(np.arange(len(a)), n)
    x = here["child"][a][of] + k // nb[of]
    y = here["child"][b][of] + k % nb[of]
    keep = x <= y
    return x[keep], y[keep]


def near_links(group: np.ndarray, fp: np.ndarray, distance: int = DISTANCE,
               block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) that link what lies within ``distance`` in the same group:
    at least one path of links between any two entries that near pairs join."""
    levels, found, size = _tree(group, fp), [], 0
    top = len(levels) - 1
    roots = np.arange(len(levels[top]["group"]))
    stack, step = [(top, roots, roots)], max(1, block // FANOUT ** 2)
    while stack:
        k, a, b = stack.pop()
        if len(a) > step:  # what waits is kept as node pairs, not as their children
            stack.append((k, a[step:], b[step:]))
            a, b = a[:step], b[:step]
        node = levels[k]
        both = node["fixed"][a] & node["fixed"][b]
        differ = np.bitwise_count((node["set"][a] ^ node["set"][b]) & both)
        open_ = differ + np.bitwise_count(~both)  # no pair below differs in more bits
        whole = open_ <= distance
        if whole.any():
            new = _whole(node, a[whole], b[whole])
            found, size = [*found, new], size + len(new[0])
            if size > block:  # what was found becomes one link for each entry at most
                found = [forest(len(fp), found)]
                size = 0
        more = ~whole & (differ <= distance)
        if k and more.any():
            stack.append((k - 1, *_pairs_below(levels[k - 1], node, a[more], b[more])))
    return forest(len(fp), found)


def _whole(node: dict, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all entries below each node pair whose pairs are all near:
    the nodes' first entries, and every entry with the first of its node."""
    w = np.unique(np.r_[a, b])
    size = node["leaves"][w]
    first = np.repeat(node["leaf"][w], size)
    each = first + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    x, y = np.r_[node["leaf"][a], first], np.r_[node["leaf"][b], each]
    return x[x != y], y[x != y]


def forest(n: int, found: list) -> tuple[np.ndarray, np.ndarray]:
    """One link from each entry to the first of its component."""
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([y for _, y in found])
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def links(entries: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """(a, b): links between distinct fingerprints that give their components."""
    routed = (_routes(entries, distance, leaf).withColumn("rank", gray_rank(F.col("fp")))
              .repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank"))

    def run(batches):
        rest = None

        def linked(mask, pattern, fp):
            group = np.cumsum(np.r_[0, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            i, j = near_links(group, fp.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], ["a", "b"])

        for batch in batches:
            now = [np.asarray(c) for c in batch.columns]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1])) if len(now[0]) else []
            cut = last[-1] + 1 if len(last) else 0
            rest = [x[cut:] for x in now]  # the last pattern may go on: at most ``leaf`` entries
            if cut:
                yield linked(*[x[:cut] for x in now])
        if rest is not None and len(rest[0]):
            yield linked(*rest)

    return routed.select("mask", "pattern", "fp").mapInArrow(run, "a long, b long").distinct()


def cluster(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints = materialize(fingerprints(docs, id_col=id_col, text=text, shingle=shingle), "simhash")
    classes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = checkpointed(connected_components(links(classes, distance, leaf)))
    names = (parts.join(classes, parts["node"] == classes["fp"])
             .groupBy("component").agg(F.min("first").alias("component_id")))
    linked = parts.join(names, "component").select(F.col("node").alias("fp"), "component_id")
    names = classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")
