"""Embedding near-duplicates by sorted projection passes, completed exactly.

Method.  In each of ``passes`` passes the distinct vectors are ordered
lexicographically by the joined signs of 64 random projections of its own, within their
label; vectors at a small angle tend to stand close, and every vector is compared with the ``window``
next ones.  Verified pairs of all passes are united.  The passes bound the partners
of a vector, so an exact completion handles what they leave open: the order of the
first pass is cut into blocks, each with its mean direction and the largest angle to
it; two blocks of a label meet unless these angles rule out all their pairs (angles obey
the triangle inequality), of two blocks only those vectors are compared that the other's
centre allows, and pairs that a window has compared are left out.  All cosines are in
double precision.  What a task sends on is a count for each vector and links that join
what its near pairs join; components are found over these links.

Scale.  Equal vectors are one row with a count, so a vector that a third of the rows
share costs as much as any other.  Windows go on over every border of a run.  The passes take
work in proportion to the vectors; the completion spreads pairs of blocks over tasks, and
their number grows with the square of a label's size, less those that the angles rule
out: in data without clusters they rule out few.

Recall and precision are exact.  ``n_by_passes`` counts the links that the passes alone
found, so their recall can be read from the result.

Defined results.  Vectors that are null, of length zero or hold null or non-finite
components, and rows with a null label, link with nothing.  Vectors of different
sizes are not compared.  Repeated ids are rows of their own; a null id names a
component only if it has no other.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, connected_components, materialize
from tessera.llm.simhash import forest
from tessera.operators.relational import number_rows

COSINE, BLOCK, SEED, PASSES, WINDOW = 0.98, 4096, 42, 4, 512
STRIP = 256  # rows of a block whose cosines are held at once


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one size as unit rows in double precision."""
    flat = np.asarray(column.flatten()).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def planes(dims: int, seed: int) -> np.ndarray:
    """dims x 64 normal numbers, the same on every machine."""
    return np.random.default_rng([seed, dims]).standard_normal((dims, 64)).astype(np.float32)


def _kind(vectors: DataFrame, vector: str) -> str:
    """The component type that vectors are kept in: float as it comes, else double."""
    return "float" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "double"


def _zeroless(vector, kind: str):
    """-0.0 and 0.0 are one."""
    return F.transform(vector, lambda x: x.cast(kind) + F.lit(0).cast(kind))


def _valid(vector: str, label: str):
    """Whether a row can link: never null."""
    v = F.col(vector)
    fine = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) \
        & F.exists(v, lambda x: x != 0)
    return F.coalesce(v.isNotNull() & F.col(label).isNotNull() & fine, F.lit(False))


def entries(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(node, group, size, vec, first, copies): every distinct valid vector of a
    label once; ``node`` is a hash of label and vector."""
    v = F.col(vector)
    return (vectors.where(_valid(vector, label))
            .select(F.col(id_col).alias("id"), F.col(label).cast("string").alias("group"),
                    _zeroless(v, _kind(vectors, vector)).alias("vec"))
            .withColumn("node", F.xxhash64("group", "vec"))
            .groupBy("node", "group", "vec").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
            .withColumn("dims", F.size("vec")))


def ranks(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(node, group, dims, copies, vec, ranks): for each pass the place of every vector in
    the order of (label, size, hash): the signs of 64 random projections, joined to one number.
    One range sort of short rows serves all passes: pass p begins behind p times the
    number of vectors."""
    def keys(batches):
        for batch in batches:
            dims, out = np.asarray(batch.column(1)), np.empty((passes, batch.num_rows), np.int64)
            for d in np.unique(dims):
                here = np.flatnonzero(dims == d)
                x = _matrix(batch.column(3).take(pa.array(here))).astype(np.float32)
                for p in range(passes):
                    bits = np.packbits(x @ planes(int(d), seed + p) > 0, axis=1)
                    out[p, here] = bits.view(">u8").ravel().astype(np.uint64).view(np.int64) ^ np.int64(-(1 << 63))
            for p in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, p, np.int32)), *batch.columns[:3], pa.array(out[p])],
                    ["pass", "group", "dims", "node", "key"])

    keyed = nodes.select("group", "dims", "node", "vec").mapInArrow(
        keys, "pass int, group string, dims int, node long, key long")
    placed = number_rows(keyed.select(F.struct("pass", "group", "dims", "key", "node").alias("order")), "order")
    rank = F.col("_rn") - F.col("order.pass") * F.lit(nodes.count())
    of = placed.select("order.node", "order.pass", rank.alias("rank")).groupBy("node").agg(
        F.array(*[F.max(F.when(F.col("pass") == p, F.col("rank"))) for p in range(passes)]).alias("ranks"))
    return nodes.select("node", "group", "dims", "copies", "vec").join(of, "node")


_FOUND = "node long, n long, link long"


def _found(node: np.ndarray, n: np.ndarray, pairs: list) -> pa.Table:
    """(node, n, link) of what a task found; its links are a forest."""
    link = np.full(len(node), -1)
    i, j = forest(len(node), pairs)
    link[i] = j
    some = np.flatnonzero(n)
    return pa.table({"node": pa.array(node[some]), "n": pa.array(n[some]),
                     "link": pa.array(node[link[some]], mask=link[some] < 0)})


def near_in_windows(rows: DataFrame, cosine: float, window: int, passes: int, block: int) -> DataFrame:
    """(node, n, link) from the sorted passes: every vector is compared with the
    ``window`` next ones in the order of each pass.  An order is cut into runs of
    ``block`` places, and a run is given the first ``window`` vectors of the next one, so
    windows go on over every border.  A pair that stands close in several orders
    counts in the first of them."""
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
    place = F.col("ranks")[F.col("pass")] - 1
    run = F.floor(place / block)
    halo = F.when((place % block < window) & (run > 0), F.array(run, run - 1)).otherwise(F.array(run))

    def compare(key, table):
        p, mine = (k.as_py() for k in key)
        at = np.stack([np.asarray(pc.list_element(table.column("ranks"), k)) for k in range(passes)])
        order = np.argsort(at[p])
        table, at = table.take(pa.array(order)), at[:, order]
        node, copies, dims = (table.column(c).to_numpy() for c in ("node", "copies", "dims"))
        group = table.column("group").combine_chunks().dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (dims[1:] != dims[:-1]), True])
        n, found, size = np.zeros(len(node), np.int64), [], 0
        for a, b in zip(edges, edges[1:]):  # vectors of one label and size
            x = _matrix(table.column("vec").slice(a, b - a).combine_chunks())
            own = int(np.sum((at[p, a:b] - 1) // block == mine))  # the halo stands behind
            for k in range(0, own, STRIP):
                to = min(k + STRIP, own)
                i, j = np.nonzero(x[k:to] @ x[k:to + window].T >= cosine)
                inside = (j > i) & (j - i <= window)
                i, j = i[inside] + a + k, j[inside] + a + k
                new = (np.abs(at[:p, i] - at[:p, j]) > window).all(axis=0)
                i, j = i[new], j[new]
                np.add.at(n, i, copies[j])
                np.add.at(n, j, copies[i])
                found.append((i, j))
                size += len(i)
                if size > 1 << 21:  # what was found becomes one link for each vector at most
                    found, size = [forest(len(node), found)], 0
        return _found(node, n, found)

    return each.withColumn("run", F.explode(halo)).groupBy("pass", "run").applyInArrow(compare, _FOUND)


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """(id, group, dims, nodes, copies, ranks, vecs, centre, reach): the vectors of each label in
    blocks along the first pass; ``reach`` is the largest angle to ``centre``."""
    def pack(table):
        x = _matrix(table.column("vec").combine_chunks())
        centre = x.mean(axis=0)
        long = np.linalg.norm(centre)
        centre = centre / long if long > 1e-9 else x[0]
        reach = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
        at = np.asarray(table.column("ranks").combine_chunks().flatten())
        vecs = np.asarray(table.column("vec").combine_chunks().flatten())
        return pa.table([pa.array([int(node.min())]), table.column("group").slice(0, 1), table.column("dims").slice(0, 1),
                         *(pa.array([c.tobytes()], pa.binary()) for c in (node, copies, at, vecs)),
                         pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([reach])],
                        ["id", "group", "dims", "nodes", "copies", "ranks", "vecs", "centre", "reach"])

    return rows.withColumn("run", F.floor((F.col("ranks")[0] - 1) / block)).groupBy("group", "dims", "run").applyInArrow(
        pack, "id long, group string, dims int, nodes binary, copies binary, ranks binary, vecs binary, "
              "centre array<double>, reach double")


DEALT = 64


def block_pairs(cut: DataFrame, cosine: float) -> DataFrame:
    """(low, high): the pairs of blocks of a label, each with itself too, that may hold
    vectors at ``cosine`` or more.  Blocks are dealt over ``DEALT`` keys and meet
    each other there, so no task joins all blocks of a label."""
    side = lambda name, end: cut.select("group", "dims", F.col("id").alias(name), F.col("centre").alias(f"centre{end}"),
                                        F.col("reach").alias(f"reach{end}"))
    low = side("low", 1).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    high = side("high", 2).withColumn("deal", F.pmod(F.xxhash64("high"), F.lit(DEALT)).cast("int"))
    both = low.join(high, ["group", "dims", "deal"]).where("low <= high")
    product = F.aggregate(F.zip_with("centre1", "centre2", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product)))
    most = float(np.arccos(np.clip(cosine, -1, 1))) + 1e-6
    return both.where((F.col("low") == F.col("high")) | (angle <= F.col("reach1") + F.col("reach2") + F.lit(most))) \
        .select("low", "high")


def near_in_blocks(cut: DataFrame, pairs: DataFrame, cosine: float, kind: str, window: int, passes: int) -> DataFrame:
    """(node, n, link) of the pairs that the passes left open.  Of two blocks only those
    vectors are compared whose angle to the other block's centre allows a pair; pairs
    that stood in a window are left out, as they are counted."""
    sides = pairs.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("id"))
    rows = sides.join(cut.select("id", "dims", "nodes", "copies", "ranks", "vecs", "centre", "reach"), "id")
    item = np.float32 if kind == "float" else np.float64
    most = float(np.arccos(np.clip(cosine, -1, 1))) + 1e-6

    def compare(key, table):
        part = {r["id"]: r for r in table.to_pylist()}
        a = part[key[0].as_py()]
        same, b = len(part) == 1, part[key[1].as_py()]
        read = lambda r: np.frombuffer(r["vecs"], item).astype(np.float64).reshape(-1, r["dims"])
        unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
        x = unit(read(a))
        y = x if same else unit(read(b))
        both = [a] if same else [a, b]
        node, copies = (np.concatenate([np.frombuffer(r[c], np.int64) for r in both]) for c in ("nodes", "copies"))
        at = np.concatenate([np.frombuffer(r["ranks"], np.int64).reshape(-1, passes) for r in both])
        off = 0 if same else len(x)
        may = lambda x, other: np.flatnonzero(np.arccos(np.clip(x @ np.array(other["centre"]), -1, 1))
                                              <= other["reach"] + most)
        left, right = (np.arange(len(x)),) * 2 if same else (may(x, b), may(y, a))
        x, y = x[left], y[right]
        n, found, size = np.zeros(len(node), np.int64), [], 0
        for k in range(0, len(x), STRIP):
            skip = k if same else 0  # of a block with itself, pairs above the diagonal
            near = x[k:k + STRIP] @ y[skip:].T >= cosine
            if same:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            i, j = left[i + k], right[j + skip] + off
            new = np.ones(len(i), bool)
            for p in range(passes):
                new &= np.abs(at[i, p] - at[j, p]) > window
            i, j = i[new], j[new]
            np.add.at(n, i, copies[j])
            np.add.at(n, j, copies[i])
            found.append((i, j))
            size += len(i)
            if size > 1 << 21:  # what was found becomes one link for each vector at most
                found, size = [forest(len(node), found)], 0
        return _found(node, n, found)

    return rows.groupBy("low", "high").applyInArrow(compare, _FOUND)


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
            cosine: float = COSINE, block: int = BLOCK, seed: int = SEED, passes: int = PASSES,
            window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept, n_by_passes) of every row."""
    nodes = materialize(entries(vectors, id_col, vector, label), "vectors")
    rows = materialize(ranks(nodes, passes, seed), "vector-ranks")
    cut = materialize(blocks(rows, block), "vector-blocks")
    first = near_in_windows(rows, cosine, window, passes, max(block, window)).withColumn("early", F.col("n"))
    rest = near_in_blocks(cut, block_pairs(cut, cosine), cosine, _kind(nodes, "vec"), window, passes).withColumn("early", F.lit(0))
    near = checkpointed(first.unionByName(rest))
    links = near.where("link is not null").select(F.col("node").alias("a"), F.col("link").alias("b")).distinct()
    parts = checkpointed(connected_components(links))
    counts = near.groupBy("node").agg(F.sum("n").alias("n"), F.sum("early").alias("early"))
    names = parts.join(nodes, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    linked = parts.join(names, "component").join(counts, "node").select("node", "component_id", "n", "early")
    more = lambda c: F.coalesce(c, F.lit(0)) + F.col("copies") - 1
    known = (nodes.join(linked, "node", "left")
             .select("node", F.coalesce("component_id", "first").alias("component_id"),
                     more("n").alias("n_links"), more("early").alias("n_by_passes")))
    rows = vectors.select(F.col(id_col).alias("vec_id"),
                          F.xxhash64(F.col(label).cast("string"),
                                     _zeroless(F.col(vector), _kind(vectors, vector))).alias("node"),
                          _valid(vector, label).alias("may"))
    joined = rows.select("vec_id", F.when(F.col("may"), F.col("node")).alias("node")).join(known, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select("vec_id", count("n_links"), component.alias("component_id"),
                         component.eqNullSafe(F.col("vec_id")).alias("kept"), count("n_by_passes"))
