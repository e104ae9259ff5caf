"""Language-model scoring by cross-entropy difference.

Method.  Two bigram models, one of the target documents and one of all documents
(the background), hold the count of every word and of every pair of words, keyed by
88-bit hashes (among 10^11 keys 2e-5 collisions are expected).  They are matched: one
shared vocabulary, the distinct words of all documents, counted; the same order and
smoothing (``ADD`` for each word of it); and the background's counts are scaled to
the target's number of tokens.  A token's loss under a model is
``-log2(share * pair / word before + (1 - share) * smoothed word)``; a document's
score is the mean over its tokens of the background's loss less the target's.  High
scores are like the target.

Counts are gathered over all documents and whole texts.  Documents are dealt by a
hash of id and text into batches of about ``BATCH_BYTES``.  A batch adds up its words
and pairs and sends each key once, with its counts, to the key's bucket, so a common
word costs as much as any other.  A bucket adds up the batches and answers each with
the other batches' counts in the order of its keys; the keys do not travel back.  No
task holds more than a batch or a bucket, and their numbers follow the input.  Rows
that are equal in id, text and mark are put together where they are read, and are
scored once; they would else fill one batch.  A
document's own counts are taken off before it is scored (leave-one-out), else the
target's documents would be scored by themselves.

Defined results.  A text without words, null included, has score 0 and no loss.
With no target document every score is 0.  A document is a target if a label row of
its id says so (null ids never are); repeated rows count and are returned each.  A very
long text is one row of one batch.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import byte_slices, small_side

SHARE, ADD = 0.6, 0.1
BATCH_BYTES = 8 << 20
CHUNK = 1 << 15  # words or pairs of a batch that are worked on at a time
PIECE_BYTES = 2 << 20  # of texts that are split into words at a time where words are counted
LOW_BYTES = 3  # of a key's lower half that are kept


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, all first bytes first (so zeros stand together),
    compressed; their number stands before."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def _pair_keys(key: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """The keys of pairs, coded as first word * ``n`` + second, from those of their words."""
    out = np.empty(len(codes), np.uint64)
    for at in range(0, len(codes), CHUNK):
        before, after = np.divmod(codes[at:at + CHUNK], max(n, 1))
        out[at:at + CHUNK] = _mixed(key[before] * np.uint64(0x9E3779B97F4A7C15)
                                    + _mixed(key[after] + np.uint64(0xC2B2AE3D27D4EB4F)))
    return out


def _low_bytes(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES].tobytes()


def _of_low_bytes(b: bytes) -> np.ndarray:
    part = np.frombuffer(b, np.uint8).reshape(-1, LOW_BYTES)
    return np.pad(part, ((0, 0), (0, 8 - LOW_BYTES))).view("<u8").ravel()


def batch_tokens(texts: pa.Array) -> dict:
    """The tokens of a batch of texts: ``owner`` and ``word`` of each, ``pair`` (-1 for
    the first of a text); words and pairs are places in ``hi`` and ``lo``, the halves
    of the batch's keys, which are distinct and sorted."""
    import xxhash
    cut = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    sizes, coded = np.diff(np.asarray(cut.offsets)), cut.flatten().dictionary_encode()
    del cut
    names, index = coded.dictionary.cast(pa.large_binary()), np.array(coded.indices)
    del coded
    n = len(names)
    both, real = np.empty((n, 2), np.uint64), np.empty(n, bool)
    for at in range(0, n, CHUNK):  # few words are Python objects at a time
        some = names.slice(at, CHUNK).to_pylist()
        both[at:at + CHUNK] = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, some)), "<u8").reshape(-1, 2)
        real[at:at + CHUNK] = [bool(w) for w in some]
    del names
    pa.default_memory_pool().release_unused()  # what the kernels took, before numpy takes as much
    real = real[index]
    word, owner = index[real].astype(np.int64), np.repeat(np.arange(len(texts)), sizes)[real]
    del index, real
    first = np.r_[True, owner[1:] != owner[:-1]][:len(owner)]
    later = np.flatnonzero(~first)
    codes, at = np.unique(word[later - 1] * n + word[later], return_inverse=True)
    used = np.unique(word)
    hi, lo = (np.r_[both[used, k], _pair_keys(both[:, k], codes, n)] for k in (0, 1))
    del both, codes
    lo &= np.uint64((1 << 8 * LOW_BYTES) - 1)
    order = np.lexsort((lo, hi))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    of_word = np.zeros(n, np.int64)
    of_word[used] = place[:len(used)]
    pair = np.full(len(word), -1)
    pair[later] = place[len(used):][at]
    return {"owner": owner, "word": of_word[word], "pair": pair, "hi": hi[order], "lo": lo[order]}


def _sums(tokens: dict, target: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Background and target counts of a batch's keys."""
    n, has = len(tokens["hi"]), tokens["pair"] >= 0
    pairs, out = tokens["pair"][has], np.empty((2, n), np.int64)
    for k, weight in enumerate((copies, copies * target)):  # whole numbers, exact as doubles
        each = weight.astype(np.float64)[tokens["owner"]]
        out[k] = np.bincount(tokens["word"], each, n)
        out[k] += np.bincount(pairs, each[has], n).astype(np.int64)
    return out


def _columns(table: pa.Table) -> tuple:
    text = table.column("text").cast(pa.large_string()).combine_chunks()
    return (text, table.column("target").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False).astype(bool),
            table.column("copies").combine_chunks().to_numpy().astype(np.int64))


def once(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: rows of one batch of a scan that are equal become one,
    so that a row which a third of the table repeats is sent once for each such batch."""
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(["doc_id", "text", "target"], use_threads=False) \
                .aggregate([([], "count_all")])
            yield from table.select(["doc_id", "text", "target", "count_all"]).rename_columns(
                ["doc_id", "text", "target", "copies"]).to_batches()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string, target boolean, copies long")


def marked(docs: DataFrame, targets: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, text, target): ``targets`` holds the ids of the target documents.
    While their measured size is small they are broadcast and texts stay where they
    are; beyond that it is a shuffle join."""
    ids = targets.select(F.col(targets.columns[0]).alias("doc_id")).where("doc_id is not null").distinct()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
            .join(small_side(ids.withColumn("target", F.lit(True))), "doc_id", "left"))


def in_batches(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with their ``batch``, and the number of bits that name a bucket."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = 1 + size // BATCH_BYTES
    batch = F.pmod(F.xxhash64(F.lit("batch"), "doc_id", "text"), F.lit(batches)).cast("int")
    return rows.withColumn("batch", batch), (4 * batches - 1).bit_length()


def requests(rows: DataFrame, bits: int) -> DataFrame:
    """(bucket, batch, hi, lo, background, target): the keys of every batch and its
    counts, packed; the bucket is the first ``bits`` bits of a key."""
    def run(key, table):
        text, target, copies = _columns(table)
        tokens = batch_tokens(text)
        sums, hi, lo = _sums(tokens, target, copies), tokens["hi"], tokens["lo"]
        del tokens, text, table
        bucket = (hi >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][:len(hi)])
        out = []
        for a, b in zip(starts, np.r_[starts[1:], len(hi)]):
            out.append((int(bucket[a]), _packed(np.diff(hi[a:b], prepend=np.uint64(0))), _low_bytes(lo[a:b]),
                        _packed(sums[0, a:b]), _packed(sums[1, a:b])))
        bucket, *rest = zip(*out) if out else [()] * 5
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "batch": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         **{c: pa.array(x, pa.binary()) for c, x in zip(("hi", "lo", "background", "target"), rest)}})

    return rows.groupBy("batch").applyInArrow(
        run, "bucket int, batch int, hi binary, lo binary, background binary, target binary")


def answers(asked: DataFrame) -> DataFrame:
    """(bucket, batch, background, target): the other batches' counts of a batch's
    keys of a bucket, in the order asked."""
    def run(key, table):
        names = ("background", "target")
        asked = {c: table.column(c).to_pylist() for c in ("hi", "lo", *names)}
        sums = [[_unpacked(x).astype(np.int64) for x in asked[c]] for c in names]
        ends = np.cumsum([len(x) for x in sums[0]])[:-1]
        hi = np.concatenate([np.cumsum(_unpacked(x), dtype=np.uint64) for x in asked["hi"]])
        lo = np.concatenate([_of_low_bytes(x) for x in asked["lo"]])
        order = np.lexsort((lo, hi))
        new = np.r_[False, (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new)
        out = []
        for parts in sums:
            own = np.concatenate(parts)
            total = np.zeros(place.max(initial=-1) + 1, np.int64)
            np.add.at(total, place, own)
            out.append([_packed(x) for x in np.split(total[place] - own, ends)])
        return pa.table({"bucket": table.column("bucket"), "batch": table.column("batch"),
                         **{c: pa.array(x, pa.binary()) for c, x in zip(names, out)}})

    return asked.groupBy("bucket").applyInArrow(run, "bucket int, batch int, background binary, target binary")


def losses(tokens: dict, target: np.ndarray, counts: np.ndarray, all_tokens: np.ndarray, words: int) -> np.ndarray:
    """Bits of every token under the background (row 0) and the target (row 1),
    each model without the counts of the token's own document."""
    owner, word, pair = (tokens[c] for c in ("owner", "word", "pair"))
    size = np.bincount(owner, minlength=len(target))

    def own(keys):
        """How often a token's key occurs in its document."""
        _, back, n = np.unique(owner * np.int64(len(tokens["hi"]) + 1) + keys + 1, return_inverse=True, return_counts=True)
        return n[back]

    n_word, n_pair, out = own(word), own(pair), np.empty((2, len(word)))
    has = pair >= 0
    prior = np.flatnonzero(has) - 1  # the token before
    mine = np.stack([np.ones(len(owner), np.int64), target[owner].astype(np.int64)])
    total = np.maximum(all_tokens[:, None] - mine * size[owner], 0)
    scale = np.where(total[0] > 0, total[1] / np.maximum(total[0], 1), 1.0)  # the background at the target's size
    for m, by in ((0, scale), (1, 1.0)):
        uni = counts[m][word] - mine[m] * n_word
        flat = (uni * by + ADD) / (total[m] * by + ADD * words)
        seen, before = flat.copy(), uni[prior]
        joint = (counts[m][pair] - mine[m] * n_pair)[has]
        seen[has] = np.where(before > 0, joint / np.maximum(before, 1), flat[has])
        out[m] = -np.log2(SHARE * seen + (1 - SHARE) * np.maximum(flat, 1e-12))
    return out


def totals(rows: DataFrame) -> tuple[int, int, int]:
    """Distinct words (by 64-bit hashes), tokens and target tokens of all documents: a
    batch of a scan sends each of its words once, and one row of sums."""
    import xxhash

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not batch.num_rows:
                continue
            words, sums = [], np.zeros(2, np.int64)
            for a, b in byte_slices(batch.column("text"), PIECE_BYTES):
                text, target, copies = _columns(table.slice(a, b - a))
                cut = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(text, "")))
                flat, sizes = cut.flatten(), np.diff(np.asarray(cut.offsets))
                real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
                size = np.bincount(np.repeat(np.arange(b - a), sizes)[real], minlength=b - a) * copies
                sums += size.sum(), size[target].sum()
                names = pc.unique(flat).cast(pa.large_binary())
                for at in range(0, len(names), CHUNK):
                    words.append(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names.slice(at, CHUNK).to_pylist() if w), np.uint64))
            del cut, flat, names
            pa.default_memory_pool().release_unused()
            distinct = np.unique(np.concatenate(words)).view(np.int64) if words else np.zeros(0, np.int64)
            for at in range(0, len(distinct), CHUNK):
                none = np.zeros(len(distinct[at:at + CHUNK]), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(distinct[at:at + CHUNK]), pa.array(none), pa.array(none)], ["word", "n", "t"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), *(pa.array([x], pa.int64()) for x in sums.tolist())], ["word", "n", "t"])

    found = rows.select("text", "target", "copies").mapInArrow(run, "word long, n long, t long").agg(
        F.countDistinct("word").alias("words"), F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    return found["words"], found["n"] or 0, found["t"] or 0


def score(rows: DataFrame, answered: DataFrame, words: int, all_tokens: np.ndarray) -> DataFrame:
    """(doc_id, n_tokens, background_loss, target_loss, score, copies) of every row."""
    def run(key, table, got):
        if not table.num_rows:
            raise RuntimeError(f"counts without documents for batch {key[0].as_py()}")
        text, target, copies = _columns(table)
        tokens = batch_tokens(text)
        got = sorted(got.to_pylist(), key=lambda r: r["bucket"])
        others = [np.stack([_unpacked(r[c]).astype(np.int64) for c in ("background", "target")]) for r in got]
        counts = np.concatenate([np.zeros((2, 0), np.int64), *others], axis=1)
        bits = losses(tokens, target, counts + _sums(tokens, target, copies), all_tokens, words)
        size = np.bincount(tokens["owner"], minlength=len(target))
        mean = [np.bincount(tokens["owner"], b, len(target)) / np.maximum(size, 1) for b in bits]
        known = (size > 0) & (all_tokens[1] > 0)
        loss = [pa.array(x, pa.float64(), mask=~known) for x in mean]
        return pa.table([table.column("doc_id"), pa.array(size.astype(np.int64)), *loss,
                         pa.array(np.where(known, mean[0] - mean[1], 0.0)), pa.array(copies)],
                        ["doc_id", "n_tokens", "background_loss", "target_loss", "score", "copies"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(
        run, f"doc_id {kind}, n_tokens long, background_loss double, target_loss double, score double, copies long")


def score_documents(docs: DataFrame, targets: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all documents against those whose ids ``targets`` holds."""
    rows, bits = in_batches(once(marked(docs, targets, id_col, text)))
    words, *tokens = totals(rows)
    found = score(rows, answers(requests(rows, bits)), max(words, 1), np.array(tokens, np.int64))
    # a row stands for at most one batch of a scan
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "_copy")
