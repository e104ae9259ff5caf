"""The text index: two record tables tokenized once, their tokens numbered.

``TextIndex`` writes these tables to the shared folder, each when it is first asked for:

* ``bags``      (side, id, doc_len, runs): the term counts of a record in one row, the only
                look at the texts that tokenizes them; ``counts`` are their single rows;
* ``tokens``    (token, tid, n_docs, n_right): a token's number is its place in this table;
* ``norms``     (side, id, norm): of each record's weights, joined with its bag, a row each;
* ``numbered``  (side, id, tid, n_docs, w, u): weights and unit weights, by token number, of
                the tokens that both sides hold; others add nothing to any product;
* ``reaching``  the same rows, but of the larger side only those of records that can reach a similarity;
* ``gold_weights`` (side, id, n_docs, w, token): all weights of the records in gold pairs only.

IDF, TF-IDF, norms, similarity and the gold pairs all read these, and every join
behind ``numbered`` is on integers; (n_docs, tid) orders tokens from rare to frequent.
The join of counts and tokens is ``text.join_tokens``, which no frequent token can
skew and which shuffles only the postings of rare tokens.  The gold pairs need counts and
tokens only, so postings and ``gold`` are computed side by side (``prepare``); what is asked
of gold pairs alone reads ``gold_weights`` and needs no ``numbered`` (``prepare_gold``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators import text as E
from tessera.operators.resolution import loose_candidates, loose_size, verified_pairs
from tessera.session import broadcast_if_small, broadcast_stored, reliable_checkpoint, stored


class TextIndex:
    def __init__(self, left: DataFrame, left_id: str, right: DataFrame, right_id: str, text_col: str = "text",
                 max_bytes: int | None = None):
        self.left = left.select(F.col(left_id).alias("left_id"), F.col(text_col).alias("ltext"))
        self.right = right.select(F.col(right_id).alias("right_id"), F.col(text_col).alias("rtext"))
        self.records = E.corpus(left, left_id, right, right_id, text_col)
        self.max_bytes = max_bytes
        self._reaching: dict[float, DataFrame] = {}

    @cached_property
    def bags(self) -> DataFrame:
        return stored(E.term_runs(E.doc_tokens(self.records)), "term-counts")

    @property
    def counts(self) -> DataFrame:
        return E.counts_of(self.bags)

    @cached_property
    def n_records(self) -> int:
        return self.records.count()

    @cached_property
    def tokens(self) -> DataFrame:
        by_token = self.counts.groupBy("token").agg(
            F.count(F.lit(1)).alias("n_docs"), F.count(F.when(F.col("side") == E.RIGHT, 1)).alias("n_right"))
        return stored(by_token.select("token", F.monotonically_increasing_id().alias("tid"), "n_docs", "n_right"), "tokens")

    def _idf(self):
        return F.lit(float(self.n_records)) / F.col("n_docs")

    def idf(self) -> DataFrame:
        """(token, n_docs, idf)."""
        return self.tokens.select("token", "n_docs", self._idf().alias("idf"))

    def _weighed(self, counts: DataFrame, table: DataFrame, *cols: str) -> DataFrame:
        w = F.col("n") / F.col("doc_len") * self._idf()
        return E.join_tokens(counts, table, self.max_bytes).select("side", "id", "n_docs", w.alias("w"), *cols)

    def weights(self) -> DataFrame:
        """(side, id, n_docs, w, token)."""
        return self._weighed(self.counts, self.tokens.select("token", "n_docs"), "token")

    def weights_of(self, bags: DataFrame, *cols: str) -> DataFrame:
        """The weights of ``bags``, stored, with further columns ``cols`` of each record."""
        return self._weighed(E.counts_of(bags), self.tokens.select("token", "n_docs"), "token", *cols)

    @cached_property
    def norms(self) -> DataFrame:
        return stored(E.vector_norms(self.weights()), "norms")

    def _held(self, side: str) -> DataFrame:
        """The tokens that a side holds."""
        return self.tokens.where(F.col("n_right") > 0 if side == E.RIGHT else F.col("n_right") < F.col("n_docs"))

    def _shared(self) -> DataFrame:
        """(token, tid, n_docs) of the tokens that both sides hold."""
        return self._held(E.RIGHT).where(F.col("n_right") < F.col("n_docs")).drop("n_right")

    def _units(self, bags: DataFrame, norms: DataFrame) -> DataFrame:
        """(side, id, tid, n_docs, w, u) of those ``bags`` that have one of the stored ``norms``."""
        with_norm = bags.join(broadcast_stored(norms, self.max_bytes), ["side", "id"])
        return self._weighed(E.counts_of(with_norm), self._shared(), "tid", "norm") \
            .withColumn("u", F.try_divide("w", "norm")).drop("norm")

    def unit_postings(self) -> DataFrame:
        """The rows of ``numbered``, which are made as they are read."""
        return self._units(self.bags, self.norms)

    @cached_property
    def numbered(self) -> DataFrame:
        return stored(self.unit_postings(), "postings")

    def reaching(self, min_similarity: float) -> DataFrame:
        """The rows of ``numbered`` that pairs at or above ``min_similarity`` can lie in: all of the side with
        fewer postings, and of the other side those of records that can reach it, written once."""
        if min_similarity not in self._reaching:
            self._reaching[min_similarity] = self._reach(min_similarity)
        return self._reaching[min_similarity]

    def _reach(self, min_similarity: float) -> DataFrame:
        """A record's product with any of the other side is at most Σ u·top, with a token's greatest unit weight
        there, and at most the norm of its shared tokens' unit weights (Cauchy–Schwarz).  Both are sums over its
        weights less a division by its norm, so one aggregate gives them with the norm, and neither norms nor
        unit weights of the records below the threshold are joined with their bags."""
        n = self.tokens.agg(F.sum("n_docs").alias("all"), F.sum("n_right").alias("right")).first()
        few, many = (E.LEFT, E.RIGHT) if 2 * (n["right"] or 0) >= (n["all"] or 0) else (E.RIGHT, E.LEFT)
        of = lambda side: self.bags.where(F.col("side") == side)
        weights = self._weighed(E.counts_of(of(few)), self._held(few).select("token", "n_docs"), "token")
        own = stored(self._units(of(few), stored(E.vector_norms(weights), "norms")), "postings")
        tops = broadcast_if_small(own.groupBy("tid").agg(F.max("u").alias("top")), self.max_bytes)
        tops = broadcast_if_small(self._shared().join(tops, "tid").select("token", "top"), self.max_bytes)
        table = self._held(many).select("token", "n_docs").join(tops, "token", "left")
        w, top = F.col("w"), F.col("top")
        sums = (self._weighed(E.counts_of(of(many)), table, "top").groupBy("side", "id")
                .agg(F.sqrt(F.sum(w * w)).alias("norm"), F.sum(w * top).alias("by_top"),
                     F.sqrt(F.sum(F.when(top.isNotNull(), w * w))).alias("by_norm")))
        reach = sums.where(F.least("by_top", "by_norm") >= (min_similarity - 1e-9) * F.col("norm"))
        others = stored(self._units(of(many), stored(reach.select("side", "id", "norm"), "norms")), "postings")
        return own.unionByName(others)

    def similar(self, min_similarity: float) -> DataFrame:
        """(left_id, right_id, cosine) at or above a similarity."""
        return E.cosine_inverted(self.reaching(min_similarity), min_similarity, self.max_bytes)

    @cached_property
    def _keyed(self) -> DataFrame:
        """(left_id, ltext, keys): left texts with their interior tokens, which are whole
        tokens of any text that contains them, in lower case too."""
        return stored(self.left.where("ltext is not null").withColumn(
            "keys", F.array_distinct(tokenize(_without_ends(F.lower("ltext"))))), "left-keys")

    @cached_property
    def gold(self) -> DataFrame:
        """(left_id, right_id) where the right text contains the whole left text.

        The rarest interior token of a left text names its candidates, ids only, until
        texts are compared.  Left texts without such a token are searched by character
        runs (``resolution.loose_candidates``)."""
        left = self._keyed
        facts = left.agg(F.count(F.when(F.length("ltext") == 0, 1)).alias("empty"),
                         F.collect_set(F.when(F.size("keys") == 0, loose_size("ltext"))).alias("sizes")).first()
        # an interior token is a token of its own record, so the index holds it
        best = (self.tokens.join(broadcast_if_small(left.select("left_id", F.explode("keys").alias("token")), self.max_bytes),
                                 "token")
                .groupBy("left_id").agg(F.min(F.struct("n_right", "token")).alias("best")).where("best.n_right > 0")
                .select("left_id", F.col("best.token").alias("token")))
        rights = self.counts.where(F.col("side") == E.RIGHT).select(F.col("id").alias("right_id"), "token")
        found = rights.join(broadcast_if_small(best, self.max_bytes), "token").select("left_id", "right_id")
        right = self.right.where("rtext is not null")
        for more in loose_candidates(left.where(F.size("keys") == 0), right, facts["sizes"], self.max_bytes):
            found = found.unionByName(more)
        return reliable_checkpoint(verified_pairs(left, right, found, facts["empty"] > 0, self.max_bytes))

    @cached_property
    def gold_weights(self) -> DataFrame:
        """The weights of the records in gold pairs.  Their ids are broadcast where they are measured
        to be few, so that of all other records nothing leaves the scan of the bags; of the tokens only
        theirs are joined."""
        ids = (self.gold.select(F.lit(E.LEFT).alias("side"), F.col("left_id").alias("id"))
               .unionByName(self.gold.select(F.lit(E.RIGHT).alias("side"), F.col("right_id").alias("id"))).distinct())
        bags = stored(self.bags.join(broadcast_if_small(ids, self.max_bytes), ["side", "id"], "leftsemi"), "gold-counts")
        wanted = broadcast_if_small(E.counts_of(bags).select("token").distinct(), self.max_bytes)
        table = stored(self.tokens.select("token", "n_docs").join(wanted, "token", "leftsemi"), "gold-tokens")
        return stored(self._weighed(E.counts_of(bags), table, "token"), "gold-weights")

    def prepare(self, min_similarity: float | None = None) -> "TextIndex":
        """Compute postings, ``numbered`` or those ``reaching`` a similarity, and ``gold`` at the same time."""
        postings = (lambda: self.numbered) if min_similarity is None else (lambda: self.reaching(min_similarity))
        with ThreadPoolExecutor(2) as pool:
            self._count(pool)
            for job in [pool.submit(postings), pool.submit(lambda: self.gold)]:
                job.result()
        return self

    def prepare_gold(self) -> "TextIndex":
        """Compute ``gold`` and ``gold_weights``: other records are counted, not weighed."""
        with ThreadPoolExecutor(2) as pool:
            self._count(pool)
        self.gold_weights
        return self

    def _count(self, pool: ThreadPoolExecutor) -> None:
        """Compute ``tokens``, and what else needs only the records, at the same time."""
        early = pool.submit(lambda: self._keyed), pool.submit(lambda: self.n_records)
        self.tokens
        for job in early:
            job.result()


def _without_ends(text):
    """A text without its first and last run of word characters: what is left holds
    its interior tokens whole."""
    return F.regexp_replace(F.regexp_replace(text, r"^\w*", ""), r"\w*\z", "")


# Small row groups in key order, so a lookup by key reads few of them; delta pages for sorted
# ids and tokens (which Parquet uses where it keeps no dictionary); a Bloom filter on the key.
STORE = {"parquet.block.size": str(1 << 20), "parquet.page.size": str(64 << 10), "parquet.writer.version": "PARQUET_2_0",
         "parquet.page.row.count.limit": "1000", "parquet.enable.dictionary": "false"}
LIST_BLOCK = 1024


def _write_sorted(rows: DataFrame, order: list[str], key: str, folder: str) -> DataFrame:
    """``rows`` in one order over all files of ``folder``, and the table that reads them."""
    _store(rows.repartitionByRange(*order).sortWithinPartitions(*order), key, folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _store(rows: DataFrame, key: str, folder: str) -> None:
    rows.write.options(**STORE).option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(folder)


def packer(block: int):
    """A function of a partition's rows (token, side, id) in order: their lists, cut into pieces
    of at most ``block`` ids, numbered within the partition.  (Made here, so that it travels to
    executors by value.)"""
    def lists_of(rows, chunk, place):
        """The pieces of a batch; ``chunk`` and ``place`` count what its first key has before it."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        changed = np.zeros(rows.num_rows, bool)
        changed[0] = True
        for c in ("token", "side"):
            values = rows.column(c)
            changed[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        firsts = np.flatnonzero(changed)
        pieces = -(-np.diff(np.append(firsts, rows.num_rows)) // block)
        key = np.repeat(np.arange(len(firsts)), pieces)
        number = np.arange(len(key)) - (np.cumsum(pieces) - pieces)[key]
        starts = firsts[key] + number * block
        ids = pa.ListArray.from_arrays(pa.array(np.append(starts, rows.num_rows), pa.int32()), rows.column("id"))
        before = np.where(key == 0, 1, 0)
        return starts, [rows.column("token").take(pa.array(starts)), rows.column("side").take(pa.array(starts)),
                        pa.array(number + chunk * before), pa.array(number * block + place * before), ids]

    def pack(batches):
        import pyarrow as pa
        names, kept, chunk, place = ["token", "side", "chunk", "place", "ids"], None, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            # the last piece of a batch is kept, as its list may go on in the next one
            rows = batch if kept is None else pa.concat_batches([kept, batch])
            starts, columns = lists_of(rows, chunk, place)
            kept, chunk, place = rows.slice(int(starts[-1])), columns[2][-1].as_py(), columns[3][-1].as_py()
            if len(starts) > 1:
                yield pa.RecordBatch.from_arrays([c[:-1] for c in columns], names)
        if kept is not None:
            yield pa.RecordBatch.from_arrays(lists_of(kept, chunk, place)[1], names)

    return pack


def write_inverted(postings: DataFrame, folder: str, block: int = LIST_BLOCK) -> DataFrame:
    """The stored inverted index (token, side, chunk, place, ids): posting lists in order of
    the token, each list's ids ascending, long lists in numbered blocks of at most ``block`` ids.

    Postings are sorted once, by a range sort on (token, side, id), so a token that is in every
    record is no hot key.  Lists are cut where their rows lie (``packer``) and stay in that order.  Only
    a partition's first list can go on from the one before: their numbers are raised by what the
    partitions before hold of them, from one table of about a row for each partition.
    A filter on ``token`` reaches the scan."""
    rows = postings.select("token", "side", "id").repartitionByRange("token", "side", "id").sortWithinPartitions("token", "side", "id")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"token string, side string, chunk long, place long, ids array<{kind}>"
    lists = reliable_checkpoint(rows.mapInArrow(packer(block), schema).withColumn("_part", F.spark_partition_id()))
    key = ["token", "side"]
    split = lists.groupBy("_part").agg(F.min(F.struct(*key)).alias("k")).select("k.*").distinct()
    held = lists.join(F.broadcast(split), key).groupBy(*key, "_part").agg(
        F.count(F.lit(1)).alias("_chunks"), F.sum(F.size("ids")).alias("_ids"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    raised = held.select(*key, "_part", F.sum("_chunks").over(before).alias("_chunks"), F.sum("_ids").over(before).alias("_ids")) \
        .where("_chunks is not null")
    numbered = lists.join(F.broadcast(raised), [*key, "_part"], "left").select(
        *key, (F.col("chunk") + F.coalesce("_chunks", F.lit(0))).alias("chunk"),
        (F.col("place") + F.coalesce("_ids", F.lit(0))).alias("place"), "ids")
    _store(numbered, "token", folder)
    return numbered.sparkSession.read.schema(schema).parquet(folder)


def postings_of(lists: DataFrame) -> DataFrame:
    """(token, side, id) rows of stored lists."""
    return lists.select("token", "side", F.explode("ids").alias("id"))


def write_records(weights: DataFrame, folder: str) -> DataFrame:
    """The weights in order of the record (side, id, token): a record's vector is one short read."""
    rows = weights.select("side", "id", "token", "w", "n_docs")
    return _write_sorted(rows, ["side", "id", "token"], "id", folder)
