"""Token counts by a linear longest-match automaton.

Method.  Words are runs between ASCII white space, each with the space before it;
a word's tokens are found greedily, always the longest vocabulary entry that fits.
The vocabulary is a trie.  A node's failure link leads to where matching goes on
once the tokens that the node's bytes are sure to begin with are taken off (popped),
and the number of those tokens is computed beforehand.  So a word is read once, left
to right, and only numbers are added: no piece is ever built.  All distinct words of
a batch step through the automaton together.

Defined results.  A null or empty text has no token.  A word that the vocabulary
cannot spell counts as one unknown token (a vocabulary that holds every byte spells
all).  Very long texts are read whole.  Repeated rows give repeated rows, an empty table
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES, FEW = 12 << 20, 32


def read_vocabulary(path: str) -> list[bytes]:
    """The tokens of a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def automaton(vocabulary: list[bytes]) -> dict[str, np.ndarray]:
    """Sorted transitions (node * 256 + byte -> node), failure links (-1: none),
    tokens popped on failure, and tokens popped when a word ends at a node (-1:
    it cannot be spelt)."""
    step: dict[int, int] = {}
    parent, last, token = [0], [0], [False]
    for word in vocabulary:
        node = 0
        for byte in word:
            key = node << 8 | byte
            if key not in step:
                step[key] = len(parent)
                parent.append(node), last.append(byte), token.append(False)
            node = step[key]
        token[node] = bool(word)
    n = len(parent)
    depth = [0] * n
    for v in range(1, n):  # a parent's number is below its children's
        depth[v] = depth[parent[v]] + 1
    fail, popped = [-1] * n, [0] * n
    for v in sorted(range(1, n), key=depth.__getitem__):
        if token[v]:
            fail[v], popped[v] = 0, 1
            continue
        z, taken = fail[parent[v]], popped[parent[v]]
        while z >= 0 and (z << 8 | last[v]) not in step:
            z, taken = fail[z], taken + popped[z]
        if z >= 0:
            fail[v], popped[v] = step[z << 8 | last[v]], taken
    ends = [0] * n
    for v in sorted(range(1, n), key=depth.__getitem__):
        ends[v] = -1 if fail[v] < 0 or ends[fail[v]] < 0 else popped[v] + ends[fail[v]]
    keys = np.array(sorted(step), np.int64)
    return {"keys": keys, "next": np.array([step[k] for k in keys.tolist()], np.int64),
            "fail": np.array(fail, np.int64), "popped": np.array(popped, np.int64), "ends": np.array(ends, np.int64)}


def count_words(words: pa.Array, auto: dict[str, np.ndarray]) -> np.ndarray:
    """Tokens of each word (without its space, which is read first)."""
    words = words.cast(pa.large_binary())
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-size, kind="stable")
    buffers, offset = words.buffers(), words.offset
    start = np.frombuffer(buffers[1], np.int64)[offset:offset + len(words)][order]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    size = size[order]
    keys, nxt, fail, popped = auto["keys"], auto["next"], auto["fail"], auto["popped"]
    state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)

    def advance(at, byte):
        """Words ``at`` read one byte each; state -1 is for ever."""
        while len(at):
            key = state[at] << 8 | byte
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[i] == key
            state[at[hit]] = nxt[i[hit]]
            at, byte = at[~hit], byte[~hit]
            total[at] += popped[state[at]]
            state[at] = fail[state[at]]
            alive = state[at] >= 0
            at, byte = at[alive], byte[alive]

    advance(np.arange(len(words)), np.full(len(words), 32, np.int64))
    longest = int(size[0]) if len(size) else 0
    for t in range(longest):
        many = int(np.searchsorted(-size, -t, "left"))  # words with over t bytes come first
        if many < FEW:  # the few longest words one by one
            table = dict(zip(keys.tolist(), nxt.tolist()))
            f, p = fail.tolist(), popped.tolist()
            for w in range(many):
                s, n = int(state[w]), int(total[w])
                for byte in data[start[w] + t:start[w] + size[w]].tolist():
                    while s >= 0 and (to := table.get(s << 8 | byte)) is None:
                        n, s = n + p[s], f[s]
                    if s < 0:
                        break
                    s = to
                state[w], total[w] = s, n
            break
        at = np.flatnonzero(state[:many] >= 0)
        advance(at, data[start[at] + t].astype(np.int64))
    end = np.where(state >= 0, auto["ends"][np.maximum(state, 0)], -1)
    out = np.empty(len(words), np.int64)
    out[order] = np.where((state < 0) | (end < 0), 1, total + end)
    return out


def count_texts(texts: pa.Array, auto: dict[str, np.ndarray]) -> np.ndarray:
    """Tokens of each whole text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    out, begin = np.zeros(len(texts), np.int64), 0
    while begin < len(texts):
        to = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + BATCH_BYTES, "right")))
        cut = pc.ascii_split_whitespace(texts.slice(begin, to - begin))
        at, words = np.asarray(cut.offsets).astype(np.int64), cut.flatten().dictionary_encode()
        n = count_words(words.dictionary, auto)
        n[pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)] = 0
        sums = np.r_[0, np.cumsum(n[np.asarray(words.indices)])]
        out[begin:to] = np.diff(sums[at - at[0]])
        begin = to
    return out


def count(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row; ``vocabulary`` is read where this is called,
    and its automaton, a few MB for a given vocabulary, goes to every task."""
    auto = docs.sparkSession.sparkContext.broadcast(automaton(read_vocabulary(vocabulary)))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count_texts(batch.column(1), auto.value))],
                                             ["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_tokens long")
