"""Token ids of whole texts by a public tokenizer file, a batch at a time.

The tokenizers here never merge across white space, so a text's ids are those of
its words one after another.  Words are cut and numbered by Arrow, each distinct
word of a batch is looked up once in a bounded cache that lives as long as the Python
worker, and the ids are put together by array gathers.  A run of Latin letters
is handed to the file's BPE model directly, and so is punctuation behind it; any
other word, and any text whose white space is not a single space or line break
between words, goes through the whole tokenizer.  So does, whole, any text that
holds one of the file's added tokens, such as an end mark, in any case.  The ids
are those of encoding the text whole (``tests/llm`` compares them).
"""

from __future__ import annotations

import gc
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS, BATCH_BYTES = 600_000, 8 << 20


def worker_memory() -> dict:
    """What this Python process keeps from task to task."""
    return sys.modules.setdefault("tessera_worker_memory", types.ModuleType("tessera_worker_memory")).__dict__


def _gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin at ``begin``, one behind another."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(len(pool), total) < 2 ** 31 else np.int64
    return pool[np.arange(total, dtype=kind) - np.repeat((end - size - begin).astype(kind), size)]


class WordEncoder:
    """Encodes texts with the tokenizers library.

    ``space_joins``: a single space belongs to the word behind it (byte-level BPE);
    otherwise white space is dropped and letters are lower-cased by the file's own
    normalizer."""

    BEHIND = "!#$%&()*+,./:;<=>?@|~-"  # ASCII that ends a run of letters
    UP_TO_END = r"^(?s:.*)[^!#$%&()*+,./:;<=>?@|~\-]"  # all before that

    def __init__(self, path: str, space_joins: bool):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.space_joins, self.bare, self.batch = space_joins, {}, 0
        # The cache, all of it arrays: words, whether they are runs of letters, the
        # batch they were last used in, and their ids one behind another.
        self.known, self.letters = pa.array([], pa.string()), np.empty(0, bool)
        self.used, self.size, self.pool = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        shift = iter(range(256, 512))  # how byte-level BPE writes the other bytes
        self.byte = [chr(b) if b in printable else chr(next(shift)) for b in range(256)]

    @classmethod
    def of(cls, path: str, space_joins: bool) -> "WordEncoder":
        memory = worker_memory()
        if (path, space_joins) not in memory:
            memory[path, space_joins] = cls(path, space_joins)
        return memory[path, space_joins]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _model(self, run: str, lead: str) -> bytes:
        """Ids of one run of Latin letters, with the space before it, or of ASCII
        punctuation: one piece for the BPE model."""
        if not run.isascii():
            run = "".join([self.byte[b] for b in run.encode()])
        if lead:
            run = self.byte[32] + run
        return array("I", [t.id for t in self.tokenizer.model.tokenize(run)]).tobytes()

    def _fresh(self, word: str, lead: str) -> bytes:
        """Ids of a word with nothing to strip; ``lead`` is the space that belongs to
        it, if any."""
        if self._plain(word):
            return self._model(word if self.space_joins else word.lower(), lead)
        if self.space_joins and "\n" in word:  # a single line break is a piece of its own
            lines = word.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                rest = [self._word(x, "") for x in lines[1:]]
                return self._bare("\n").join([self._word(lines[0], lead), *rest])
        return self._whole(lead + word)

    def _bare(self, word: str) -> bytes:
        """``_fresh`` without a space before it, remembered."""
        ids = self.bare.get(word)
        if ids is None:
            if len(self.bare) > 50_000:
                self.bare.clear()
            ids = self.bare[word] = self._fresh(word, "")
        return ids

    @staticmethod
    def _plain(word: str) -> bool:
        """A run of Latin letters."""
        return word.isalpha() and max(word) <= "ÿ"

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a word: a run of letters and what is behind it, or an odd word."""
        core = word.rstrip(self.BEHIND)
        if len(core) == len(word) or not self._plain(core):
            core = word
        ids = self._fresh(core, lead) if lead else self._bare(core)
        return ids + self._bare(word[len(core):]) if len(core) < len(word) else ids

    def _remember(self, words: pa.Array, letters: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        """Add words and their ids; beyond ``CACHE_WORDS`` the half used last stays."""
        self.known = pa.concat_arrays([self.known, words])
        self.letters, self.size = np.r_[self.letters, letters], np.r_[self.size, size]
        self.used = np.r_[self.used, np.full(len(words), self.batch)]
        self.pool = np.r_[self.pool, pool]
        if len(self.known) > CACHE_WORDS:
            stay = np.sort(np.argsort(self.used, kind="stable")[-(CACHE_WORDS // 2):])
            self.pool = _gather(self.pool, (np.cumsum(self.size) - self.size)[stay], self.size[stay])
            self.known = self.known.take(pa.array(stay))
            self.letters, self.used, self.size = self.letters[stay], self.used[stay], self.size[stay]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of distinct words, each with the space that belongs
        to it.  Of words that differ in the punctuation behind them the letters are
        looked up once."""
        self.batch += 1
        lead = " " if self.space_joins else ""
        if not self.space_joins:
            words = pc.ascii_lower(words)  # the normalizer would
        cores = pc.utf8_rtrim(words, self.BEHIND)
        once = cores.dictionary_encode()
        names = once.dictionary
        at = pc.index_in(names, value_set=self.known)
        hit = at.is_valid().to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.used[at[hit]] = self.batch
        missed = names.filter(pa.array(~hit))
        new = missed.to_pylist()
        ids = [self._fresh(w, lead) if w else b"" for w in new]
        n_new = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        letters_new = np.fromiter(map(self._plain, new), bool, len(new))
        pool_new = np.frombuffer(b"".join(ids), "<u4")
        # each core: where its ids begin in both pools together, how many, plain or not
        begin, size, letters = (np.empty(len(names), k) for k in (np.int64, np.int64, bool))
        old = at[hit]
        begin[hit], size[hit], letters[hit] = (np.cumsum(self.size) - self.size)[old], self.size[old], self.letters[old]
        begin[~hit], size[~hit], letters[~hit] = len(self.pool) + np.cumsum(n_new) - n_new, n_new, letters_new
        place = np.asarray(once.indices)
        parts = [self.pool, pool_new]
        # what is behind the cores: a few distinct ends, and odd words that go whole
        more = np.flatnonzero(pc.not_equal(pc.binary_length(words), pc.binary_length(cores)).to_numpy(zero_copy_only=False))
        plain = letters[place[more]]
        ended, odd = words.take(pa.array(more[plain])), words.take(pa.array(more[~plain])).to_pylist()
        ends = pc.replace_substring_regex(ended, self.UP_TO_END, "").dictionary_encode()
        tails = [self._bare(w) for w in ends.dictionary.to_pylist()]
        wholes = [self._fresh(w, lead) for w in odd]
        n_more = np.fromiter(map(len, tails + wholes), np.int64, len(tails) + len(wholes)) // 4
        b_more = len(self.pool) + len(pool_new) + np.cumsum(n_more) - n_more
        parts.append(np.frombuffer(b"".join(tails + wholes), "<u4"))
        first, count = begin[place], size[place]
        first[more[~plain]], count[more[~plain]] = b_more[len(tails):], n_more[len(tails):]
        first2, count2 = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        which = np.asarray(ends.indices)
        first2[more[plain]], count2[more[plain]] = b_more[:len(tails)][which], n_more[:len(tails)][which]
        out = _gather(np.concatenate(parts), np.stack([first, first2], 1).ravel(), np.stack([count, count2], 1).ravel())
        keep = letters_new | ~pc.match_substring(missed, "\n").to_numpy(zero_copy_only=False)  # such words seldom meet again
        if len(new):
            self._remember(missed.filter(pa.array(keep)), letters_new[keep], n_new[keep],
                           _gather(pool_new, (np.cumsum(n_new) - n_new)[keep], n_new[keep]))
        return out, count + count2

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.split_pattern(texts, " ") if self.space_joins else pc.ascii_split_whitespace(texts)
        at = np.asarray(cut.offsets).astype(np.int64)
        at, flat = at - at[0], cut.flatten().dictionary_encode()
        place = np.asarray(flat.indices)
        pool, size = self._words(flat.dictionary.cast(pa.string()))
        if self.space_joins:
            odd = pc.or_(pc.equal(flat.dictionary, ""), pc.not_equal(flat.dictionary, pc.utf8_trim_whitespace(
                flat.dictionary))).to_numpy(zero_copy_only=False)
            full = at[1:] > at[:-1]
            strange = np.zeros(len(texts), bool)
            if odd.any():
                strange[full] = np.logical_or.reduceat(odd[place], at[:-1][full])
            heads = at[:-1][full]
            begin = flat.dictionary.take(pa.array(place[heads])).to_pylist()
            ids = [self._whole(texts[i].as_py()) if strange[i] else self._word(w, "")
                   for i, w in zip(np.flatnonzero(full).tolist(), begin)]
            ids.append(b"")
            place = place.astype(np.int64)
            place[heads] = len(size) + np.arange(len(heads))
            if strange.any():  # all of such a text stands at its first word
                none = np.repeat(strange, np.diff(at))
                none[heads] = False
                place[none] = len(size) + len(heads)
            size = np.r_[size, np.fromiter(map(len, ids), np.int64, len(ids)) // 4]
            pool = np.r_[pool, np.frombuffer(b"".join(ids), "<u4")]
        n = size[place]
        end = np.r_[0, np.cumsum(n)]
        return _gather(pool, (np.cumsum(size) - size)[place], n), np.diff(end[at])

    def _with_marks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``_some``, but texts that hold an added token are encoded whole."""
        low, held = pc.utf8_lower(texts), np.zeros(len(texts), bool)
        for mark in self.marks:
            held |= pc.match_substring(low, mark).to_numpy(zero_copy_only=False)
        if not held.any():
            return self._some(texts)
        pool, n = self._some(pc.if_else(pa.array(held), pa.scalar("", texts.type), texts))
        wholes = [np.frombuffer(self._whole(t), "<u4") for t in texts.filter(pa.array(held)).to_pylist()]
        begin, n = np.cumsum(n) - n, n.copy()
        n[held] = [len(w) for w in wholes]
        begin[held] = len(pool) + np.cumsum(n[held]) - n[held]
        return _gather(np.concatenate([pool, *wholes]), begin, n), n

    def encode(self, texts: pa.Array):
        """(ids, ids of each text) for runs of texts, together all of ``texts``."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        size, begin = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while begin < len(texts):
            done = size[begin - 1] if begin else 0
            to = max(begin + 1, int(np.searchsorted(size, done + BATCH_BYTES, "right")))
            gc.disable()  # nothing here is cyclic, and many small objects live long
            try:
                some = self._with_marks(texts.slice(begin, to - begin))
            finally:
                gc.enable()
            pa.default_memory_pool().release_unused()  # what the kernels took for these texts
            yield some
            begin = to
