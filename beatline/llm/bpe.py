"""BPE encoding and decoding of a byte-level vocabulary, by speculation and proof.

A word (a piece of the vocabulary's own pre-splitting) is first cut greedily into the
longest tokens. A sequence of tokens is the BPE result exactly when every adjacent pair
is, taken alone, the BPE result of its own bytes; that test is vectorised over all
distinct pairs of all new words of a batch. Only words in which a pair fails are merged
step by step. Each Python worker keeps the words it has seen, up to a bound.

Defined results: a null text is an empty text and gives no ids; the vocabulary's special
tokens are recognised inside texts; repeated rows are encoded alike; an empty table gives
an empty table; a column with the name of the new one is replaced.
"""

from __future__ import annotations

import heapq
import json
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from beatline.llm.chunks import Chunks, Memory
from beatline.llm.common import add_arrays

#: The pre-splitting of byte-level vocabularies (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks and words of a generation that a worker remembers: many, or few where its memory has other
#: uses (then the old generation goes at the end of a task, too). Bytes up to which a plain list serves merging.
MANY, FEW, SHORT = (600_000, 300_000), (200_000, 70_000), 48
NEVER = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """Letter to byte: printable Latin-1 bytes stand for themselves, the others for 256, 257..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Tables of one vocabulary file and the words seen so far."""

    def __init__(self, path: str, memory: tuple[int, int] = MANY):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in t)
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rule = {(int(a), int(b)): (r, int(m)) for r, (a, b, m) in enumerate(zip(left, right, made))}
        #: Per token: the rank of the merge that makes it (-1: a byte) and that merge's halves.
        self.rank = np.full(size, -1, np.int64)
        self.half = np.zeros((2, size), np.int64)
        self.rank[made[::-1]] = np.arange(len(merges))[::-1]
        self.half[0][made[::-1]], self.half[1][made[::-1]] = left[::-1], right[::-1]
        keys = left * size + right
        self.pair_order = np.argsort(keys, kind="stable")
        self.pair_keys, self.size = keys[self.pair_order], size
        self.byte_id = [0] * 256
        for i, b in enumerate(self.bytes):
            if len(b) == 1 and i not in self.special.values():
                self.byte_id[b[0]] = i
        # A token may be proposed only if merging its own bytes ends in it.
        whole = np.ones(size, bool)
        fits = self.compatible(left, right, np.arange(len(merges)))
        for a, b, m, ok in zip(left.tolist(), right.tolist(), made.tolist(), fits.tolist()):
            whole[m] = ok and whole[a] and whole[b]
        self.token = {b: i for i, b in enumerate(self.bytes)
                      if b and whole[i] and i not in self.special.values()}
        #: Lengths of the tokens that start with these three bytes, longest first, then those of shorter tokens.
        lengths: dict[bytes, set[int]] = {}
        for b in self.token:
            if len(b) > 2:
                lengths.setdefault(b[:3], set()).add(len(b))
        self.lengths = {b: (*sorted(n, reverse=True), 2, 1) for b, n in lengths.items()}
        self.split = regex.compile(SPLIT).findall
        # Letters and digits of the regex library that the tokenizer's older Unicode tables lack.
        recent = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(
            chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)) if unicodedata.category(c) == "Cn"]
        cut = pre_tokenizers.ByteLevel(add_prefix_space=False)
        apart = {at[0] // 4 for _, at in cut.pre_tokenize_str("".join(f"a{c}1\n" for c in recent)) if at[0] % 4 == 1}
        joint = {at[0] // 4 for _, at in cut.pre_tokenize_str("".join(f"!{c}!\n" for c in recent)) if at[0] % 4 == 1}
        newer = "".join(c for i, c in enumerate(recent) if i in apart and i not in joint)
        odd, first = "[" + (newer or "\ufffe") + "]", min(newer or "\ufffe")
        find = regex.compile(odd).search
        self.odd = lambda text: max(text) >= first and find(text) is not None
        self.exact_split = regex.compile(
            SPLIT.replace(r"[^\s\p{L}\p{N}]", rf"(?:{odd}|[^\s\p{{L}}\p{{N}}])").replace(
                r"\p{L}+", rf"(?:(?!{odd})\p{{L}})+").replace(r"\p{N}+", rf"(?:(?!{odd})\p{{N}})+")).findall
        self.pieces = Memory(lambda words: [
            pack(f"<{len(ids)}I", *ids) for ids in self.encode_words([w.encode() for w in words])], memory[1])
        self.chunks = Chunks(self.code, memory[0])

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_order[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """For each pair: whether merging the bytes of both never joins across their border,
        at all or (``until``) by a rule that comes before that rank.

        Walks back in time from the finished pair: undoes the later of the two last merges
        (the right one if both have the same rule, as merging goes from left to right) and
        asks at each moment whether a rule for the two tokens at the border came first."""
        x, y = a.copy(), b.copy()
        until_x = np.full(len(x), NEVER) if until is None else until.astype(np.int64)
        until_y = until_x.copy()
        ok, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            u, v = x[live], y[live]
            r = self.pair_rank(u, v)
            joined = (r < until_x[live]) & (r <= until_y[live]) & (r < NEVER)
            ok[live[joined]] = False
            ru, rv = self.rank[u], self.rank[v]
            more = ~joined & (np.maximum(ru, rv) >= 0)
            undo_x = more & (ru > rv)
            undo_y = more & ~undo_x
            until_x[live[undo_x]], x[live[undo_x]] = ru[undo_x], self.half[1][u[undo_x]]
            until_y[live[undo_y]], y[live[undo_y]] = rv[undo_y], self.half[0][v[undo_y]]
            live = live[more]
        return ok

    def propose(self, word: bytes) -> list[int]:
        out, i, n, token, lengths = [], 0, len(word), self.token.get, self.lengths.get
        while i < n:
            for k in lengths(word[i:i + 3], (2, 1)):
                if (t := token(word[i:i + k])) is not None:
                    break
            out.append(t)
            i += k
        return out

    def merge(self, word: bytes) -> list[int]:
        """Merges of lowest rank first, then leftmost; on a linked list with a heap if long."""
        ids = [self.byte_id[c] for c in word]
        n = len(ids)
        if n <= SHORT:
            rule, none = self.rule.get, (int(NEVER), -1)
            ways = [rule(p, none) for p in zip(ids, ids[1:])]
            while ways:
                best = min(ways)
                if best is none:
                    break
                i = ways.index(best)
                ids[i:i + 2] = [best[1]]
                del ways[i]
                if i < len(ways):
                    ways[i] = rule((best[1], ids[i + 1]), none)
                if i:
                    ways[i - 1] = rule((ids[i - 1], best[1]), none)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*p, i, ids[i], ids[i + 1]) for i in range(n - 1) if (p := self.rule.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if p := self.rule.get((new, ids[after[i]])):
                    heapq.heappush(heap, (*p, i, new, ids[after[i]]))
            if (h := before[i]) >= 0 and (p := self.rule.get((ids[h], new))):
                heapq.heappush(heap, (*p, h, ids[h], new))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        proposed = [self.propose(w) for w in words]
        flat = np.array([t for p in proposed for t in p], np.int64)
        if not len(flat):
            return proposed
        of = np.repeat(np.arange(len(words)), [len(p) for p in proposed])
        same = np.flatnonzero(of[1:] == of[:-1])
        pairs, back = np.unique(flat[same] * self.size + flat[same + 1], return_inverse=True)
        ok = self.compatible(pairs // self.size, pairs % self.size)
        for k in np.unique(of[same[~ok[back]]]).tolist():
            proposed[k] = self.merge(words[k])
        return proposed

    def code(self, strings: list[str]) -> list[bytes]:
        """The ids of each string, which holds no special token, from the pieces it splits into."""
        split = [self.split(t) if t.isascii() or not self.odd(t) else self.exact_split(t) for t in strings]
        get = self.pieces.learn(set().union(*split))
        return [b"".join(map(get, words)) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        pieces, where = [], []
        marks = [(m, np.array([i], "<u4").tobytes()) for m, i in self.special.items()]
        cutter = regex.compile("(" + "|".join(regex.escape(m) for m, _ in marks) + ")") if marks else None
        for text in texts:
            parts = cutter.split(text) if cutter and any(m in text for m, _ in marks) else [text]
            where.append(len(parts))
            pieces += parts
        coded = [self.special[p] if p in self.special else None for p in pieces]
        plain = iter(self.chunks.encode([p for p in pieces if p not in self.special]))
        done = iter([np.array([c], "<u4").tobytes() if c is not None else next(plain) for c in coded])
        return [next(done) if n == 1 else b"".join(next(done) for _ in range(n)) for n in where]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ids beyond the vocabulary give nothing, broken UTF-8 the mark U+FFFD."""
        known = ids[ids < self.size].tolist()
        return b"".join(map(self.bytes.__getitem__, known)).decode("utf-8", "replace")


_LOADED: dict[tuple, Bpe] = {}


def loaded(path: str, memory: tuple[int, int] = MANY) -> Bpe:
    """The vocabulary, read once in each Python worker."""
    if (path, memory) not in _LOADED:
        _LOADED[path, memory] = Bpe(path, memory)
    return _LOADED[path, memory]


def rest(path: str, memory: tuple[int, int]) -> None:
    """What a worker does at the end of a task."""
    if memory != MANY:
        loaded(path, memory).chunks.memory.rest()
        loaded(path, memory).pieces.rest()


IDS = T.ArrayType(T.IntegerType(), False)


def _lists(coded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, coded)], dtype=np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def _texts(bpe: Bpe, ids: list[np.ndarray]) -> pa.Array:
    return pa.array(list(map(bpe.decode, ids)), pa.string())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids",
           memory: tuple[int, int] = MANY) -> DataFrame:
    """Adds ``out``: the ids of the column ``text`` in the vocabulary file ``path`` (which every
    machine must have there). Other columns stay; no shuffle."""
    def make():
        bpe = loaded(path, memory)
        return lambda texts: [_lists(bpe.encode([t or "" for t in texts.to_pylist()]))]

    return add_arrays(df, [text], T.StructType([T.StructField(out, IDS)]), make, done=lambda: rest(path, memory))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the text of the ids, special tokens included; null ids count as none."""
    def make():
        bpe = loaded(path)
        return lambda col: [_texts(bpe, [
            np.array([i for i in v or () if i is not None], np.int64) for v in col.to_pylist()])]

    return add_arrays(df, [ids], T.StructType([T.StructField(out, T.StringType())]), make)


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded",
                  memory: tuple[int, int] = MANY) -> DataFrame:
    """Adds the ids and the text that they decode to, in one pass over the table."""
    def make():
        bpe = loaded(path, memory)

        def both(texts: pa.Array) -> list[pa.Array]:
            coded = bpe.encode([t or "" for t in texts.to_pylist()])
            return [_lists(coded), _texts(bpe, [np.frombuffer(c, "<u4") for c in coded])]

        return both

    adds = T.StructType([T.StructField(ids, IDS), T.StructField(out, T.StringType())])
    return add_arrays(df, [text], adds, make, done=lambda: rest(path, memory))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids (decimal, joined by commas) and decoded text."""
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
