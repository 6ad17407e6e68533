"""Language identification by cross-parsing entropy.

For each language, a bounded sample of its labelled texts becomes a suffix automaton. A
text is parsed against it into the longest phrases that occur in the sample: the next
phrase starts where the sample has no continuation. The number of phrases times the bits
that point into a sample of that length, per character, estimates the cross-entropy of
the text under the language; the lowest one wins.

Letters are folded to lower case, everything else is a break. Texts are parsed whole, in
segments of SEGMENT characters side by side (a border between segments costs every
language the same), so each step of the automata serves thousands of segments at once.

Defined results: the language of a null text or one without any letter is ``und`` with
score 0; of equally good languages the alphabetically first wins; letters that no sample
holds cost each language a phrase; repeated rows get equal results; training rows
without language or text teach nothing, and without any training row all texts are
``und``; an empty table stays empty; columns with the names of the new ones are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_columns

#: Characters sampled for each language, from pieces of at most PIECE characters.
SAMPLE, PIECE = 30_000, 600
#: Letters of a language that have columns in its table (the others are searched for), and the
#: length of the segments parsed side by side.
DENSE, SEGMENT = 60, 512
BREAK, UNKNOWN, PAD = 0, 1, 2
UNDETERMINED = "und"


def samples(docs: DataFrame, chars: int = SAMPLE, piece: int = PIECE) -> dict[str, str]:
    """At most ``chars`` characters of text of each language: pieces, at places that a hash
    picks, of the texts with the smallest hashes, about as many as the bound needs."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id", "lang").alias("hash"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.least(F.length("text"), F.lit(piece))).alias("chars"))
    # Twice the texts needed on average, so that the bound is reached; then the smallest hashes.
    share = F.least(F.lit(1.0), 2.0 * chars / F.col("chars"))
    picked = known.join(F.broadcast(sizes), "lang").where(  # one row for each language
        F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30))
    start = F.pmod(F.xxhash64("hash"), F.greatest(F.lit(1), F.length("text") - piece)) + 1
    rows = picked.select("lang", "hash", F.substring("text", start.cast("int"), F.lit(piece)).alias("part")).collect()
    out: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["hash"])):
        if len(out.get(r["lang"], "")) < chars:
            out[r["lang"]] = (out.get(r["lang"], "") + "\n" + r["part"])[:chars]
    return out


def transitions(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings by state, at most three for each symbol of the
    text; the root is state 1 and state 0 is none."""
    step: list[dict[int, int]] = [{}, {}]
    length, link, last = [0, 0], [0, 0], 1
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """The transitions as a table: state by symbol, 0 means that no substring goes on so."""
    step = transitions(symbols)
    table = np.zeros((len(step), width), np.int32)
    for s, row in enumerate(step):
        for c, t in row.items():
            table[s, c] = t
    return table


class Automaton:
    """The automaton of a sample over its own letters, the most frequent first: a table of the states
    by the first letters, and sorted keys of the transitions by all others. No letter is left out."""

    def __init__(self, codes: np.ndarray, symbols: int):
        times = np.bincount(codes, minlength=symbols)
        times[:PAD + 1] = 0
        letters = np.argsort(-times, kind="stable")[:np.count_nonzero(times)]
        self.own = np.full(symbols, UNKNOWN, np.int32)  # by symbol of the parser; unknown here, too
        self.own[[BREAK, PAD]] = BREAK, PAD
        self.own[letters] = np.arange(PAD + 1, PAD + 1 + len(letters))
        self.size = PAD + 1 + len(letters)
        self.width = min(self.size, PAD + 1 + DENSE)
        step = transitions(self.own[codes].tolist())
        table = np.zeros((len(step), self.width), np.int32)
        keys: list[int] = []
        targets: list[int] = []
        self.first = np.ones(self.size, np.int32)
        for s, row in enumerate(step):
            for c, t in row.items():
                if c == UNKNOWN:
                    continue
                if s == 1:
                    self.first[c] = t
                if c < self.width:
                    table[s, c] = t
                else:
                    keys.append(s * self.width * self.size + c)
                    targets.append(t * self.width)
        table[:, PAD] = np.arange(len(step))  # padding changes nothing
        self.table = (table * self.width).ravel()
        self.first *= self.width
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.targets = np.append(np.array(targets, np.int32)[order], 0).astype(np.int32)

    def phrases(self, steps: np.ndarray) -> np.ndarray:
        """Phrases of each column of symbols."""
        steps = self.own.take(steps)
        rare = (steps >= self.width).any(axis=1)
        state = np.full(steps.shape[1], self.width, np.int32)
        count = np.ones(steps.shape[1], np.int32)
        for c, some in zip(steps, rare):
            if some:
                at = np.flatnonzero(c >= self.width)
                after = self.table.take(state + np.where(c >= self.width, UNKNOWN, c))
                key = state[at].astype(np.int64) * self.size + c[at]
                place = np.searchsorted(self.keys, key)
                after[at] = np.where(self.keys[place] == key, self.targets[place], 0)
            else:
                after = self.table.take(state + c)
            ended = after == 0
            count += ended
            state = np.where(ended, self.first.take(c), after)
        return count


class Parser:
    """Automata of the languages and the classes of all characters. Each letter of the samples is a
    symbol of its own; their number is bounded by the samples, not by the languages' scripts."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        points = np.arange(0x110000)
        letter = np.zeros(len(points), bool)
        folded = points.copy()
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                letter[c] = True
                low = ch.lower()
                if len(low) == 1:
                    folded[c] = ord(low)
        seen = Counter(ch for t in texts.values() for ch in t.lower() if ch.isalpha())
        symbol = np.where(letter, UNKNOWN, BREAK).astype(np.int32)
        kept = sorted(seen, key=lambda ch: (-seen[ch], ch))
        for i, ch in enumerate(kept):
            symbol[ord(ch)] = PAD + 1 + i
        self.symbol = np.where(letter, symbol[folded], BREAK).astype(np.int32)
        self.tables, self.bits = [], []
        for lang in self.languages:
            codes = self.codes(texts[lang])
            self.tables.append(Automaton(codes, PAD + 1 + len(kept)))
            self.bits.append(np.log2(max(2, len(codes))))

    def codes(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (row) under each language (column)."""
        many = [-(-len(c) // SEGMENT) for c in codes]
        flat = np.full((sum(many), SEGMENT), PAD, np.int32)
        row = 0
        for c, n in zip(codes, many):
            flat[row:row + n].reshape(-1)[:len(c)] = c
            row += n
        steps = np.ascontiguousarray(flat.T)
        of = np.repeat(np.arange(len(codes)), many)
        out = np.zeros((len(codes), len(self.tables)), np.int64)
        for k, table in enumerate(self.tables):
            np.add.at(out[:, k], of, table.phrases(steps))
        return out

    def __call__(self, texts: list[str | None]) -> Iterable[tuple[str, float]]:
        codes = [self.codes(t or "") for t in texts]
        lettered = np.array([bool((c >= UNKNOWN).any()) for c in codes])
        if not self.languages or not lettered.any():
            return [(UNDETERMINED, 0.0)] * len(texts)
        bits = self.phrases(codes) * np.array(self.bits)
        best = bits.argmin(axis=1)
        behind = np.minimum((bits - bits.min(axis=1, keepdims=True)) / 8, 60)
        score = 1 / np.exp2(-behind).sum(axis=1)
        return [(self.languages[b], float(s)) if ok else (UNDETERMINED, 0.0)
                for b, s, ok in zip(best, score, lettered)]


_PARSERS: dict[int, Parser] = {}


def parser(texts: dict[str, str]) -> Parser:
    """The automata of these samples, built once in each Python worker."""
    key = hash(tuple(sorted(texts.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(texts)
    return _PARSERS[key]


def identify(df: DataFrame, train_on: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus lang_pred and score; ``train_on`` has doc_id, text and lang."""
    texts = samples(train_on)
    adds = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return add_columns(df, [text], adds, lambda: parser(texts))
