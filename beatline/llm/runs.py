"""Periodic runs of words by minimizers at many scales.

A run is a stretch of words with smallest period q, of at least ``times`` periods and
``least`` words, that no neighbouring word extends with that period.

Scale k = 16, 32, 64, ... finds the periods in (k / 2, k]. It hashes all stretches of k
words and takes each that is the smallest (ties: all of the smallest) of some ``w``
neighbouring ones; w is such that k, w and a period fit into any run of the scale. So the window
at a run's start and the one a period later choose equal stretches. As k is not below the
period, stretches of k words of a run are equal only at multiples of the period, so these
two follow each other among the chosen ones with their hash. Pairs of followers whose
distance is in the scale's range are the seeds; each is extended word by word, both ways.
Natural text has few seeds, since a seed is a square. Periods up to 8, too short for that,
are found by comparing all words with those q further on.

Words have exact numbers, so what is found is exact; the 64-bit hashes only choose seeds.
Texts go through in groups whose words are laid side by side, the longest first, with a
number between them that occurs nowhere else; long scales read only the texts that are long enough.
A task holds one group, or one long text, at a time. No shuffle.

Defined results: null texts, empty ones and those without words have no runs and an empty
collapsed text; equal rows get equal results; an empty table stays empty; columns with the
names of the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_columns

LEAST, TIMES = 6, 4
#: Periods that are found by direct scans, and words that are looked through at once.
SHORT, GROUP = 8, 1 << 17
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

Run = tuple[int, int, int]  # start, length, period


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _slide(x: np.ndarray, w: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of all stretches of ``w`` values."""
    n, p = len(x) - w + 1, 1
    while 2 * p <= w:
        x = least(x[:-p], x[p:])
        p *= 2
    return least(x[:n], x[w - p:w - p + n])


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """In how many leading values both agree."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return n


def _smallest(x: np.ndarray, q: int) -> bool:
    """Whether no shorter period than ``q`` holds for ``x``, which is some periods long."""
    one = x[:q]
    return not any((one[d:] == one[:-d]).all() for d in range(1, q // 2 + 1) if q % d == 0)


def _lagged(x: np.ndarray, q: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """start, end and period of the runs of one short period."""
    if len(x) <= q:
        return
    edges = np.concatenate([[-1], np.flatnonzero(x[:-q] != x[q:]), [len(x) - q]])
    for i in np.flatnonzero(np.diff(edges) > max(least, times * q) - q).tolist():
        a, b = int(edges[i]) + 1, int(edges[i + 1]) + q
        if _smallest(x[a:b], q):
            yield a, b, q


def _seeds(hashes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the pairs of equal minimizers of one scale."""
    if len(hashes) < w:
        return np.zeros(0, int), np.zeros(0, int)
    low = _slide(hashes, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    chosen = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), w, np.maximum) == hashes)
    value = hashes[chosen]
    order = np.argsort(value, kind="stable")
    value, place = value[order], chosen[order]
    far = np.diff(place)
    near = (value[1:] == value[:-1]) & (far > k // 2) & (far <= k)
    return place[:-1][near], far[near]


def _grown(x: np.ndarray, places: np.ndarray, periods: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """start, end and period of the runs that the seeds belong to."""
    order = np.lexsort((places, periods))
    before, until = 0, -1
    for p, q in zip(places[order].tolist(), periods[order].tolist()):
        if q == before and p + q < until:
            continue  # in the stretch that was grown last
        a = p - _agree(x[:p][::-1], x[q:p + q][::-1])
        b = p + q + _agree(x[p:], x[p + q:])
        before, until = q, b
        if b - a >= max(least, times * q) and _smallest(x[a:b], q):
            yield a, b, q


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """All runs of each text (a list of words), by start, then period."""
    if times < 3:
        raise ValueError("minimizers of this kind need runs of three periods or more")
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers, parts, starts, n = _Numbers(), [], [], 0
    for j, i in enumerate(order):
        parts += [np.fromiter(map(numbers.__getitem__, texts[i]), np.int64, len(texts[i])), np.array([-1 - j])]
        starts.append(n)
        n += len(texts[i]) + 1
    x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    longest = len(texts[order[0]]) if order else 0
    found = [r for q in range(1, min(SHORT, longest) + 1) for r in _lagged(x, q, least, times)]
    hashes = (x.astype(np.uint64) + np.uint64(1)) * _MIX[0]
    hashes ^= hashes >> np.uint64(29)
    k, sizes = 1, np.array([len(texts[i]) for i in order])
    while times * (k + 1) <= longest:
        m = int((sizes >= times * (k + 1)).sum())  # the texts that can hold a run of the next scale come first
        hashes = hashes[:starts[m - 1] + int(sizes[m - 1]) - k + 1]
        hashes = hashes[:-k] * _MIX[0] + hashes[k:] * _MIX[1]
        hashes ^= hashes >> np.uint64(31)
        k *= 2
        if k > SHORT:
            found += _grown(x, *_seeds(hashes, k, (times - 1) * (k // 2 + 1) - k + 1), least, times)
    out: list[list[Run]] = [[] for _ in texts]
    at = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    for j, (a, b, q) in sorted(zip(at.tolist(), found), key=lambda r: (r[1][0], r[1][2])):
        out[order[j]].append((a - starts[j], b - a, q))
    return out


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words, joined by spaces, without those that any run holds after its first period."""
    if not found:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for a, n, q in found:
        gone[a + q] += 1
        gone[a + n] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g])


def greatest(found: list[Run]) -> Run | None:
    """The run with most periods; ties: the first start, then the shortest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
NEW = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                    T.StructField("greatest", RUN), T.StructField("collapsed", T.BinaryType())])


def find(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Adds n_words, runs (an array of start, length, period; words are numbered from 0), greatest (the
    run of most periods, or null) and collapsed (the text without the repeats)."""
    def record(run: Run | None) -> dict | None:
        return None if run is None else dict(zip(("start", "length", "period"), run))

    def groups(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
        held: list[list[bytes]] = []
        size = 0
        for t in texts:
            held.append((t or b"").split())
            size += len(held[-1])
            if size >= GROUP:
                yield held
                held, size = [], 0
        yield held

    def each(texts: list[bytes | None]) -> Iterator[tuple]:
        for held in groups(texts):
            for words, found in zip(held, runs_of(held, least, times)):
                yield len(words), [record(r) for r in found], record(greatest(found)), collapsed(words, found)

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n in NEW.names} or c == text]
    raw = df.select(*kept, F.col(f"`{text}`").cast("binary").alias("__words"))
    made = add_columns(raw, ["__words"], NEW, lambda: each).drop("__words")
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def digests(df: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run, and sha256 of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                  F.lit(","), r["period"].cast("string"), F.lit("\n")))
    g = F.col("greatest")
    return df.select("doc_id", F.size("runs").cast("long").alias("n_runs"), g["start"].alias("start"),
                     g["length"].alias("length"), g["period"].alias("period"),
                     F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
                     F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
                     F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
