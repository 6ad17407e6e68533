"""Language-model scoring with a causal self-attention model that is trained in numpy.

Words (lower case in A-Z, split at ASCII white space) become subword ids of a public byte-level
vocabulary, cut greedily into its longest tokens; each text ends with an end id. The model
predicts the next id from one head of causal self-attention over the ids before it, with
learned biases by distance and a residual hidden layer: a softmax over groups of ids, one
over the leaves of the group, and within a leaf the share that the id has of it in the
whole training text (most frequent ids are leaves of their own). So a text's probability
is a product over all its ids, the end included.

Texts are scored in windows of two blocks: the ids of the second block ask, those of both
are asked, so each id is predicted once and from at least a block before it. What comes
before a text is the end id, repeated. Windows are batched; a mask keeps them causal.

What is gathered: counts of all words and subwords of the training texts, summed before
and after a shuffle. Then each text is cut once into ids, which are stored. The attention
weights learn from every training text once, whatever their number: a hash deals the texts over
ROUNDS rounds; in a round every task trains on its texts of that round, and the weights are
averaged by the number of ids. So the weights, and with them the scores, depend on how the rows
fall to tasks, that is on the files and the settings of the scan. The base score, with counts of
words, looks up the HEAD most frequent words in a broadcast table and joins all others by a shuffle.
A very long text takes some 12 bytes an id where it is laid out, beside its Arrow batch.

Defined results: a null or empty text has one token, the end; repeated rows are scored
alike; without training texts all counts are zero and the model is untrained, but all
scores are finite; an empty table stays empty; other columns of the input are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm import bpe
from beatline.llm.chunks import Memory
from beatline.llm.common import cut, ship

#: Width, groups, leaves of a group, hidden width, and ids of a block (a window has two).
WIDTH, GROUPS, LEAVES, HIDDEN, STEP = 16, 48, 48, 32, 16
#: Leaves of a group that its rarer ids share.
COMMON = 8
#: Rounds of averaging, over which the training texts are dealt.
ROUNDS = 4
#: Most frequent words in the broadcast table, words that a task counts before it passes them on,
#: words of a generation that a worker remembers.
HEAD, HELD, WORDS = 200_000, 400_000, 400_000
#: Weights that travel in one row when the tasks' weights are summed.
PIECE = 1024
#: Ids that are scored in one go, windows of a task's first training step (four more with each step, as its first
#: steps lead furthest) and at most, ids that a task lays out at a time for such steps.
CHUNK, FIRST, BATCH, PART = 1 << 13, 64, 256, 1 << 17


class Segments:
    """Words as subword ids."""

    def __init__(self, path: str):
        self.bpe = bpe.loaded(path)
        self.end = self.bpe.size
        #: How an id is stored, the end included.
        self.code = "H" if self.end < 1 << 16 else "I"
        self.memory = Memory(self._make, WORDS)

    def _make(self, words: list[bytes]) -> list[bytes]:
        return [pack(f"<{len(ids)}{self.code}", *ids) for ids in map(self.bpe.propose, [b" " + w for w in words])]

    def coded(self, texts: list[list[bytes]]) -> list[bytes]:
        get = self.memory.learn(set().union(*texts))
        return [b"".join(map(get, words)) for words in texts]

    def read(self, coded: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(ids, f"<{self.code}") for ids in coded]


_SEGMENTS: dict[str, Segments] = {}


def segments(path: str) -> Segments:
    if path not in _SEGMENTS:
        _SEGMENTS[path] = Segments(path)
    return _SEGMENTS[path]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word and times over all ``docs`` (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "times"])

        for b in batches:
            for t in b.column(0).to_pylist():
                held.update(words_of(t))
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, times long").groupBy("word").agg(F.sum("times").alias("times"))


def subword_counts(words: DataFrame, path: str, size: int) -> np.ndarray:
    """How often each id occurs in the counted words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        propose = segments(path).bpe.propose
        for b in batches:
            ids, weights = [], []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cut_up = propose(b" " + w.encode())
                ids += cut_up
                weights += [n] * len(cut_up)
            np.add.at(held, ids, weights)
        has = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(held[has])], ["id", "times"])

    out = np.zeros(size, np.int64)
    found = words.select("word", "times").mapInArrow(run, "id int, times long").groupBy("id").agg(F.sum("times"))
    for i, n in found.collect():  # a row for each id of the vocabulary at most
        out[i] = n
    return out


@dataclass
class Vocabulary:
    """Group and leaf (counted over all groups) of each id, the log share of an id in its leaf, and
    the logarithms of the shares of groups, and of leaves in their groups, to start from."""

    group: np.ndarray
    leaf: np.ndarray
    log_share: np.ndarray
    log_groups: np.ndarray
    log_leaves: np.ndarray

    @classmethod
    def make(cls, counts: np.ndarray, tokens: list[bytes], ends: int) -> Vocabulary:
        """Ids in the order of how they begin, cut into groups of about equal weight; in a group the
        most frequent ids are leaves, the others share COMMON leaves of about equal weight."""
        weight = np.append(counts, ends).astype(float) + 0.1
        n = len(weight)
        order = np.array(sorted(range(n), key=lambda i: (tokens[i][:1] == b" ", tokens[i])))
        group = np.zeros(n, np.int32)
        mass = np.cumsum(weight[order]) - weight[order] / 2
        group[order] = np.minimum(mass / weight.sum() * GROUPS, GROUPS - 1).astype(int)
        leaf = np.zeros(n, np.int32)
        for g in range(GROUPS):
            mine = order[group[order] == g]
            top = np.argsort(-weight[mine], kind="stable")[:LEAVES - COMMON]
            place = np.full(len(mine), -1)
            place[np.sort(top)] = np.arange(len(top))
            rest = np.flatnonzero(place < 0)
            part = np.cumsum(weight[mine[rest]])
            place[rest] = len(top) + np.minimum(
                (part - weight[mine[rest]] / 2) / max(part[-1] if len(part) else 1, 1e-9) * COMMON, COMMON - 1).astype(int)
            leaf[mine] = g * LEAVES + place
        in_leaf = np.bincount(leaf, weight, GROUPS * LEAVES)
        in_group = in_leaf.reshape(GROUPS, LEAVES).sum(axis=1)
        shares = np.maximum(in_leaf.reshape(GROUPS, LEAVES), 1e-9) / np.maximum(in_group, 1e-9)[:, None]
        return cls(group, leaf, np.log(weight / in_leaf[leaf]),
                   np.log(np.maximum(in_group, 1e-9) / in_group.sum()), np.log(np.maximum(shares, 1e-9)))


SHAPES = {"by_group": (GROUPS, WIDTH), "by_leaf": (GROUPS * LEAVES, WIDTH), "ask": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
          "value": (WIDTH, WIDTH), "mix": (WIDTH, WIDTH), "near": (2 * STEP,), "up": (WIDTH, HIDDEN), "up0": (HIDDEN,),
          "down": (HIDDEN, WIDTH), "out": (WIDTH, GROUPS), "out0": (GROUPS,),
          "fine": (GROUPS, WIDTH, LEAVES), "fine0": (GROUPS, LEAVES)}
#: Distance from the asking id (row) to the asked one (column) in a window; negative ones lie ahead.
DISTANCE = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)[None]


def row_sums(a: np.ndarray) -> np.ndarray:
    return a @ np.ones(a.shape[1], a.dtype)


def sums_by(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows that share a place."""
    order = np.argsort(at.astype(np.uint16 if size <= 1 << 16 else np.int64), kind="stable")
    found = at[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[found[first]] = np.add.reduceat(rows.take(order, axis=0), first, axis=0)
    return out


class Attention:
    """The model; weights are float32 arrays by name. Groups and leaves are those of the ids."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        near = weights["near"][np.clip(DISTANCE, 0, 2 * STEP - 1)]
        self.bias = np.where(DISTANCE >= 0, near, np.float32(-1e9)).astype(np.float32)
        # Input, question, key and value depend on the leaf alone: one table to look them up in.
        x = weights["by_leaf"] + np.repeat(weights["by_group"], LEAVES, axis=0)
        self.table = np.concatenate([x, *(x @ weights[n] for n in ("ask", "key", "value"))], axis=1)
        self.out = np.vstack([weights["out"], weights["out0"]])
        self.fine = np.concatenate([weights["fine"], weights["fine0"][:, None]], axis=1)

    @classmethod
    def fresh(cls, vocabulary: Vocabulary, seed: int = 7) -> dict[str, np.ndarray]:
        """Weights to start from, close to the frequencies of ids alone."""
        r = np.random.Generator(np.random.PCG64(seed))
        scale = {"by_group": 0.5, "by_leaf": 0.5, "out": 0.02, "fine": 0.02}
        w = {k: (r.standard_normal(s) * scale.get(k, s[0] ** -0.5 if len(s) > 1 else 0)).astype(np.float32)
             for k, s in SHAPES.items()}
        w["out0"], w["fine0"] = vocabulary.log_groups.astype(np.float32), vocabulary.log_leaves.astype(np.float32)
        return w

    def forward(self, leaves: np.ndarray) -> dict[str, np.ndarray]:
        """Activations for blocks (rows of STEP ids); the first block of a text only is asked."""
        w = self.w
        looked_up = self.table.take(leaves.ravel(), axis=0)
        x, q, k, v = (looked_up[:, i * WIDTH:(i + 1) * WIDTH] for i in range(4))
        n = len(leaves) - 1
        k, v = (np.lib.stride_tricks.as_strided(
            a, (n, 2 * STEP, WIDTH), (STEP * a.strides[0], a.strides[0], a.strides[1])) for a in (k, v))
        q = (q[STEP:] * np.float32(WIDTH ** -0.5)).reshape(n, STEP, WIDTH)
        p = q @ k.transpose(0, 2, 1)
        p += self.bias
        np.minimum(p, 80, out=p)
        np.exp(p, out=p)  # what lies ahead becomes zero
        total = row_sums(p.reshape(-1, 2 * STEP))[:, None]
        seen = (p @ v).reshape(-1, WIDTH)
        seen /= total
        h = x[STEP:] + seen @ w["mix"]
        hidden = h @ w["up"]
        hidden += w["up0"]
        np.maximum(hidden, 0, out=hidden)
        top = np.empty((len(h), WIDTH + 1), h.dtype)  # the last column meets the biases
        np.add(h, hidden @ w["down"], out=top[:, :WIDTH])
        top[:, WIDTH] = 1
        return {"x": x, "q": q, "k": k, "v": v, "p": p, "total": total, "seen": seen, "h": h, "hidden": hidden, "top": top}

    def chances(self, scores: np.ndarray, aim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Exponentials of the scores (in their place), their sums, and the log share of the one aimed at."""
        np.minimum(scores, 80, out=scores)
        at = scores[np.arange(len(scores)), aim]
        np.exp(scores, out=scores)
        sums = row_sums(scores)
        return scores, sums, at - np.log(np.maximum(sums, 1e-30))

    def by_group(self, top: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        """Places in the order of the groups aimed at, their activations, (group, from, to) of each
        group's stretch, and the scores of its leaves there."""
        order = np.argsort(groups.astype(np.uint8 if GROUPS <= 256 else np.int32), kind="stable")
        ends = np.cumsum(np.bincount(groups, minlength=GROUPS)).tolist()
        spans = [(g, i, j) for g, (i, j) in enumerate(zip([0, *ends], ends)) if j > i]
        top = top.take(order, axis=0)
        fine = np.empty((len(top), LEAVES), top.dtype)
        for g, i, j in spans:
            np.matmul(top[i:j], self.fine[g], out=fine[i:j])
        return order, top, spans, fine

    def log_probability(self, leaves: np.ndarray, aim_group: np.ndarray, aim_leaf: np.ndarray) -> np.ndarray:
        """Natural log probability of the leaf aimed at, from the second block on."""
        top = self.forward(leaves)["top"]
        out = self.chances(top @ self.out, aim_group)[2].astype(float)
        order, _, _, fine = self.by_group(top, aim_group)
        out[order] += self.chances(fine, aim_leaf[order] % LEAVES)[2]
        return out

    def gradients(self, leaves: np.ndarray, aim_group: np.ndarray, aim_leaf: np.ndarray,
                  weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the places of weight 1, and its gradients."""
        w, a = self.w, self.forward(leaves)
        each = (weight / max(1.0, float(weight.sum()))).astype(a["top"].dtype)

        def slopes(scores: np.ndarray, aim: np.ndarray, each: np.ndarray) -> tuple[float, np.ndarray]:
            e, sums, logs = self.chances(scores, aim)
            e *= (each / sums)[:, None]
            e[np.arange(len(e)), aim] -= each
            return -float(logs @ each), e

        loss, e = slopes(a["top"] @ self.out, aim_group, each)
        out = a["top"].T @ e
        order, top, spans, fine = self.by_group(a["top"], aim_group)
        lost, d = slopes(fine, aim_leaf[order] % LEAVES, each[order])
        fines, sorted_back = np.zeros_like(self.fine), np.empty((len(top), WIDTH), top.dtype)
        for k, i, j in spans:
            np.matmul(top[i:j].T, d[i:j], out=fines[k])
            np.matmul(d[i:j], w["fine"][k].T, out=sorted_back[i:j])
        g = {"out": out[:-1], "out0": out[-1], "fine": fines[:, :-1], "fine0": fines[:, -1]}
        top = e @ w["out"].T
        top[order] += sorted_back
        g["down"] = a["hidden"].T @ top
        hidden = top @ w["down"].T
        hidden *= a["hidden"] > 0
        g["up"], g["up0"] = a["h"].T @ hidden, row_sums(hidden.T)
        h = top
        h += hidden @ w["up"].T
        g["mix"] = a["seen"].T @ h
        n = len(leaves) - 1
        seen = h @ w["mix"].T
        # A question's slopes over what it asks sum to zero: take off their mean by its chances.
        mean = row_sums(seen * a["seen"])[:, None]
        seen, p = seen.reshape(n, STEP, WIDTH), a["p"]
        p.reshape(-1, 2 * STEP)[...] /= a["total"]
        ds = seen @ a["v"].transpose(0, 2, 1)
        ds -= mean.reshape(n, STEP, 1)
        ds *= p
        near = np.bincount(np.clip(DISTANCE, 0, None).ravel(), ds.sum(axis=0).ravel(), 2 * STEP)
        g["near"] = near.astype(h.dtype)
        x = np.zeros_like(a["x"])
        x[STEP:] += h

        def back(name: str, d: np.ndarray, at: int = 0) -> None:
            g[name] = a["x"][at:].T @ d
            x[at:] += d @ w[name].T

        def overlap(d: np.ndarray) -> np.ndarray:
            out = np.zeros((n + 1, STEP, WIDTH), d.dtype)
            out[:-1] += d[:, :STEP]
            out[1:] += d[:, STEP:]
            return out.reshape(-1, WIDTH)

        q = (ds @ a["k"]).reshape(-1, WIDTH)
        q *= np.float32(WIDTH ** -0.5)
        back("ask", q, STEP)
        back("key", overlap(ds.transpose(0, 2, 1) @ a["q"]))
        back("value", overlap(p.transpose(0, 2, 1) @ seen))
        g["by_leaf"] = sums_by(leaves.ravel(), x, GROUPS * LEAVES)
        g["by_group"] = g["by_leaf"].reshape(GROUPS, LEAVES, WIDTH).sum(axis=1)
        return loss + lost, g


def laid_out(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in blocks: a block of end ids, then the ids before each id to predict, padded with end
    ids. Also the id to predict and the text (-1: none) of each place from the second block on."""
    many = [-(-(len(t) + 1) // STEP) for t in texts]
    size = sum(many) + len(texts)
    ids = np.full(size * STEP, end, np.int32)
    aims, of = ids.copy(), np.full(size * STEP, -1, np.int32)
    at = 0
    for k, (t, n) in enumerate(zip(texts, many)):
        at += STEP
        ids[at + 1:at + 1 + len(t)] = t
        aims[at:at + len(t)] = t
        of[at:at + len(t) + 1] = k
        at += n * STEP
    return ids.reshape(size, STEP), aims[STEP:], of[STEP:]


def groups(texts: list[np.ndarray], most: int = CHUNK) -> Iterator[list[int]]:
    held, size = [], 0
    for k, t in enumerate(texts):
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(k)
        size += len(t) + STEP
    if held:
        yield held


def score_texts(model: Attention, vocabulary: Vocabulary, texts: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each text, its end included. A text longer than a chunk is
    scored chunk by chunk, each with the block before it as its context."""
    out = np.zeros(len(texts))
    for some in groups(texts):
        blocks, aims, of = laid_out([texts[k] for k in some], end)
        total = np.zeros(len(some))
        step = CHUNK // STEP
        for i in range(0, len(blocks) - 1, step):
            part = blocks[i:i + step + 1]
            a, o = (v[i * STEP:(i + len(part) - 1) * STEP] for v in (aims, of))
            got = model.log_probability(vocabulary.leaf[part], vocabulary.group[a], vocabulary.leaf[a])
            got += vocabulary.log_share[a]
            has = o >= 0
            total += np.bincount(o[has], got[has], len(some))
        out[some] = total / np.log(10)
    return out


def train_part(weights: dict[str, np.ndarray], vocabulary: Vocabulary, batches: Iterator[list[np.ndarray]],
               end: int, rate: float) -> tuple[dict[str, np.ndarray], int]:
    """The weights after one pass over a task's texts with Adam's steps, and the ids seen."""
    flat = np.concatenate([weights[k].ravel() for k in SHAPES])
    w, at = {}, 0  # parts of one vector, so that a step is taken over all at once
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        w[k], at = flat[at:at + size].reshape(shape), at + size
    m, s = np.zeros_like(flat), np.zeros_like(flat)
    t = seen = 0
    for texts in batches:
        blocks, aims, of = laid_out(texts, end)
        i = 0
        while i < len(blocks) - 1:
            part = blocks[i:i + min(BATCH, FIRST + 4 * t) + 1]
            a, o = (v[i * STEP:(i + len(part) - 1) * STEP] for v in (aims, of))
            i += len(part) - 1
            if not (o >= 0).any():
                continue
            _, g = Attention(w).gradients(vocabulary.leaf[part], vocabulary.group[a], vocabulary.leaf[a], (o >= 0).astype(np.float32))
            g = np.concatenate([g[k].ravel() for k in SHAPES])
            t, seen = t + 1, seen + int((o >= 0).sum())
            m += np.float32(0.1) * (g - m)
            g *= g
            g -= s
            s += np.float32(0.01) * g
            g = np.sqrt(s / np.float32(1 - 0.99 ** t))
            g += np.float32(1e-8)
            np.divide(m, g, out=g)
            flat -= np.float32(rate / (1 - 0.9 ** t)) * g
    return w, seen


def train(coded: DataFrame, path: str, vocabulary: Vocabulary, weights: dict[str, np.ndarray], end: int) -> dict[str, np.ndarray]:
    """Averages, weighed by ids, of the weights that the tasks reach, round by round. ``coded`` has ids
    and turn, the round (from 0) that trains on them; a round brings one weight vector back, summed by Spark."""
    for k in range(ROUNDS):
        rate = 0.01 * 0.6 ** k
        start = weights

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = segments(path).read
            texts = (read(b.column(0).to_pylist()) for b in batches)
            w, seen = train_part(start, vocabulary, ([t[i] for i in some] for t in texts for some in groups(t, PART)), end, rate)
            if seen:
                flat = np.concatenate([w[n].ravel() for n in SHAPES]).astype(float) * seen
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(-(-len(flat) // PIECE) + 1), pa.int32()),
                    pa.array([[float(seen)], *[flat[i:i + PIECE] for i in range(0, len(flat), PIECE)]], pa.list_(pa.float64()))],
                    ["piece", "values"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for b in batches:
                for piece, values in zip(b.column(0).to_pylist(), b.column(1)):
                    held[piece] = held.get(piece, 0) + np.asarray(values.values)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                              pa.array(list(held.values()), pa.list_(pa.float64()))], ["piece", "values"])

        schema = "piece int, values array<double>"
        sums = coded.where(F.col("turn") == k).select("ids").mapInArrow(run, schema).repartition("piece").mapInArrow(add, schema)
        rows = dict(sums.collect())  # the weights once, whatever the number of tasks
        if not rows:
            continue
        flat = np.concatenate([rows[i] for i in range(1, len(rows))]) / rows[0][0]
        weights, at = {}, 0
        for name, shape in SHAPES.items():
            size = int(np.prod(shape))
            weights[name] = flat[at:at + size].reshape(shape).astype(np.float32)
            at += size
    return weights


CODED = ("place long, doc_id long, held_out boolean, turn long, n_tokens long, head_known long, head_log double, ids binary, "
         "tail array<struct<word:string,times:int>>")


def encoded(rows: DataFrame, path: str, head: Broadcast) -> DataFrame:
    """``rows`` (doc_id, held_out, turn, text) with a number of their own instead of the text, and the text's subword
    ids, its number of tokens, how many words are in ``head`` (word to log), their logs' sum, and the other words."""
    nan = float("nan")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known, cutter = head.value.get, segments(path)
        place = TaskContext.get().partitionId() << 40
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                texts = [words_of(t) for t in part.column(3).to_pylist()]
                logs = [np.fromiter(map(known, w, repeat(nan)), float, len(w)) for w in texts]
                tail = [Counter(w[k] for k in np.flatnonzero(np.isnan(x)).tolist()) for w, x in zip(texts, logs)]
                ends = np.cumsum([0, *map(len, tail)]).astype(np.int32)
                rare = pa.StructArray.from_arrays(
                    [pa.array([w for c in tail for w in c], pa.binary()).cast(pa.string()),
                     pa.array([n for c in tail for n in c.values()], pa.int32())], ["word", "times"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(place, place + len(texts))), *part.columns[:3],
                    pa.array([len(w) + 1 for w in texts], pa.int64()),
                    pa.array([int((~np.isnan(x)).sum()) for x in logs], pa.int64()),
                    pa.array([float(np.nansum(x)) for x in logs]), pa.array(cutter.coded(texts), pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), rare)],
                    ["place", "doc_id", "held_out", "turn", "n_tokens", "head_known", "head_log", "ids", "tail"])
                place += len(texts)

    return rows.select("doc_id", "held_out", "turn", "text").mapInArrow(run, CODED)


def score(docs: DataFrame, path: str, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of
    ``docs`` (doc_id, text); rows that are not ``held_out`` are learned from."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    learn = rows.where("NOT held_out")
    words = cut(word_counts(learn), "words")
    n_words, kinds = words.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1))).first()
    texts = learn.count()
    total, kinds = n_words + texts, kinds + (texts > 0)
    norm = float(np.log10(total + 0.1 * (kinds + 1)))
    # The head: words from an eighth of a power of two on, so that HEAD words at most have as many.
    size = F.floor(8 * F.log2("times"))
    sizes = words.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect()  # 8 * 63 rows at most
    held, least = 0, 8 * 64
    for row in sizes:
        held += row["count"]
        if held > HEAD:
            break
        least = row["size"]
    head = words.where(size >= least)

    known = {r["word"].encode(): float(np.log10(r["times"] + 0.1)) for r in head.collect()}  # HEAD rows at most
    turn = F.when(F.col("held_out"), -1).otherwise(F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(ROUNDS)))
    coded = cut(encoded(rows.withColumn("turn", turn.cast("long")), path, spark.sparkContext.broadcast(known)), "coded")

    table = bpe.loaded(path)
    end = table.size
    vocabulary = Vocabulary.make(subword_counts(words, path, end), [*table.bytes, b""], texts)
    weights = train(coded, path, vocabulary, Attention.fresh(vocabulary), end)
    shared = spark.sparkContext.broadcast((weights, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vocabulary = shared.value
        model, read = Attention(weights), segments(path).read
        for b in batches:
            scores = score_texts(model, vocabulary, read(b.column(0).to_pylist()), end)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(scores)], [*b.schema.names[1:], "score"])

    plain = coded.drop("tail", "turn", "ids")
    scored = coded.select("ids", *plain.columns).mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())]))
    rare = coded.select("place", F.explode("tail").alias("t")).select("place", "t.word", F.col("t.times").alias("n"))
    counted = rare.join(words, "word", "left")
    c = F.coalesce(F.col("times"), F.lit(0))
    tails = counted.groupBy("place").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"), F.sum(F.col("n") * F.log10(c + 0.1)).alias("tail_log"))
    end_log = float(np.log10(texts + 0.1))
    zero = F.lit(0)
    return scored.join(tails, "place", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", zero) + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        "score")
