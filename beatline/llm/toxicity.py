"""Toxicity by weak supervision.

Voters are lexicon entries and patterns: each of the strongest entries (given words that
the labelled rows confirm, and words and word stems that their toxic texts share) is a
voter, as are several entries in one text, disguised spellings, shouting and runs of
exclamation marks. A generative model estimates from all texts, without labels
but for the known classes of the labelled rows, how often each voter fires in either
class, and which voters still go together within a class; voters that say the same thing
share their weight. Its posterior probabilities are the labels on which a linear classifier
is trained, over the voters and the presence of vocabulary words; that classifier scores.

Words and stems are counted over all labelled rows. How much evidence an entry needs grows with the
logarithm of the number of entries that could be chosen, so a rare toxic word enters once enough labels speak for it.
The strongest entries are taken one by one, without those that a family taken before covers, up to ``VOCABULARY``
families. The first ``WORDS`` of them are a voter each; all others are dealt to ``SHARED`` voters, which
fire for any of theirs. The classifier is fitted on at most ``SAMPLE`` labelled rows, taken
by a hash of their ids; the label model on the counts of all vote patterns, of which there
are 2 ** VOTERS at most (16 bytes each). Labels, language, source and id are no input of a score.

Defined results: null and empty texts have no votes and no words and score as the
classifier's constant, below one half unless the labels say otherwise; labels that are null, or of unknown
documents, teach nothing; repeated rows score alike; without labelled rows of both classes
the given lexicon alone votes; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_columns, cut, maybe_in, ship, without

#: Insults to begin with, common words of several languages (a fixed list, a parameter).
LEXICON = ("idiot", "moron", "stupid", "loser", "pathetic", "worthless", "disgusting", "scum", "trash",
           "clown", "dumb", "imbecile", "bastard", "hate", "filthy", "idiota", "imbécile", "dummkopf")
#: Bound of the rows that the classifier is fitted on; entries that are voters; voters for all other entries; families.
SAMPLE, WORDS, SHARED, VOCABULARY = 20_000, 16, 4, 256
#: Entries that a task counts before it hands them on.
HELD = 200_000
#: Lengths of stems; an entry that ends in a star is a stem, the start of longer words.
STEMS = (4, 5, 6)
PATTERNS = ("two_entries", "disguised", "shouting", "exclaiming")
LEXICAL = WORDS + SHARED
VOTERS = LEXICAL + len(PATTERNS)
ROUNDS = 40
_BLANK = {i: " " for i in range(128) if not chr(i).isalnum()}
_LEET = str.maketrans("013457@$!", "oieastasi")
_MARKS = re.compile(r"!{3,}")
_MIXED = re.compile(r"[a-zA-Z]*[013457@$][a-zA-Z013457@$!]*[a-zA-Z]")


def words_of(text: str | None) -> Counter:
    return Counter((text or "").lower().translate(_BLANK).split())


def entries_of(words: Iterable[str]) -> set[str]:
    """The words of a text and the stems of the longer ones."""
    return {w[:k] + "*" for k in STEMS for w in words if len(w) > k}.union(words)


class Voters:
    """Votes and vocabulary entries of a text."""

    def __init__(self, lexicon: list[str], vocabulary: list[str]):
        self.lexicon, self.bits = frozenset(lexicon), {
            w: 1 << (i if i < WORDS else WORDS + i % SHARED) for i, w in enumerate(lexicon)}
        self.index = {w: i for i, w in enumerate(vocabulary)}

    def __call__(self, text: str | None) -> tuple[int, list[int]]:
        seen = words_of(text)
        text = text or ""
        entries = entries_of(seen)
        hits = self.lexicon & entries
        votes = 0
        for w in hits:
            votes |= self.bits[w]
        n = sum(seen.values())
        capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        disguised = any(m[0].lower().translate(_LEET) in self.lexicon for m in _MIXED.finditer(text))
        marks = (len(hits) >= 2, disguised,
                 n >= 5 and capitals * 2 > sum(map(len, seen.elements())), _MARKS.search(text) is not None)
        votes += sum(1 << (LEXICAL + i) for i, m in enumerate(marks) if m)
        return votes, sorted(self.index[w] for w in self.index.keys() & entries)


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic, a row for each id; of several labels the toxic one counts."""
    return labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` of the labelled ``docs``: doc_id, text, toxic; those of the smallest hashes."""
    known = known_labels(labels)
    # About twice the bound passes the first filter, so that few rows meet for the order.
    share = min(1.0, 2 * limit / max(1, known.count()))
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    chosen = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.join(F.broadcast(chosen), "doc_id")  # ``limit`` rows at most


def entry_counts(rows: DataFrame) -> DataFrame:
    """word, one, none: how many toxic and other texts of ``rows`` (text, toxic) hold each word or stem."""
    def handed(held: list[Counter]) -> Iterator[pa.RecordBatch]:
        for k, texts in enumerate(held):
            if texts:
                yield pa.RecordBatch.from_pydict({
                    "word": list(texts), "toxic": pa.array([k] * len(texts), pa.int32()),
                    "texts": pa.array(list(texts.values()), pa.int64())})
                texts.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter(), Counter()]
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[toxic].update(entries_of(set((text or "").lower().translate(_BLANK).split())))
                if len(held[0]) + len(held[1]) > HELD:
                    yield from handed(held)
        yield from handed(held)

    parts = rows.select("text", "toxic").mapInArrow(count, "word string, toxic int, texts long")
    return parts.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("texts")).otherwise(0)).alias("one"),
        F.sum(F.when(F.col("toxic") == 0, F.col("texts")).otherwise(0)).alias("none"))


def families(entries: Iterable[tuple[str, int]], limit: int = VOCABULARY) -> dict[str, int]:
    """The first ``limit`` of ``entries`` (word, toxic texts; strongest first) that say something new: not what a taken
    stem covers, nor a stem that a taken entry makes up (four fifths of its texts)."""
    taken: dict[str, int] = {}
    makes: dict[str, int] = {}  # of each start of a taken entry the most texts
    for w, one in entries:
        body = w.rstrip("*")
        covered = any(body[:k] + "*" in taken for k in STEMS if len(body) >= k)
        if covered or w.endswith("*") and makes.get(body, 0) >= 0.8 * one:
            continue
        taken[w] = one
        for k in STEMS:
            if len(body) >= k:
                makes[body[:k]] = max(makes.get(body[:k], 0), one)
        if len(taken) == limit:
            break
    return taken


def lexicon_of(rows: DataFrame, given: tuple[str, ...] = LEXICON) -> tuple[list[str], list[str]]:
    """Voter words and vocabulary from all labelled ``rows`` (text, toxic): words by the log odds of the share of toxic
    and of other texts that hold them, given words first if the rows don't speak against them."""
    sizes = dict(rows.groupBy("toxic").count().collect())
    n = [sizes.get(0, 0), sizes.get(1, 0)]
    if not min(n):
        return list(given), list(given)
    odds = F.log((F.col("one") + 0.5) / (n[1] + 1)) - F.log((F.col("none") + 0.5) / (n[0] + 1))
    words = cut(entry_counts(rows).where((F.col("one") > 0) | F.col("word").isin(*given)).withColumn("odds", odds), "toxicity-words")
    # Evidence: odds in proportion to the toxic texts that hold the word, against chance among so many words.
    evidence = F.col("odds") * F.col("one")
    least = 2 * float(np.log(max(1, words.count()))) + 6
    strong = words.where((F.col("odds") > 2) & (evidence > least)).orderBy(F.desc(evidence), F.desc(F.length("word")), "word")
    against = {r["word"] for r in words.where(F.col("word").isin(*given) & (F.col("odds") <= 0)).collect()}
    strong = strong.select("word", "one")
    first = strong.limit(16 * VOCABULARY).collect()
    chosen = families(first)
    if len(chosen) < VOCABULARY and len(first) == 16 * VOCABULARY:  # very large families: partition by partition
        chosen = families(strong.toLocalIterator())
    ranked = list(chosen)
    common = 0.25 * max(chosen.values(), default=0)
    voters = [w for w, one in chosen.items() if one >= common]
    voters += [w for w in given if w not in chosen and w not in against]
    voters += [w for w in ranked if w not in voters]
    return voters, ranked + [w for w in voters if w not in chosen]


class LabelModel:
    """Two classes; each voter fires with a probability by class; voters that still go
    together within a class share their weight. A voter that doesn't fire abstains: that
    no voter fires at all is the only silence that counts."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, known: np.ndarray):
        """``votes``: patterns by voters, 0 or 1; ``counts``: texts with the pattern;
        ``known``: labelled texts with the pattern, not toxic and toxic."""
        share = np.clip(1 - 0.1 ** votes[:, :LEXICAL].sum(axis=1), 0.02, 0.98)
        self.quiet = votes.sum(axis=1) == 0
        self.none = np.zeros(2)
        for _ in range(ROUNDS):
            toxic = share * np.maximum(counts - known.sum(axis=1), 0) + known[:, 1]
            other = (1 - share) * np.maximum(counts - known.sum(axis=1), 0) + known[:, 0]
            self.rates = np.stack([(w @ votes + 0.5 * base) / (w.sum() + 0.5) for w, base in ((other, 0.02), (toxic, 0.5))])
            self.rates = np.clip(self.rates, 1e-6, 1 - 1e-6)
            self.none = np.array([(w[self.quiet].sum() + 0.5) / (w.sum() + 1) for w in (other, toxic)])
            self.prior = float(np.clip((toxic.sum() + 0.5) / (counts.sum() + 1), 1e-4, 0.9))
            self.correlations = self._residual(votes, (other, toxic))
            self.weights = 1 / (1 + np.clip(self.correlations, 0, 1).sum(axis=1) - np.diag(self.correlations).clip(0, 1))
            share = self.posterior(votes)
        self.accuracy = self.rates[1] * self.prior / (self.rates[1] * self.prior + self.rates[0] * (1 - self.prior))

    def _residual(self, votes: np.ndarray, classes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Correlation of each pair of voters within the classes, the larger class share counting more."""
        out = np.zeros((votes.shape[1],) * 2)
        for w in classes:
            d = votes - w @ votes / max(w.sum(), 1e-9)
            spread = np.sqrt((w[:, None] * d * d).sum(axis=0))
            spread[spread < 1e-6] = np.inf  # a voter that never changes goes together with none
            out += (d * w[:, None]).T @ d / np.outer(spread, spread) * (w.sum() / sum(c.sum() for c in classes))
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fires = np.maximum(np.log(self.rates[1] / self.rates[0]), 0)
        silent = min(float(np.log(self.none[1] / self.none[0])), 0.0)
        odds = np.log(self.prior / (1 - self.prior)) + (votes * fires) @ self.weights + silent * (votes.sum(axis=1) == 0)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def bits(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] >> np.arange(VOTERS) & 1).astype(float)


def train(inputs: np.ndarray, targets: np.ndarray, steps: int = 25, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels by Newton's steps; both classes weigh alike."""
    x = np.column_stack([inputs, np.ones(len(inputs))]).astype(float)
    weight = targets / max(targets.sum(), 1e-9) + (1 - targets) / max((1 - targets).sum(), 1e-9)
    weight /= weight.sum()
    ridge = np.full(x.shape[1], decay)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (weight * (targets - p)) - ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return w[:-1], float(w[-1])


FEATURES = T.StructType([T.StructField("__votes", T.LongType()),
                         T.StructField("__words", T.ArrayType(T.IntegerType()))])


@dataclass
class Classifier:
    """A linear classifier over votes and vocabulary entries."""

    voters: list[str]
    vocabulary: list[str]
    weights: list[float]
    constant: float

    def each(self) -> Voters:
        return Voters(self.voters, self.vocabulary)

    def odds(self, votes: int, words: list[int]) -> float:
        fired = sum(w for i, w in enumerate(self.weights[:VOTERS]) if votes >> i & 1)
        return self.constant + fired + sum(self.weights[VOTERS + k] for k in words)


def fit(df: DataFrame, labels: DataFrame, train_on: DataFrame, text: str = "text") -> tuple[Classifier, DataFrame]:
    """The classifier, and ``df`` without its texts with their votes and entries (FEATURES)."""
    ship(df.sparkSession)
    texts = train_on.select("doc_id", "text")
    labelled = cut(sample(texts, labels), "toxicity-sample")
    # Only texts that may have a label are shuffled; a merge at every size, as labels grow with the texts.
    known = cut(known_labels(labels), "toxicity-labels")
    voters, vocabulary = lexicon_of(maybe_in(texts, known, "doc_id").join(known.hint("merge"), "doc_id"))
    made = Classifier(voters, vocabulary, [0.0] * (VOTERS + len(vocabulary)), -2.0)

    def make():
        each = made.each()
        return lambda texts: map(each, texts)

    featured = cut(add_columns(df, [text], FEATURES, make).drop(text), "toxicity")
    counted = featured.groupBy("__votes").agg(F.count(F.lit(1)).alias("n")).toArrow()  # 2 ** VOTERS rows at most
    counted = dict(zip(counted["__votes"].to_pylist(), counted["n"].to_pylist()))
    # SAMPLE rows at most, as columns.
    rows = add_columns(labelled, ["text"], FEATURES, make).select("__votes", "__words", "toxic").toArrow()
    known: dict[int, list[float]] = {}
    for p, toxic in zip(rows["__votes"].to_pylist(), rows["toxic"].to_pylist()):
        known.setdefault(p, [0.0, 0.0])[toxic] += 1
    patterns = sorted(counted.keys() | known.keys())
    if not patterns:
        return made, featured
    at = {p: i for i, p in enumerate(patterns)}
    counts, labelled_counts = np.zeros(len(patterns)), np.zeros((len(patterns), 2))
    for p, n in counted.items():
        counts[at[p]] = n
    for p, c in known.items():
        labelled_counts[at[p]] = c
    votes = bits(np.array(patterns, np.int64))
    posterior = LabelModel(votes, np.maximum(counts, labelled_counts.sum(axis=1)), labelled_counts).posterior(votes)
    if len(rows):
        inputs = np.zeros((len(rows), VOTERS + len(vocabulary)), np.float32)
        place = [at[p] for p in rows["__votes"].to_pylist()]
        inputs[:, :VOTERS] = votes[place]
        words = rows["__words"].combine_chunks()
        inputs[np.repeat(np.arange(len(rows)), words.value_lengths()), VOTERS + words.flatten().to_numpy()] = 1
        targets = posterior[place]
    else:
        inputs, targets = np.pad(votes, ((0, 0), (0, len(vocabulary)))), posterior
    weights, constant = train(inputs, targets)
    return Classifier(voters, vocabulary, weights.tolist(), constant), featured


def score(df: DataFrame, labels: DataFrame, train_on: DataFrame, text: str = "text") -> DataFrame:
    """``df`` (with doc_id) without its texts, with score and predicted.

    ``train_on`` holds the documents (doc_id, text) whose labels may be learned from."""
    made, featured = fit(df, labels, train_on, text)
    table = F.array(*[F.lit(w) for w in made.weights])
    fired = F.aggregate(F.sequence(F.lit(0), F.lit(VOTERS - 1)), F.lit(made.constant), lambda a, i: a + F.when(
        F.getbit("__votes", i) == 1, F.get(table, i)).otherwise(0.0))
    total = F.aggregate("__words", fired, lambda a, k: a + F.get(table, k + VOTERS))
    return featured.withColumn("score", 1 / (1 + F.exp(-total))).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)).drop("__votes", "__words")


def reject(df: DataFrame, labels: DataFrame, train_on: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic. With a ``key``, a number that tells its rows apart and is the same
    whenever ``df`` is read, texts are looked through once and the toxic rows leave by their keys; without one,
    the classifier goes over the texts in a second pass."""
    if key is not None:
        rated = score(df.select(key, "doc_id", text), labels, train_on, text)
        return without(df, cut(rated.where("predicted = 1").select(key), "toxic"), key)
    made, _ = fit(df.select("doc_id", text), labels, train_on, text)

    def make():
        each = made.each()
        return lambda texts: ((made.odds(*each(t)) >= 0,) for t in texts)

    flagged = add_columns(df, [text], T.StructType([T.StructField("__toxic", T.BooleanType())]), make)
    return flagged.where("NOT __toxic").select(*[F.col(f"`{c}`") for c in df.columns])
