"""Quality rules that vote, weighed by what their agreement shows of them.

Each rule looks at one property of a text and votes good (+1), bad (-1) or abstains (0).
No labels are used: expectation-maximisation over the counts of all vote patterns
estimates for both classes how often each rule votes how, and a text is kept if the
posterior probability of good, given all votes, is at least one half. The rules vote
independently within a class. There are 3 ** 10 patterns (ten rules) at most, so the table
of their counts has a fixed bound, whatever the number of texts.

Defined results: a null or empty text has no words, so all its counts are zero and it is
not kept; repeated rows get equal results; an empty table stays empty; columns with the
names of the new ones are replaced.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_columns, cut

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
#: Common short words of several languages, lower case (a fixed list).
STOP_WORDS = frozenset(
    b"the of and to in a is that for on with as be it was are at by this from or an "
    b"der die das und den von zu mit sich des auf ist im dem nicht ein eine "
    b"le la les et des en un une du que est pour dans qui par plus avec au "
    b"el los las del y por con se no una su para al es".split())

MEASURES = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_marks", "n_upper", "n_letters", "n_stop_words", "n_top_word")])
#: Iterations of the estimation, and the counts that each class and vote starts with.
ROUNDS, PRIOR = 60, 1.0


def measures(text: str | None) -> tuple[int, ...]:
    """The numbers that the rules look at, in the order of MEASURES. Letters are ASCII letters
    and all code points beyond ASCII; capitals are ASCII ones."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    points = int(byte.sum() - byte[0x80:0xC0].sum())
    symbols = sum(int(byte[ord(c)]) for c in SYMBOLS)
    capitals = int(byte[65:91].sum())
    letters = capitals + int(byte[97:123].sum()) + int(byte[0xC0:].sum())
    blanks = sum(int(byte[ord(c)]) for c in BLANKS)
    lines = [ln for ln in data.split(b"\n") if ln.strip()]
    seen = Counter(words)
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        covered = bytearray(n)
        for i, t in enumerate(triples):
            if times[t] > 1:
                covered[i:i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return (n, points - blanks, symbols, len(lines) - len(set(lines)), repeated, len(lines),
            int(byte[ord("!")]), capitals, letters, sum(seen[w] for w in STOP_WORDS.intersection(seen)),
            max(seen.values(), default=0))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of MEASURES."""
    return add_columns(df, [text], MEASURES, lambda: lambda texts: map(measures, texts))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules as columns over MEASURES. A rule about shares abstains without words."""
    c = F.col
    n = F.greatest(c("n_words"), F.lit(1))
    any_words = c("n_words") > 0

    def share(part: Column, whole: Column, good: float, bad: float) -> Column:
        r = part / F.greatest(whole, F.lit(1))
        return F.when(any_words, _vote(r <= good, r > bad)).otherwise(0)

    length = c("word_chars") / n
    return {
        "length": _vote(c("n_words") >= 80, c("n_words") < 50),
        "word_length": F.when(any_words, _vote(length.between(3, 10), (length < 2.5) | (length > 12))).otherwise(0),
        "symbols": share(c("n_symbols"), n, 0.02, 0.1),
        "dup_lines": share(c("n_dup_lines"), c("n_lines"), 0.1, 0.3),
        "repeats": share(c("n_repeat_words"), n, 0.15, 0.3),
        "marks": share(c("n_marks"), n, 0.02, 0.1),
        "capitals": share(c("n_upper"), c("n_letters"), 0.15, 0.4),
        "letters": share(c("word_chars") - c("n_letters"), c("word_chars"), 0.1, 0.3),
        "top_word": share(c("n_top_word"), n, 0.15, 0.3),
        "stop_words": F.when(any_words, _vote(c("n_stop_words") / n >= 0.08, c("n_stop_words") / n < 0.02)).otherwise(0),
    }


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """The share of good texts and, by class (bad, good), rule and vote (-1, 0, 1), how often a
    text of the class gets the vote. Starts from the number of bad votes, as junk passes most
    rules and fails those made for its kind; good texts draw good votes: a rule that would
    say the opposite counts as undecided."""
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    good = np.array([0.95, 0.5, 0.05])[np.minimum((votes < 0).sum(axis=1), 2)]
    share, p = 0.5, np.zeros((2, votes.shape[1], 3))
    for _ in range(ROUNDS):
        for k, weight in enumerate(((1 - good) * counts, good * counts)):
            table = np.einsum("p,prv->rv", weight, hot) + PRIOR
            p[k] = table / table.sum(axis=1, keepdims=True)
        share = float((good * counts).sum() + PRIOR) / float(counts.sum() + 2 * PRIOR)
        good = posterior(votes, share, p)
    return share, p


def log_odds(p: np.ndarray) -> np.ndarray:
    """By rule and vote, the log odds of good against bad that the vote gives."""
    odds = np.log(p[1]) - np.log(p[0])
    odds[:, 0] = np.minimum(odds[:, 0], 0)
    odds[:, 2] = np.maximum(odds[:, 2], 0)
    return odds


def posterior(votes: np.ndarray, share: float, p: np.ndarray) -> np.ndarray:
    odds = log_odds(p)
    score = np.log(share / (1 - share)) + odds[np.arange(votes.shape[1]), votes + 1].sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def judge(measured: DataFrame) -> DataFrame:
    """Adds quality_probability to a table with the columns of MEASURES, which is read twice:
    for the counts of all vote patterns and for the result."""
    named = rules()
    patterns = measured.groupBy(*[v.alias(k) for k, v in named.items()]).agg(F.count(F.lit(1)).alias("texts"))
    found = patterns.collect()  # at most 3 rows to the power of the rules
    votes = np.array([r[:-1] for r in found], np.int64).reshape(len(found), len(named))
    share, p = estimate(votes, np.array([r[-1] for r in found], float))
    odds = log_odds(p)
    score = F.lit(float(np.log(share / (1 - share))))
    for k, vote in enumerate(named.values()):
        score = score + F.when(vote < 0, float(odds[k, 0])).when(vote > 0, float(odds[k, 2])).otherwise(float(odds[k, 1]))
    return measured.withColumn("quality_probability", 1 / (1 + F.exp(-score)))


def assess(df: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """``df`` without its texts, with MEASURES, base_failed, quality_probability and kept."""
    measured = cut(measure(df, text).drop(text), "quality")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judge(measured).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality_probability") >= least))
