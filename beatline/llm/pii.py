"""Personal data in texts by anchor expansion.

An Aho-Corasick automaton passes over each text once and finds anchors: at-signs, plus
signs, digits, scheme marks and the cues of identifiers. At each anchor a small
deterministic parser looks left and right, fixes the boundaries and validates what it
found (octets, check digits, lengths, domain labels). Matches of one kind do not overlap
and are taken leftmost first; a match that fails its validation is dropped whole.

Kinds, in the order used for ties: email, ip, card, phone (the base kinds), then url,
iban, ssn and secret (access keys and quoted tokens behind their cues).

Defined results: a null or empty text has no spans (masked: null stays null); offsets are
code points, ends exclusive; repeated rows get equal results; an empty table stays empty;
columns with the names of the new ones are replaced. Texts are read whole, in time linear
in their length.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import add_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn", "secret")
#: Kinds that masking replaces; a web address alone names nobody.
PRIVATE = tuple(k for k in KINDS if k != "url")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBER = re.compile(r"[0-9][ ().0-9-]+[0-9]")
HOST = re.compile(r"(?:[A-Za-z0-9-]+\.)*[A-Za-z0-9-]+(?::[0-9]{1,5})?(?:[/?#][^\s\"<>]*)?")
ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
QUOTED = re.compile(r"\s{0,3}[=:]\s{0,3}\"([0-9A-Za-z_+/=-]{16,}+)\"")
IBAN = re.compile(r"[:\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]){11,30})(?![0-9A-Za-z])")
SCHEMES = ("https", "http", "ftp")
IBAN_CUES = ("IBAN", "iban", "Iban")
#: In lower case, with one capital or one for each word, and in upper case.
SECRET_CUES = tuple(sorted({f(w) for w in ("token", "secret", "password", "api_key")
                            for f in (str.lower, str.capitalize, str.title, str.upper)}))
CUES = (*IBAN_CUES, "AKIA", *SECRET_CUES)


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, "digit")
    for w in ("@", "+", "://", *CUES):
        a.add_word(w, w)
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def octet(run: str) -> bool:
    short = run.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def emails(text: str, marks: list[int]) -> list[tuple[int, int]]:
    out, free = [], 0
    for p in marks:
        start = p
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < p and (m := DOMAIN.match(text, p + 1)):
            out.append((start, m.end()))
            free = m.end()
    return out


def phones(text: str, marks: list[int]) -> list[tuple[int, int]]:
    out = []
    for p in marks:
        if m := NUMBER.match(text, p + 1):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((p, m.end()))
    return out


def digit_runs(places: list[int]) -> list[tuple[int, int]]:
    runs, start, last = [], -1, -2
    for p in places:
        if p != last + 1:
            if start >= 0:
                runs.append((start, last + 1))
            start = p
        last = p
    if start >= 0:
        runs.append((start, last + 1))
    return runs


def addresses(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Four runs of digits with one dot between each."""
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            if all(octet(text[a:b]) for a, b in four):
                out.append((four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    return out


def groups(text: str, runs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Runs of digits joined by single spaces or hyphens."""
    out: list[list[tuple[int, int]]] = []
    for r in runs:
        if out and r[0] == out[-1][-1][1] + 1 and text[r[0] - 1] in " -":
            out[-1].append(r)
        else:
            out.append([r])
    return out


def cards(text: str, chains: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out = []
    for chain in chains:
        if 12 <= sum(b - a for a, b in chain) <= 19 and luhn("".join(text[a:b] for a, b in chain)):
            out.append((chain[0][0], chain[-1][1]))
    return out


def social_numbers(text: str, chains: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """ddd-dd-dddd with hyphens, none of the parts zero and no area that is never issued."""
    out = []
    for chain in chains:
        if [b - a for a, b in chain] == [3, 2, 4]:
            (a, b), (c, d), (e, f) = chain
            area = text[a:b]
            if (text[b] == text[d] == "-" and area not in ("000", "666") and area < "900"
                    and text[c:d] != "00" and text[e:f] != "0000"):
                out.append((a, f))
    return out


def urls(text: str, marks: list[int]) -> list[tuple[int, int]]:
    out, free = [], 0
    for p in marks:  # the place of "://"
        scheme = next((s for s in SCHEMES if text[max(free, p - len(s)):p].lower() == s), None)
        m = HOST.match(text, p + 3)
        if scheme and m:
            end = p + 3 + len(m[0].rstrip(".,;:!?)'\""))
            if end > p + 3:
                out.append((p - len(scheme), end))
                free = end
    return out


def ibans(text: str, marks: list[int]) -> list[tuple[int, int]]:
    """Behind the cue: letters and digits whose remainder by 97 is 1."""
    out, free = [], 0
    for p in marks:
        if p >= free and (m := IBAN.match(text, p)):
            plain = m[1].replace(" ", "")
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                out.append(m.span(1))
                free = m.end(1)
    return out


def secrets(text: str, keys: list[int], cues: list[int]) -> list[tuple[int, int]]:
    found = [m.span() for p in keys if (m := ACCESS_KEY.match(text, p))]
    found += [m.span(1) for p in cues if (m := QUOTED.match(text, p))]
    out, free = [], 0
    for a, b in sorted(found):
        if a >= free:
            out.append((a, b))
            free = b
    return out


class Finder:
    """All spans of a text, by start and then kind."""

    def __init__(self):
        self.anchors = automaton().iter

    def __call__(self, text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        digits: list[int] = []
        at: dict[str, list[int]] = {}
        for end, what in self.anchors(text):
            if what == "digit":
                digits.append(end)
            else:
                at.setdefault(what, []).append(end)
        if not digits and not at:
            return []
        runs = digit_runs(digits)
        chains = groups(text, runs)
        found = {
            "email": emails(text, at.get("@", [])), "ip": addresses(text, runs), "card": cards(text, chains),
            "phone": phones(text, at.get("+", [])), "url": urls(text, [e - 2 for e in at.get("://", [])]),
            "iban": ibans(text, sorted(e + 1 for c in IBAN_CUES for e in at.get(c, []))),
            "ssn": social_numbers(text, chains),
            "secret": secrets(text, [e - 3 for e in at.get("AKIA", [])],
                              [e + 1 for c in SECRET_CUES for e in at.get(c, [])]),
        }
        order = {k: i for i, k in enumerate(KINDS)}
        return sorted(((k, a, b) for k, spans in found.items() for a, b in spans),
                      key=lambda s: (s[1], order[s[0]]))


def masked(text: str, spans: list[tuple[str, int, int]], kinds: tuple[str, ...] = PRIVATE) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in angle brackets."""
    out, free = [], 0
    merged: list[list] = []
    for k, a, b in spans:
        if k not in kinds:
            continue
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    for k, a, b in merged:
        out += [text[free:a], f"<{k.upper()}>"]
        free = b
    return "".join([*out, text[free:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def find(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds ``out``: an array of (kind, start, end)."""
    def make():
        finder = Finder()
        return lambda texts: (([{"kind": k, "start": a, "end": b} for k, a, b in finder(t)],) for t in texts)

    return add_columns(df, [text], T.StructType([T.StructField(out, SPANS)]), make)


def mask(df: DataFrame, text: str = "text", kinds: tuple[str, ...] = PRIVATE) -> DataFrame:
    """Replaces personal data in the column ``text``."""
    def make():
        finder = Finder()
        return lambda texts: ((None if t is None else masked(t, finder(t), kinds),) for t in texts)

    return add_columns(df, [text], T.StructType([T.StructField(text, T.StringType())]), make).select(
        *[F.col(f"`{c}`") for c in df.columns])


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(df: DataFrame) -> DataFrame:
    """The counts of the base kinds, the digest of their spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return df.select("doc_id", *[count(k) for k in BASE],
                     F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                     joined(F.col("spans")).alias("spans"))
