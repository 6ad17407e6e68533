"""Texts cut at single spaces and line ends, where byte-level pre-splitting cuts as well.

A space or newline that follows a character other than white space always starts a new
piece, so the chunks between such places are coded independently, and a worker can
remember them. A text in which white space follows white space is coded whole.

Pre-splitting also cuts between a letter and a run of punctuation. Where coding is dear, a
chunk that ends in such a run is put together from the chunk before the run and the run.
Texts come as a list or as an Arrow column; in a column each distinct chunk is looked up once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of a memory's generation, characters of a slice of texts, and bytes of a slice of a column.
MEMO, SLICE, COLUMN = 600_000, 1_000_000, 8 << 20
#: Marks of which up to three end a chunk apart from the letter before them, and what lies above the
#: letters that are letters in every version of Unicode.
MARKS, TAIL, LATER = ",.;:!?#*$%&", 3, "\u0250"


class Memory:
    """Results by string, in two generations: when the new one is full it replaces the old
    one, so strings in use stay and memory is bounded."""

    def __init__(self, make: Callable[[list[str]], list], most: int = MEMO):
        self.make, self.most = make, most
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def learn(self, strings: set[str]) -> Callable[[str], object]:
        """Makes what is missing and returns the lookup, good until the next call."""
        self.turn()
        return self.add(strings)

    def turn(self) -> None:
        """Starts a new generation if this one is full; until the next call, ``new`` keeps what it has."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}

    def add(self, strings: set[str]) -> Callable[[str], object]:
        """As :meth:`learn`, within this generation."""
        missing = strings.difference(self.new)
        if missing and self.old:
            again = [s for s in missing if s in self.old]
            self.new.update(zip(again, map(self.old.__getitem__, again)))
            missing = missing.difference(again)
        if missing:
            todo = list(missing)
            self.new.update(zip(todo, self.make(todo)))
        return self.new.__getitem__


    def rest(self) -> None:
        """Lets the old generation go, so that an idle worker keeps little."""
        self.old = {}


class Chunks:
    """``coder`` maps strings to their ids as bytes, each string on its own; if it is ``dear``,
    marks at the end of a chunk are coded apart. ``led`` may do so faster for strings that each begin
    with their only space or newline and end in no white space."""

    def __init__(self, coder: Callable[[list[str]], list[bytes]], most: int = MEMO, dear: bool = False,
                 led: Callable[[list[str]], list[bytes]] | None = None):
        self.coder, self.led, self.dear, self.memory = coder, led or coder, dear, Memory(self._make, most)
        self.tails: dict[str, bytes] = {}  # some 1,500 at most

    def _make(self, chunks: list[str]) -> list[bytes | bool]:
        """A chunk with a leading newline stands for itself, any other for itself after a space;
        False if white space would meet white space."""
        odd = {c for c in chunks if not c or c[-1].isspace()}
        parts = self._parted(chunks) if self.dear else {}
        plain = [c for c in chunks if c not in odd and c not in parts] if odd or parts else chunks
        coded = self.led([c if c[0] == "\n" else " " + c for c in plain])
        if not odd and not parts:
            return coded
        rest = iter(coded)
        return [False if c in odd else parts[c] if c in parts else next(rest) for c in chunks]

    def _parted(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of the chunks that end in marks after a letter, from those of the chunk before the marks,
        and of those that came to be known on the way."""
        stems = {}
        for c in chunks:
            if c and c[-1] in MARKS:
                stem = c.rstrip(MARKS)
                if stem and len(c) - len(stem) <= TAIL and stem[-1].isalpha() and stem[-1] < LATER:
                    stems[c] = stem
        if not stems:
            return {}
        new = {c[len(s):] for c, s in stems.items()}.difference(self.tails)
        self.tails.update(zip(new, self.coder(list(new))))
        asked = set(stems.values())
        get = self.memory.add(asked)
        found = {c: get(s) + self.tails[c[len(s):]] for c, s in stems.items()}
        return found | {c: get(c) for c in asked.intersection(chunks)}

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and (chars == 0 or chars + len(texts[end]) <= SLICE):
                chars += len(texts[end])
                end += 1
            out += self._slice(texts[start:end])
            start = end
        return out

    def _slice(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") for t in texts]
        first = [c.pop(0) for c in split]
        self.memory.turn()
        held = [list(map(self.memory.new.get, chunks)) for chunks in split]
        get = self.memory.add({c for h, chunks in zip(held, split) if None in h for c, ids in zip(chunks, h) if ids is None})
        out: list[bytes] = []
        whole = []
        for k, (head, h, chunks) in enumerate(zip(self.coder(first), held, split)):
            out.append(b"")
            if chunks and first[k] and first[k][-1].isspace():
                whole.append(k)
                continue
            try:
                out[k] = head + b"".join([get(c) if ids is None else ids for c, ids in zip(chunks, h)] if None in h else h)
            except TypeError:  # False among them
                whole.append(k)
        for k, ids in zip(whole, self.coder([texts[k] for k in whole])):
            out[k] = ids
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """As :meth:`encode`, of a column without nulls: Arrow cuts the texts and puts the ids together, and
        a chunk is looked up once in a slice, however often it occurs there."""
        texts = texts.cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // COLUMN)) + 1
        return [ids for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]) for ids in self._column(texts.slice(i, j - i))]

    def _column(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        starts = split.offsets.to_numpy()
        first = np.zeros(len(split.values), bool)
        first[starts[:-1]] = True
        heads = split.values.filter(pa.array(first)).to_pylist()
        rest = split.values.filter(pa.array(~first)).dictionary_encode()
        kinds = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.memory.turn()
        held = list(map(self.memory.new.get, kinds))
        get = self.memory.add({c for c, ids in zip(kinds, held) if ids is None})
        coded = [get(c) if ids is None else ids for c, ids in zip(kinds, held)]
        ids = pa.array([None if c is False else c for c in coded], pa.large_binary()).take(rest.indices)
        ends = starts - np.arange(len(starts))  # without the first chunks
        whole = {k for k, h in enumerate(heads) if ends[k] < ends[k + 1] and h and h[-1].isspace()}
        if ids.null_count:
            whole.update((np.searchsorted(ends, np.flatnonzero(ids.is_null()), "right") - 1).tolist())
        _, at, data = ids.buffers()
        at = np.frombuffer(at, np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        data = memoryview(data or b"")
        out = [head + data[i:j].tobytes() for head, i, j in zip(self.coder(heads), at, at[1:])]
        some = sorted(whole)
        for k, ids in zip(some, self.coder([texts[k].as_py() for k in some])):
            out[k] = ids
        return out
