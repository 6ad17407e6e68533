"""Token ids as binary files of independent zstandard frames with a trailing seek table.

A file holds the documents of one range of ids, ascending: frames of at most
``FRAME_IDS`` little-endian unsigned 32-bit ids (a frame holds whole documents; only a
longer document has several frames of its own), a skippable frame with the index of the
documents, and last a skippable frame with the seek table in zstandard's seekable layout:
compressed size, size and checksum (low half of XXH64) of each frame. A reader fetches
table and index from the end and then decompresses only the frames it needs; any
zstandard decoder reads the ids of the whole file.

Defined results: a null text counts as empty; each document ends with the end id, so an
empty one holds that id alone; a null doc_id sorts first and is kept as null; repeated
doc_ids are separate documents; an empty table gives no file and an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from beatline.llm.chunks import Chunks
from beatline.llm.common import ship

FRAME_IDS = 1 << 18
#: Strings coded in one call of the library, and those that need no token between them; chunks of a generation
#: that a worker remembers.
JOINT, LED, MEMO = 64, 32, 600_000
#: Fixed values of the seekable zstandard layout: skippable frames and the table's end mark.
INDEX_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80

_LOADED: dict[str, Chunks] = {}


def coder(path: str) -> Chunks:
    """The library's tokenizer, read once in each Python worker, with a memory of chunks.

    Strings are coded many at a time, joined by a special token, at which the library cuts
    a text before all else; a string that holds that token is coded alone. Strings that begin with
    their only space or newline need none: each is cut off where an id begins with one."""
    if path in _LOADED:
        return _LOADED[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    mark, mark_id = next(((t.content, i) for i, t in tok.get_added_tokens_decoder().items()
                          if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)), (None, -1))

    def ids_of(text: str) -> np.ndarray:
        return np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def code(strings: list[str]) -> list[bytes]:
        alone = {i for i, s in enumerate(strings) if mark is None or mark in s}
        joint = [s for i, s in enumerate(strings) if i not in alone] if alone else strings
        out: list[bytes] = []
        for i in range(0, len(joint), JOINT):
            ids = ids_of(mark.join(joint[i:i + JOINT]))
            data, cuts = ids.tobytes(), 4 * np.flatnonzero(ids == mark_id)
            out += [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)])]
        if not alone:
            return out
        rest = iter(out)
        return [ids_of(s).tobytes() if i in alone else next(rest) for i, s in enumerate(strings)]

    blank = np.zeros(max(tok.get_vocab(with_added_tokens=True).values()) + 1, bool)
    blank[[i for t, i in tok.get_vocab(with_added_tokens=False).items() if t[0] in "ĠĊ"]] = True
    plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized or " " in t.content or "\n" in t.content
                    for t in tok.get_added_tokens_decoder().values())

    def led(strings: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(strings), LED):
            ids = ids_of("".join(strings[i:i + LED]))
            data, cuts = ids.tobytes(), (4 * np.flatnonzero(blank[ids])).tolist()
            out += [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]
        return out

    _LOADED[path] = Chunks(code, MEMO, dear=True, led=led if plain else None)
    return _LOADED[path]


def at(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pyarrow.fs.LocalFileSystem(), uri)


class TokenFileWriter:
    """Writes one file: documents come in, a frame goes out when it is full."""

    def __init__(self, out, level: int = 3, frame_ids: int = FRAME_IDS):
        self.out, self.most = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int] = []
        self.valid: list[bool] = []
        self.sizes: list[int] = []
        self.parts: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id or 0)
        self.valid.append(doc_id is not None)
        self.sizes.append(len(ids) // 4)
        if self.held and self.held + len(ids) > 4 * self.most:
            self.flush()
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= 4 * self.most:
            self.flush()

    def flush(self) -> None:
        data = memoryview(b"".join(self.parts))
        for i in range(0, len(data), 4 * self.most):
            raw = data[i:i + 4 * self.most]
            packed = self.zstd.compress(raw)
            self.out.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        index = self.zstd.compress(struct.pack("<Q", len(self.docs)) + np.array(self.docs, "<i8").tobytes()
                                   + np.array(self.valid, "u1").tobytes() + np.array(self.sizes, "<u8").tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        # The index's length stands before the table's entries, so the end leads to both.
        table += struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, END_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class TokenFile:
    """Reads one file; ``source`` is seekable."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != END_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        source.seek(end - 9 - 12 * n)
        entries = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.firsts = np.concatenate([[0], np.cumsum(entries[:, 1])]) // 4
        self.checksums = entries[:, 2]
        source.seek(int(self.starts[-1]))
        magic, size = struct.unpack("<II", source.read(8))
        if magic != INDEX_MAGIC:
            raise ValueError("no index of documents before the seek table")
        index = zstandard.ZstdDecompressor().decompress(source.read(size))
        (k,) = struct.unpack_from("<Q", index)
        self.doc_ids = np.frombuffer(index, "<i8", k, 8)
        self.valid = np.frombuffer(index, "u1", k, 8 + 8 * k).astype(bool)
        self.sizes = np.frombuffer(index, "<u8", k, 8 + 9 * k).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.cached = (-1, b"")

    def frame(self, k: int) -> bytes:
        """Frame ``k``, decompressed and held against its checksum."""
        if self.cached[0] != k:
            self.source.seek(int(self.starts[k]))
            packed = self.source.read(int(self.starts[k + 1] - self.starts[k]))
            raw = zstandard.ZstdDecompressor().decompress(packed)
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[k]:
                raise ValueError(f"checksum of frame {k} does not match")
            self.cached = (k, raw)
        return self.cached[1]

    def ids(self, i: int) -> bytes:
        """The ids of the ``i``-th document."""
        lo, hi = int(self.offsets[i]), int(self.offsets[i + 1])
        k, parts = int(np.searchsorted(self.firsts, lo, "right")) - 1, []
        while lo < hi:
            stop = min(hi, int(self.firsts[k + 1]))
            base = int(self.firsts[k])
            parts.append(self.frame(k)[4 * (lo - base):4 * (stop - base)])
            lo, k = stop, k + 1
        return b"".join(parts)


def write(df: DataFrame, folder: str, path: str, end_id: int = 0, doc_id: str = "doc_id",
          text: str = "text", level: int = 3) -> DataFrame:
    """Writes the documents, ascending by id, as token files in ``folder`` and returns the list
    of files (part, file, n_docs, n_ids), which is a Parquet table in the same folder.

    One range partition and one file a task; a file appears under its name only when it is
    whole, so a task that is run again replaces it by the same bytes."""
    spark = df.sparkSession
    ship(spark)
    end = np.array([end_id], "<u4").tobytes()
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    # Rows of one id may be many: their place in the input deals them out as well.
    docs = docs.withColumn("tie", F.monotonically_increasing_id())
    docs = docs.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, writer = coder(path), None
        part = TaskContext.get().partitionId()
        fs, root = at(folder)
        name = f"part-{part:06d}.ids.zst"
        temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
        for b in batches:
            if writer is None and b.num_rows:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(temporary)
                writer = TokenFileWriter(out, level)
            for d, coded in zip(b.column(0).to_pylist(), chunks.encode_column(b.column(1).fill_null(""))):
                writer.add(d, coded + end)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(temporary, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"],
                "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([sum(writer.sizes)], pa.int64())})

    listed = f"{folder}/_files"
    docs.mapInArrow(run, "part int, file string, n_docs long, n_ids long").write.parquet(listed)
    return spark.read.schema("part int, file string, n_docs long, n_ids long").parquet(listed)


def read(files: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (little-endian 32-bit integers) of the
    documents in the files, or of the ``wanted`` ids alone, of which only the frames are read."""
    spark: SparkSession = files.sparkSession
    ship(spark)
    only = None if wanted is None else np.array(sorted(set(wanted)), np.int64)
    n = max(1, files.count())
    # One row a file, so the running sum over all of them is a small one.
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    listed = files.select("part", "file", F.coalesce(before, F.lit(0)).alias("base")).repartitionByRange(n, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, base in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                fs, name = at(file)
                with fs.open_input_file(name) as source:
                    f = TokenFile(source)
                    pick = np.arange(len(f.sizes))
                    if only is not None:
                        pick = pick[f.valid & np.isin(f.doc_ids, only)]
                    for i in range(0, len(pick), 256):
                        k = pick[i:i + 256]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(f.doc_ids[k], mask=~f.valid[k]),
                            "start": pa.array(base + f.offsets[k]),
                            "ids": pa.array([f.ids(int(x)) for x in k], pa.binary())})

    return listed.mapInArrow(run, "doc_id long, start long, ids binary")
