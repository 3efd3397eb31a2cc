"""Token ids of documents in seekable files.

Documents are encoded in ascending ``doc_id`` order, an end id closes each. A file holds little-endian
unsigned 32-bit ids in independent zstandard frames of at most ``FRAME_IDS`` ids, each with its own
checksum, followed by the seek table of the public zstd seekable format (a skippable frame with the
compressed size, raw size and XXH64 checksum of every frame). A reader fetches the table from the
file's end and decompresses only the frames that hold the documents it wants.

Spark range-partitions and sorts the documents; each task writes one file, under a name of its own first
and then moved into place, so a task that runs again leaves the same file. Files of the shared folder are
reached through pyarrow's file systems, by the folder's URI.

Defined results: NULL and empty texts give the end id alone; rows with NULL doc_id come first; repeated
doc_ids are ordered by text hash, so equal rows are interchangeable; an empty table writes empty files
and gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.storage import new_dir

from .common import named, staged

END_ID = 2
FRAME_IDS = 1 << 16
#: Pieces of text that one Python worker keeps with their ids; later ones are encoded each time.
CACHED_PIECES = 1_000_000
#: New pieces that the library gets at once, and characters of texts cut into pieces at once.
LINES = 2000
TOGETHER = 1 << 20

# Fixed values of the public zstd seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Whole texts to id bytes with the tokenizers library.

    A byte-level BPE of this kind never joins what stands on both sides of a single white space character,
    or a letter or digit with the ASCII punctuation behind it. A text is cut there, and each distinct piece
    is encoded once; new pieces go to the library together, a line each. A text with two white space
    characters in a row, or with what may be a special token, goes through the library whole.
    """

    _whole = re.compile("[\\s\u180e\u200b\u2060\ufeff]{2}|<\\|")
    _piece = re.compile(r" ?[A-Za-z0-9À-ÖØ-öø-ÿ]+(?=[ \t-\r!-/:-@\[-`{-~]|\Z)| ?[^ \t-\r]+|[ \t-\r]")
    _plain = re.compile(" ?[^\\s\u180e\u200b\u2060\ufeff]+").fullmatch

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[str, bytes] = {}
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        lines = [p for p in pieces if self._plain(p)]
        out = dict(zip(rest := [p for p in pieces if not self._plain(p)], self._ids(rest)))
        for i in range(0, len(lines), LINES):
            own = lines[i : i + LINES]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(own)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = [*(4 * np.flatnonzero(ids == self.newline)).tolist(), 4 * len(ids)]
            raw, start = ids.tobytes(), 0
            for p, end in zip(own, ends, strict=True):
                out[p] = raw[start:end]
                start = end + 4
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; new pieces of ``TOGETHER`` characters of texts go to the library at once."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= TOGETHER:
                out += self._encode(group)
                group, size = [], 0
        return out + list(self._encode(group))

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        kept, find = self.kept, self._piece.findall
        found = [None if self._whole.search(text) else find(text) for text in texts]
        more = self._new(list(set(chain.from_iterable(p for p in found if p)).difference(kept)))
        if len(kept) < CACHED_PIECES:
            kept.update(more)
            more = {}
        for text, pieces in zip(texts, found):
            if pieces is None:
                yield self._ids([text])[0]
            elif more:
                yield b"".join([kept[p] if p in kept else more[p] for p in pieces])
            else:
                yield b"".join(map(kept.__getitem__, pieces))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class FrameWriter:
    """Cuts a stream of id bytes into frames and closes the file with the seek table."""

    def __init__(self, sink, level: int = 3):
        import zstandard

        self.sink, self.buffer, self.table = sink, bytearray(), bytearray()
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def write(self, data: bytes) -> None:
        self.buffer += data
        size = 4 * FRAME_IDS
        if len(self.buffer) >= size:
            view = bytes(self.buffer)
            whole = len(view) // size * size
            for at in range(0, whole, size):
                self._frame(view[at : at + size])
            self.buffer = bytearray(view[whole:])

    def _frame(self, raw: bytes) -> None:
        import xxhash

        packed = self.compressor.compress(raw)
        self.sink.write(packed)
        self.table += struct.pack("<III", len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)

    def close(self) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        footer = struct.pack("<IBI", len(self.table) // 12, CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(self.table) + len(footer)) + self.table + footer)


class FrameReader:
    """Reads any range of ids from an open random-access file, a frame at a time."""

    def __init__(self, source):
        import zstandard

        self.source = source
        end = source.size()
        frames, flag, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._at(end - 9 - 12 * frames, 12 * frames)
        self.entries = list(struct.iter_unpack("<III", table))
        self.raw_at, self.packed_at = [0], [0]
        for packed, raw, _ in self.entries:
            self.packed_at.append(self.packed_at[-1] + packed)
            self.raw_at.append(self.raw_at[-1] + raw)
        self.decompressor = zstandard.ZstdDecompressor()
        self.frames_read, self._last = 0, (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def _frame(self, i: int) -> bytes:
        import xxhash

        if self._last[0] != i:
            packed, size, check = self.entries[i]
            raw = self.decompressor.decompress(self._at(self.packed_at[i], packed), max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {i} is damaged")
            self.frames_read += 1
            self._last = (i, raw)
        return self._last[1]

    def chunks(self, start: int, count: int) -> Iterator[bytes]:
        """Bytes of ``count`` ids from id ``start`` on, in pieces of a frame at most."""
        at, end = 4 * start, 4 * (start + count)
        if end > self.raw_at[-1]:
            raise ValueError("the file holds fewer ids")
        while at < end:
            i = bisect_right(self.raw_at, at) - 1
            raw = self._frame(i)
            stop = min(end, self.raw_at[i + 1])
            yield raw[at - self.raw_at[i] : stop - self.raw_at[i]]
            at = stop


def _place(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """Write the files below ``folder``; returns the index (doc_id, file, first, n_tokens), staged."""
    tokenizer = tokenizer or default_tokenizer()
    store, root = _place(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        place, base = _place(folder)
        own = f"{base}/.{number}-{uuid.uuid4().hex}"
        tokens, first, end = encoder(tokenizer), 0, struct.pack("<I", END_ID)
        with place.open_output_stream(own) as sink:
            writer = FrameWriter(sink)
            for batch in batches:
                starts, counts = [], []
                for ids in tokens.encode([t or "" for t in batch.column(1).to_pylist()]):
                    writer.write(ids)
                    writer.write(end)
                    starts.append(first)
                    counts.append(len(ids) // 4 + 1)
                    first += counts[-1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([number] * len(starts), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())],
                    names=["doc_id", "file", "first", "n_tokens"],
                )
            writer.close()
        place.move(own, f"{base}/{number:06d}.zst")

    ordered = (
        docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .select("doc_id", "text")
    )
    kind = ordered.schema["doc_id"].dataType.simpleString()
    return staged(ordered.mapInArrow(write, f"doc_id {kind}, file int, first long, n_tokens long"), "token-index")


def read_tokens(index: DataFrame, folder: str) -> DataFrame:
    """Per row of the index: doc_id, start among all ids, n_tokens and the CRC-32 of the ids read from the files.

    Only one total per file comes to the driver.
    """
    totals = sorted(index.groupBy("file").agg(F.sum("n_tokens")).collect())
    before, offsets = 0, {}
    for number, total in totals:
        offsets[number] = before
        before += total

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, base = _place(folder)
        number, reader = None, None
        for batch in batches:
            starts, sums = [], []
            for file, first, count in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if file != number:
                    number, reader = file, FrameReader(place.open_input_file(f"{base}/{file:06d}.zst"))
                crc = 0
                for chunk in reader.chunks(first, count):
                    crc = zlib.crc32(chunk, crc)
                starts.append(offsets[file] + first)
                sums.append(crc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts, pa.int64()), batch.column(3), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    kind = index.schema["doc_id"].dataType.simpleString()
    return index.mapInArrow(read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    return new_dir(spark, "tokens")
