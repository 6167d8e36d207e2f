"""Token ids in binary files of independent zstandard frames with a seek table.

A file holds one frame per document (its ids as little-endian unsigned 32-bit integers), a
skippable frame with the documents' ids, and as trailing skippable frame the seek table of the
public seekable format: compressed size, decompressed size and checksum of every frame before it.
A reader fetches the table from the file's end and decompresses the frames it wants.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shared_folder, ship, stored

END_ID = 1
#: Characters of text that go into one file, about.
FILE_CHARS = 32 << 20
#: Words whose ids a Python worker remembers; beyond that, new words are encoded whenever they come.
WORDS_HELD = 1_200_000

# Fixed values of the seekable zstandard format.
SKIPPABLE, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_FOOTER = struct.Struct("<IBI")


class Encoder:
    """Whole texts to packed ids. The ids of a word are looked up once and remembered.

    The tokenizer's own splitting never crosses ASCII white space, so the ids of a text are those
    of its words in order.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        end, known = struct.pack("<I", END_ID), self.known
        split = [_plain((text or "").encode("utf-8", "replace")).split() for text in texts]
        packed = [list(map(known.get, words)) for words in split]
        part = [i for i, ids in enumerate(packed) if None in ids]
        new = list({w for i in part for w, ids in zip(split[i], packed[i]) if ids is None})
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)
        fresh = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(new, found)}
        for i in part:
            packed[i] = [fresh[w] if ids is None else ids for w, ids in zip(split[i], packed[i])]
        if len(known) + len(fresh) <= WORDS_HELD:
            known.update(fresh)
        return [b"".join([*ids, end]) for ids in packed]


def _plain(raw: bytes) -> bytes:
    """In lower case as far as ASCII goes, which the tokenizer does anyway; it looks for special tokens before."""
    return raw if b"<|" in raw else raw.lower()


@lru_cache(1)
def encoder(vocabulary: str) -> Encoder:
    """One per Python worker, so that its tasks share what it remembers."""
    return Encoder(vocabulary)


def write_file(out, rows: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write ``(document id, packed ids)`` rows to the open file ``out``: numbers of documents and ids."""
    press = zstandard.ZstdCompressor(level=1)
    entries, ids, known = [], [], []
    for doc_id, packed in rows:
        frame = press.compress(packed)
        out.write(frame)
        entries.append((len(frame), len(packed), xxhash.xxh64_intdigest(packed) & 0xFFFFFFFF))
        ids.append(doc_id or 0)
        known.append(doc_id is not None)
    names = np.array(ids, "<i8").tobytes() + np.array(known, np.uint8).tobytes()
    out.write(struct.pack("<II", SKIPPABLE, len(names)) + names)
    entries.append((len(names) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
    table = np.array(entries, _ENTRY).tobytes() + _FOOTER.pack(len(entries), 0x80, FOOTER_MAGIC)
    out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
    return len(ids), sum(e[1] for e in entries) // 4


class SeekableFile:
    """Random access to the documents of one file; ``source`` can seek and read."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, os.SEEK_END) or source.tell()
        source.seek(size - _FOOTER.size)
        frames, flags, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end")
        source.seek(size - _FOOTER.size - frames * _ENTRY.itemsize)
        self.entries = np.frombuffer(source.read(frames * _ENTRY.itemsize), _ENTRY)
        self.starts = np.concatenate([[0], self.entries["packed"].astype(np.int64).cumsum()])
        n = frames - 1
        source.seek(int(self.starts[n]) + 8)
        names = source.read(9 * n)
        known = np.frombuffer(names, np.uint8, n, 8 * n)
        self.doc_ids = [int(i) if k else None for i, k in zip(np.frombuffer(names, "<i8", n), known)]

    def document(self, i: int) -> bytes:
        """The packed ids of the i-th document, whose checksum must agree."""
        self.source.seek(int(self.starts[i]))
        packed, size, check = (int(x) for x in self.entries[i])
        out = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size) if size else b""
        if xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {i} differs")
        return out


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` as a URI; one without a scheme is on the session's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, file_chars: int = FILE_CHARS) -> DataFrame:
    """Write ``docs(doc_id, text)`` in ascending doc_id order to files under ``folder``; their list.

    The list has ``file_no, path, n_docs, n_tokens``, in document order by file_no. ``folder`` is a
    URI that driver and executors share; ``vocabulary`` is a tokenizer file that every machine has.
    A task writes under a name of its own and renames when done, so a repeated or speculative task
    does no harm. Null doc_ids come last; ties are in order of the text's hash. Null and empty texts
    have the end id alone.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    dealt = rows.repartitionByRange(max(1, -(-chars // file_chars)), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encode = TaskContext.get(), encoder(vocabulary).encode
        store, base = _open(folder)
        number = context.partitionId()
        draft, final = f"{base}/.draft-{number}-{context.taskAttemptId()}-{uuid.uuid4().hex}", f"{base}/tokens-{number:06d}.zst"
        store.create_dir(base, recursive=True)

        def encoded() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()))

        with store.open_output_stream(draft) as out:
            n_docs, n_tokens = write_file(out, encoded())
        if store.get_file_info(final).type == fs.FileType.NotFound:
            store.move(draft, final)
        else:  # an attempt before this one got as far as this; what it wrote is the same
            store.delete_file(draft)
        yield pa.record_batch(
            [pa.array([number], pa.int64()), pa.array([f"{folder}/{final.rsplit('/', 1)[1]}"]), pa.array([n_docs], pa.int64()), pa.array([n_tokens], pa.int64())],
            ["file_no", "path", "n_docs", "n_tokens"],
        )

    return stored(dealt.mapInArrow(write, "file_no long, path string, n_docs long, n_tokens long"))


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a list.

    Every frame is decompressed and checked. Offsets of files add up over the list, a row per file.
    """
    before = F.sum("n_tokens").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    listed = files.withColumn("before", F.coalesce(before, F.lit(0))).where("n_docs > 0")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = _open(path)
                ids, starts, sizes, sums = [], [], [], []
                with store.open_input_file(name) as source:
                    file = SeekableFile(source)
                    for i, doc_id in enumerate(file.doc_ids):
                        packed = file.document(i)
                        ids.append(doc_id)
                        starts.append(start)
                        sizes.append(len(packed) // 4)
                        sums.append(zlib.crc32(packed))
                        start += sizes[-1]
                yield pa.record_batch([pa.array(x, pa.int64()) for x in (ids, starts, sizes, sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a given number of partitions isn't merged into fewer: a task per file or so, not one for all
    spread = listed.select("path", "before").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = qualified(spark, f"{shared_folder(spark)}/tablespoon/{uuid.uuid4().hex}")
    docs = documents(spark, sf_dir)
    return read_tokens(write_tokens(docs, folder, str(public_tokenizers.path("word_bpe_49k.json"))))
