"""Token files: one Zstandard frame per document, a document table and a trailing seek table.

Layout of a file (all numbers little-endian):

    data frames     one independent zstd frame per document, in ascending doc_id order;
                    its content is the document's ids as u16 (u32 if the vocabulary needs it)
    document table  skippable frame (magic 0x184D2A50): b"TOKD", version u8, id width u8,
                    count u64, then per document doc_id i64 and a byte, 1 if doc_id is NULL
    seek table      skippable frame (magic 0x184D2A5E) of the public Zstandard seekable format:
                    per data frame compressed size u32, content size u32 and the low 32 bits of
                    the content's XXH64; then frame count u32, descriptor u8 (0x80), 0x8F92EAB1

Any zstd reader decodes the whole file; a reader of this module seeks to a
document's frame, decompresses it alone and checks it.

Writing: documents are dealt by ranges of doc_id, sorted inside each range,
encoded and written by the task that holds the range. Every attempt of a task
writes a file of its own name, and only the files of attempts that Spark took
are in the manifest, so lost executors leave at most files that nobody reads.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm import flat
from statloom.llm.shared import Tables, text_groups

DOC_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Bytes of text in one file.
FILE_BYTES = 128 << 20
#: Encoded words remembered by a Python worker; beyond it the memory starts anew.
REMEMBERED_WORDS = 400_000
ZSTD_LEVEL = 1

#: Words that the tokenizer's split rule cuts like this pattern, and whose lower case needs no normaliser:
#: ASCII without the apostrophe, and Latin-1 letters.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_SIGNS = bytes(c for c in range(0x21, 0x7F) if c not in _ALNUM and c != 0x27)
#: Words are cut between letters or digits and signs too, and A-Z count as a-z.
CUT_WORDS = flat.word_rule(flat.ASCII_SPACE, lower=True, kinds=(_ALNUM, _SIGNS))


class WordEncoder:
    """Ids of texts by a ``tokenizers`` file, each distinct word encoded once.

    Words are cut at ASCII white space, so the tokenizer must treat white space
    as a plain separator. If it also cuts between letters or digits and signs
    and lower-cases A-Z, words are cut there and lower-cased first: such parts
    repeat more often. Plain words are cut further into the pieces that the
    tokenizer's merges work on; the library encodes those. All other words go
    to the library whole. Probe texts check on load what the tokenizer does;
    blocks with a special token's brackets in them are cut at white space only.
    """

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(config)
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.memory: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        if self._whole(["An a\tb,\n\nc's  9"])[0] != b"".join(self._whole(["An", "a", "b,", "c's", "9"])):
            raise ValueError("the tokenizer does not treat white space as a plain separator")
        letters = [chr(c) for c in range(0xDF, 0x100)]
        self.letters = {ord(c): "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
        probes = ["Ab12cD,.x!é", "ÀÉß7ÿ--Zz", "(a)_b[9]9", "#Über%%5é"]
        self.merges = self.tokenizer.model.tokenize
        self.by_piece = True
        self.by_piece = [self._word(w) for w in probes] == self._whole(probes)

    @property
    def width(self) -> int:
        return array(self.kind).itemsize

    def _whole(self, words: list[str]) -> list[bytes]:
        """Ids of words by the library, as packed numbers."""
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _word(self, word: str) -> bytes | None:
        """Ids of a plain word from its pieces; None if it has to go to the library whole."""
        if self.by_piece and word.isascii() and word.isalpha():
            return array(self.kind, [t.id for t in self.merges(word.lower())]).tobytes()
        if not (self.by_piece and _PLAIN.fullmatch(word)) or "<|" in word:
            return None
        return b"".join([self.pieces.get(p) or self._piece(p) for p in _PIECES.findall(word.lower())])

    def _piece(self, piece: str) -> bytes:
        # the letters that the tokenizer's merges work on stand for bytes
        letters = piece if piece.isascii() else piece.translate(self.letters)
        ids = array(self.kind, [t.id for t in self.merges(letters)]).tobytes()
        if len(self.pieces) >= REMEMBERED_WORDS:
            self.pieces.clear()
        self.pieces[piece] = ids
        return ids

    def _learn(self, fresh: list[bytes]) -> None:
        """Encode words that are not in memory."""
        known, rest = self.memory, []
        for w in fresh:
            ids = self.older.get(w)
            if ids is None:
                ids = self._word(w.decode("utf-8"))
            if ids is None:
                rest.append(w)
            else:
                known[w] = ids
        for i in range(0, len(rest), 20_000):
            part = rest[i : i + 20_000]
            known.update(zip(part, self._whole([w.decode("utf-8") for w in part]), strict=True))

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a block, flat, and the texts' offsets in them. Each distinct word is looked up once."""
        raw, rule = buf.tobytes(), flat.SPACED
        if self.by_piece and b"<|" not in raw:
            raw, rule = raw.lower(), CUT_WORDS  # of bytes, this lowers A-Z only
        words = flat.find_words(buf, off, rule)
        if len(self.memory) > REMEMBERED_WORDS:  # words of the last stretch stay at hand
            self.memory, self.older = {}, self.memory
        _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
        known = self.memory
        distinct = [raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)]
        self._learn([w for w in distinct if w not in known])
        ids = [known[w] for w in distinct]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        store = np.frombuffer(b"".join(ids), f"<u{self.width}")
        count = size[which]
        end = np.concatenate([[0], np.cumsum(count)])
        # every token takes its place in the store: where its word's ids begin, and how far into the word it is
        place = np.repeat((np.cumsum(size) - size)[which] - end[:-1], count) + np.arange(end[-1])
        return store[place], end[words.row_first]


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(config: str) -> WordEncoder:
    key = hash(config)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(config)
    return _ENCODERS[key]


class FileWriter:
    """Writes one token file to a folder of any file system that pyarrow opens by URI."""

    def __init__(self, uri: str, width: int):
        import zstandard

        self.fs, path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        self.out = self.fs.open_output_stream(path)
        self.zstd = zstandard.ZstdCompressor(level=ZSTD_LEVEL, write_content_size=True)
        self.width, self.docs, self.seek = width, [], bytearray()
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.zstd.compress(ids)
        self.out.write(frame)
        self.docs.append(doc_id)
        self.seek += struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
        self.tokens += len(ids) // self.width

    def close(self) -> None:
        ids = np.array([d or 0 for d in self.docs], "<i8").tobytes()
        table = b"TOKD" + struct.pack("<BBQ", 1, self.width, len(self.docs)) + ids + bytes(d is None for d in self.docs)
        self.out.write(struct.pack("<II", DOC_MAGIC, len(table)) + table)
        footer = struct.pack("<IBI", len(self.docs), 0x80, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(self.seek) + len(footer)) + self.seek + footer)
        self.out.close()


class FileReader:
    """Random access to a token file: only the frames asked for are read and decompressed."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_FOOTER or flags != 0x80:
            raise ValueError(f"{uri}: no seek table")
        seek_at = size - 17 - 12 * count
        head = struct.unpack("<II", self.file.read_at(8, seek_at))
        if head != (SEEK_MAGIC, 12 * count + 9):
            raise ValueError(f"{uri}: bad seek table")
        self.table = np.frombuffer(self.file.read_at(12 * count, seek_at + 8), "<u4").reshape(-1, 3).astype(np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        docs = self.file.read_at(int(seek_at - self.offset[-1]), int(self.offset[-1]))
        magic, _, tag, version, self.width, n = struct.unpack_from("<II4sBBQ", docs)
        if (magic, tag, version, n) != (DOC_MAGIC, b"TOKD", 1, count):
            raise ValueError(f"{uri}: bad document table")
        ids, null = np.frombuffer(docs, "<i8", n, 22), np.frombuffer(docs, np.uint8, n, 22 + 8 * n)
        self.doc_ids = [None if x else i for i, x in zip(ids.tolist(), null.tolist(), strict=True)]
        self.sizes = self.table[:, 1] // self.width
        self.zstd = zstandard.ZstdDecompressor()

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the file, checked against its checksum."""
        import xxhash

        size, content, check = self.table[place].tolist()
        data = self.zstd.decompress(self.file.read_at(size, int(self.offset[place])), max_output_size=max(content, 1))
        if len(data) != content or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {place}: bad checksum")
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, doc_id: int | None) -> list[np.ndarray]:
        """Ids of every document with this doc_id."""
        return [self.ids(k) for k, d in enumerate(self.doc_ids) if d == doc_id]


_MANIFEST = "path string, first_doc long, n_docs long, n_tokens long"


def _write(config, folder: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = first = None
        for block in flat.blocks(batches):
            encoder = _encoder(config.value)
            if writer is None:
                task = TaskContext.get()
                path = f"{folder}/tokens-{task.partitionId():06d}-{task.taskAttemptId()}.tok"
                writer, first = FileWriter(path, encoder.width), block.column("doc_id")[0].as_py()
            end = array(encoder.kind, [end_id]).tobytes()
            ids, cuts = encoder.encode(*flat.text_buffer(block.column("text")))
            for doc_id, a, b in zip(block.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                writer.add(doc_id, ids[a:b].tobytes() + end)
        if writer is not None:
            writer.close()
            yield pa.record_batch([pa.array([path]), pa.array([first], pa.int64()), pa.array([len(writer.docs)]), pa.array([writer.tokens])],
                                  ["path", "first_doc", "n_docs", "n_tokens"])

    return run


class TokenFiles:
    """Token files of a table and their manifest (path, first_doc, n_docs, n_tokens, start)."""

    def __init__(self, docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None):
        """Write the files.

        Every text is encoded whole, without special tokens, and ends with
        ``end_id``. NULL is encoded like the empty text: the end id alone.
        Files are in ascending doc_id order, NULL ids first; rows that share a
        doc_id follow each other by text. Other columns are ignored. An empty
        table writes no file. Without ``folder`` files go to the shared folder.
        """
        spark = docs.sparkSession
        self.tables = Tables(spark, "token-files")
        with open(tokenizer_path, encoding="utf-8") as f:
            config = spark.sparkContext.broadcast(f.read())
        folder = f"{folder or self.tables.root}/files-{uuid.uuid4().hex}"
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        dealt = own.repartitionByRange(text_groups(own, size=FILE_BYTES), F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        written = self.tables.write(dealt.mapInArrow(_write(config, folder, end_id), _MANIFEST), "manifest")
        before = Window.orderBy(F.asc_nulls_first("first_doc")).rowsBetween(Window.unboundedPreceding, -1)  # one row per file
        self.manifest = written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        self.count = written.count()

    def read(self) -> DataFrame:
        """Read every document back: doc_id, start, n_tokens and ids (array<int>)."""
        return self._read(_with_ids, "doc_id long, start long, n_tokens long, ids array<int>")

    def digests(self) -> DataFrame:
        """Read every document back and reduce it to doc_id, start, n_tokens and ids_crc32."""
        return self._read(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")

    def _read(self, rows, ddl: str) -> DataFrame:
        return self.manifest.select("path", "start").repartition(max(1, self.count), "path").mapInArrow(rows, ddl)

    def drop(self) -> None:
        self.tables.drop()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[FileReader, int, np.ndarray]]:
    """(file, start of the file, places) in pieces of a bounded number of ids."""
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            file = FileReader(path)
            for _, places in flat.cut_by(np.cumsum(file.sizes) // (1 << 21), np.arange(len(file.sizes))):
                yield file, start + int(file.sizes[: places[0]].sum()), places


def _rows(file: FileReader, start: int, places: np.ndarray) -> list[pa.Array]:
    size = file.sizes[places]
    return [pa.array([file.doc_ids[k] for k in places.tolist()], pa.int64()), pa.array(start + np.cumsum(size) - size, pa.int64()), pa.array(size, pa.int64())]


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, start, places in _documents(batches):
        crc = pa.array([zlib.crc32(file.ids(k).tobytes()) for k in places.tolist()], pa.int64())
        yield pa.record_batch([*_rows(file, start, places), crc], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, start, places in _documents(batches):
        ids = pa.array([file.ids(k).astype(np.int32) for k in places.tolist()], pa.list_(pa.int32()))
        yield pa.record_batch([*_rows(file, start, places), ids], ["doc_id", "start", "n_tokens", "ids"])
