"""Token ids of documents in seekable binary files: independent zstandard frames and a seek table at the end.

A file is a row of parts, each followed by an empty skippable frame of eight bytes (``SEPARATOR``):

* one zstandard frame for each document, with a content checksum, holding its token ids as
  little-endian unsigned 32-bit integers; a document of more than ``frame_tokens`` ids takes
  several frames;
* at the end a skippable frame with the seek table: for each frame the document's id, whether it goes
  on with the document of the frame before, its size, its number of ids and the CRC-32 of
  their bytes; then the number of frames, the CRC-32 of these entries, and a closing number.

A zstandard tool therefore takes the whole file for one stream of ids, and a reader that knows the
table decompresses the frames it needs and no others. Spark's text writer writes the parts as
lines with the separator for a line break. So files reach any store that Spark reaches, and a
task that is run again leaves one copy. Files follow each other in the order of ids; ``_manifest`` beside them has
for each file the range of ids and the number of tokens before it.
"""

import io
import math
import os
import sys
import zlib
from array import array
from collections.abc import Collection, Iterable, Iterator, Sequence
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedward.session import planned_bytes

from .common import text_portions
from .words import blank_parts

#: A skippable frame without content, by the zstandard format.
SEPARATOR = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
# The numbers that begin a skippable frame and end a seek table, by the published seekable format.
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
ENTRY = np.dtype([("doc_id", "<i8"), ("flags", "u1"), ("size", "<u4"), ("tokens", "<u4"), ("check", "<u4")])
NULL_ID, GOES_ON = 1, 2
_FOOTER = np.dtype([("frames", "<u4"), ("check", "<u4"), ("magic", "<u4")])

#: Input bytes for one file.
FILE_BYTES = 1 << 25
FRAME_TOKENS = 1 << 20
_UNKNOWN = 1 << 55
_BATCH = 1 << 22
#: Bytes of words and their ids that a task remembers; beyond, it starts anew.
_REMEMBERED = 5 << 24
_GROUP = 64
_CLOSING = b".,;:!?$*&%#"
#: About so many characters of texts, or such a part of a longer one, are encoded together.
_TOGETHER = 1 << 22


class DamagedFile(ValueError):
    """A file whose checksums or sizes do not fit."""


@lru_cache(maxsize=4)
def _tokenizer(path: str) -> Tokenizer:
    # Tasks run side by side already; threads of the library would only add to them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def _plain(text: bytes) -> bytes:
    """ASCII letters in lower case.

    Texts with special tokens or with combining marks, which some small letters alone join, stay as they are.
    """
    return text if b"\xcc" in text or b"<|" in text else text.lower()


@lru_cache(maxsize=4)
def _encoder(path: str, end_id: int, by_words: bool) -> "Encoder":
    """One for each worker, so that the words it knows serve its later tasks as well."""
    return Encoder(path, end_id, by_words)


class Encoder:
    """Ids of whole texts as bytes, each followed by the end id.

    With ``by_words`` every word between blanks is encoded once and remembered; ASCII
    letters are lower-cased first, and marks that close a word are taken by themselves. This gives the ids of the whole text with
    tokenizers that lower-case, drop blanks and split between words and marks.
    """

    def __init__(self, path: str, end_id: int, by_words: bool) -> None:
        self._model = _tokenizer(path)
        self._end = np.array([end_id], "<u4").tobytes()
        self._by_words = by_words
        special = self._model.get_added_tokens_decoder().items()
        self._mark = next(((token.content, i) for i, token in special if token.special and token.content.split() == [token.content]), None)
        suffix = getattr(self._model.model, "end_of_word_suffix", None)
        vocabulary = self._model.get_vocab() if suffix else {}
        self._tells_ends = bool(suffix)
        letters, normal, pre = "abcdefghijklmnopqrstuvwxyz", self._model.normalizer, self._model.pre_tokenizer
        plain = normal is None or normal.normalize_str(letters) == letters
        self._takes_letters = plain and pre is not None and [t for t, _ in pre.pre_tokenize_str(letters)] == [letters] and array("I").itemsize == 4 and sys.byteorder == "little"
        self._seen: set[str] = set()
        self._stays: dict[str, bool] = {}
        self._letters: dict[int, str] = {}
        self._closes = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self._closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._known: dict[bytes, bytes] = {}
        self._size = 0

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if not self._by_words:
            for ids in self._encoded(texts):
                yield ids + self._end
            return
        data = [text.encode("utf-8", "surrogatepass") for text in texts]
        if max(map(len, data), default=0) <= _TOGETHER:
            for ids in self._ids_of([_plain(text) for text in data]):
                yield ids + self._end
            return
        for text in data:
            yield b"".join([ids for part in blank_parts(_plain(text), _TOGETHER) for ids in self._ids_of([part])] + [self._end])

    def _ids_of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text: its words are numbered, and every distinct one is looked up once."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        numbered = lists.flatten().dictionary_encode()
        words = numbered.dictionary.view(pa.binary()).to_pylist()
        known = self._learn(set(words))
        found = pa.array(map(known.__getitem__, words), pa.binary()).take(numbered.indices)
        # Ids of all words lie behind each other, so those of a text are one slice.
        _, bounds, ids = found.buffers()
        ends = np.frombuffer(bounds, "<i4", len(found) + 1)[lists.offsets.to_numpy()].tolist() if bounds else [0] * (len(texts) + 1)
        for start, end in zip(ends, ends[1:]):
            yield ids[start:end].to_pybytes() if end > start else b""

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """What is known, these words included."""
        if self._size > _REMEMBERED:
            self._known, self._size = {}, 0
        new = words.difference(self._known)
        marked = {}
        for word in new:
            stem = word.rstrip(_CLOSING)
            if stem and len(stem) < len(word) and (stem[-1:].isalnum() or self._ends_in_letter(stem.decode("utf-8", "surrogatepass")[-1])):
                marked[word] = stem, word[len(stem) :]
        new = new.difference(marked)
        new.update(set().union(*marked.values()).difference(self._known))
        whole, other = {}, {}
        for word in new:
            text = word.decode("utf-8", "surrogatepass")
            (whole if text.isalpha() and self._tells_ends else other)[word] = text
        for some, encode in ((whole, self._encoded_whole), (other, self._encoded_words)):
            self._remember(some, list(encode(list(some.values()))))
        self._remember(marked, [self._known[stem] + self._known[marks] for stem, marks in marked.values()])
        return self._known

    def _ends_in_letter(self, char: str) -> bool:
        """Whether a letter stays one: some become a letter and a combining mark, which later marks would join."""
        if char not in self._stays:
            normal = self._model.normalizer
            self._stays[char] = char.isalpha() and (normal is None or normal.normalize_str(char)[-1:].isalpha())
        return self._stays[char]

    def _remember(self, words: Collection[bytes], ids: list[bytes]) -> None:
        self._known.update(zip(words, ids, strict=True))
        self._size += sum(map(len, words)) + sum(map(len, ids)) + 150 * len(ids)

    def _encoded_whole(self, words: list[str]) -> Iterator[bytes]:
        """Words of letters, many in one text: the ids of each end with a token that closes a word.

        Small ASCII letters that neither the normalizer nor the pre-tokenizer changes go to the model itself. So do
        other words, normalized together, of which the pre-tokenizer takes every character for a letter.
        """
        if not self._takes_letters:
            yield from self._grouped(words)
            return
        ids, others = {}, []
        for word in words:
            if word.isascii() and word.islower():
                ids[word] = self._tokenized(word)
            else:
                others.append(word)
        joined, normal = " ".join(others), self._model.normalizer
        parts = (joined if normal is None else normal.normalize_str(joined)).split(" ")
        if len(parts) == len(others):
            for letter in set().union(*parts).difference(self._seen):
                self._see(letter)
            for word, part in zip(others, parts, strict=True):
                if part and self._letters.keys() >= set(map(ord, part)):
                    ids[word] = self._tokenized(part.translate(self._letters))
            others = [word for word in others if word not in ids]
        ids.update(zip(others, self._grouped(others), strict=True))
        yield from map(ids.__getitem__, words)

    def _see(self, letter: str) -> None:
        """Remember what the pre-tokenizer makes of a character, if it leaves two of it together."""
        self._seen.add(letter)
        pieces = self._model.pre_tokenizer.pre_tokenize_str(letter * 2)
        if len(pieces) == 1 and letter.isalpha():
            made = pieces[0][0]
            if made == made[: len(made) // 2] * 2:
                self._letters[ord(letter)] = made[: len(made) // 2]

    def _tokenized(self, word: str) -> bytes:
        return array("I", [token.id for token in self._model.model.tokenize(word)]).tobytes()

    def _grouped(self, words: list[str]) -> Iterator[bytes]:
        groups = [words[i : i + _GROUP] for i in range(0, len(words), _GROUP)]
        for group, encoding in zip(groups, self._model.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, "<u4")
            ends = (np.flatnonzero(self._closes[ids]) + 1).tolist()
            if len(ends) != len(group):
                yield from self._encoded(group)
                continue
            data = ids.tobytes()
            for start, end in zip([0, *ends], ends, strict=False):
                yield data[4 * start : 4 * end]

    def _encoded_words(self, words: list[str]) -> Iterator[bytes]:
        """Many words in one text, with a special token between them by which their ids are told apart."""
        groups = [words[i : i + _GROUP] for i in range(0, len(words), _GROUP)]
        plain = [self._mark is not None and not any(self._mark[0] in word for word in group) for group in groups]
        joined = [f" {self._mark[0]} ".join(group) for group, is_plain in zip(groups, plain, strict=True) if is_plain]
        encoded = iter(self._model.encode_batch(joined, add_special_tokens=False))
        for group, is_plain in zip(groups, plain, strict=True):
            if not is_plain:
                yield from self._encoded(group)
                continue
            ids = np.array(next(encoded).ids, "<u4")
            marks = np.flatnonzero(ids == self._mark[1]).tolist()
            data = ids.tobytes()
            for start, end in zip([-1, *marks], [*marks, len(ids)], strict=True):
                yield data[4 * start + 4 : 4 * end]

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        for encoding in self._model.encode_batch(texts, add_special_tokens=False):
            yield np.array(encoding.ids, "<u4").tobytes()


def file_parts(documents: Iterable[tuple[int | None, bytes]], frame_tokens: int = FRAME_TOKENS, level: int = 3) -> Iterator[bytes]:
    """The parts of a file in order, without separators; the last one is the seek table."""
    compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
    entries = []
    for doc_id, ids in documents:
        for start in range(0, max(1, len(ids)), 4 * frame_tokens):
            data = ids[start : start + 4 * frame_tokens]
            frame = compressor.compress(data)
            flags = (NULL_ID if doc_id is None else 0) | (GOES_ON if start else 0)
            entries.append((doc_id or 0, flags, len(frame), len(data) // 4, zlib.crc32(data)))
            yield frame
    table = np.array(entries, ENTRY).tobytes()
    footer = np.array([(len(entries), zlib.crc32(table), FOOTER_MAGIC)], _FOOTER).tobytes()
    head = np.array([TABLE_MAGIC, len(table) + len(footer)], "<u4").tobytes()
    yield head + table + footer


def seek_table(file: BinaryIO) -> np.ndarray:
    """The entries of a file that is open for reading; none in one of no bytes."""
    size = file.seek(0, io.SEEK_END)
    if not size:
        return np.zeros(0, ENTRY)
    tail = _FOOTER.itemsize + len(SEPARATOR)
    if size < tail:
        raise DamagedFile("no seek table")
    file.seek(size - tail)
    footer = np.frombuffer(file.read(_FOOTER.itemsize), _FOOTER)[0]
    length = int(footer["frames"]) * ENTRY.itemsize
    if footer["magic"] != FOOTER_MAGIC or size < tail + length:
        raise DamagedFile("no seek table")
    file.seek(size - tail - length)
    table = file.read(length)
    if zlib.crc32(table) != footer["check"]:
        raise DamagedFile("seek table")
    return np.frombuffer(table, ENTRY)


def read_documents(file: BinaryIO, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
    """(id, number of ids before it in the file, its ids as bytes) of the documents that are wanted, or of all.

    Only their frames are read and decompressed. A frame that is damaged raises.
    """
    table = seek_table(file)
    if not len(table):
        return
    offsets = np.concatenate([[0], np.cumsum(table["size"].astype(np.int64) + len(SEPARATOR))])
    before = np.concatenate([[0], np.cumsum(table["tokens"].astype(np.int64))])
    firsts = np.flatnonzero(table["flags"] & GOES_ON == 0)
    ends = np.append(firsts[1:], len(table))
    if wanted is not None:
        heads = table[firsts]
        asked = np.isin(heads["doc_id"], np.array(sorted(set(wanted)), np.int64)) & (heads["flags"] & NULL_ID == 0)
        firsts, ends = firsts[asked], ends[asked]
    decompressor = zstandard.ZstdDecompressor()
    for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
        file.seek(offsets[first])
        data = []
        for entry in table[first:end]:
            frame = file.read(int(entry["size"]))
            file.seek(len(SEPARATOR), io.SEEK_CUR)
            try:
                data.append(decompressor.decompress(frame, max_output_size=4 * int(entry["tokens"])))
            except zstandard.ZstdError as error:
                raise DamagedFile(f"frame of document {entry['doc_id']}") from error
            if len(data[-1]) != 4 * entry["tokens"] or zlib.crc32(data[-1]) != entry["check"]:
                raise DamagedFile(f"frame of document {entry['doc_id']}")
        doc_id = None if table[first]["flags"] & NULL_ID else int(table[first]["doc_id"])
        yield doc_id, int(before[first]), data[0] if len(data) == 1 else b"".join(data)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, sized: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about _BATCH bytes in the column number ``sized``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[sized]) + 64
        if size > _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    frame_tokens: int = FRAME_TOKENS,
    by_words: bool = True,
    file_bytes: int = FILE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every whole text, write the files to the new folder ``path`` and return their manifest.

    ``tokenizer`` names a file for the ``tokenizers`` library that all executors have. Special tokens are not
    added; ``end_id`` ends each document. ``by_words`` encodes every distinct word once, see
    :class:`Encoder` for which tokenizers that gives the ids of the whole text; pass False for others.
    Ids of documents are integers.

    A null or empty text has the end id alone. Null ids come first; rows that repeat an id
    follow each other by a hash of the text and then the text, each with ids of its own. An empty table
    gives a manifest without rows. Other columns are ignored.

    Documents are dealt by ranges of (id, hash), a file for each ``file_bytes`` of the input, so one id that
    repeats very often fills several files. Texts are shuffled once, and each task
    holds some megabytes of texts and one document's ids at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    size = planned_bytes(docs)
    if size > _UNKNOWN:  # a plan that does not say how much it reads
        files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    else:
        files = max(spark.sparkContext.defaultParallelism, math.ceil(size / file_bytes))
    ordered = rows.repartitionByRange(files, F.asc_nulls_first("id"), "tie")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("id"), "tie", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id, by_words)

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                ids = batch["id"].to_pylist()
                for start, texts in text_portions(batch["text"], _TOGETHER):
                    yield from zip(ids[start : start + len(texts)], encoder(texts), strict=True)

        parts = ((part,) for part in file_parts(documents(), frame_tokens))
        yield from _in_batches(parts, pa.schema([("part", pa.binary())]), 0)

    parts = ordered.select("id", "text").mapInArrow(encode, "part binary").select(F.col("part").cast("string").alias("value"))
    parts.write.option("lineSep", SEPARATOR.decode("ascii")).option("compression", "none").option("maxRecordsPerFile", 0).text(path)
    _write_manifest(spark, path)
    return manifest(spark, path)


def _files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, content) of data files; the file's number comes from its name."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths)
    return found.select(F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long").alias("file"), F.col("path"), "content")


def _write_manifest(spark: SparkSession, path: str) -> None:
    schema = pa.schema([("file", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name, content in zip(batch["file"], batch["path"], batch["content"], strict=True):
                table = seek_table(pa.BufferReader(content.as_buffer()))
                docs = table[table["flags"] & GOES_ON == 0]
                known = docs["doc_id"][docs["flags"] & NULL_ID == 0]
                row = (number.as_py(), name.as_py(), len(docs), int(table["tokens"].sum(dtype=np.int64)), *((int(known[0]), int(known[-1])) if len(known) else (None, None)))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema=schema)

    found = _files(spark, path).mapInArrow(tables, "file long, path string, n_docs long, n_tokens long, first_id long, last_id long")
    # One row for each file, so that one task can add them up.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    found.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).filter("n_docs > 0").write.parquet(f"{path}/_manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, n_docs, n_tokens, first_id, last_id, start) of every file that has documents."""
    return spark.read.parquet(f"{path}/_manifest")


def read_tokens(spark: SparkSession, path: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents in the files, or of those with the wanted ids.

    ``start`` counts the ids of all documents before it in all files; ``ids`` are the bytes of
    unsigned 32-bit integers. Only files whose range of ids may hold a wanted one are read, and
    only the frames of wanted documents are decompressed. Each frame's checksum is tested.
    """
    listed = manifest(spark, path)
    if wanted is None:
        files = _files(spark, path)
    else:
        wanted = sorted(set(wanted))
        asked = F.exists(F.lit(wanted) if wanted else F.expr("cast(array() as array<bigint>)"), lambda i: (F.col("first_id") <= i) & (F.col("last_id") >= i))
        paths = [row.path for row in listed.filter(asked).select("path").collect()]
        files = _files(spark, paths) if paths else _files(spark, path).limit(0)
    schema = pa.schema([("file", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch["file"].to_pylist(), batch["content"], strict=True):
                rows = ((number, *row) for row in read_documents(pa.BufferReader(content.as_buffer()), wanted))
                yield from _in_batches(rows, schema, 3)

    found = files.select("file", "content").mapInArrow(decode, "file long, doc_id long, before long, ids binary")
    placed = found.join(listed.select("file", "start"), "file")
    return placed.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "ids")
