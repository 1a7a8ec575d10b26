"""Token ids in binary files, with Elias-Fano encoded document boundaries.

Texts are encoded with a public tokenizer and written in ascending id order as shard files; a file holds

* a header: magic, format, id width, counts, bit widths, checksum of the rest;
* the documents' ids, ascending, as an Elias-Fano sequence (null ids lead and are only counted);
* the boundaries between documents, n + 1 positions in the file's own token array, as an Elias-Fano sequence;
* the token ids, end ids included, as one flat array of 16-bit (32-bit for larger vocabularies) integers.

An Elias-Fano sequence of n values below u keeps the lower log2(u / n) bits of each value packed, and the rest as
a bit vector with one 1 per value: two bits a value beside the lower ones. ``select`` finds the k-th 1 from a 32-bit
sample every ``SAMPLE`` ones and counts of the words behind it, so an offset is read in near-constant time and no table
of 64-bit offsets exists. Positions are counted within a file; where a file starts in the whole array is
a sum over the files before it, taken from the manifest (one row a file).

One range partitioning of the texts by id puts them in order; each task streams its sorted texts through the tokenizer
into files of at most ``FILE_TOKENS`` tokens, so a task never holds more than one file. Files
are written under a temporary name and renamed: a task that runs again after an executor is lost
writes the same bytes under the same name. They are read back with Spark's ``binaryFile`` source.
"""

from __future__ import annotations

import functools
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import batches_of, id_text, staged
from cartwheel.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
FILE_TOKENS = 1 << 21
FILE_DOCS = 1 << 16
BATCH_BYTES = 4 << 20
JOINED = 256  # new words encoded as one text
CACHED_WORDS = 1 << 19  # words a Python worker keeps the ids of
CACHED_IDS = 1 << 23  # and the ids of all of them
SAMPLE = 256  # ones between two samples of a select structure

MAGIC = b"CWTOK\x01\x00\x00"
HEADER = struct.Struct("<8sIIQQQqQI")  # magic, id width, part, number in part, documents, null ids, least id, tokens, checksum
SEQUENCE = struct.Struct("<QQI")  # values, universe, lower bits
SUFFIX = ".tok"
MANIFEST = "part int, number int, name string, n_docs bigint, n_tokens bigint"
READ = "part int, number int, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint"


# ---- Elias-Fano --------------------------------------------------------------

def byte_select() -> np.ndarray:
    """Place of the k-th 1 of every byte value."""
    out = np.zeros((256, 8), np.uint8)
    for value in range(256):
        for k, place in enumerate(b for b in range(8) if value >> b & 1):
            out[value, k] = place
    return out


PLACES = byte_select()


def packed(values: np.ndarray, width: int) -> bytes:
    """Unsigned values as ``width`` bits each, least significant bit first."""
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpacked(data: np.ndarray, ranks: np.ndarray, width: int) -> np.ndarray:
    """The values at ``ranks`` of a packed array."""
    out = np.zeros(len(ranks), np.uint64)
    start = ranks.astype(np.int64) * width
    for k in range(width):
        at = start + k
        out |= ((data[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(k)
    return out


def elias_fano(values: np.ndarray, universe: int) -> bytes:
    """Ascending unsigned values below ``universe`` (2⁶⁴ at most), repeats allowed."""
    n, universe = len(values), min(universe, (1 << 64) - 1)
    values = values.astype(np.uint64)
    width = max(0, (universe // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    size = -(-(int(high[-1]) + 1) // 64) * 64 if n else 0
    bits = np.zeros(size, np.uint8)
    bits[high] = 1
    low = packed(values & np.uint64((1 << width) - 1), width)
    samples = high[::SAMPLE].astype("<u4").tobytes()
    return SEQUENCE.pack(n, universe, width) + low + samples + np.packbits(bits, bitorder="little").tobytes()


class EliasFano:
    """A sequence as read from ``data`` at ``at``; ``end`` is where the next part of the file starts."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.universe, self.width = SEQUENCE.unpack_from(data, at)
        at += SEQUENCE.size
        view = np.frombuffer(data, np.uint8)
        lows = -(-self.n * self.width // 8)
        self.low = view[at:at + lows]
        at += lows
        count = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", count, at)
        at += 4 * count
        # The last one stands at (last value >> width) + n - 1; the vector is whole 64-bit words.
        size = 0
        if self.n:
            size = self._size(view, at)
        self.high = view[at:at + size]
        self.end = at + size

    def _size(self, view: np.ndarray, at: int) -> int:
        """Bytes of the bit vector: whole words until the n-th one."""
        done, left = (self.n - 1) // SAMPLE * SAMPLE, int(self.samples[-1]) // 64
        need = self.n - done
        word = left
        start = int(self.samples[-1]) % 64
        while True:
            chunk = np.unpackbits(view[at + 8 * word:at + 8 * (word + 64)], bitorder="little")
            ones = np.flatnonzero(chunk[start:])
            if len(ones) >= need:
                return 8 * (word + (start + int(ones[need - 1])) // 64 + 1)
            need -= len(ones)
            word, start = word + 64, 0

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """Places of the ones of given ranks (0-based), by samples and byte counts."""
        ranks = np.asarray(ranks, np.int64)
        place = self.samples[ranks // SAMPLE].astype(np.int64)
        byte, left = place >> 3, ranks % SAMPLE
        value = self.high[byte] & ((0xFF << (place & 7)) & 0xFF).astype(np.uint8)
        ones = np.bitwise_count(value).astype(np.int64)
        open_ = np.flatnonzero(left >= ones)
        while len(open_):
            left[open_] -= ones[open_]
            byte[open_] += 1
            value[open_] = self.high[byte[open_]]
            ones[open_] = np.bitwise_count(value[open_])
            open_ = open_[left[open_] >= ones[open_]]
        return byte * 8 + PLACES[value, left]

    def get(self, ranks: np.ndarray) -> np.ndarray:
        """Values of given ranks."""
        ranks = np.asarray(ranks, np.int64)
        high = (self.select(ranks) - ranks).astype(np.uint64)
        return (high << np.uint64(self.width)) | unpacked(self.low, ranks, self.width)


# ---- files ---------------------------------------------------------------------

def file_bytes(doc_ids: list[int | None], bounds: np.ndarray, ids: np.ndarray, part: int, number: int) -> bytes:
    """A shard file. ``doc_ids`` ascend, null first; ``bounds`` are n + 1 positions in ``ids``."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    least = known[0] if known else 0
    shifted = np.array([d - least for d in known], np.uint64)
    body = (elias_fano(shifted, int(shifted[-1]) + 1 if known else 0) + elias_fano(bounds, int(bounds[-1]) + 1) + ids.tobytes())
    return HEADER.pack(MAGIC, ids.itemsize, part, number, len(doc_ids), nulls, least, len(ids), zlib.crc32(body)) + body


class TokenFile:
    """A shard file in memory: ``doc_id``, ``offsets`` and ``ids`` of documents by their place in the file."""

    def __init__(self, data: bytes):
        magic, width, self.part, self.number, self.n_docs, self.nulls, self.least, self.n_tokens, check = HEADER.unpack_from(data)
        if magic != MAGIC or zlib.crc32(memoryview(data)[HEADER.size:]) != check:
            raise ValueError("not a whole token file")
        self.keys = EliasFano(data, HEADER.size)
        self.bounds = EliasFano(data, self.keys.end)
        self.tokens = np.frombuffer(data, f"<u{width}", self.n_tokens, self.bounds.end)

    def doc_id(self, place: int) -> int | None:
        return None if place < self.nulls else int(self.keys.get(np.array([place - self.nulls]))[0]) + self.least

    def offsets(self, places: np.ndarray) -> np.ndarray:
        return self.bounds.get(places).astype(np.int64)

    def ids(self, place: int) -> np.ndarray:
        a, b = self.offsets(np.array([place, place + 1]))
        return self.tokens[a:b]


# ---- encoding ------------------------------------------------------------------

def load_tokenizer(path: str):
    """The tokenizer; strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def taken(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def strings(values: pa.Array) -> list[str]:
    """The strings of an array without nulls (several times as fast as ``to_pylist``)."""
    return values.to_numpy(zero_copy_only=False).tolist()


def ends_stem(char: str) -> bool:
    """Whether punctuation may be parted behind ``char``: a letter or digit in every version of the character tables."""
    return char < "\u0530" and char.lower().isalnum()


class WordEncoder:
    """Ids of texts through their words: white space is dropped and ends every piece of the tokenizer, so the ids of a
    text are those of its words in order, and a word is encoded once as long as it is kept (``splits_at_space`` checks the first).

    A word is looked up apart from the punctuation at its end, an ASCII word in lower case: such a tokenizer lowers case
    and starts a new piece there (``lowers_ascii`` checks both). New words of letters alone are encoded ``JOINED`` at a time,
    as one text: a tokenizer that marks the end of a word in its ids (``word_ends``) says itself where each of them ends.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.halves, self.ends = tokenizer, lowers_ascii(tokenizer), word_ends(tokenizer)
        self.reset()

    def reset(self) -> None:
        self.pieces: dict[str, int] = {"": 0}  # numbers of stems and punctuation
        self.flat, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def split(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
        """Stems of the words, which of them have punctuation apart, and that punctuation."""
        if not self.halves:
            return words, np.zeros(0, np.int64), []
        words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        stems = pc.ascii_rtrim(words, characters=string.punctuation)
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        apart = pa.array([ends_stem(c) for c in last.dictionary.to_pylist()], pa.bool_()).take(last.indices)
        cut = np.flatnonzero(pc.and_(apart, pc.less(pc.binary_length(stems), pc.binary_length(words))).to_numpy(zero_copy_only=False))
        tails = [w[len(s):] for w, s in zip(strings(words.take(pa.array(cut))), strings(stems.take(pa.array(cut))), strict=True)]
        return pc.if_else(apart, stems, words), cut, tails

    def apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and how many each has."""
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))

    def joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same through one text; every piece has one end at least, so as many ends as pieces are one each."""
        found = np.array(self.tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[found])
        return (found, np.diff(last, prepend=-1)) if len(last) == len(pieces) else self.apart(pieces)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct pieces; those not met before are encoded."""
        get = self.pieces.get
        out = np.array([get(p, -1) for p in pieces], np.int64)
        letters, rest = [], []
        for i in np.flatnonzero(out < 0).tolist():
            (letters if self.ends is not None and pieces[i].lower().isalpha() else rest).append(i)
        if places := letters + rest:
            new = [pieces[i] for i in places]
            cuts = range(0, len(letters), JOINED)
            found = [self.joined(new[i:min(i + JOINED, len(letters))]) for i in cuts] + ([self.apart(new[len(letters):])] if rest else [])
            first = len(self.pieces)
            self.pieces.update(zip(new, range(first, first + len(new)), strict=True))
            out[places] = np.arange(first, first + len(new))
            self.flat = np.concatenate([self.flat, *(ids for ids, _ in found)])
            self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in found)])
        return out

    def learn(self, vocabulary: pa.Array) -> np.ndarray:
        """Numbers of the stem and the punctuation (0: none) of every word."""
        if len(self.pieces) > CACHED_WORDS or len(self.flat) > CACHED_IDS:
            self.reset()
        stems, cut, tails = self.split(vocabulary)
        coded = stems.dictionary_encode()
        out = np.zeros((len(stems), 2), np.int64)
        out[:, 0] = self.numbers(strings(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
        self.numbers(list(dict.fromkeys(tails)))
        out[cut, 1] = [self.pieces[t] for t in tails]
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none), as 32-bit integers."""
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pc.list_flatten(parts).dictionary_encode()
        pairs = self.learn(coded.dictionary)
        sizes, starts = self.sizes[pairs], (np.cumsum(self.sizes) - self.sizes)[pairs]
        ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])  # after each distinct word
        found = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(self.flat[taken(starts.ravel(), sizes.ravel())])).take(coded.indices)
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        out, bounds = found.values.to_numpy(), found.offsets.to_numpy()[words]
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class PlainEncoder:
    """Ids of whole texts, for a tokenizer whose pieces may span white space."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]


PROBES = [" ", "  ", "a b", " a", "a ", "don 't", "x\n\ny", "1 2", "a , b", "e \u0301", "\u1100 \u1161", "\u03a3 \u03a3", "\t.\r.", "\x0b!\x0c!", "(a) [b]"]
ENDS = ["Word.", "word", "IT's!", "a'", "x.y.", "Z9,", "9!?", "''", "a's'", "Q\u201d.", "A<|>", "don't''", "#tag)", "e.g.,", "I'LL.", "-", "9-"]
WIDE_ENDS = ["\u00e9.", "\u00c9'", "ca\u00f1\u00f3n,", "\u00df!?", "\u0436).", "\u03a9's'", "\u00c0 l.", "\u00b2;", "\u0660-", "x\u2019s.", "\u01f0\"", "o\u0301o."]


def splits_at_space(tokenizer) -> bool:
    """Whether the tokenizer treats every probe as its words apart: only then are words encoded alone."""
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    return all(ids(t) == [i for w in pc.ascii_split_whitespace(pa.array([t]))[0].as_py() for i in ids(w)] for t in PROBES)


def lowers_ascii(tokenizer) -> bool:
    """Whether ASCII words have the ids of their lower case, and punctuation at the end of a word is a piece of its own."""
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    stems = [(w.rstrip(string.punctuation), w) for w in [*(w.lower() for w in ENDS if w.isascii()), *WIDE_ENDS]]
    return all(ids(w) == ids(w.lower()) for w in ENDS) and all(ids(word) == ids(stem) + ids(word[len(stem):]) for stem, word in stems)


def word_ends(tokenizer) -> np.ndarray | None:
    """Which ids end a word; none for a tokenizer whose ids do not say so of every word."""
    from tokenizers.pre_tokenizers import ByteLevel

    suffix, vocabulary = getattr(tokenizer.model, "end_of_word_suffix", None), tokenizer.get_vocab(with_added_tokens=False)
    if not suffix or not all(c + suffix in vocabulary for c in ByteLevel.alphabet()):
        return None
    out = np.zeros(max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return out


@functools.lru_cache(maxsize=1)
def encoder_at(path: str, changed: int) -> WordEncoder | PlainEncoder:
    """The encoder of a tokenizer's file as of ``changed``; a Python worker keeps it, and the words it knows, for its next tasks."""
    tokenizer = load_tokenizer(path)
    return (WordEncoder if splits_at_space(tokenizer) else PlainEncoder)(tokenizer)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str, tokenizer_path: str, end_id: int, file_tokens: int, file_docs: int):
    """mapInArrow over sorted texts: writes this task's files, yields their manifest rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        part = TaskContext.get().partitionId()
        store, base = _filesystem(folder)
        encoder = encoder_at(tokenizer_path, os.stat(tokenizer_path).st_mtime_ns)
        dtype = "<u2" if max(encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else "<u4"
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        tokens = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, docs, tokens, number
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
            data = file_bytes(docs, bounds, np.concatenate(held).astype(dtype), part, number)
            name = f"part-{part:06d}-{number:06d}{SUFFIX}"
            passing = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(passing) as out:
                out.write(data)
            store.move(passing, f"{base}/{name}")
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "name": [name],
                                              "n_docs": pa.array([len(docs)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64())})
            held, docs, tokens, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for piece in batches_of(iter([batch]), "text", BATCH_BYTES):
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text")), strict=True):
                    if docs and (tokens + len(ids) >= file_tokens or len(docs) == file_docs):
                        yield flush()
                    held.append(np.append(ids, np.uint32(end_id)))
                    docs.append(doc_id)
                    tokens += len(ids) + 1
        if docs:
            yield flush()
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                      file_tokens: int = FILE_TOKENS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Writes the token files of ``docs`` into ``folder`` (shared by all executors); returns the manifest, one row per file.

    Manifest: part, number, name, n_docs, n_tokens, start. Files in order of (part, number) hold the
    documents by id, null ids first, rows that share an id by a hash of their text; equal rows may stand in either order.
    Null and empty texts have only the end id. A text above ``file_tokens`` is a file of its own.
    """
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    rows = id_text(docs, id_col, text_col).withColumns({"_hash": F.xxhash64("text"), "_mark": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("doc_id"), F.asc("_hash"), F.asc("_mark")]  # the mark lets a range end between equal rows
    tasks = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = staged(tasks.mapInArrow(_write(folder, tokenizer_path, end_id, file_tokens, file_docs), MANIFEST), "token-manifest")
    return with_starts(files)


def with_starts(files: DataFrame) -> DataFrame:
    """Adds where each file starts in the whole array: sums inside a part, and over the parts (one row a write task)."""
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (files.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts.drop("_n"), "part")
            .withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document of each file."""
    for batch in batches:
        for content in batch.column("content"):
            f = TokenFile(content.as_buffer().to_pybytes())
            bounds = f.offsets(np.arange(f.n_docs + 1))
            wide = f.tokens.astype("<u4", copy=False)
            crc = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            known = f.keys.get(np.arange(f.n_docs - f.nulls)).astype(np.int64) + np.int64(f.least)  # wraps back below 2⁶³
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(f.n_docs, f.part, np.int32)), "number": pa.array(np.full(f.n_docs, f.number, np.int32)),
                "doc_id": pa.concat_arrays([pa.nulls(f.nulls, pa.int64()), pa.array(known, pa.int64())]),
                "local_start": pa.array(bounds[:-1]), "n_tokens": pa.array(np.diff(bounds)), "ids_crc32": pa.array(crc, pa.int64())})


def read_documents(spark, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files of a manifest."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("content")
    rows = content.mapInArrow(_documents, READ)
    return (rows.join(files.select("part", "number", F.col("start").alias("_file_start")), ["part", "number"])
            .select("doc_id", (F.col("_file_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_report(docs: DataFrame, tokenizer_path: str | Callable[[], str] | None = None) -> DataFrame:
    """Contract of ``op13_tokens``: the files written under the shared checkpoint folder and read back."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    folder = scratch_dir(docs.sparkSession, "tokens")
    return read_documents(docs.sparkSession, folder, write_token_files(docs, folder, tokenizer_path))
