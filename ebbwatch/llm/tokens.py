"""Token ids as Arrow files of equal-length sequences, with a mask and an index of documents.

The ids of all documents, in ascending id order, each closed by an end id, are one stream. It is cut in sequences
of fixed length; record batches hold fixed-size lists of ids and of mask bits, so any sequence is found by its
number without copying. Each Spark partition of the sorted documents is one shard: ``part-n.arrow`` with the
sequences and ``part-n.docs.arrow`` with where its documents start. The last sequence of a shard is padded under a
zero mask.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import in_shards, small_batches
from ebbwatch.sources.storage import materialize, scratch_path

LENGTH = 1024  # ids of a sequence
BATCH = 256  # sequences of a record batch
KNOWN = 600_000  # units that a worker remembers before it drops those asked for once, some 200 bytes each
KNOWN_IDS = 4_000_000  # ids that they may have in all, which bounds long units


class Encoder:
    """The library's ids of whole texts, with the ids of recurring units remembered.

    The pre-tokenizer of byte-level BPE starts a piece at a single space or line end between two characters that
    are not white space, and between a run of letters and the ASCII marks that follow it up to the next such place,
    whatever stands around. A text is cut there, each different unit of a batch is encoded by the library once, and
    the ids are joined. Texts with other white space at a cut, NUL or a special token are encoded whole.
    """

    def __init__(self, path: str):
        # Spark runs a worker for each core; threads inside one would only add memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        cut = self.tokenizer.pre_tokenizer
        by_bytes = isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space
        self.model = self.tokenizer.model if by_bytes and self.tokenizer.normalizer is None else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces. Letters, after a space or not, are one piece to the library's model; of others
        the library takes many at once, as words that are cut already."""
        if self.model is not None:
            plain = [p for p in pieces if (p[1:] if p[:1] == " " else p).isalpha()]
            ids = [[t.id for t in self.model.tokenize(_byte_letters(p))] for p in plain]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._add(plain, np.fromiter(chain.from_iterable(ids), self.kind, sizes.sum()), sizes)
            pieces = [p for p in pieces if p not in self.known]
        for at in range(0, len(pieces), 1_000):
            some = pieces[at : at + 1_000]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            self._add(some, np.array(found.ids, self.kind), sizes)

    def _add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, used = len(self.known), int(self.ends[len(self.known)])
        self.ids = _room(self.ids, used + len(ids))
        self.ends = _room(self.ends, n + len(units) + 1)
        self.asked = _room(self.asked, len(self.ends))
        self.ids[used : used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(units)] = used + np.cumsum(sizes)
        self.known.update(zip(units, range(n, n + len(units)), strict=True))

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends, self.asked = np.zeros(1 << 16, self.kind), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, bool)

    def _make_room(self) -> None:
        """Keep the units that were asked for again since the last time, if these are few enough."""
        units, kept = list(self.known), np.flatnonzero(self.asked[: len(self.known)])
        ids, sizes = self._gather(kept)
        self.forget()
        if len(kept) <= KNOWN // 2 and len(ids) <= KNOWN_IDS // 2:
            self._add([units[i] for i in kept.tolist()], ids, sizes)

    def _units(self, units: list[str]) -> np.ndarray:
        """Numbers of different units among the known ones, after learning those that are new."""
        if len(self.known) > KNOWN or self.ends[len(self.known)] > KNOWN_IDS:
            self._make_room()
        number = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        self.asked[number[number >= 0]] = True
        missing = [units[i] for i in np.flatnonzero(number < 0).tolist()]
        if missing:
            pieces = [_pieces(u) if u[-1:] in _MARKS else (u,) for u in missing]
            self._learn([p for p in dict.fromkeys(chain.from_iterable(pieces)) if p not in self.known])
            joined = [(u, ps) for u, ps in zip(missing, pieces, strict=True) if len(ps) > 1]
            if joined:
                halves = np.fromiter(map(self.known.__getitem__, chain.from_iterable(ps for _, ps in joined)), np.int64)
                ids, sizes = self._gather(halves)
                self._add([u for u, _ in joined], ids, sizes.reshape(-1, 2).sum(axis=1))
            number[number < 0] = np.fromiter(map(self.known.__getitem__, missing), np.int64, len(missing))
        return number

    def _gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known units one after another, and how many each has."""
        sizes = self.ends[number + 1] - self.ends[number]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.ends[number] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; the array holds no nulls."""
        odd = pc.match_substring(texts, "\0")
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        cut = pc.split_pattern(marked, "\0")
        coded = cut.values.dictionary_encode()
        units, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        bounds = cut.offsets.to_numpy()
        bad = ~_regular(coded.dictionary)
        strange = np.add.reduceat(np.append(bad[at], False), bounds[:-1]) if len(texts) else np.zeros(0)
        whole = odd.to_numpy(zero_copy_only=False) | (strange > 0)
        stream, sizes = self._gather(self._units(units)[at])
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        rows = np.flatnonzero(whole).tolist()
        library = dict(zip(rows, self._library([texts[i].as_py() for i in rows]), strict=True))
        return [library[i] if i in library else stream[ends[i] : ends[i + 1]] for i in range(len(texts))]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, in one of twice the size or more where ``size`` does not fit."""
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def _byte_letters(piece: str) -> str:
    """The piece as byte-level vocabularies write it: a letter for each byte of its UTF-8."""
    if piece.isascii():
        return piece.replace(" ", "\u0120")
    return piece.encode().decode("latin-1").translate(_LETTER_OF_BYTE)


#: Bytes that print stand for themselves, the others for the letters from U+0100 on, in order.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTER_OF_BYTE = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}
_MARKS = frozenset(string.punctuation)
_WORD_AND_MARKS = re.compile(r"([ \n]?[^\W\d_]+)([!-/:-@\[-`{-~]+)")


def _regular(units: pa.Array) -> np.ndarray:
    """Whether a unit, after its leading space or line end, neither is empty nor starts or ends with white space."""
    size = lambda x: pc.utf8_length(x).to_numpy(zero_copy_only=False)
    led = pc.or_(pc.starts_with(units, " "), pc.starts_with(units, "\n")).to_numpy(zero_copy_only=False)
    bare = size(pc.utf8_trim_whitespace(units))
    return (bare > 0) & (bare == size(units) - led)


def _pieces(unit: str) -> tuple[str, ...]:
    """A word and the marks after it, which are never in one piece; any other unit stays whole."""
    found = _WORD_AND_MARKS.fullmatch(unit)
    return found.groups() if found and found[1].lstrip(" \n").isalpha() else (unit,)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def sequence_schema(kind: np.dtype, length: int) -> pa.Schema:
    ids = pa.uint16() if kind.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Writes a stream of ids as fixed-length sequences."""

    def __init__(self, sink, kind: np.dtype, length: int, batch: int = BATCH):
        self.schema, self.length, self.batch = sequence_schema(kind, length), length, batch
        self.file = pa.ipc.new_file(sink, self.schema)
        self.kind, self.rest, self.written = kind, np.zeros(0, kind), 0

    def add(self, ids: np.ndarray) -> None:
        self.rest = np.concatenate([self.rest, ids])
        step = self.length * self.batch
        whole = len(self.rest) // step * step
        for at in range(0, whole, step):
            self._write(self.rest[at : at + step], step)
        self.rest = self.rest[whole:]

    def close(self) -> None:
        if len(self.rest):
            size = -(-len(self.rest) // self.length) * self.length
            self._write(np.concatenate([self.rest, np.zeros(size - len(self.rest), self.kind)]), len(self.rest))
        self.file.close()

    def _write(self, ids: np.ndarray, real: int) -> None:
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
            for values in (ids, np.arange(len(ids)) < real)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))


def write_tokens(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    length: int = LENGTH,
    shard_bytes: int = 4_000_000,
) -> DataFrame:
    """Write the shards below ``folder`` (a URI that executors share); returns shard, n_docs, n_tokens.

    The frame is stored, so the files are written once. A task writes under a name of its own attempt and moves the
    files when they are complete: a repeated or doubled task leaves the same files.

    Ids ascend, null first; documents with equal ids are ordered by a hash of their text. Null texts are empty and
    give the end id alone. An empty table writes no shard. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "tie"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        names = [f"part-{shard:06d}.arrow", f"part-{shard:06d}.docs.arrow"]
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        paths = [f"{root}/_{n}.{task.taskAttemptId()}" for n in names]
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.kind)
        docs = total = 0
        sequences = index = layout = None
        sinks = []
        for batch in in_shards(batches, "text", shard_bytes):
            ids = batch.column("doc_id")
            if sequences is None:
                sinks = [store.open_output_stream(p) for p in paths]
                sequences = ShardWriter(sinks[0], enc.kind, length)
                layout = pa.schema([("doc_id", ids.type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                index = pa.ipc.new_file(sinks[1], layout)
            encoded = enc.encode(batch.column("text"))
            sizes = np.array([len(x) + 1 for x in encoded], np.int64)
            starts = total + np.cumsum(sizes) - sizes
            sequences.add(np.concatenate([x for ids_ in encoded for x in (ids_, end)]))
            index.write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(sizes)], schema=layout))
            docs, total = docs + len(encoded), total + int(sizes.sum())
            pa.default_memory_pool().release_unused()
        if sequences is not None:
            sequences.close()
            index.close()
            for sink in sinks:
                sink.close()
            for path, name in zip(paths, names, strict=True):
                store.move(path, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([docs]), pa.array([total])], ["shard", "n_docs", "n_tokens"]
            )

    return materialize(ordered.select("doc_id", "text").mapInArrow(write, "shard long, n_docs long, n_tokens long"), "token-shards")


class ShardReader:
    """Random access to the sequences of a shard; local files are mapped into memory, not read."""

    def __init__(self, store: fs.FileSystem, path: str):
        source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.held = -1, None

    def batch(self, i: int) -> pa.RecordBatch:
        if i != self.at:
            self.at, self.held = i, self.file.get_batch(i)
        return self.held

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of one sequence."""
        batch, row = self.batch(number // BATCH), number % BATCH
        cut = slice(row * self.length, (row + 1) * self.length)
        return batch.column("ids").values.to_numpy()[cut], batch.column("mask").values[cut].to_numpy(zero_copy_only=False)

    def stream(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """Views of the ids from one place of the stream to another."""
        step = self.length * BATCH
        while start < stop:
            i = start // step
            end = min(stop, (i + 1) * step)
            yield self.batch(i).column("ids").values.to_numpy()[start - i * step : end - i * step]
            start = end


def read_tokens(shards: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files.

    ``start`` counts the ids of all documents before it; the sums run over one row for each shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    count = max(1, shards.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{root}/part-{row['shard']:06d}"
                sequences = ShardReader(store, f"{name}.arrow")
                with store.open_input_file(f"{name}.docs.arrow") as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        docs = index.get_batch(i)
                        starts, sizes = (docs.column(c).to_numpy() for c in ("start", "n_tokens"))
                        crcs = []
                        for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                            crc = 0
                            for ids in sequences.stream(start, start + size):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                        yield pa.RecordBatch.from_arrays(
                            [docs.column("doc_id"), pa.array(starts + row["base"]), pa.array(sizes), pa.array(crcs, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return placed.repartition(count).mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def encode_corpus(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write the files into a fresh shared folder and read them back; see ``write_tokens`` and ``read_tokens``."""
    folder = _uri(scratch_path(documents.sparkSession, "tokens"))
    shards = write_tokens(documents, folder, tokenizer, doc_id, text, **options)
    return read_tokens(shards, folder, documents.schema[doc_id].dataType.simpleString())


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
