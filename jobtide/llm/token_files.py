"""Token ids as Arrow files of equal-length sequences.

A data file is an Arrow IPC file of record batches with a fixed number of rows; a row is a
fixed-size list of ids and one of mask bits (true: token, false: padding). Lists of one size lie
end to end, so sequence i is found by division and read as a view of the mapped file. Ids are as
wide as the vocabulary needs, 16 or 32 bits. Documents follow each other without gaps; only the
last row of a file is padded. Beside it, ``.docs`` says where each document begins.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.byte_text import buffers, span_hashes
from jobtide.llm.common import stored

SEQUENCE = 2_048
ROWS = 256
END_ID = 0
#: Runs of text whose ids a Python worker remembers, and ids of them; then it starts afresh.
REMEMBERED, REMEMBERED_IDS, TABLE_BITS = 1_000_000, 8_000_000, 22
SLICE_BYTES = 2 << 20
#: Marks that, after a letter, always begin a new piece of their own.
MARKS = b",.;:!?%*$&#|"
#: White space beyond ASCII, in UTF-8 (or the start of it); texts with it are not cut.
WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
JOINED = 1_000

DOCS = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])


def _schema(sequence: int, kind: np.dtype) -> pa.Schema:
    ids = pa.from_numpy_dtype(kind)
    return pa.schema(
        [("ids", pa.list_(ids, sequence)), ("mask", pa.list_(pa.bool_(), sequence))]
    )


def _class(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


_WHITE = _class(bytes([*range(9, 14), *range(28, 33)]))
_LETTER = _class(bytes([*range(65, 91), *range(97, 123)]))
_MARK = _class(MARKS)


class Encoder:
    """Texts to ids, as if each text were encoded as a whole.

    The pre-tokenizer of a byte-level vocabulary never joins what lies on both sides of a space
    or a line end with non-white neighbours, nor a letter and a mark after it. Texts are cut
    there, and every different run between the cuts goes through the tokenizer once, many runs in
    one text with line ends between them. Runs are known by two 64-bit hashes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        narrow = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind = np.dtype("<u2" if narrow else "<u4")
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.uncut = [*WIDE_SPACE, *(t.content.encode() for t in added)]
        self.line_end = self._ids(["\n"])[0]
        self._forget()

    def _forget(self) -> None:
        self.table = np.full(1 << TABLE_BITS, -1, np.int32)  # place of a run, by its key's slot
        self.keys = np.empty(0, np.uint64)
        self.checks = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.ids = np.empty(0, self.kind)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _runs(self, runs: list[bytes]) -> list[np.ndarray]:
        """Ids of runs; those without line ends are encoded many at a time."""
        found: list[np.ndarray | None] = [None] * len(runs)
        plain = [k for k, run in enumerate(runs) if b"\n" not in run]
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            ids = self._ids([b"\n".join([runs[k] for k in some]).decode()])[0]
            cuts = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) == 1 and len(cuts) == len(some) - 1:
                low = [0, *(cuts + 1).tolist()]
                for k, i, j in zip(some, low, [*cuts.tolist(), len(ids)]):
                    found[k] = ids[i:j]
        left = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(left, self._ids([runs[k].decode() for k in left])):
            found[k] = ids
        return found

    def _cuts(self, memory: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where runs begin, with the end of the last one."""
        solid = ~_WHITE[memory]
        cut = np.zeros(len(memory) + 1, bool)
        inner = np.zeros(len(memory), bool)
        inner[1:-1] = solid[:-2] & solid[2:]
        cut[:-1] |= (memory == 32) & inner
        line = (memory == 10) & inner
        cut[:-1] |= line
        cut[1:] |= line
        cut[1:-1] |= _LETTER[memory[:-1]] & _MARK[memory[1:]]
        data = memory.tobytes()
        for text in self.uncut:
            at = data.find(text)
            while at >= 0:
                doc = np.searchsorted(bounds, at, side="right")
                cut[bounds[doc - 1] : bounds[doc]] = False
                at = data.find(text, int(bounds[doc]))
        cut[bounds] = True
        return np.flatnonzero(cut)

    def encode(self, memory: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and the last ones end)."""
        if len(memory) == 0:
            return np.empty(0, self.kind), np.zeros(len(bounds), np.int64)
        if len(self.keys) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        cuts = self._cuts(memory, bounds)
        keys, checks = span_hashes(memory, cuts[:-1], cuts[1:])
        at = self._find(keys)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            _, first = np.unique(keys[unknown], return_index=True)
            fresh = unknown[first]
            low, high = cuts[fresh].tolist(), cuts[fresh + 1].tolist()
            found = self._runs([memory[i:j].tobytes() for i, j in zip(low, high)])
            self._learn(keys[fresh], checks[fresh], found)
            at = self._find(keys)
        if (self.checks[at] != checks).any():  # two runs with one hash
            found = self._runs([memory[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])])
            sizes, ids = np.array([len(f) for f in found], np.int64), np.concatenate(found)
        else:
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            ids = self.ids[
                np.arange(ends[-1]) + np.repeat(self.starts[at] - (ends - sizes), sizes)
            ]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return ids, ends[np.searchsorted(cuts, bounds)]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys among those known, -1 for others; a taken slot sends on to the next."""
        slots = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        at = self.table[slots]
        if len(self.keys) == 0:
            return at
        wrong = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & ((1 << TABLE_BITS) - 1)
            at[wrong] = self.table[slots[wrong]]
            wrong = wrong[(at[wrong] >= 0) & (self.keys[at[wrong]] != keys[wrong])]
        return at

    def _learn(self, keys: np.ndarray, checks: np.ndarray, found: list[np.ndarray]) -> None:
        """Add runs with different keys that are not known."""
        sizes = np.array([len(f) for f in found], np.int64)
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        places = np.arange(len(self.keys), len(self.keys) + len(keys), dtype=np.int32)
        self.keys = np.concatenate((self.keys, keys))
        self.checks = np.concatenate((self.checks, checks))
        self.starts = np.concatenate((self.starts, starts))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, *found))
        slots = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        while len(places):
            free = self.table[slots] < 0
            self.table[slots[free]] = places[free]  # of several for a slot, one gets it
            left = self.table[slots] != places
            places, slots = places[left], (slots[left] + 1) & ((1 << TABLE_BITS) - 1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The Python worker's own encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Appends ids to a data file and notes where documents begin."""

    def __init__(self, uri: str, sequence: int = SEQUENCE, rows: int = ROWS, kind: str = "<u4"):
        system, path = _locate(uri)
        self.sequence, self.kind = sequence, np.dtype(kind)
        self.room = np.zeros(rows * sequence, self.kind)
        self.filled = self.total = 0
        self.streams = [system.open_output_stream(path), system.open_output_stream(f"{path}.docs")]
        self.data = pa.ipc.new_file(self.streams[0], _schema(sequence, self.kind))
        self.docs = pa.ipc.new_file(self.streams[1], DOCS)

    def append(self, doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Documents whose ids lie between ``bounds``."""
        lengths = np.diff(bounds)
        starts = self.total + bounds[:-1] - bounds[0]
        self.docs.write_batch(pa.record_batch([doc_ids, starts, lengths], schema=DOCS))
        self.total += len(ids)
        while len(ids):
            n = min(len(ids), len(self.room) - self.filled)
            self.room[self.filled : self.filled + n] = ids[:n]
            self.filled += n
            ids = ids[n:]
            if self.filled == len(self.room):
                self._flush()

    def _flush(self) -> None:
        size = -(-self.filled // self.sequence) * self.sequence
        self.room[self.filled : size] = 0
        mask = np.arange(size) < self.filled
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.sequence)
            for values in (self.room[:size], mask)
        ]
        self.data.write_batch(pa.record_batch(lists, schema=_schema(self.sequence, self.kind)))
        self.filled = 0

    def close(self) -> None:
        if self.filled:
            self._flush()
        for out in (self.data, self.docs, *self.streams):
            out.close()


class Sequences:
    """Random access to a data file: ``[i]`` gives (ids, mask) of sequence i as views of the file,
    a numpy array and an Arrow array of bits."""

    def __init__(self, uri: str):
        system, path = _locate(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.sequence = self.file.schema.field("ids").type.list_size
        self.batches = self.file.num_record_batches
        self.rows = len(self.file.get_batch(0)) if self.batches else 1  # all but the last alike

    def __len__(self) -> int:
        if not self.batches:
            return 0
        return (self.batches - 1) * self.rows + len(self.file.get_batch(self.batches - 1))

    def _flat(self, batch: int, column: int) -> pa.Array:
        return self.file.get_batch(batch).column(column).values

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        batch, row = divmod(i, self.rows)
        ids, mask = self._flat(batch, 0), self._flat(batch, 1)
        at = row * self.sequence
        return (
            ids.slice(at, self.sequence).to_numpy(zero_copy_only=True),
            mask.slice(at, self.sequence),
        )

    def tokens(self) -> Iterator[np.ndarray]:
        """All ids without padding, batch by batch."""
        for batch in range(self.batches):
            ids, mask = self._flat(batch, 0), self._flat(batch, 1)
            yield ids.to_numpy(zero_copy_only=True)[: mask.true_count]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode every whole text, with ``end_id`` after each, into data files in order of ids.

    Returns one row per file: ``file``, ``first_id``, ``part``, ``n_docs``, ``n_tokens``, stored.

    Documents are dealt by ranges of ids, as many as ``spark.sql.shuffle.partitions`` says, and
    sorted within; a task streams its range into one file. NULL texts are empty and have the end
    id only; NULL ids come first; repeated ids follow each other in the order of their texts'
    hashes. An empty table gives no file. ``folder`` must be on storage that all executors
    share. Files carry a new name for each attempt and only those of finished tasks are in the
    result, so a lost executor's half-written file is never read; ``remove_unlisted`` deletes it.
    """
    system, path = _locate(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(
        docs[id_col].cast("bigint").alias("id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")

    def write(batches):
        work, writer, first, n = encoder(tokenizer), None, None, 0
        part = TaskContext.get().partitionId()
        file = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            memory, bounds = buffers(batch.column(1))
            for low, high in _slices(bounds):
                at = bounds[low : high + 1]
                ids, ends = work.encode(memory[at[0] : at[-1]], at - at[0])
                ids = np.insert(ids, ends[1:], work.kind.type(end_id))
                doc_ids = batch.column(0).slice(low, high - low)
                if writer is None:
                    writer, first = SequenceWriter(file, sequence, ROWS, work.kind), doc_ids[0]
                writer.append(doc_ids, ids, ends + np.arange(len(ends)))
                n += high - low
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [file],
                    "first_id": pa.array([first.as_py()], pa.int64()),
                    "part": pa.array([part], pa.int64()),
                    "n_docs": pa.array([n], pa.int64()),
                    "n_tokens": pa.array([writer.total], pa.int64()),
                }
            )

    kinds = "file string, first_id long, part long, n_docs long, n_tokens long"
    return stored(ordered.select("id", "text").mapInArrow(write, kinds), "token-file-list")


def remove_unlisted(files: DataFrame, folder: str) -> list[str]:
    """Delete the files below ``folder`` that tasks which failed or ran twice have left: those that
    are not in ``files``, the result of ``write_token_files``. Call it when nothing writes there any
    more; returns the names deleted. Files of other names stay."""
    kept = {r.file.rsplit("/", 1)[-1] for r in files.select("file").collect()}  # a row per file
    system, path = _locate(folder)
    gone = []
    for info in system.get_file_info(fs.FileSelector(path)):
        name = re.match(r"part-\d{6}-[0-9a-f]{32}\.arrow", info.base_name)
        if info.is_file and name and name[0] not in kept:
            system.delete_file(info.path)
            gone.append(info.base_name)
    return sorted(gone)


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``SLICE_BYTES`` bytes; a longer row is a run of its own."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + SLICE_BYTES, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, from the data files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files in order; only one row
    per file is accumulated for it.
    """
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "part")
    placed = files.select(
        "file", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("before")
    )
    spread = placed.repartition(max(1, files.count()))  # a file to a task, however small the list

    def read(batches):
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(file, before)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return spread.mapInArrow(read, kinds)


def _documents(file: str, before: int) -> Iterator[pa.RecordBatch]:
    """Walk through a file once: documents in order, each from one or more batches of ids."""
    system, path = _locate(file)
    chunks = Sequences(file).tokens()
    held = np.empty(0, "<u4")  # sums are over 32-bit ids, whatever the width in the file
    with system.open_input_file(f"{path}.docs") as source:
        index = pa.ipc.open_file(source)
        for k in range(index.num_record_batches):
            docs = index.get_batch(k)
            sums = []
            for n in docs.column("n_tokens").to_pylist():
                crc = 0
                while n > len(held):
                    crc, n = zlib.crc32(held.tobytes(), crc), n - len(held)
                    held = next(chunks).astype("<u4")
                crc, held = zlib.crc32(held[:n].tobytes(), crc), held[n:]
                sums.append(crc)
            starts = docs.column("at").to_numpy() + before
            yield pa.RecordBatch.from_arrays(
                [docs.column("doc_id"), pa.array(starts), docs.column("n_tokens"),
                 pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
