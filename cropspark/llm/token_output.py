"""Token ids in Arrow files of equal-length sequences, with masks.

Documents are range-partitioned by id, sorted, encoded and packed in order: a partition's ids
fill sequences of `LENGTH` ids, and only its last sequence is padded (mask false). A file holds
record batches of `ROWS` sequences, `BATCHES` at most, as fixed-size lists: column `ids` of
unsigned 16-bit integers (32-bit for larger vocabularies) and column `mask`. Nothing is
compressed, so sequence i is a view into the mapped file. The schema's metadata names the place
of the file (partition, number) and the documents that start in it (ids, places, lengths).

Spark's text writer commits the files: a row is a file without its closing magic bytes, which
are the line separator, and there is one row a file. So no executor writes outside Spark's
commit protocol, and any file system Spark can write will do. Memory is bounded by a slice of
texts, one file and the chunks that a worker remembers (`Encoder`).

Defined results: null and empty texts give the end id alone; documents without an id come
first; documents with equal ids follow each other in order of text, null before empty (equal rows
are alike), so a task that runs again packs the same files; an empty table gives no sequences and no
rows; only the id and text columns are read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from cropspark.llm.frames import stored
from cropspark.llm.text_arrays import Texts, mixed, slices
from cropspark.llm.token_alignment import BYTE_LEVEL_PATTERN
from cropspark.llm.worker_cache import kept

LENGTH = 1024
ROWS = 256
BATCHES = 4
MAGIC = "ARROW1"
SLICE_BYTES = 1 << 20
KEPT_CHUNKS = 400_000
KEPT_IDS = 8_000_000
KEPT_BYTES = 16 << 20
#: Bytes of a chunk that are compared as numbers.
WIDE = 24
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def load_tokenizer(path: str):
    """The tokenizer of a file, which a worker reads once."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    def read():
        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    return kept(("tokenizer", path), read)


def chunk_starts(part: Texts) -> np.ndarray:
    """Places at which `BYTE_LEVEL_PATTERN` ends a piece whatever stands around, and the starts of texts.

    These are a blank after a sign that is surely no blank, a single line feed between two such signs and
    the sign after it, and a printable ASCII sign, no letter, after a letter of ASCII or Latin-1. The pieces
    of a chunk are those that the whole text has there.
    """
    data = np.concatenate([np.full(3, 32, np.uint8), part.data, np.full(1, 32, np.uint8)])
    printable = (data > 32) & (data < 127)
    letter = ((data | 32) - np.uint8(97)) < 26
    going = (data & 192) == 128  # in a sign of several bytes
    two, latin = (data >= 0xC3) & (data < 0xE0), data == 0xC3
    three = (data >= 0xE4) & (data < 0xEE)
    # what ends at the byte before each place
    solid = printable[2:-2] | (going[2:-2] & (two[1:-3] | (going[1:-3] & three[:-4])))
    word = letter[2:-2] | (going[2:-2] & latin[1:-3] & (data[2:-2] != 0x97) & (data[2:-2] != 0xB7))
    here = data[3:-1]
    cut = np.zeros(len(part.data) + 1, bool)
    cut[:-1] = (solid & (here == 32)) | (word & printable[3:-1] & ~letter[3:-1])
    lone = solid & (here == 10) & (printable[4:] | two[4:] | three[4:])
    cut[:-1] |= lone
    cut[1:] |= lone
    cut[part.offsets] = True
    return np.flatnonzero(cut[:-1])


class Grown:
    """An array that rows are added to."""

    def __init__(self, dtype: type, *shape: int):
        self.all, self.n = np.empty((1 << 12, *shape), dtype), 0

    def add(self, rows: np.ndarray) -> None:
        end = self.n + len(rows)
        if end > len(self.all):
            held, self.all = self.all[: self.n], np.empty((2 * end, *self.all.shape[1:]), self.all.dtype)
            self.all[: self.n] = held
        self.all[self.n : end] = rows
        self.n = end


class Numbers:
    """Numbers of 64-bit hashes, found by looking on from the place that a hash names."""

    def __init__(self):
        self.hashes, self.slots = Grown(np.uint64), np.full(1 << 13, -1, np.int32)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for one that has none."""
        last = np.uint64(len(self.slots) - 1)
        at = (hashes & last).astype(np.int64)
        found = self.slots[at]
        other = np.flatnonzero((found >= 0) & (self.hashes.all[found] != hashes))
        while len(other):
            at[other] = (at[other] + 1) & int(last)
            found[other] = self.slots[at[other]]
            other = other[(found[other] >= 0) & (self.hashes.all[found[other]] != hashes[other])]
        return found

    def add(self, hashes: np.ndarray) -> None:
        """The next numbers to the hashes, which have none and differ from each other."""
        start = self.hashes.n
        self.hashes.add(hashes)
        if 2 * self.hashes.n > len(self.slots):
            self.slots, start = np.full(2 << self.hashes.n.bit_length(), -1, np.int32), 0
        own = np.arange(start, self.hashes.n, dtype=np.int32)
        at = (self.hashes.all[own] & np.uint64(len(self.slots) - 1)).astype(np.int64)
        while len(own):
            free = self.slots[at] < 0
            self.slots[at[free]] = own[free]
            left = self.slots[at] != own
            own, at = own[left], (at[left] + 1) & (len(self.slots) - 1)


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer of the tokenizers library.

    Such a tokenizer splits a text by a pattern and encodes each piece on its own. With the standard
    pattern a slice of texts is cut into chunks of whole pieces (`chunk_starts`), a chunk is given to the
    library once and its ids are remembered, up to `KEPT_CHUNKS` chunks. Chunks are found by a hash
    of their bytes, size and up to `WIDE` bytes being compared; longer ones by themselves. New chunks go in lines
    of one string, whose line feeds are pieces of their own; chunks with other blanks go one by
    one. With any other pattern whole texts go to the library.
    """

    def __init__(self, path: str, pattern: str):
        self.tokenizer = load_tokenizer(path)
        self.line_feed = self._ids("\n")
        self.cuts = pattern == BYTE_LEVEL_PATTERN and len(self.line_feed) == 1
        self.one_line = re.compile(r" ?\S+").fullmatch
        self.forget()

    def forget(self) -> None:
        self.short, self.keys, self.place = Numbers(), Grown(np.uint64, WIDE // 8 + 1), Grown(np.int64)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.start, self.count, self.ids = Grown(np.int64), Grown(np.int64), Grown(np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.start.add(self.ids.n + np.cumsum(counts) - counts)
        self.count.add(counts)
        self.ids.add(ids)

    def learn(self, chunks: list[bytes]) -> np.ndarray:
        """Learn the ids of new chunks; gives the place among `chunks` of each in the order of its place."""
        texts = [c.decode("utf-8", "replace") for c in chunks]
        plain = [self.one_line(t) is not None for t in texts]
        lines, rest = list(itertools.compress(texts, plain)), [t for t, p in zip(texts, plain) if not p]
        for at in range(0, len(lines), 2000):
            own = lines[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(own)], add_special_tokens=False)[0].ids, np.uint32)
            feeds = np.flatnonzero(ids == self.line_feed[0])
            if len(feeds) == len(own) - 1:
                self._add(np.delete(ids, feeds), np.diff(feeds, prepend=-1, append=len(ids)) - 1)
            else:  # the tokenizer doesn't keep these line feeds apart
                self._add(*_flat([self._ids(t) for t in own]))
        if rest:
            self._add(*_flat([e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]))
        return np.argsort(~np.array(plain, bool), kind="stable")

    def places(self, part: Texts, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of each chunk in `start` and `count`."""
        raw = part.data.tobytes() + bytes(WIDE)
        eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        keys = np.empty((len(starts), WIDE // 8 + 1), np.uint64)
        keys[:, 0] = sizes
        hashes = sizes.astype(np.uint64)
        for k in range(WIDE // 8):
            at = np.minimum(starts + 8 * k, len(eights) - 1)
            keys[:, k + 1] = eights[at] & _FIRST_BYTES[np.clip(sizes - 8 * k, 0, 8)]
            hashes = mixed(hashes ^ keys[:, k + 1])
        hashes[sizes > WIDE] = 0
        found = self.short.get(hashes)
        other = np.flatnonzero((found < 0) & (sizes <= WIDE))
        if len(other):
            new = other[np.unique(hashes[other], return_index=True)[1]]
            new = new[self.learn([raw[a:b] for a, b in zip(starts[new].tolist(), (starts + sizes)[new].tolist())])]
            self.short.add(hashes[new])
            self.keys.add(keys[new])
            self.place.add(np.arange(self.start.n - len(new), self.start.n))
            found[other] = self.short.get(hashes[other])
        other = np.flatnonzero((found < 0) | (sizes > WIDE) | (self.keys.all[found] != keys).any(axis=1))
        found = self.place.all[found]
        if len(other):  # long chunks, and any whose hash is another's too
            chunks = [raw[a:b] for a, b in zip(starts[other].tolist(), (starts + sizes)[other].tolist())]
            new = list(dict.fromkeys(c for c in chunks if c not in self.long))
            if new:
                n = self.start.n
                self.long.update((new[k], n + i) for i, k in enumerate(self.learn(new).tolist()))
                self.long_bytes += sum(map(len, new))
            found[other] = [self.long[c] for c in chunks]
        return found

    def encode(self, texts: list[str], end_id: int) -> Iterator[np.ndarray]:
        """The ids, with the end id, of each text."""
        for part in slices(pa.array(texts, pa.string()), SLICE_BYTES):
            yield from self.encode_slice(part, end_id)

    def encode_slice(self, part: Texts, end_id: int) -> Iterator[np.ndarray]:
        """The ids, with the end id, of each text of a slice."""
        if not self.cuts:
            texts = [part.text(i).decode("utf-8", "replace") for i in range(part.n)]
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array([*e.ids, end_id], np.uint32)
            return
        if self.start.n > KEPT_CHUNKS or self.ids.n > KEPT_IDS or self.long_bytes > KEPT_BYTES:
            self.forget()
        starts = chunk_starts(part)
        sizes = np.diff(starts, append=len(part.data))
        found = self.places(part, starts, sizes) if len(starts) else starts
        counts = self.count.all[found]
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids.all[np.repeat(self.start.all[found] - before[:-1], counts) + np.arange(before[-1])]
        ends = before[np.searchsorted(starts, part.offsets[1:])]
        whole = np.insert(ids, ends, np.uint32(end_id))
        ends = ends + np.arange(1, part.n + 1)
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield whole[a:b]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids one after the other, and how many each list has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


def encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and token ids, with the end id, of each document (columns: id, text)."""
    encoder = kept(("encoder", path, pattern), lambda: Encoder(path, pattern))
    for batch in batches:
        for part in slices(batch.column(1), SLICE_BYTES):
            ids = batch.column(0).slice(part.first, part.n).to_pylist()
            yield from zip(ids, encoder.encode_slice(part, end_id))


def _file(tokens: np.ndarray, width: np.dtype, partition: int, number: int, docs: list[tuple]) -> bytes:
    """An Arrow file of the tokens; docs are (id or None, place in the partition, length)."""
    rows = -(-len(tokens) // LENGTH)
    flat = np.zeros(rows * LENGTH, width)
    flat[: len(tokens)] = tokens
    mask = np.zeros(rows * LENGTH, bool)
    mask[: len(tokens)] = True
    ids = np.array([d[0] or 0 for d in docs], "<i8").tobytes()
    schema = pa.schema(
        [
            pa.field("ids", pa.list_(pa.from_numpy_dtype(width), LENGTH), False),
            pa.field("mask", pa.list_(pa.bool_(), LENGTH), False),
        ],
        metadata={
            "partition": str(partition),
            "number": str(number),
            "doc_ids": ids,
            "without_id": bytes(d[0] is None for d in docs),
            "places": np.array([d[1] for d in docs], "<i8").tobytes(),
            "lengths": np.array([d[2] for d in docs], "<i8").tobytes(),
        },
    )
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, schema) as writer:
        for at in range(0, rows, ROWS):
            span = slice(at * LENGTH, min(rows, at + ROWS) * LENGTH)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[span]), LENGTH) for x in (flat, mask)]
            writer.write_batch(pa.record_batch(lists, schema=schema))
    data = out.getvalue().to_pybytes()
    assert data.endswith(MAGIC.encode())
    return data[: -len(MAGIC)]


def _packed(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    width = np.dtype("<u2" if load_tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")
    partition, full = TaskContext.get().partitionId(), LENGTH * ROWS * BATCHES
    held, docs, place, number = [], [], 0, 0
    for doc_id, ids in encoded(batches, path, pattern, end_id):
        docs.append((doc_id, place, len(ids)))
        place += len(ids)
        held.append(ids)
        while place - number * full >= full:
            tokens = np.concatenate(held)
            starts = [d for d in docs if d[1] < (number + 1) * full]
            yield pa.RecordBatch.from_pydict({"file": pa.array([_file(tokens[:full], width, partition, number, starts)], pa.binary())})
            docs, held, number = docs[len(starts) :], [tokens[full:]], number + 1
    if place > number * full:
        rest = _file(np.concatenate(held), width, partition, number, docs)
        yield pa.RecordBatch.from_pydict({"file": pa.array([rest], pa.binary())})


def write_sequences(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode `docs` in ascending order of id and write the files below `path`."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(lambda batches: _packed(batches, tokenizer, pattern, end_id), "file binary")
    files.select(F.col("file").cast("string").alias("value")).write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1).text(path)


class Sequences:
    """Random access to the sequences of one file; a path is memory-mapped, a buffer used as it is."""

    def __init__(self, source: str | bytes | pa.Buffer):
        opened = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.file = pa.ipc.open_file(opened)
        meta = self.file.schema.metadata
        self.partition, self.number = int(meta[b"partition"]), int(meta[b"number"])
        ids = np.frombuffer(meta[b"doc_ids"], "<i8").tolist()
        self.doc_ids = [None if gone else i for i, gone in zip(ids, meta[b"without_id"])]
        self.places, self.lengths = (np.frombuffer(meta[k], "<i8") for k in (b"places", b"lengths"))
        self.length = self.file.schema.field("ids").type.list_size

    def batch(self, k: int) -> np.ndarray:
        """The ids of a record batch, one sequence a row, without a copy."""
        values = self.file.get_batch(k).column(0).flatten()
        return values.to_numpy(zero_copy_only=True).reshape(-1, self.length)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence i."""
        batch = self.file.get_batch(i // ROWS)
        row = i % ROWS
        ids = batch.column(0)[row].values.to_numpy(zero_copy_only=True)
        return ids, batch.column(1)[row].values.to_numpy(zero_copy_only=False)

    def tokens(self) -> np.ndarray:
        """All ids that are not padding."""
        parts = [self.batch(k) for k in range(self.file.num_record_batches)]
        masks = [self.file.get_batch(k).column(1).flatten().to_numpy(zero_copy_only=False) for k in range(len(parts))]
        return np.concatenate([p.ravel()[m] for p, m in zip(parts, masks)])


_PIECES = "partition bigint, place bigint, at bigint, doc_id bigint, length bigint, n bigint, ids binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's part in a file; `doc_id` and `length` only where the document starts."""
    names = [x.split()[0] for x in _PIECES.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            file = Sequences(content.as_buffer())
            tokens = file.tokens().astype("<u4")
            first = file.number * LENGTH * ROWS * BATCHES
            # what comes before the first document that starts here ends an earlier one
            starts = [first, *file.places.tolist(), first + len(tokens)]
            rows = []
            for k in range(len(starts) - 1):
                a, b = starts[k], min(starts[k + 1], first + len(tokens))
                if b > a:
                    own = (file.doc_ids[k - 1], int(file.lengths[k - 1])) if k else (None, None)
                    rows.append((file.partition, a if k else -1, a, *own, b - a, tokens[a - first : b - first].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(zip(*rows), names)], names=names
            )


def _with_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        ids = batch.column("ids")
        crc = [zlib.crc32(x.as_buffer()) for x in ids]
        # whole documents go on as numbers; only those that run over a file's end keep their ids
        whole = [p >= 0 and n == m for p, n, m in zip(*(batch.column(c).to_pylist() for c in ("place", "length", "n")))]
        left = pa.array([None if w else x.as_py() for w, x in zip(whole, ids)], pa.binary())
        yield batch.set_column(6, "ids", left).append_column("crc", pa.array(crc, pa.int64()))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    pieces = stored(files.mapInArrow(_with_crc, _PIECES + ", crc bigint"), "pieces")
    whole = pieces.filter("ids is null").select("partition", "place", "doc_id", "n", "crc")
    # a piece that goes on belongs to the last document that starts before it in its partition
    parts = pieces.filter("ids is not null")
    run = Window.partitionBy("partition").orderBy("at")
    owner = F.max(F.when(F.col("place") >= 0, F.col("place"))).over(run)
    joined = (
        parts.withColumn("place", owner)
        .groupBy("partition", "place")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    )
    content = F.array_join(F.transform("parts", lambda p: p["ids"].cast("string")), "").cast("binary")
    docs = whole.unionByName(joined.select("partition", "place", "doc_id", "n", F.crc32(content).alias("crc")))
    totals = pieces.groupBy("partition").agg(F.sum("n").alias("all"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("partition", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    return docs.join(offsets, "partition").select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )
