"""Token ids as binary files with Elias-Fano encoded document boundaries.

Every text is encoded whole, an end id is appended, and the ids of all
documents form one array in ascending id order. The array lies in shards
(range partitions of the id), one file each:

    magic ``DLTI1``
    ids           n_ids little-endian numbers of ``width`` bytes: 2 if the vocabulary fits, else 4
    boundaries    Elias-Fano code of the running ends of the documents
    document ids  Elias-Fano code of (id - smallest id), in order
    header        seven u64 numbers: documents, documents without an id (they come
                  first), ids, smallest document id, bytes of both codes, width

An Elias-Fano code of n rising numbers below u keeps the low ``l = log2(u / n)``
bits of each in a packed array and the high parts as unary gaps in a bit
vector: at most n * (3 + l) bits in all, against 64 n for a table. ``select(i)`` finds
the i-th one of the bit vector through a directory of one 32-bit count to
``STRETCH`` bytes, so a document's offset is read without decoding the others. The
reader takes the end of every run of documents from it.

A shard knows only its own offsets; the start of a shard is the sum of the
shards before it, taken over the manifest (one row per file). Files are
written to the shared folder under names of the attempt, and the manifest
names those of the attempt that was committed.

Nulls: a null text is empty (the end id alone); null document ids come first.
Rows that repeat an id lie side by side, ordered by a hash of the text. An
empty table gives no files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import byte_slices
from delaylens.llm.files import create, open_input
from delaylens.llm.pieces import cut, gather
from delaylens.llm.token_count import load_tokenizer
from delaylens.session import materialize, scratch_path

MAGIC = b"DLTI1\0\0\0"
HEAD = struct.Struct("<7Q")
STRETCH = 64         # bytes of high bits to a directory entry
SUPER = 1 << 12      # directory entries to a superblock
ENCODE_RUN = 1 << 16
READ_DOCS = 1 << 13
KEPT_BYTES = 96 << 20      # of remembered pieces, their ids and about 150 bytes to each for the table
SLICE_BYTES = 8 << 20
RUN_PIECES = 512
READ_IDS = 1 << 20


class EliasFano:
    """A rising sequence of non-negative numbers in near-minimal space.

    ``select`` rests on two small tables: the ones before each stretch of ``STRETCH``
    bytes of the high bits, as 32-bit counts from the start of a superblock of
    ``SUPER`` stretches, and 64-bit counts of the superblocks: about 1/16 of the
    high bits. Inside a stretch the ones are counted."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        stretches = -(-len(high) // STRETCH)
        counts = np.zeros(stretches, np.uint16)
        for a in range(0, stretches, SUPER):      # a superblock at a time: work arrays stay small
            part = high[a * STRETCH:(a + SUPER) * STRETCH]
            counts[a:a + SUPER] = np.add.reduceat(np.bitwise_count(part), np.arange(0, len(part), STRETCH), dtype=np.uint16)
        self.near = np.zeros(stretches, np.uint32)
        self.far = np.zeros(-(-stretches // SUPER) + 1, np.int64)
        for k, a in enumerate(range(0, stretches, SUPER)):
            ends = np.cumsum(counts[a:a + SUPER], dtype=np.uint32)
            self.near[a + 1:a + SUPER] = ends[:-1]
            self.far[k + 1] = self.far[k] + int(ends[-1])

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (max(1, top) // max(1, n)).bit_length() - 1)
        low = np.zeros((n * low_bits + 7) // 8, np.uint8)
        high = np.zeros(((top >> low_bits) + n - 1) // 8 + 1 if n else 0, np.uint8)
        shifts = np.arange(low_bits, dtype=np.uint64)
        for a in range(0, n, ENCODE_RUN):      # a multiple of 8, so runs meet at bytes
            run = np.asarray(values[a:a + ENCODE_RUN]).astype(np.uint64)
            bits = np.packbits((run[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
            low[a * low_bits // 8:a * low_bits // 8 + len(bits)] = bits
            at = (run >> np.uint64(low_bits)).astype(np.int64) + np.arange(a, a + len(run))
            np.bitwise_or.at(high, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        return cls(n, low_bits, low, high)

    def to_bytes(self) -> bytes:
        return struct.pack("<4Q", self.n, self.low_bits, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, n_low, n_high = struct.unpack_from("<4Q", data)
        return cls(n, low_bits, np.frombuffer(data, np.uint8, n_low, 32), np.frombuffer(data, np.uint8, n_high, 32 + n_low))

    def directory_bytes(self) -> int:
        return self.near.nbytes + self.far.nbytes

    def _stretch(self, i: int) -> tuple[int, int]:
        """The stretch that holds the i-th one, and the ones before it."""
        block = int(np.searchsorted(self.far, i, side="right")) - 1
        first = block * SUPER
        at = first + int(np.searchsorted(self.near[first:first + SUPER], i - int(self.far[block]), side="right")) - 1
        return at, int(self.far[block]) + int(self.near[at])

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th one in the high bits, and its low bits."""
        at, before = self._stretch(i)
        bits = np.unpackbits(self.high[at * STRETCH:(at + 1) * STRETCH], bitorder="little")
        place = 8 * STRETCH * at + int(np.flatnonzero(bits)[i - before])
        low = 0
        for b in range(self.low_bits):
            k = i * self.low_bits + b
            low |= (int(self.low[k >> 3]) >> (k & 7) & 1) << b
        return (place - i) << self.low_bits | low

    def slice(self, a: int, b: int) -> np.ndarray:
        """Values a to b - 1 at once: the ends by the directory, the ones between them in one go."""
        if a >= b:
            return np.zeros(0, np.int64)
        first, before = self._stretch(a)
        last, _ = self._stretch(b - 1)
        ones = np.flatnonzero(np.unpackbits(self.high[first * STRETCH:(last + 1) * STRETCH], bitorder="little"))
        high = ones[a - before:][:b - a] + 8 * STRETCH * first - np.arange(a, b)
        if not self.low_bits:
            return high
        start, stop = a * self.low_bits, b * self.low_bits
        bits = np.unpackbits(self.low[start >> 3:(stop + 7) >> 3], bitorder="little")[start & 7:][:stop - start]
        low = bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return high << self.low_bits | low


class PieceIds:
    """Ids of texts from ids of their pieces, as the tokenizers library gives
    them. Pieces met before are codes into one flat pool of ids; a pool that holds
    more than KEPT_BYTES is begun anew."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # byte-level tokens are written with one character per byte
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._begin()

    def _begin(self) -> None:
        self.code, self.ids, self.ends, self.held = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), 0

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the order in which the pieces have them, and their number per piece in that order. Pieces that begin with a
        space and a letter or digit are matched the same when they stand side by
        side, so runs of them are encoded as one text; as every id stands for
        whole bytes, the bytes tell where a piece ends."""
        alone = np.array([len(p) < 2 or p[0] != " " or not p[1].isalnum() or "<|" in p for p in pieces], bool)
        together = [p for p, a in zip(pieces, alone.tolist()) if not a]
        runs = [together[k:k + RUN_PIECES] for k in range(0, len(together), RUN_PIECES)]
        got = iter(self.tokenizer.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False))
        single = iter(self.tokenizer.encode_batch_fast([p for p, a in zip(pieces, alone.tolist()) if a], add_special_tokens=False))
        sizes, flat = [], []
        for r in runs:
            ids = next(got).ids
            stop = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum([len(p.encode()) for p in r])) + 1
            sizes.append(np.diff(stop, prepend=0))
            flat.append(ids)
        size = np.zeros(len(pieces), np.int64)
        size[~alone] = np.concatenate(sizes) if sizes else 0
        rest = [next(single).ids for _ in range(int(alone.sum()))]
        size[alone] = [len(x) for x in rest]
        ids = np.fromiter(itertools.chain(*flat, *rest), np.uint32, int(size.sum()))
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        return ids, order, size[order]

    def _codes(self, pieces: list[str]) -> np.ndarray:
        found = np.array([self.code.get(p, -1) for p in pieces], np.int64)
        at = np.flatnonzero(found < 0)
        ids, order, sizes = self._encode([pieces[k] for k in at.tolist()])
        at = at[order]
        found[at] = np.arange(len(self.ends), len(self.ends) + len(at))
        self.code.update(zip([pieces[k] for k in at.tolist()], found[at].tolist()))
        self.held += sum(len(pieces[k]) for k in at.tolist()) + ids.nbytes + 150 * len(at)
        first = int(self.ends[-1]) if len(self.ends) else 0
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, first + np.cumsum(sizes)])
        return found

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end ids, and the number of ids of each text."""
        pieces, index, stops = cut(texts)
        index = self._codes(pieces)[index] if pieces else index
        pool = np.append(self.ids, np.uint32(end_id))
        ends = np.append(self.ends, len(pool))
        index = np.insert(index, stops, len(ends) - 1)      # the end id after each text
        ids, at = gather(pool, ends, index)
        if self.held > KEPT_BYTES:
            self._begin()
        closing = at[stops + np.arange(len(stops))]
        return ids, np.diff(closing, prepend=0)


_PIECES: dict = {}


def piece_ids(path: str) -> PieceIds:
    if path not in _PIECES:
        _PIECES[path] = PieceIds(path)
    return _PIECES[path]


def _write_shard(folder: str, path: str, end_id: int, batches: Iterator[pa.RecordBatch]):
    """Ids stream to the file; boundaries and document ids, a few bytes per
    document, follow when the last document is written."""
    own, name, shard = piece_ids(path), f"{folder}/{uuid.uuid4().hex}.ids", None
    sizes, docs, nulls, n_ids, out = [], [], 0, 0, None
    width = max(own.width, 2 if end_id < 1 << 16 else 4)
    for batch in batches:
        for part in byte_slices(batch, 1, SLICE_BYTES):
            if out is None:
                out = create(name)
                out.write(MAGIC)
                shard = part.column(2)[0].as_py()
            ids, n = own.texts(part.column(1), end_id)
            out.write(ids.astype(f"<u{width}").tobytes())
            sizes.append(n)
            nulls += part.column(0).null_count
            docs.append(part.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            n_ids += len(ids)
    if out is None:
        return
    docs, sizes = np.concatenate(docs), np.concatenate(sizes)
    least = int(docs[0]) if len(docs) else 0
    ends = EliasFano.encode(np.cumsum(sizes)).to_bytes()
    names = EliasFano.encode((docs - least).astype(np.uint64)).to_bytes()
    out.write(ends + names + HEAD.pack(len(sizes), nulls, n_ids, least % (1 << 64), len(ends), len(names), width))
    out.close()
    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name],
                                      "n_docs": [len(sizes)], "n_ids": [n_ids]})


def write_token_ids(docs: DataFrame, path: str, end_id: int = 0, shards: int | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Write the files; returns the manifest (shard, path, n_docs, n_ids), a written table."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .repartitionByRange(shards, "doc_id").withColumn("shard", F.spark_partition_id())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    return materialize(rows.mapInArrow(lambda batches: _write_shard(folder, path, end_id, batches),
                                       "shard int, path string, n_docs long, n_ids long"), "token-manifest")


class Shard:
    """Random access to one file: the ids of the i-th document."""

    def __init__(self, path: str):
        self.file = open_input(path)
        size = self.file.size()
        head = self._at(size - HEAD.size, HEAD.size)
        self.n, self.nulls, self.n_ids, least, n_ends, n_names, self.width = HEAD.unpack(head)
        self.least = least - (1 << 64) * (least >> 63)
        if self._at(0, 8) != MAGIC or size != 8 + self.width * self.n_ids + n_ends + n_names + HEAD.size:
            raise ValueError(f"{path} is no token file or is cut off")
        codes = self._at(8 + self.width * self.n_ids, n_ends + n_names)
        self.ends, self.names = EliasFano.from_bytes(codes[:n_ends]), EliasFano.from_bytes(codes[n_ends:])

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1 of the shard's array."""
        return np.frombuffer(self._at(8 + self.width * a, self.width * (b - a)), f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def _run_end(self, a: int, from_id: int) -> int:
        """The document after the run that starts at ``a``: as many as end within READ_IDS
        ids, one at least and READ_DOCS at most, by bisection over ``select``."""
        low, high = a + 1, min(self.n, a + READ_DOCS)
        while low < high:
            middle = (low + high + 1) // 2
            if self.ends.select(middle - 1) <= from_id + READ_IDS:
                low = middle
            else:
                high = middle - 1
        return low

    def runs(self) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Runs of whole documents of about READ_IDS ids: document ids, ends within the run, ids."""
        a, from_id = 0, 0
        while a < self.n:
            b = self._run_end(a, from_id)
            ends = self.ends.slice(a, b)
            known = self.names.slice(max(0, a - self.nulls), max(0, b - self.nulls)) + self.least
            docs = [None] * (b - a - len(known)) + known.tolist()
            yield docs, ends - from_id, self.ids(from_id, self.ends.select(b - 1))
            a, from_id = b, int(ends[-1])


def read_token_ids(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)      # one row per file
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    parts = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for docs, ends, ids in Shard(path).runs():
                    data, starts = memoryview(ids.tobytes()), np.concatenate([[0], ends[:-1]])
                    crc = [zlib.crc32(data[4 * int(a):4 * int(b)]) for a, b in zip(starts, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                    first += int(ends[-1])

    return (files.repartition(parts, "path")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
