"""Token-id files coded with a static range asymmetric numeral system (rANS).

One table of symbol frequencies, counted over all documents and scaled to 2**BITS, is shared by all blocks.
A block holds whole documents and can be decoded by itself. Its ids are dealt in turn to LANES interleaved
coders; states are 64-bit and give off 32-bit words. Layout of a block, all little-endian:

    magic "RNS2" | lanes u32 | span u32 | ids u64 | words u64 | checkpoints u32 | crc32 of the ids u32 | crc32 of all else u32
    per checkpoint: step u64 | first word u64 | crc32 of the ids up to the next u32 | 0 u32 | a state u64 for each lane
    words u32

The first checkpoint is at step 0; others follow every SPAN steps, of which a block has several. ``decode`` goes
from all of them at once, in steps that take an id of every lane of every span; one span can be decoded by itself, and
``spans`` deals them over all tasks. A block or span whose checksum differs is refused.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import wordhash
from dialoom.llm.shared import Scratch, partitions
from dialoom.llm.tokens import Encoder

BITS = 20
LANES = 512
#: Steps between checkpoints: 65,536 ids, a quarter of an ordinary block.
SPAN = 128
#: A block ends with the document that brings it to as many ids.
BLOCK_IDS = 1 << 18
#: Bytes of a Parquet row group, which a writer holds in memory.
GROUP_BYTES = 16 << 20
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIQQIII")
_MARK = struct.Struct("<QQII")


class CorruptBlock(ValueError):
    """A block's header or a checksum isn't what it should be."""


class Table:
    """Frequencies scaled to 2**BITS, at least 1 for each symbol that occurs."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.float64)
        used = np.flatnonzero(counts)
        if len(used) > 1 << BITS:
            raise ValueError("more symbols than the table has places")
        freq = np.zeros(len(counts), np.int64)
        if len(used):
            total = 1 << BITS
            share = counts[used] / counts[used].sum() * (total - len(used))
            f = 1 + np.floor(share).astype(np.int64)
            short = total - int(f.sum())
            f[np.argsort(-(share % 1), kind="stable")[:short]] += 1
            freq[used] = f
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        """The symbol of each place; made when first decoding."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block."""
    n = len(ids)
    steps = -(-n // LANES)
    x = np.full(LANES, _LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    given = 0
    freq, first = table.freq[ids], table.first[ids]
    limit, more = freq << np.uint64(63 - BITS), np.uint64(1 << BITS) - freq
    for step in range(steps - 1, -1, -1):
        a, b = step * LANES, min(n, (step + 1) * LANES)
        y = x[: b - a]
        full = np.flatnonzero(y >= limit[a:b])
        out = y[full]
        y[full] = out >> np.uint64(32)
        out = out.astype("<u4")  # the lower half
        # ((y // f) << BITS) + y % f + first
        y += (y // freq[a:b]) * more[a:b] + first[a:b]
        words.append(out)
        given += len(out)
        if step % SPAN == 0:
            marks.append((step, given, x.copy()))
    raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
    each = 4 * SPAN * LANES
    body = b"".join(_MARK.pack(s, given - g, zlib.crc32(raw[each * k : each * (k + 1)]), 0) + state.astype("<u8").tobytes() for k, (s, g, state) in enumerate(reversed(marks)))
    body += b"".join(w.tobytes() for w in reversed(words))
    return _sealed(_HEAD.pack(b"RNS2", LANES, SPAN, n, given, len(marks), zlib.crc32(raw), 0), body)


def _sealed(head: bytes, body: bytes) -> bytes:
    return head[:-4] + struct.pack("<I", zlib.crc32(body, zlib.crc32(head[:-4]))) + body


def _head(block: bytes) -> tuple:
    if len(block) < _HEAD.size:
        raise CorruptBlock("a block is too short")
    magic, *rest, seal = _HEAD.unpack_from(block)
    view = memoryview(block)
    if magic != b"RNS2" or zlib.crc32(view[_HEAD.size :], zlib.crc32(view[: _HEAD.size - 4])) != seal:
        raise CorruptBlock("a block's checksum differs")
    return tuple(rest)


def span_count(block: bytes) -> int:
    """How many spans, each of which can be decoded by itself, a block has."""
    return _head(block)[4]


def decode(block: bytes, table: Table, span: int | None = None) -> np.ndarray:
    """The ids of a block, or only those from one checkpoint to the next."""
    lanes, stride, n, given, marks, crc = _head(block)
    each = _MARK.size + 8 * lanes
    words = np.frombuffer(block, "<u4", given, _HEAD.size + marks * each).astype(np.uint64)
    chosen = range(marks) if span is None else [span]
    heads = [_MARK.unpack_from(block, _HEAD.size + k * each) for k in chosen]
    x = np.stack([np.frombuffer(block, "<u8", lanes, _HEAD.size + k * each + _MARK.size) for k in chosen]).astype(np.uint64) if heads else np.zeros((0, lanes), np.uint64)
    w = np.array([h[1] for h in heads], np.int64)
    sizes = [min(n, (k + 1) * stride * lanes) - k * stride * lanes for k in chosen]  # only the last may be short
    out = np.empty((len(sizes), stride * lanes), np.uint32)
    low, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS)

    def step(y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of states (a row for each span), and the states after; ``at``: the spans' next words, moved on."""
        place = y & low
        s = table.symbol[place]
        y = table.freq[s] * (y >> shift) + place - table.first[s]
        less = y < _LOW
        took = np.count_nonzero(less, axis=1)
        few = np.flatnonzero(less)
        if len(few):
            flat = y.reshape(-1)
            flat[few] = (flat[few] << np.uint64(32)) | words[np.repeat(at - np.cumsum(took) + took, took) + np.arange(len(few))]
            at += took
        return s, y

    for t in range(stride):
        full = sum(m >= (t + 1) * lanes for m in sizes)  # spans with an id in every lane; they come first
        if full:
            at = w[:full]
            out[:full, t * lanes : (t + 1) * lanes], x[:full] = step(x[:full], at)
            w[:full] = at
        if full < len(sizes):
            if (m := sizes[-1] - t * lanes) > 0:
                out[-1:, t * lanes : t * lanes + m], _ = step(x[-1:, :m], w[-1:].copy())
                sizes[-1] = -1  # done
            if not full:
                break
    ids = np.concatenate([out[k, : min(n, (c + 1) * stride * lanes) - c * stride * lanes] for k, c in enumerate(chosen)]) if heads else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != (crc if span is None else heads[0][2]):
        raise CorruptBlock("the ids' checksum differs")
    return ids


@dataclass(frozen=True)
class Plan:
    tokenizer: str
    end: int = 2
    #: Ids are below this.
    vocabulary: int = 1 << 16


def _ids(plan: Plan):
    def run(batches):
        coder = Encoder.of(plan.tokenizer)
        kind = "<u2" if plan.vocabulary <= 1 << 16 else "<u4"
        for batch in batches:
            for part in wordhash.parts(batch, "text", 2 << 20):
                ids, off = coder.encode(part.column("text"), plan.end)
                raw, w = ids.astype(kind).tobytes(), int(kind[-1])
                rows = pa.array([raw[w * a : w * b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), rows], names=["doc_id", "ids"])
        wordhash.trim()

    return run


def _counts(plan: Plan):
    def run(batches):
        kind = "<u2" if plan.vocabulary <= 1 << 16 else "<u4"
        total = np.zeros(plan.vocabulary, np.int64)
        for batch in batches:
            col = pa.array(batch.column("ids"))
            _, off, data = col.buffers()
            o = np.frombuffer(off, np.int32 if pa.types.is_binary(col.type) else np.int64)[col.offset : col.offset + len(col) + 1]
            if data is not None and o[-1] > o[0]:
                ids = np.frombuffer(data, np.uint8)[o[0] : o[-1]].tobytes()
                total += np.bincount(np.frombuffer(ids, kind), minlength=plan.vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    return run


def _write(plan: Plan, table: Table):
    """Blocks of a part's rows, which come in order."""

    def run(batches):
        Encoder.forget()  # a worker may have one from the stage before, which isn't needed beside blocks
        wordhash.frugal()
        kind = "<u2" if plan.vocabulary <= 1 << 16 else "<u4"
        docs, held, n, start, number, part = [], [], 0, 0, 0, None

        def out():
            ids = np.concatenate(held).astype(np.uint32)
            sizes = np.array([len(h) for h in held], np.int64)
            cols = [
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([encode(ids, table)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(cols, names=["part", "number", "start", "n_ids", "doc_ids", "sizes", "block"])

        for batch in batches:
            for p, d, x in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                part = p
                docs.append(d)
                held.append(np.frombuffer(x, kind))
                n += len(held[-1])
                if n >= BLOCK_IDS:
                    yield out()
                    docs, held, start, n, number = [], [], start + n, 0, number + 1
        if held:
            yield out()
        wordhash.trim()

    return run


def _read(table: Table):
    def run(batches):
        for batch in batches:
            for base, docs, sizes, block in zip(*(batch.column(c).to_pylist() for c in ("base", "doc_ids", "sizes", "block")), strict=True):
                raw = decode(block, table).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(raw[4 * (b - m) : 4 * b]) for b, m in zip(ends.tolist(), sizes, strict=True)]
                cols = [pa.array(docs, pa.int64()), pa.array(base + ends - np.array(sizes)), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write(spark: SparkSession, docs: DataFrame, plan: Plan, path: str) -> Table:
    """Tokenise each row of ``docs(doc_id, text)`` once, count the ids of all, and write their blocks in
    ascending order of doc_id (nulls first; equal ids by their tokens) to ``path`` as Parquet, whose column
    ``block`` holds the format above. Returns the shared table, which is written beside the blocks."""
    scratch = Scratch(spark, "ids")
    ids = scratch.save(docs.select("doc_id", "text").mapInArrow(_ids(plan), "doc_id long, ids binary"), "ids")
    found = ids.select("ids").mapInArrow(_counts(plan), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(plan.vocabulary, np.int64)
    for r in found.collect():  # at most the vocabulary
        counts[r["id"]] = r["n"]
    table = Table(counts)
    ordered = ids.repartitionByRange(partitions(spark), "doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", F.xxhash64("ids"), "ids")
    blocks = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    schema = "part int, number int, start long, n_ids long, doc_ids array<long>, sizes array<long>, block binary"
    blocks.mapInArrow(_write(plan, table), schema).write.mode("overwrite").option("compression", "none").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/blocks")
    spark.createDataFrame([(int(i), int(table.freq[i])) for i in np.flatnonzero(table.freq)], "id int, freq long").write.mode("overwrite").parquet(f"{path}/table")
    scratch.drop("ids")
    return table


def load_table(spark: SparkSession, path: str, vocabulary: int) -> Table:
    table = Table(np.zeros(vocabulary))
    freq = np.zeros(vocabulary, np.int64)
    for r in spark.read.parquet(f"{path}/table").collect():  # at most the vocabulary
        freq[r["id"]] = r["freq"]
    table.freq = freq.astype(np.uint64)
    table.first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    return table


def read(spark: SparkSession, path: str, vocabulary: int = 1 << 16) -> DataFrame:
    """Decode the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    table = load_table(spark, path, vocabulary)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row for each part
    before = [0]
    for p in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(p, 0))
    first = F.element_at(F.array(*map(F.lit, before)), F.col("part") + 1)
    rows = blocks.select((first.cast("long") + F.col("start")).alias("base"), "doc_ids", "sizes", "block")
    return rows.mapInArrow(_read(table), "doc_id long, start long, n_tokens long, ids_crc32 long")


def spans(spark: SparkSession, path: str, vocabulary: int = 1 << 16) -> DataFrame:
    """The ids of all blocks by checkpoint, each span decoded by itself and dealt over all tasks, so that even the block
    of one very long document is decoded in parallel: part, number, span, ids."""
    table = load_table(spark, path, vocabulary)

    def cut(batches):
        for batch in batches:
            for p, k, block in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "block")), strict=True):
                for i in range(span_count(block)):
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([k], pa.int32()), pa.array([i], pa.int32()), pa.array([only(block, i)], pa.binary())], names=["part", "number", "span", "block"])

    def run(batches):
        for batch in batches:
            ids = [decode(b, table, 0) for b in batch.column("block").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "number", "span")), pa.array(ids, pa.list_(pa.int64()))], names=["part", "number", "span", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks").select("part", "number", "block").mapInArrow(cut, "part int, number int, span int, block binary")
    return blocks.repartition(partitions(spark), "part", "number", "span").mapInArrow(run, "part int, number int, span int, ids array<long>")


def only(block: bytes, span: int) -> bytes:
    """A block that holds one span of another: its checkpoint and the words up to the next one's."""
    lanes, stride, n, given, marks, _ = _head(block)
    each = _MARK.size + 8 * lanes
    at = _HEAD.size + span * each
    _, first, crc, _ = _MARK.unpack_from(block, at)
    last = _MARK.unpack_from(block, at + each)[1] if span + 1 < marks else given
    words = _HEAD.size + marks * each
    body = _MARK.pack(0, 0, crc, 0) + block[at + _MARK.size : at + each] + block[words + 4 * first : words + 4 * last]
    return _sealed(_HEAD.pack(b"RNS2", lanes, stride, min(n - span * stride * lanes, stride * lanes), last - first, 1, crc, 0), body)


def round_trip(spark: SparkSession, docs: DataFrame, plan: Plan) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and read them back.

    Null text is empty: it has the end id alone. An empty table gives no rows. Rows with equal ids are all
    kept. Other columns of ``docs`` are ignored.
    """
    path = Scratch(spark, "ans").path("files")
    write(spark, docs, plan, path)
    return read(spark, path, plan.vocabulary)
