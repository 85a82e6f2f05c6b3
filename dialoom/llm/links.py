"""How many links each set of a component has, derived from a highly similar set's.

All links lie within components. In each component one set, the one with most links known so far, is the centre c; every
other set x is kept as its difference x ^ c, which is small where the sets are near. For two sets

    |x ^ y| = |x ^ c| + |y ^ c| - 2 |(x ^ c) & (y ^ c)|,

so answers of all pairs follow from the differences alone. With slack(x) = (den - num) * |x| - (den + num) * |x ^ c|, x and
y link exactly if slack(x) + slack(y) + 2 (den + num) |(x ^ c) & (y ^ c)| >= 0. Members are put in order of slack and cut into
blocks: two blocks whose slacks can't add up to less than zero link as a whole, two that can't be lifted to zero by their
differences don't at all, and neither are compared; others are by one product of matrices. Pairs are counted, not listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import wordhash
from dialoom.llm.shared import Scratch, partitions

#: Members of a block, and elements of their differences.
MEMBERS, ELEMENTS = 256, 1 << 18
#: Elements that are compared at a time.
COLUMNS = 4096

_INTS = (("id", np.int64), ("copies", np.int64), ("slack", np.int64), ("size", np.int64))


def _pack(m: dict, i: int, j: int) -> bytes:
    return b"".join(m[k][i:j].astype(t).tobytes() for k, t in _INTS) + b"".join(m["delta"][i:j])


def _unpack(raw: bytes, n: int) -> dict:
    m, at = {}, 0
    for k, t in _INTS:
        m[k] = np.frombuffer(raw, t, n, at)
        at += 8 * n
    m["flat"] = np.frombuffer(raw, np.uint64, -1, at)
    m["row"] = np.repeat(np.arange(n), m["size"])
    return m


def shared(a: dict, b: dict) -> np.ndarray:
    """How many elements the differences of two blocks' members have in common, a row for each of the first."""
    out = np.zeros((len(a["id"]), len(b["id"])), np.float32)
    both = np.intersect1d(a["flat"], b["flat"])
    if not len(both):
        return out
    spots = []
    for m in (a, b):
        at = np.minimum(np.searchsorted(both, m["flat"]), len(both) - 1)
        hit = both[at] == m["flat"]
        spots.append((m["row"][hit], at[hit]))
    for c in range(0, len(both), COLUMNS):
        parts = []
        for m, (row, at) in zip((a, b), spots, strict=True):
            some = (at >= c) & (at < c + COLUMNS)
            x = np.zeros((len(m["id"]), min(COLUMNS, len(both) - c)), np.float32)
            x[row[some], at[some] - c] = 1
            parts.append(x)
        out += parts[0] @ parts[1].T
    return out


def linked(a: dict, b: dict, num: int, den: int) -> np.ndarray:
    """Which members of two blocks link."""
    slack = a["slack"][:, None] + b["slack"][None, :]
    least, most = a["slack"].min() + b["slack"].min(), a["slack"].max() + b["slack"].max()
    if least >= 0:
        return np.ones(slack.shape, bool)
    if most + 2 * (den + num) * min(a["size"].max(), b["size"].max()) < 0:
        return np.zeros(slack.shape, bool)
    return slack + 2 * (den + num) * shared(a, b).astype(np.int64) >= 0


def _deltas(num: int, den: int):
    def run(batches):
        for batch in batches:
            wordhash.frugal()
            deltas, slack, size = [], [], []
            for x, c, n in zip(batch.column("set"), batch.column("centre"), batch.column("n").to_pylist(), strict=True):
                d = np.setxor1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.uint64), assume_unique=True)
                deltas.append(d.tobytes())
                size.append(len(d))
                slack.append((den - num) * n - (den + num) * len(d))
            cols = [*(batch.column(k) for k in ("comp", "id", "copies")), pa.array(slack, pa.int64()), pa.array(size, pa.int64()), pa.array(deltas, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["comp", "id", "copies", "slack", "size", "delta"])

    return run


def _blocks(batches):
    """Blocks from rows sorted by (comp, slack, id), each named by its first member."""
    comp, held, elements = None, [], 0

    def out():
        m = {k: np.array([r[k] for r in held], t) for k, t in _INTS} | {"delta": [r["delta"] for r in held]}
        cols = [[comp], [int(m["id"][0])], [len(held)], [int(m["slack"].min())], [int(m["slack"].max())], [int(m["size"].max())], [_pack(m, 0, len(held))]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["comp", "b", "members", "least", "most", "wide", "block"])

    for batch in batches:
        for r in batch.to_pylist():
            if held and (r["comp"] != comp or len(held) == MEMBERS or elements + r["size"] > ELEMENTS):
                yield out()
                held, elements = [], 0
            comp = r["comp"]
            held.append(r)
            elements += r["size"]
    if held:
        yield out()


def _counts(parts: list[tuple[np.ndarray, np.ndarray]]):
    ids = np.concatenate([i for i, _ in parts]) if parts else np.zeros(0, np.int64)
    n = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    u, of = np.unique(ids, return_inverse=True)
    total = np.zeros(len(u), np.int64)
    np.add.at(total, of, n)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(total)], names=["id", "links"])


def _within(num: int, den: int):
    def run(batches):
        for batch in batches:
            parts = []
            for n, raw in zip(batch.column("members").to_pylist(), batch.column("block").to_pylist(), strict=True):
                m = _unpack(raw, n)
                ok = linked(m, m, num, den)
                np.fill_diagonal(ok, False)
                parts.append((m["id"], ok @ m["copies"]))
            yield _counts(parts)

    return run


def _between(num: int, den: int):
    def run(batches):
        parts, rows = [], 0
        for batch in batches:
            for n, p, k, q in zip(*(batch.column(c).to_pylist() for c in ("members1", "p", "members2", "q")), strict=True):
                a, b = _unpack(p, n), _unpack(q, k)
                ok = linked(a, b, num, den)
                parts += [(a["id"], ok @ b["copies"]), (b["id"], a["copies"] @ ok)]
                rows += n + k
                if rows > 1 << 20:  # combined before they are passed on
                    done = _counts(parts)
                    parts, rows = [(done.column("id").to_numpy(), done.column("links").to_numpy())], 0
        yield _counts(parts)

    return run


def counts(scratch: Scratch, members: DataFrame, known: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """(id, links): how many documents of other sets each set links with. ``members(id, comp, n, copies)`` are the sets of
    components of at least two, ``known(a, b)`` some of their links, at least one for each set, and ``full(id, set)`` gives
    the shingles of the sets of components of at least three."""
    sizes = members.groupBy("comp").agg(F.count("*").alias("sets"), F.sum("copies").alias("docs"))
    rows = scratch.save(members.join(sizes, "comp"), "links-members")
    two = rows.where("sets = 2").select("id", (F.col("docs") - F.col("copies")).alias("links"))
    more = rows.where("sets > 2").select("comp", "id", "n", "copies")
    degree = known.select(F.col("a").alias("id")).union(known.select("b")).groupBy("id").agg(F.count("*").alias("k"))
    centres = more.join(degree, "id").groupBy("comp").agg(F.max(F.struct("k", "id"))["id"].alias("id"))
    centres = scratch.save(centres.join(full, "id").select("comp", F.col("set").alias("centre")), "links-centres")
    own = more.join(full, "id").join(centres, "comp").select("comp", "id", "n", "copies", "set", "centre")
    deltas = own.mapInArrow(_deltas(num, den), "comp long, id long, copies long, slack long, size long, delta binary")
    deltas = scratch.save(deltas, "links-deltas")
    # by ranges, so that a large component is cut over several tasks
    ordered = deltas.repartitionByRange(partitions(scratch.spark), "comp", "slack", "id").sortWithinPartitions("comp", "slack", "id")
    blocks = scratch.save(ordered.mapInArrow(_blocks, "comp long, b long, members int, least long, most long, wide long, block binary"), "links-blocks")
    several = blocks.groupBy("comp").agg(F.count("*").alias("k")).where("k > 1").select("comp")
    meta = lambda k: blocks.join(several, "comp", "left_semi").select("comp", *(F.col(c).alias(f"{c}{k}") for c in ("b", "members", "least", "most", "wide")))
    none = F.col("most1") + F.col("most2") + F.lit(2 * (den + num)) * F.least("wide1", "wide2") < 0
    met = meta(1).join(meta(2), "comp").where("least1 < least2 OR (least1 = least2 AND b1 < b2)").where(~none).select("comp", "b1", "members1", "b2", "members2")
    body = lambda k, name: blocks.select("comp", F.col("b").alias(f"b{k}"), F.col("block").alias(name))
    pairs = met.join(body(1, "p"), ["comp", "b1"]).join(body(2, "q"), ["comp", "b2"]).select("members1", "p", "members2", "q")
    kind = "id long, links long"
    each = blocks.select("members", "block").mapInArrow(_within(num, den), kind).union(pairs.mapInArrow(_between(num, den), kind)).union(two)
    out = scratch.save(each.groupBy("id").agg(F.sum("links").alias("links")), "links-out")
    scratch.drop("links-members", "links-centres", "links-deltas", "links-blocks")
    return out
