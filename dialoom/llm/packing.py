"""Best-fit packing of documents into fixed-length sequences with a grouping genetic algorithm.

Documents longer than a sequence are cut into full pieces (only the first may be shorter); full pieces are
sequences of their own. The others are dealt at random into blocks of bounded size. For each block, several
islands evolve packings of it, each island in a task of its own: a genome is a list of bins; crossover injects the
fullest bins of one parent into the other, removes the bins that hold a document twice, and puts the displaced
documents back, first in exchange for smaller ones where that fills a bin better, then by best fit; mutation
empties the worst-filled bins and some others. After each epoch the islands' best packings are written, and migrate
along a ring within the block; a block with as few bins as its sizes allow is done. The best packing of all islands is
the block's. Every island is seeded by its block, number and epoch, so a lost executor's work is repeated exactly.

Bins that stay badly filled are not final: their documents are packed again, over all blocks, in further
rounds with ever fewer blocks, so that little is lost by cutting the table into blocks.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import wordhash
from dialoom.llm.shared import Scratch, partitions
from dialoom.llm.tokens import Encoder


@dataclass(frozen=True)
class Plan:
    tokenizer: str
    capacity: int = 1024
    end: int = 2
    #: Pieces of a block, on average.
    block: int = 3000
    islands: int = 3
    epochs: int = 3
    generations: int = 6
    population: int = 5
    #: Bins with more free places than this are packed again in a further round.
    loose: int = 8
    rounds: int = 3
    seed: int = 7


def best_fit(items: np.ndarray, sizes: np.ndarray, bins: list[list[int]], free: list[int], capacity: int) -> None:
    """Put the items, largest first, each into the bin with the least free space that holds it, or a new bin."""
    by_free: dict[int, list[int]] = {}
    mask = 0
    for b, f in enumerate(free):
        by_free.setdefault(f, []).append(b)
        mask |= 1 << f
    for i in items[np.argsort(-sizes[items], kind="stable")].tolist():
        s = int(sizes[i])
        above = mask >> s
        if above:
            f = s + ((above & -above).bit_length() - 1)
            same = by_free[f]
            b = same.pop()
            if not same:
                mask &= ~(1 << f)
        else:
            b, f = len(bins), capacity
            bins.append([])
            free.append(capacity)
        bins[b].append(i)
        f -= s
        free[b] = f
        by_free.setdefault(f, []).append(b)
        mask |= 1 << f


def flat(bins: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(bins), np.int64)


def exchange(items: np.ndarray, sizes: np.ndarray, bins: list[list[int]], free: list[int]) -> np.ndarray:
    """Put items into bins in exchange for one smaller item each, where that fills a bin better, the largest gain
    first; returns what is outside afterwards."""
    gaps = [b for b, f in enumerate(free) if f]
    if not gaps or not len(items):
        return items
    pool: dict[int, list[int]] = {}
    for i in items.tolist():
        pool.setdefault(int(sizes[i]), []).append(i)
    kinds = np.array(sorted(pool))
    some = [bins[b] for b in gaps]
    member = flat(some)
    of = np.repeat(gaps, list(map(len, some)))
    reach = sizes[member] + np.array(free)[of]
    best = kinds[np.maximum(np.searchsorted(kinds, reach, "right") - 1, 0)]
    gain = np.where(best <= reach, best - sizes[member], 0)
    done: set[int] = set()
    for k in np.argsort(-gain, kind="stable").tolist():
        if gain[k] <= 0:
            break
        b, old, size = int(of[k]), int(member[k]), int(best[k])
        if b in done or not pool.get(size):
            continue
        bins[b][bins[b].index(old)] = pool[size].pop()
        free[b] -= size - int(sizes[old])
        pool.setdefault(int(sizes[old]), []).append(old)
        done.add(b)
    return np.array(sorted(i for v in pool.values() for i in v), np.int64)


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """A bound that no packing is below: the total, and items over half a bin with those that fit beside none of them."""
    s = np.sort(sizes)
    sums = np.concatenate([[0], np.cumsum(s)])
    half = int(np.searchsorted(s, capacity // 2, "right"))  # those up to half a bin come first
    least = max(-(-int(sums[-1]) // capacity), len(s) - half)
    if half:
        k = np.unique(s[:half])
        begin = np.searchsorted(s, k)  # the small ones are begin:half, the large ones half:huge
        huge = np.maximum(np.searchsorted(s, capacity - k, "right"), half)
        room = (huge - half) * capacity - (sums[huge] - sums[half])
        over = sums[half] - sums[begin] - room
        least = max(least, int((len(s) - half + np.maximum(0, -(-over // capacity))).max()))
    return least


def bins_of(genome: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[list[list[int]], list[int]]:
    """A packing from the bins' numbers by item."""
    if not len(genome):
        return [], []
    order = np.argsort(genome, kind="stable")
    starts = np.concatenate([[0], np.flatnonzero(np.diff(genome[order])) + 1])
    items = order.tolist()
    bins = [items[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(items)], strict=True)]
    return bins, (capacity - np.add.reduceat(sizes[order], starts)).tolist()


def genome_of(p, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    out[flat(p[0])] = np.repeat(np.arange(len(p[0])), list(map(len, p[0])))
    return out


class Island:
    """Evolves packings of items with the given sizes; a packing is (bins, free places of each). It begins with
    given packings, or anew."""

    def __init__(self, sizes: np.ndarray, plan: Plan, seed: int | list[int], given: list[np.ndarray] | None = None):
        self.sizes, self.plan, self.rng = sizes, plan, np.random.default_rng(seed)
        self.least = fewest(sizes, plan.capacity)
        self.people = [bins_of(g, sizes, plan.capacity) for g in given or []][: plan.population]
        if not self.people:
            self.people = [self._first(0)]
        while len(self.people) < plan.population and not self.done():
            k = len(self.people)
            self.people.append(self.mutate(self.people[k % len(given)]) if given else self._first(k))

    def _first(self, k: int):
        bins: list[list[int]] = []
        free: list[int] = []
        items = np.arange(len(self.sizes))
        if k:  # some items first-come, so that the population differs
            early = self.rng.random(len(items)) < 0.1 * k
            for part in (items[early], items[~early]):
                best_fit(part, self.sizes, bins, free, self.plan.capacity)
        else:
            best_fit(items, self.sizes, bins, free, self.plan.capacity)
        return bins, free

    def worth(self, p) -> tuple:
        """Fewer bins, then fuller full ones: the sum of squared free places is larger when few bins hold the gaps."""
        f = np.array(p[1], np.int64)
        return (-len(f), int((f * f).sum()))

    def best(self):
        return max(self.people, key=self.worth)

    def done(self) -> bool:
        """Whether no packing has fewer bins than the best one here."""
        return len(self.best()[0]) <= self.least

    def _refit(self, bins: list[list[int]], free: list[int]):
        have = np.zeros(len(self.sizes), bool)
        have[flat(bins)] = True
        out = np.flatnonzero(~have)
        for _ in range(2):
            out = exchange(out, self.sizes, bins, free)
        best_fit(out, self.sizes, bins, free, self.plan.capacity)
        return bins, free

    def cross(self, p, q):
        """q with the best-filled bins of p injected whole."""
        order = np.argsort(p[1], kind="stable")
        n = int(self.rng.integers(1, max(2, len(order) // 2)))
        gift = [p[0][i] for i in order[:n].tolist()]
        taken = np.zeros(len(self.sizes), bool)
        taken[flat(gift)] = True
        twice = np.bincount(np.repeat(np.arange(len(q[0])), list(map(len, q[0]))), taken[flat(q[0])], len(q[0])) > 0
        kept = [(b, f) for b, f, t in zip(*q, twice.tolist(), strict=True) if not t]
        return self._refit([*map(list, gift), *(list(b) for b, _ in kept)], [*(p[1][i] for i in order[:n].tolist()), *(f for _, f in kept)])

    def mutate(self, p):
        """Empty the loosest bins and some at random, and fit their items again."""
        f = np.array(p[1])
        drop = (f >= np.quantile(f, 0.9)) & (f > 0) | (self.rng.random(len(f)) < 0.05)
        return self._refit([list(b) for b, d in zip(p[0], drop, strict=True) if not d], [x for x, d in zip(p[1], drop.tolist(), strict=True) if not d])

    def evolve(self) -> None:
        for _ in range(self.plan.generations):
            if self.done():
                return
            i, j = self.rng.integers(0, len(self.people), 2).tolist()
            child = self.cross(self.people[i], self.people[j]) if i != j else self.mutate(self.people[i])
            if self.rng.random() < 0.5:
                child = self.mutate(child)
            worst = min(range(len(self.people)), key=lambda k: self.worth(self.people[k]))
            if self.worth(child) >= self.worth(self.people[worst]):
                self.people[worst] = child


def epoch(sizes: np.ndarray, plan: Plan, seed: list[int], given: list[np.ndarray] | None) -> tuple[list[np.ndarray], tuple, bool]:
    """One epoch of an island: its two best packings, the best one's worth, and whether it can't be bettered."""
    x = Island(sizes, plan, seed, given)
    x.evolve()
    best = sorted(x.people, key=x.worth, reverse=True)[:2]
    return [genome_of(p, len(sizes)) for p in best], x.worth(best[0]), x.done()


def pack(sizes: np.ndarray, plan: Plan, seed: int):
    """What the islands make of one block, here one after another: (bins, free)."""
    state: list[tuple] = [(None, None, False)] * plan.islands
    for e in range(plan.epochs):
        given = [None if e == 0 else [*own, state[k - 1][0][0]] for k, (own, _, _) in enumerate(state)]
        state = [epoch(sizes, plan, [seed, k, e], g) for k, g in enumerate(given)]
        if any(done for _, _, done in state):
            break
    best = max(range(plan.islands), key=lambda k: (state[k][1], k))
    return bins_of(state[best][0][0], sizes, plan.capacity)


def _pieces(plan: Plan):
    """One row for each piece of each text."""

    def run(batches):
        coder = Encoder.of(plan.tokenizer)
        cap = plan.capacity
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                ids, off = coder.encode(part.column("text"), plan.end)
                n = np.diff(off)
                first = np.where(n > cap, np.where(n % cap, n % cap, cap), n)
                count = 1 + (n - first) // cap
                row = np.repeat(np.arange(len(n)), count)
                k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(k == 0, 0, first[row] + (k - 1) * cap)
                length = np.where(k == 0, first[row], cap)
                raw = ids.astype("<u4").tobytes()
                at = off[:-1][row] + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist(), strict=True)]
                cols = [part.column("doc_id").take(pa.array(row)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _gather(batches):
    """Blocks from rows sorted by (block, key): block, keys, sizes."""
    held: list[pa.RecordBatch] = []

    def done():
        t = pa.Table.from_batches(held).combine_chunks()
        cols = [[t.column("block")[0].as_py()], [t.column("key").to_numpy().astype("<i8").tobytes()], [t.column("length").to_numpy().astype("<i4").tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "keys", "sizes"])

    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            if held and held[0].column("block")[0].as_py() != block[i]:
                yield done()
                held.clear()
            held.append(batch.slice(i, j - i))
    if held:
        yield done()


def _epoch(plan: Plan, number: int, e: int):
    """An epoch of each row's island."""

    def run(batches):
        Encoder.forget()  # a worker may have one from the stage before, and keeps it for all that follows
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
                given = [np.frombuffer(g, "<i4") for g in (row["first"], row["second"], row["guest"]) if g is not None]
                best, worth, done = epoch(sizes, plan, [plan.seed + 31 * number, row["block"], row["island"], e], given or None)
                out = {"block": row["block"], "island": row["island"], "first": best[0].astype("<i4").tobytes(), "second": best[-1].astype("<i4").tobytes(), "bins": -worth[0], "gaps": worth[1], "done": done}
                yield pa.RecordBatch.from_pylist([out], schema=_STATE)

    return run


_STATE = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("first", pa.binary()), ("second", pa.binary()), ("bins", pa.int64()), ("gaps", pa.int64()), ("done", pa.bool_())])
_STATE_SQL = "block long, island int, first binary, second binary, bins long, gaps long, done boolean"


def _place(plan: Plan, last: bool):
    """Places from blocks and their best packings; ``bin`` is null for what another round packs."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes, keys = np.frombuffer(row["sizes"], "<i4").astype(np.int64), np.frombuffer(row["keys"], "<i8")
                bins, free = bins_of(np.frombuffer(row["genome"], "<i4"), sizes, plan.capacity)
                where, offset, again = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
                for b, (items, f) in enumerate(zip(bins, free, strict=True)):
                    items = sorted(items)
                    where[items] = b
                    offset[items] = np.concatenate([[0], np.cumsum(sizes[items])[:-1]])
                    if not last and f > plan.loose:
                        again[items] = True
                cols = [pa.array(keys), pa.array(sizes), pa.array(where, mask=again), pa.array(offset), pa.array(np.full(len(sizes), row["block"], np.int64))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "length", "bin", "offset", "block"])

    return run


def _packed(scratch: Scratch, rest: DataFrame, plan: Plan, number: int, blocks: int, last: bool) -> DataFrame:
    """One round over ``rest(key, length)``: key, length, bin (null: to be packed again), offset, block."""
    n = partitions(scratch.spark)
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(blocks)).cast("long"))
    dealt = dealt.repartition(max(1, min(blocks, 4 * n)), "block").sortWithinPartitions("block", "key")
    # a task's rows are few and small: gathered, or each task would write a file, for which the executor starts processes
    table = scratch.save(dealt.mapInArrow(_gather, "block long, keys binary, sizes binary").hint("rebalance"), f"blocks{number}")
    sizes = table.select("block", "sizes")
    null = F.lit(None).cast("binary")
    state, names = None, []
    for e in range(plan.epochs):
        if state is None:
            rows = sizes.select("block", F.explode(F.sequence(F.lit(0), F.lit(plan.islands - 1))).alias("island"), "sizes", null.alias("first"), null.alias("second"), null.alias("guest"))
        else:  # the best packing of an island goes to the next one of its block's ring
            open_ = state.groupBy("block").agg(F.max("done").alias("d")).where("NOT d").select("block")
            own = state.join(open_, "block").select("block", "island", "first", "second")
            guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(plan.islands)).alias("island"), F.col("first").alias("guest"))
            rows = own.join(guests, ["block", "island"]).join(sizes, "block")
        rows = rows.repartition(max(1, min(blocks * plan.islands, 4 * n)), "block", "island")
        name = f"islands{number}-{e}"
        grown = scratch.save(rows.select("block", "island", "sizes", "first", "second", "guest").mapInArrow(_epoch(plan, number, e), _STATE_SQL).hint("rebalance"), name)
        if grown.isEmpty():
            scratch.drop(name)
            break
        names.append(name)
        state = grown
    # a block's last epoch is its best one, as an island's best packing is never given up
    every = functools.reduce(DataFrame.unionByName, (scratch.load(x, state) for x in names))
    best = every.groupBy("block").agg(F.max(F.struct(-F.col("bins"), "gaps", "island", F.col("first").alias("genome"))).alias("b")).select("block", "b.genome")
    out = scratch.save(table.join(best, "block").mapInArrow(_place(plan, last), "key long, length long, bin long, offset long, block long"), f"round{number}")
    scratch.drop(f"blocks{number}", *names)
    return out


def packing(spark: SparkSession, docs: DataFrame, plan: Plan) -> DataFrame:
    """Pieces of all rows of ``docs(doc_id, text)`` and their places:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty: its piece is the end id alone. Rows with equal or null ids are packed like any others.
    An empty table gives no rows; other columns of ``docs`` are ignored.
    """
    scratch = Scratch(spark, "packing")
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(plan), "doc_id long, piece int, start long, length long, ids_crc32 long")
    # written once, so that the key, a row's number, stays the same
    pieces = scratch.save(pieces.withColumn("key", F.monotonically_increasing_id()), "pieces")
    rest = pieces.where(F.col("length") < plan.capacity).select("key", "length")
    placed = []
    left = rest.count()
    number = 0
    while left:
        blocks = max(1, round(left / plan.block))
        last = blocks == 1 or number + 1 == plan.rounds
        out = _packed(scratch, rest, plan, number, blocks, last)
        done = out.where("bin is not null")
        placed.append(done.select("key", (F.lit((number + 1) << 56) + F.col("block") * (1 << 20) + F.col("bin")).alias("sequence_id"), "offset"))
        if last:
            break
        rest = out.where("bin is null").select("key", "length")
        left = rest.count()
        number += 1
    full = pieces.where(F.col("length") >= plan.capacity).withColumn("sequence_id", F.col("key")).withColumn("offset", F.lit(0).cast("long"))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if not placed:
        return full.select(cols)
    every = placed[0]
    for p in placed[1:]:
        every = every.union(p)
    return pieces.where(F.col("length") < plan.capacity).join(every, "key").select(cols).union(full.select(cols))
