"""N-gram Jaccard self-join with set-relation skipping.

Documents become sets of word shingles; two link when ``den * |x & y| >= num * |x | y|``. The join is exact:

* Equal sets collapse into one before anything is compared.
* Every set is ordered with the most frequent shingles last and indexed under its prefix, the only place
  where the first common shingle of a linked pair can stand.
* Answers from similar sets: in each index list a member drawn by a hash (the leader) is compared with all
  others, which is linear in the list. Components of these answers stand in for their members: two members of
  one component need no further comparison. Lists that still mix components get another leader, for a few
  rounds. For members x, y of a list whose exact distances to the first leader are d(x), d(y), the triangle
  inequality gives |x ^ y| >= |d(x) - d(y)|, which rules out more without looking at the sets.
* Block skipping: lists are ordered by set size and cut where no pair can link over a gap; members left alone
  go. What is mixed after the answers above is cut into blocks; pairs of blocks whose
  sizes or prefix positions cannot reach the needed overlap are skipped as a whole. The pairs of blocks of a
  long list are dealt over all tasks.
* Pairs that survive parity bitmaps (a lower bound of the symmetric difference) are verified on the sets.
* Components tell which sets may link; how many links each set has is derived from a similar set's (``links``).

Sets are identified by a 64-bit hash of their 64-bit shingle hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.llm import links, wordhash
from dialoom.llm.shared import Scratch, components, partitions

#: Most ids that are broadcast to pick documents for verification (about 64 MB); beyond it, a shuffled join.
BROADCAST_IDS = 1_000_000
#: Members of a block of an index list, and pairs that a task combines before it passes them on.
BLOCK = 256
COMBINED = 300_000
#: Most rounds of comparing lists with a leader; what they leave is compared within blocks.
ROUNDS = 3
#: Sets of up to as many shingles have parity bitmaps of 64 bytes, larger ones of 512.
NARROW = 900
#: Shingles are counted in runs of this many; those seen at least LOCAL times in a run count on.
RUN, LOCAL = 2_000_000, 6


@dataclass(frozen=True)
class Rule:
    """Shingles of ``size`` words; a link needs 100 * intersection >= ... i.e. den * i >= num * u."""

    size: int = 5
    num: int = 80
    den: int = 100
    #: How many of the most frequent shingles are moved to the end of the order (bounds what is broadcast).
    heavy: int = 65_536

    def prefix(self, n: int) -> int:
        return n - -(-n * self.num // self.den) + 1


def _sets(texts, size: int):
    w = wordhash.words(texts)
    s, off = wordhash.shingles(w, size)
    for i in range(len(off) - 1):
        yield np.unique(s[off[i] : off[i + 1]])


def _count_runs(size: int):
    def run(batches):
        held: list[np.ndarray] = []
        n = 0

        def out():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            keep = c >= LOCAL
            return pa.RecordBatch.from_arrays([pa.array(u[keep].view(np.int64)), pa.array(c[keep].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                for u in _sets(part.column("text"), size):
                    held.append(u)
                    n += len(u)
                if n >= RUN:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return run


def _heavy(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The most frequent shingles, counted over all documents; their number is bounded by the rule."""
    counts = docs.select("text").mapInArrow(_count_runs(rule.size), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(rule.heavy).select("token").collect()
    return np.sort(np.array([r[0] for r in top], dtype=np.int64).view(np.uint64))


def _bits(u: np.ndarray) -> bytes:
    b = 512 if len(u) <= NARROW else 4096
    return np.packbits((np.bincount((u & np.uint64(b - 1)).astype(np.int64), minlength=b) & 1).astype(np.uint8)).tobytes()


def _set_id(u: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(u.tobytes())


def _describe(rule: Rule, heavy: np.ndarray):
    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                ids, ns, prefixes, bits = [], [], [], []
                for u in _sets(part.column("text"), rule.size):
                    n = len(u)
                    ids.append(_set_id(u))
                    ns.append(n)
                    if not n:
                        prefixes.append(u)
                        bits.append(b"")
                        continue
                    if len(heavy):
                        often = heavy[np.minimum(np.searchsorted(heavy, u), len(heavy) - 1)] == u
                        if often.any():
                            bits.append(_bits(u))
                            u = np.concatenate([u[~often], u[often]])
                        else:
                            bits.append(_bits(u))
                    else:
                        bits.append(_bits(u))
                    prefixes.append(u[: rule.prefix(n)])
                off = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(ns, pa.int32()), pa.ListArray.from_arrays(off, flat), pa.array(bits, pa.binary())],
                    names=["doc_id", "id", "n", "prefix", "bits"],
                )

    return run


def _lists(rule: Rule):
    """Index lists from rows sorted by (token, n, id). Where a size is too large for the one before, no pair can link
    over the gap; members that such gaps leave alone go (but not a task's first and last row, whose neighbours
    another task may have)."""

    def run(batches):
        held = None  # the last row, as its follower isn't known yet
        joined, first = False, True  # whether the last row has a neighbour before it; whether nothing came out yet
        names = ["token", "id", "n", "pos"]
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
            if held is not None:
                cols = [np.concatenate([a, c]) for a, c in zip(held, cols, strict=True)]
            tok, _, n, _ = cols
            if not len(tok):
                continue
            link = np.empty(len(tok), bool)
            link[0] = joined
            link[1:] = (tok[1:] == tok[:-1]) & (rule.den * n[:-1].astype(np.int64) >= rule.num * n[1:].astype(np.int64))
            keep = link.copy()
            keep[:-1] |= link[1:]
            keep[0] |= first
            held, joined = [c[-1:] for c in cols], bool(link[-1])
            if len(tok) > 1:
                first = False
                rows = np.flatnonzero(keep[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(x[rows]) for x in cols], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=names)

    return run


def _bit_matrix(col, width: int = 64) -> np.ndarray:
    """Bitmaps as rows of 8-byte words, longer ones folded to ``width`` bytes."""
    rows = []
    for x in col.to_pylist():
        a = np.frombuffer(x, np.uint8)
        rows.append(a if len(a) == width else np.bitwise_xor.reduce(a.reshape(-1, width), axis=0))
    return np.array(rows, np.uint8).reshape(len(rows), width).view(np.uint64)


def _needed(rule: Rule, na, nb):
    """Least overlap of a linked pair."""
    return -(-(na + nb) * rule.num // (rule.num + rule.den))


def _sieve(rule: Rule):
    """Drops pairs whose bitmaps differ in more bits than their sets may."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy().astype(np.int64) for k in ("na", "nb"))
            most = na + nb - 2 * _needed(rule, na, nb)
            keep = np.ones(len(na), bool)
            la, lb = (np.array([len(x) for x in batch.column(k).to_pylist()], np.int64) for k in ("abits", "bbits"))
            for wide in (False, True):
                some = np.flatnonzero((np.minimum(la, lb) > 64) == wide)
                if len(some):
                    width = 512 if wide else 64
                    a, b = (_bit_matrix(batch.column(k).take(pa.array(some)), width) for k in ("abits", "bbits"))
                    keep[some] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= most[some]
            yield batch.filter(pa.array(keep)).select(["a", "b", "na", "nb"])

    return run


def _overlaps(batches):
    for batch in batches:
        got = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            got.append(int((y[at] == x).sum()))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("a", "b", "na", "nb")), pa.array(got, pa.int32())], names=["a", "b", "na", "nb", "both"])


def _full_sets(size: int):
    def run(batches):
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                sets = list(_sets(part.column("text"), size))
                yield pa.RecordBatch.from_arrays([pa.array(np.array([_set_id(u) for u in sets], np.uint64).view(np.int64)), pa.array([u.tobytes() for u in sets], pa.binary())], names=["id", "set"])

    return run


def _verify(scratch: Scratch, docs: DataFrame, sets: DataFrame, pairs: DataFrame, rule: Rule, name: str) -> DataFrame:
    """Exact overlaps of the pairs (a, b) that the bitmaps let through: (a, b, na, nb, both)."""
    side = lambda k: sets.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"{k}bits"))
    left = scratch.save(
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "abits", "bbits").mapInArrow(_sieve(rule), "a long, b long, na int, nb int"), f"{name}-sieved"
    )
    ids = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    need = scratch.save(sets.join(ids, "id").select(F.col("doc").alias("doc_id")).distinct(), f"{name}-need")
    small = need.count() <= BROADCAST_IDS
    full = docs.join(F.broadcast(need) if small else need, "doc_id", "left_semi").select("text").mapInArrow(_full_sets(rule.size), "id long, set binary")
    full = scratch.save(full, f"{name}-sets")
    joined = left.join(full.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b").join(full.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    found = scratch.save(joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_overlaps, "a long, b long, na int, nb int, both int").distinct(), f"{name}-found")
    scratch.drop(f"{name}-need", f"{name}-sets", f"{name}-sieved")
    return found


def _links(found: DataFrame, rule: Rule) -> DataFrame:
    return found.where(F.col("both") * (rule.num + rule.den) >= (F.col("na") + F.col("nb")) * rule.num).select("a", "b")


def _may(rule: Rule, a: dict, b: dict) -> np.ndarray:
    """Which aligned members can link, as far as their entries in an index list tell."""
    na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
    ok = (a["comp"] != b["comp"]) & (rule.den * np.minimum(na, nb) >= rule.num * np.maximum(na, nb))
    need = _needed(rule, na, nb)
    pa_, pb = a["pos"].astype(np.int64), b["pos"].astype(np.int64)
    ok &= np.minimum(pa_, pb) + 1 + np.minimum(na - pa_ - 1, nb - pb - 1) >= need
    most = na + nb - 2 * need
    ok &= (a["leader"] != b["leader"]) | (a["d"] < 0) | (b["d"] < 0) | (np.abs(a["d"].astype(np.int64) - b["d"]) <= most)
    for bits, some in (("bits", ok), ("wide", ok & (na > NARROW) & (nb > NARROW))):
        at = np.flatnonzero(some & ok)
        ok[at] = np.bitwise_count(a[bits][at] ^ b[bits][at]).sum(axis=1, dtype=np.int64) <= most[at]
    return ok


_FIELDS = (("id", np.int64), ("comp", np.int64), ("leader", np.int64), ("n", np.int32), ("pos", np.int32), ("d", np.int32))


def _pack(m: dict, i: int, j: int) -> bytes:
    return b"".join(m[k][i:j].astype(t).tobytes() for k, t in _FIELDS) + m["bits"][i:j].tobytes() + (m["wide"][i:j].tobytes() if m["n"][i:j].max() > NARROW else b"")


def _unpack(raw: bytes, n: int) -> dict:
    at, m = 0, {}
    for k, t in _FIELDS:
        m[k] = np.frombuffer(raw, t, n, at)
        at += n * np.dtype(t).itemsize
    m["bits"] = np.frombuffer(raw, np.uint64, n * 8, at).reshape(n, 8)
    at += n * 64
    m["wide"] = np.frombuffer(raw, np.uint64, n * 64, at).reshape(n, 64) if len(raw) > at else np.zeros((n, 64), np.uint64)
    return m


_BLOCKS = "x long, y long, token long, b long, members int, nmin int, nmax int, pmin int, pmax int, block binary"


def _block_rows(rule: Rule):
    """From rows sorted by (token, n, id): candidate pairs within blocks (x, y), and the blocks of lists that have (or, at
    a task's ends, may have) several. A block is named by its first member."""

    def run(batches):
        token, number, rest, first = None, 0, None, None
        schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("token", pa.int64()), ("b", pa.int64()), *((k, pa.int32()) for k in ("members", "nmin", "nmax", "pmin", "pmax")), ("block", pa.binary())])

        pairs: list[np.ndarray] = []

        def combined():
            """Pairs so far, each once: a pair shares many lists, of which a task has several."""
            one = np.unique(np.concatenate(pairs), axis=0)
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(one[:, 0]), pa.array(one[:, 1]), *(pa.nulls(len(one), f.type) for f in list(schema)[2:])], schema=schema)

        def made(m, tok, spans, at):
            """spans: begin and end of blocks; at: whether there may be others of the list."""
            ids = np.repeat(np.arange(len(spans)), [j - i for i, j in spans])
            xs, ys = [], []
            for gap in range(1, max((j - i for i, j in spans), default=0)):
                same = np.flatnonzero(ids[gap:] == ids[:-gap])
                a, b = ({k: v[same + o] for k, v in m.items()} for o in (0, gap))
                ok = _may(rule, a, b)
                xs.append(a["id"][ok])
                ys.append(b["id"][ok])
            x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys))
            if len(x):
                pairs.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
                if sum(map(len, pairs)) > COMBINED:
                    yield combined()
            for i, j in (z for z, some in zip(spans, at, strict=True) if some):
                v = [None, None, int(tok[i]), int(m["id"][i]), j - i, int(m["n"][i]), int(m["n"][j - 1]), int(m["pos"][i:j].min()), int(m["pos"][i:j].max()), _pack(m, i, j)]
                yield pa.RecordBatch.from_arrays([pa.array([z], f.type) for z, f in zip(v, schema, strict=True)], schema=schema)

        def cut(tok, m, last):
            """Full blocks and ended lists; what may go on is kept."""
            nonlocal token, number, rest, first
            if first is None:
                first = tok[0]
            begin = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
            end = np.append(begin[1:], len(tok))
            spans, at, kept = [], [], len(tok)
            for i, j in zip(begin.tolist(), end.tolist(), strict=True):
                b = number if tok[i] == token else 0
                while j - i >= BLOCK:
                    spans.append((i, i + BLOCK))
                    at.append(True)
                    i, b = i + BLOCK, b + 1
                if j == len(tok) and not last:
                    token, number, kept = tok[j - 1], b, i
                elif i < j:
                    spans.append((i, j))
                    at.append(b > 0 or tok[i] == first or (last and j == len(tok)))
            rest = (tok[kept:], {k: v[kept:] for k, v in m.items()})
            upto = spans[-1][1] if spans else 0
            if spans:
                yield from made({k: v[:upto] for k, v in m.items()}, tok, spans, at)

        for batch in batches:
            if not batch.num_rows:
                continue
            tok = batch.column("token").to_numpy()
            m = {k: batch.column(k).to_numpy(zero_copy_only=False).astype(t) for k, t in _FIELDS}
            m["bits"] = _bit_matrix(batch.column("bits"))
            m["wide"] = np.zeros((len(tok), 64), np.uint64)
            large = np.flatnonzero(m["n"] > NARROW)
            if len(large):
                m["wide"][large] = _bit_matrix(batch.column("bits").take(pa.array(large)), 512)
            if rest is not None and len(rest[0]):
                tok = np.concatenate([rest[0], tok])
                m = {k: np.concatenate([rest[1][k], v]) for k, v in m.items()}
            yield from cut(tok, m, False)
        if rest is not None and len(rest[0]):
            yield from cut(*rest, True)
        if pairs:
            yield combined()

    return run


def _block_pairs(rule: Rule):
    def run(batches):
        pairs: list[np.ndarray] = []

        def combined():
            one = np.unique(np.concatenate(pairs), axis=0)
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(one[:, 0]), pa.array(one[:, 1])], names=["x", "y"])

        for batch in batches:
            for p, np_, q, nq in zip(*(batch.column(c).to_pylist() for c in ("p", "members1", "q", "members2")), strict=True):
                a, b = _unpack(p, np_), _unpack(q, nq)
                i, j = (z.ravel() for z in np.meshgrid(np.arange(len(a["id"])), np.arange(len(b["id"])), indexing="ij"))
                ok = _may(rule, {k: v[i] for k, v in a.items()}, {k: v[j] for k, v in b.items()})
                x, y = a["id"][i[ok]], b["id"][j[ok]]
                if len(x):
                    pairs.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
                    if sum(map(len, pairs)) > COMBINED:
                        yield combined()
        if pairs:
            yield combined()

    return run


def _mixed(members: DataFrame) -> DataFrame:
    """Members of lists that have several components."""
    lists_of = members.groupBy("token").agg(F.min("comp").alias("p"), F.max("comp").alias("q"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("who"))
    # lists with the same members give the same pairs: one of them stands for all
    some = lists_of.where("p <> q").groupBy("p", "q", "size", "who").agg(F.min("token").alias("token")).select("token")
    return members.join(some, "token", "left_semi")


def _leaders(scratch: Scratch, members: DataFrame, number: int) -> DataFrame:
    """The leader of each list: at first drawn alike for all lists, so that similar lists share one, then for each list
    by itself, so that members meet many. Written, so that joins may split long lists."""
    drawn = F.xxhash64("id", F.lit(number)) if number == 1 else F.xxhash64("id", "token", F.lit(number))
    least = F.min(F.struct(drawn.alias("h"), "id", "n", "pos", "comp")).alias("l")
    lead = members.groupBy("token").agg(least).select("token", *(F.col(f"l.{c}").alias(f"l{c}") for c in ("id", "n", "pos", "comp")))
    return scratch.save(lead, f"lead{number}")


def _stars(members: DataFrame, lead: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of leaders and members of other components that may link: linear in the lists."""
    n, m = F.col("n"), F.col("ln")
    needed = F.ceil((n + m) * F.lit(rule.num) / F.lit(rule.num + rule.den))
    most = F.least("pos", "lpos") + 1 + F.least(n - F.col("pos") - 1, m - F.col("lpos") - 1)
    fits = (F.col("comp") != F.col("lcomp")) & (F.least(n, m) * rule.den >= F.greatest(n, m) * rule.num) & (most >= needed)
    return members.join(lead, "token").where(fits).select(F.least("id", "lid").alias("a"), F.greatest("id", "lid").alias("b")).distinct()


def _rest(scratch: Scratch, sets: DataFrame, members: DataFrame, lead: DataFrame, found: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """Pairs of different components that share an index list and that no bound rules out: (a, b)."""
    answers = found.select("a", "b", (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("d"))
    to = lead.select("token", F.col("lid").alias("leader"))
    entries = (
        _mixed(members)
        .join(to, "token")
        .withColumns({"a": F.least("id", "leader"), "b": F.greatest("id", "leader")})
        .join(answers, ["a", "b"], "left")
        .withColumn("d", F.when(F.col("id") == F.col("leader"), 0).otherwise(F.coalesce("d", F.lit(-1))).cast("int"))
        .join(sets.select("id", "bits"), "id")
        .select("token", "id", "comp", "leader", "n", "pos", "d", "bits")
    )
    # by ranges, so that a long list is cut over several tasks
    entries = scratch.save(entries, "entries").repartitionByRange(parts, "token", "n", "id").sortWithinPartitions("token", "n", "id")
    blocks = scratch.save(entries.mapInArrow(_block_rows(rule), _BLOCKS), "blocks")
    inner = blocks.where("x is not null").select("x", "y")
    long = blocks.where("x is null").drop("x", "y")
    meta = lambda k: long.select("token", *(F.col(c).alias(f"{c}{k}") for c in ("b", "members", "nmin", "nmax", "pmin", "pmax")))
    reach = lambda k, o: F.col(f"nmax{k}") - F.greatest(F.lit(0), F.col(f"pmin{k}") - F.col(f"pmax{o}"))
    needed = F.ceil((F.col("nmin1") + F.col("nmin2")) * F.lit(rule.num) / F.lit(rule.num + rule.den))
    met = (
        meta(1)
        .join(meta(2), "token")
        .where("nmin1 < nmin2 OR (nmin1 = nmin2 AND b1 < b2)")
        .where((F.col("nmin2") * rule.num <= F.col("nmax1") * rule.den) & (F.least(reach(1, 2), reach(2, 1)) >= needed))
        .select("token", "b1", "members1", "b2", "members2")
    )
    body = lambda k, name: long.select("token", F.col("b").alias(f"b{k}"), F.col("block").alias(name))
    outer = met.join(body(1, "p"), ["token", "b1"]).join(body(2, "q"), ["token", "b2"]).select("p", "members1", "q", "members2").mapInArrow(_block_pairs(rule), "x long, y long")
    pairs = inner.union(outer).distinct().select(F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = scratch.save(pairs.join(found.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    scratch.drop("blocks", "entries")
    return pairs


def join(spark: SparkSession, docs: DataFrame, rule: Rule = Rule(), count_links: bool = True) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id, n_links``.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included, and ``n_links`` the number of
    other rows that the row links with (left out unless ``count_links``). Null or blank text
    has no shingles and links with nothing. Rows with a null doc_id are returned with a null component and number.
    Repeated ids are separate rows whose sets join as any others. Other columns of ``docs`` are ignored.
    """
    scratch, parts = Scratch(spark, "ngram"), partitions(spark)
    docs = docs.select("doc_id", "text")
    heavy = _heavy(docs, rule)
    rows = scratch.save(docs.mapInArrow(_describe(rule, heavy), "doc_id long, id long, n int, prefix array<long>, bits binary"), "rows")
    one = rows.where("n > 0 and doc_id is not null").groupBy("id").agg(F.min(F.struct("doc_id", "n", "prefix", "bits")).alias("m"), F.count("*").alias("copies"))
    sets = scratch.save(one.select("id", F.col("m.doc_id").alias("doc"), "m.n", "m.prefix", "m.bits", "copies"), "reps")
    scratch.reclaim()
    # by ranges, so that a long list is cut over several tasks
    index = sets.select("id", "n", F.posexplode("prefix").alias("pos", "token")).repartitionByRange(parts, "token", "n", "id").sortWithinPartitions("token", "n", "id")
    lists = scratch.save(index.select("token", "id", "n", "pos").mapInArrow(_lists(rule), "token long, id long, n int, pos int"), "lists")
    members = lists.withColumn("comp", F.col("id"))
    comps, found, lead = None, None, None
    for number in range(1, ROUNDS + 1):
        some = members if comps is None else scratch.save(_mixed(members), f"mixed{number}")
        own = _leaders(scratch, some, number)
        pairs = _stars(some, own, rule)
        if found is not None:
            pairs = pairs.join(found.select("a", "b"), ["a", "b"], "left_anti")
        new = _verify(scratch, docs, sets, pairs, rule, f"star{number}")
        found, lead = (new, own) if found is None else (found.union(new), lead)
        gained = not _links(new, rule).isEmpty()
        if gained or comps is None:
            comps = components(scratch, _links(found, rule), f"near{number}")
            members = scratch.save(lists.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), f"members{number}")
        scratch.drop(f"mixed{number}")
        del some, own, pairs, new
        scratch.reclaim()
        if not gained:
            break
    late = _verify(scratch, docs, sets, _rest(scratch, sets, members, lead, found, rule, parts), rule, "late")
    scratch.reclaim()
    if not _links(late, rule).isEmpty():
        comps = components(scratch, _links(found.union(late), rule), "all")
    if count_links:
        members = sets.join(comps, "id").select("id", "comp", "n", "copies")
        many = comps.groupBy("comp").count().where("count > 2").select("comp")
        need = scratch.save(sets.join(comps.join(many, "comp"), "id").select(F.col("doc").alias("doc_id")).distinct(), "links-need")
        small = need.count() <= BROADCAST_IDS
        texts = docs.join(F.broadcast(need) if small else need, "doc_id", "left_semi").select("text")
        full = scratch.save(texts.mapInArrow(_full_sets(rule.size), "id long, set binary").dropDuplicates(["id"]), "links-sets")
        degrees = links.counts(scratch, members, _links(found.union(late), rule), full, rule.num, rule.den)
        scratch.drop("links-need", "links-sets")
        scratch.reclaim()
    grouped = sets.select("id", "doc").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = grouped.groupBy("comp").agg(F.min("doc").alias("component_id"))
    final = grouped.join(least, "comp").select("id", "component_id")
    if count_links:
        own_copies = sets.select("id", (F.col("copies") - 1).alias("others"))
        final = final.join(own_copies, "id").join(degrees, "id", "left").select("id", "component_id", (F.col("others") + F.coalesce("links", F.lit(0))).alias("n_links"))
    final = scratch.save(final, "final")
    slim = scratch.save(rows.select("doc_id", "id", F.col("n").cast("long").alias("n_shingles")), "slim")
    scratch.drop("rows", "reps", "lists", "rest", "late-found", "all-out", "links-out")
    for number in range(1, ROUNDS + 1):
        scratch.drop(*(f"{x}{number}{y}" for x, y in (("star", "-found"), ("near", "-out"), ("members", ""), ("lead", ""))))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    out = slim.join(final, "id", "left")
    degree = [F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(0)).alias("n_links")] if count_links else []
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), *degree)


def representatives(spark: SparkSession, docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs``, all columns kept, less those that are linked to a smaller doc_id.

    Ids are taken to be unique, but of wholly equal rows one stays. Rows without shingles or with a null id stay.
    """
    found = join(spark, docs, rule, count_links=False)
    losers = found.where("component_id <> doc_id").select("doc_id").distinct()
    small = losers.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(losers) if small else losers, "doc_id", "left_anti").select(docs.columns)
    again = found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_anti").select(docs.columns)
    return once.union(kept.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"]))
