"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and runs of white space become one space. An item of m characters may
differ from a passage by k = floor(m * rate) edits. Cut into k + 1 pieces, at least one piece stands in the
passage unchanged: an Aho-Corasick automaton of all pieces finds every such place in one pass over a text,
and each place's window is verified with Myers' bit-parallel edit distance. A short item must stand between word
boundaries, so each passage of about its length at such a place is compared with it. Items are taken in blocks of a
bounded number of characters, a pass over the documents for each, so any number of items can be searched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import wordhash


@dataclass(frozen=True)
class Plan:
    #: Edits allowed for each character of an item.
    rate: float = 0.08
    #: Shorter items (after normalising) are found only between word boundaries.
    least: int = 24
    #: Characters of a block of items, which bounds what is sent to the executors.
    block_chars: int = 4_000_000


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length, with their places."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _of_word(c: str) -> bool:
    """Whether a character is part of a word that spaces set off; those of scripts without spaces stand alone."""
    if "\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u3040" <= c <= "\u30ff" or "\u3400" <= c <= "\u9fff" or c >= "\U00020000":
        return False
    return c.isalnum() or unicodedata.category(c)[0] == "M"


def boundary(text: str, at: int) -> bool:
    """Whether no word goes on over a place of the text."""
    return at == 0 or at == len(text) or not (_of_word(text[at - 1]) and _of_word(text[at]))


def distance(a: str, b: str) -> int:
    """Edits between two short strings."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance between the pattern of m characters and any substring, and where the first such ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = pattern_masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best:
            best, end = score, j
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
    return best, end


class Matcher:
    """Finds items, given as (item_id, normalised text), in texts."""

    def __init__(self, items: list[tuple[int, str]], plan: Plan):
        import ahocorasick

        self.least = plan.least
        self.items = []  # (item_id, text, budget, masks, masks of the reverse); no masks of short items
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            budget = int(len(text) * plan.rate)
            for at, piece in pieces(text, budget):
                places.setdefault(piece, []).append((len(self.items), at + len(piece)))
            long = len(text) >= plan.least
            self.items.append((item_id, text, budget, masks(text) if long else {}, masks(text[::-1]) if long else {}))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if places:
            self.automaton.make_automaton()
        self.some = bool(places)

    def _short(self, k: int, text: str, at: int, best: tuple[int, int, int] | None) -> tuple[int, int, int] | None:
        """The better of ``best`` and the passages that begin within the edits of a place: (distance, start, end)."""
        _, item, budget, _, _ = self.items[k]
        if best and not best[0]:
            return best
        for lo in range(max(0, at - budget), min(len(text), at + budget) + 1):
            if not boundary(text, lo):
                continue
            for hi in range(max(lo + 1, lo + len(item) - budget), min(len(text), lo + len(item) + budget) + 1):
                if boundary(text, hi):
                    d = 0 if text[lo:hi] == item else distance(item, text[lo:hi]) if budget else 1
                    if d <= budget and (best is None or (d, lo, hi) < best):
                        best = (d, lo, hi)
        return best

    def find(self, text: str, first: bool = False) -> Iterator[tuple[int, int, int, int]]:
        """(number of the item, distance, start, end) of each item's best passage in the normalised text;
        ``first``: only of one item that is there."""
        if not self.some or not text:
            return
        windows: dict[int, list[list[int]]] = {}
        short: dict[int, tuple[int, int, int]] = {}
        for end, where in self.automaton.iter(text):
            for k, upto in where:
                m, budget = len(self.items[k][1]), self.items[k][2]
                if m < self.least:
                    found = self._short(k, text, end + 1 - upto, short.get(k))
                    if found:
                        short[k] = found
                        if first:
                            yield k, *found
                            return
                    continue
                lo, hi = max(0, end + 1 - upto - budget), min(len(text), end + 1 - upto + m + budget)
                own = windows.setdefault(k, [])
                if own and own[-1][0] <= lo <= own[-1][1]:  # overlapping windows of an item are verified as one
                    own[-1][1] = max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        for k, found in sorted(short.items()):
            yield k, *found
        for k, spans in sorted(windows.items()):
            _, item, budget, forward, backward = self.items[k]
            best = None
            for lo, hi in spans:
                d, end = myers(forward, len(item), text[lo:hi])
                if d <= budget and (best is None or d < best[0]):
                    best = (d, lo, lo + end)
            if best:
                d, lo, end = best
                _, back = myers(backward, len(item), text[max(0, end - len(item) - budget) : end][::-1])
                yield k, d, end - back, end
                if first:
                    return


def blocks(benchmark: DataFrame, plan: Plan, ids: bool = True) -> Iterator[list[tuple[int | None, str]]]:
    """Normalised items of ``benchmark(item_id, text)`` in blocks of bounded size; ``ids``: only of items with an id."""
    block: list[tuple[int, str]] = []
    size, seen = 0, None
    known = F.col("text").isNotNull() & F.col("item_id").isNotNull() if ids else F.col("text").isNotNull()
    rows = benchmark.where(known).select("item_id", "text").distinct().orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        item = (r["item_id"], normal(r["text"]))
        if not item[1] or item == seen:
            continue
        seen = item
        chars = max(len(item[1]), plan.least)  # of short items no more go into a block
        if block and size + chars > plan.block_chars:
            yield block
            block, size = [], 0
        block.append(item)
        size += chars
    if block:
        yield block


_open: dict[int, Matcher] = {}


def _matcher(items: list[tuple[int, str]], plan: Plan) -> Matcher:
    """Built once for each process and block."""
    key = hash((plan, tuple(items)))
    if key not in _open:
        _open.clear()
        _open[key] = Matcher(items, plan)
    return _open[key]


def _find(items: list[tuple[int, str]], plan: Plan):
    def run(batches):
        m = _matcher(items, plan)
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    best: dict[int, tuple] = {}
                    for k, d, a, b in m.find(normal(text)):
                        row = (doc_id, m.items[k][0], d, a, b, m.items[k][2])
                        if row[1] not in best or row[2:] < best[row[1]][2:]:
                            best[row[1]] = row
                    rows += best.values()
                cols = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "distance", "start", "end", "budget"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Which rows of ``docs(doc_id, text)`` hold which items of ``benchmark(item_id, text)``:
    doc_id, item_id, distance, start, end (in the normalised text, of a best passage), budget.

    Null and empty texts hold nothing; null and blank items aren't searched, nor items without an id. Items
    with equal texts are all found; an item given with several texts counts by its best. Repeated documents are all
    searched, and a null doc_id is returned as null.
    """
    out = None
    for items in blocks(benchmark, plan):
        found = docs.select("doc_id", "text").mapInArrow(_find(items, plan), "doc_id long, item_id long, distance int, start int, end int, budget int")
        out = found if out is None else out.union(found)
    if out is None:
        return docs.select(F.col("doc_id").cast("long")).limit(0).selectExpr("doc_id", "0L AS item_id", "0 AS distance", "0 AS start", "0 AS end", "0 AS budget")
    return out


def _keep(items: list[tuple[int, str]], plan: Plan):
    def run(batches):
        m = _matcher(items, plan)
        for batch in batches:
            for part in wordhash.parts(batch, "text"):
                clean = [next(m.find(normal(t), first=True), None) is None for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

    return run


def clean(docs: DataFrame, benchmark: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs``, all columns kept, that hold no item, be it with or without an id.

    Null and empty texts hold none and stay; repeated rows are judged alike, and a null doc_id doesn't matter. Items with
    null or blank text are in no document; without items all rows stay.
    """
    for items in blocks(benchmark, plan, ids=False):
        docs = docs.mapInArrow(_keep(items, plan), docs.schema)
    return docs
