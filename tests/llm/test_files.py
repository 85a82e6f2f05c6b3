import functools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from dialoom.llm import ans, hilbert, packing, tokens

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@functools.cache
def library(path):
    """The library's tokenizer as its file gives it, apart from the one under test."""
    return Tokenizer.from_file(path)


ODD = ["a  b", "a   b\n\n c", "\t x   y\x1cz ", "<|endoftext|> hi<|endoftext|>", "don't WE'll  12345 ½²  …!!\n\n\n", "", None, "é é  İx", "a\x85b\u2003 \u3000c", " ", "\n", "x ", "a,b;c.'s %.% _x_", "e\u0301,\u0338"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_equal_the_library(path):
    e, fresh = tokens.Encoder(path), Tokenizer.from_file(path)
    texts = ODD + [prose(i, 60) for i in range(20)]
    for _ in range(2):  # the second time from the store
        ids, off = e.encode(texts, 2)
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == [*fresh.encode(t or "", add_special_tokens=False).ids, 2], t


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_of_one_hash_keep_their_own_ids(path, monkeypatch):
    from test_joins import thue_morse

    texts = [*thue_morse("ab", 10), "the sea the sand", "sea  the; the, x1y", None, "", "sand"] + [prose(i, 30) for i in range(5)]
    fresh = Tokenizer.from_file(path)
    want = [[*fresh.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    for hashes in (None, lambda data, start, end: np.zeros(len(start), np.uint64), lambda data, start, end: ((end - start) % 3).astype(np.uint64)):
        if hashes:
            monkeypatch.setattr(tokens, "span_hashes", hashes)
        e = tokens.Encoder(path)
        for _ in range(2):
            ids, off = e.encode(texts, 2)
            assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab,'. \n\t\u00a0\u2003é1!s", max_size=12), max_size=5))
def test_ids_of_any_text(texts):
    for path in (WORD, BYTE):
        e, fresh = tokens.Encoder.of(path), library(path)
        ids, off = e.encode(texts, 2)
        want = [[*fresh.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_in_a_text_get_their_ids(path):
    fresh = Tokenizer.from_file(path)
    texts = ["one <|endoftext|> two", "<|startoftext|>a, b<|endoftext|>\n\n<|endoftext|>", "x <|endoftext| > y", "plain, text", "<|ENDOFTEXT|>.a", "a<|endoftext", "|>b", None]
    e = tokens.Encoder(path)
    for _ in range(2):  # the second time from the store
        ids, off = e.encode(texts, 2)
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == [*fresh.encode(t or "", add_special_tokens=False).ids, 2], t
    assert fresh.token_to_id("<|endoftext|>") in ids


def test_new_pieces_are_encoded_joined(monkeypatch):
    """Where ids keep all bytes, far fewer texts than pieces go to the library, and each piece keeps its own ids."""
    texts = [prose(i, 400) for i in range(6)] + ["a\u00a0", " b  \n", "it's 're", "x<|endoftext|", "> y", "<|endoftext|>", " ", "\n\n", "caf\u00e9, \u4e2d\u6587", None]
    for path in (WORD, BYTE):
        e, fresh, given = tokens.Encoder(path), library(path), []
        inner = e._ids
        monkeypatch.setattr(e, "_ids", lambda some: given.append(len(some)) or inner(some))
        ids, off = e.encode(texts, 2)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [[*fresh.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
        assert (sum(given) < e.count / 5) == (path == BYTE)
        e.clear()
        pieces = [b" a", b"b", b" c ", b" <|endoftext", b"|>", b" d\xc2\xa0", b" e", b" <|endoftext|>", b" f", b" g's"]
        got, sizes = e._joined_ids(pieces)
        want = [fresh.encode(p.decode(), add_special_tokens=False).ids for p in pieces]
        assert got.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    e.bytes_of = e.bytes_of + 1  # ends that aren't found: each for itself
    got, sizes = e._joined_ids(pieces)
    assert got.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


def test_a_full_store_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 5)
    e = tokens.Encoder(BYTE)
    for i in range(4):
        ids, _ = e.encode([prose(i, 40)], 2)
        assert ids.tolist() == [*e.tokenizer.encode(prose(i, 40)).ids, 2]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_of_the_store_are_found_without_sorting(path, monkeypatch):
    texts = [prose(i, 400) for i in range(20)]
    e = tokens.Encoder(path)
    first, _ = e.encode(texts, 2)
    sorted_, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, **more: sorted_.append(len(x)) or unique(x, **more))
    again, _ = e.encode(texts, 2)
    assert (again == first).all() and sum(sorted_) == 0


@pytest.mark.parametrize("shift", [0, 40, 63])
def test_pieces_that_share_places_of_the_table_are_found(monkeypatch, shift):
    """With hashes that differ in their upper bits only, and a table that grows."""
    hashes = tokens.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda *of: (hashes(*of) >> np.uint64(shift)) << np.uint64(shift))
    e, fresh = tokens.Encoder(BYTE), library(BYTE)
    e.table = np.full(2, -1, np.int32)
    for k in range(6):
        texts = [" ".join(f"w{k}{i}q{j}" for j in range(20)) for i in range(5)] + ODD
        ids, off = e.encode(texts, 2)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [[*fresh.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("n", [0, 1, ans.LANES - 1, ans.LANES, ans.LANES + 1, 70_000])
def test_blocks_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 40_000).astype(np.uint32)
    table = ans.Table(np.bincount(ids, minlength=1 << 16))
    assert (ans.decode(ans.encode(ids, table), table) == ids).all()


@pytest.mark.parametrize("n", [1, ans.SPAN * ans.LANES, ans.SPAN * ans.LANES + 1, ans.BLOCK_IDS, ans.BLOCK_IDS + 70_001])
def test_ordinary_blocks_have_checkpoints_that_decode_alone(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 40_000).astype(np.uint32)
    table = ans.Table(np.bincount(ids, minlength=1 << 16))
    block = ans.encode(ids, table)
    step = ans.SPAN * ans.LANES
    assert ans.span_count(block) == -(-n // step) and (n < ans.BLOCK_IDS or ans.span_count(block) >= 4)
    assert (ans.decode(block, table) == ids).all()
    for k in range(ans.span_count(block)):
        assert (ans.decode(block, table, k) == ids[k * step : (k + 1) * step]).all()
        alone = ans.only(block, k)
        assert len(alone) < len(block) or ans.span_count(block) == 1
        assert (ans.decode(alone, table) == ids[k * step : (k + 1) * step]).all()


def test_spans_of_a_long_document_are_dealt_over_tasks(spark, tmp_path):
    docs = spark.createDataFrame([(1, prose(1, 60_000)), (2, "short")], "doc_id long, text string")
    path = str(tmp_path / "files")
    ans.write(spark, docs, ans.Plan(WORD), path)
    rows = sorted((r["part"], r["number"], r["span"], r["ids"]) for r in ans.spans(spark, path).collect())
    assert len(rows) >= 2
    fresh = library(WORD)
    want = [i for t in (prose(1, 60_000), "short") for i in [*fresh.encode(t, add_special_tokens=False).ids, 2]]
    assert [i for r in rows for i in r[3]] == want


def test_damaged_blocks_are_refused(monkeypatch):
    monkeypatch.setattr(ans, "SPAN", 16)
    ids = np.random.default_rng(1).integers(0, 300, 50_000).astype(np.uint32)
    table = ans.Table(np.bincount(ids, minlength=300))
    block = ans.encode(ids, table)
    for at in (0, 30, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ans.CorruptBlock):
            ans.decode(bytes(bad), table)
    with pytest.raises(ans.CorruptBlock):
        ans.decode(block[:5], table)


def test_token_files_equal_the_library(spark):
    docs = documents(spark)
    got = sorted((tuple(r) for r in ans.round_trip(spark, docs, ans.Plan(WORD)).select("doc_id", "n_tokens", "ids_crc32", "start").collect()), key=lambda r: r[3])
    e = library(WORD)
    want = []
    for r in docs.collect():
        ids = [*e.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted([g[:3] for g in got], key=str) == sorted(want, key=str)
    keys = [g[0] if g[0] is not None else -1 for g in got]
    assert keys == sorted(keys)
    assert [g[3] for g in got] == np.concatenate([[0], np.cumsum([g[1] for g in got])[:-1]]).tolist()
    assert ans.round_trip(spark, docs.limit(0), ans.Plan(WORD)).count() == 0


def test_packing_is_whole_and_gapless(spark):
    docs = documents(spark)
    plan = packing.Plan(BYTE, block=20)
    rows = packing.packing(spark, docs, plan).collect()
    e = library(BYTE)
    want = []
    for r in docs.collect():
        ids = [*e.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, m in sorted(b):
            assert o == at
            at += m
        assert at <= 1024
    total = sum(w[3] for w in want)
    assert len(bins) <= -(-total // 1024) + 2
    assert packing.packing(spark, docs.limit(0), plan).count() == 0


def test_islands_of_many_blocks_are_written_as_few_files(spark, monkeypatch):
    files, save = {}, packing.Scratch.save

    def saved(self, df, name):
        out = save(self, df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(packing.Scratch, "save", saved)
    docs = spark.createDataFrame([(i, prose(i, 400 + 37 * i % 90)) for i in range(60)], "doc_id long, text string")
    rows = packing.packing(spark, docs, packing.Plan(BYTE, block=6, generations=1)).collect()
    assert {r["doc_id"] for r in rows} == set(range(60)) and files["blocks0"] <= 2
    assert all(n <= 2 for name, n in files.items() if name.startswith("islands"))


def plain_best_fit(sizes):
    bins = []
    packing.best_fit(np.arange(len(sizes)), sizes, bins, [], 1024)
    return len(bins)


def test_islands_begin_without_a_tokenizer_store():
    tokens.Encoder.of(BYTE).encode(["a b"], 2)
    assert not list(packing._epoch(packing.Plan(BYTE), 0, 0)(iter([]))) and not tokens.Encoder._open


def test_genetic_packing_is_valid_and_no_worse_than_best_fit():
    plan = packing.Plan("")
    sizes = np.random.default_rng(3).integers(200, 700, 300)
    best, left = packing.pack(sizes, plan, 1)
    assert packing.fewest(sizes, 1024) <= len(best) <= plain_best_fit(sizes) and sorted(i for b in best for i in b) == list(range(300))
    assert all(sizes[b].sum() + f == 1024 for b, f in zip(best, left))
    assert packing.pack(sizes, plan, 1)[0] == best  # the same again


@pytest.mark.parametrize("seed", [3, 17, 27])
def test_genetic_packing_beats_best_fit_where_it_can(seed):
    sizes = np.random.default_rng(seed).integers(200, 700, 60)
    assert len(packing.pack(sizes, packing.Plan(""), 1)[0]) == -(-int(sizes.sum()) // 1024) < plain_best_fit(sizes)


def triplets(n, seed):
    """Sizes of which n bins can be filled to the last place, three in each."""
    r = np.random.default_rng(seed)
    a = r.integers(389, 500, n)
    b = np.array([r.integers(256, (1024 - x) // 2 + 1) for x in a])
    return r.permutation(np.concatenate([a, b, 1024 - a - b]))


@pytest.mark.parametrize("seed", [1, 2])
def test_genetic_packing_gains_on_triplets(seed):
    sizes = triplets(100, seed)
    assert packing.fewest(sizes, 1024) == 100 and len(packing.pack(sizes, packing.Plan(""), 1)[0]) < plain_best_fit(sizes)


def test_the_bound_is_below_every_packing():
    for seed in range(30):
        r = np.random.default_rng(seed)
        sizes = r.integers(1, r.integers(300, 1024), r.integers(1, 80))
        assert packing.fewest(sizes, 1024) <= plain_best_fit(sizes)
    assert packing.fewest(np.array([600, 600, 600]), 1024) == 3 and packing.fewest(np.zeros(0, np.int64), 1024) == 0


def test_exchange_fills_bins_and_loses_nothing():
    sizes = np.array([500, 500, 300, 310, 24, 20])
    bins, free = [[0, 1], [2, 3]], [24, 414]
    out = packing.exchange(np.array([4, 5]), sizes, bins, free)
    assert sorted([*out.tolist(), *(i for b in bins for i in b)]) == list(range(6))
    assert all(sizes[b].sum() + f == 1024 for b, f in zip(bins, free))


def test_islands_in_tasks_equal_islands_in_a_row(spark):
    from dialoom.llm.shared import Scratch

    sizes = triplets(40, 5)
    rest = spark.createDataFrame([(i, int(x)) for i, x in enumerate(sizes)], "key long, length long")
    plan = packing.Plan("")
    rows = packing._packed(Scratch(spark, "t"), rest, plan, 0, 1, True).collect()
    assert sorted(r["key"] for r in rows) == list(range(120))
    want = packing.pack(sizes, plan, plan.seed)  # other seeds of the islands, so only as good
    by = defaultdict(int)
    for r in rows:
        by[r["bin"]] += r["length"]
    assert max(by.values()) <= 1024 and abs(len(by) - len(want[0])) <= 1 and len(by) <= plain_best_fit(sizes)


def test_curve_visits_each_cell_by_unit_steps():
    import itertools

    for n, bits in ((2, 3), (3, 2), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        h = hilbert.curve_index(points, bits)
        assert sorted(h) == list(range(len(points)))
        assert np.abs(np.diff(points[np.argsort(h)], axis=0)).sum(axis=1).max() == 1


@pytest.mark.parametrize("number", [5, 40, 100])
def test_shards_are_even_and_keep_groups(spark, number):
    docs = documents(spark)
    rows = hilbert.shards(spark, docs, number).collect()
    source = docs.collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in source), key=str
    )
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < number and r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(k, [])) for k in range(number)]
    assert max(counts) - min(counts) <= 1
    if number == 5:
        split = defaultdict(set)
        for r in rows:
            split[r["text_crc32"]].add(r["shard"])
        assert sum(len(s) - 1 for s in split.values()) <= number - 1
    assert hilbert.shards(spark, docs.limit(0), number).count() == 0
    stats = hilbert.statistics(hilbert.shards(spark, docs, number))
    rows = stats.collect()
    assert sum(r["rows"] for r in rows) == len(source) and all(r["least_size"] <= r["largest_size"] for r in rows)


def test_curve_lets_readers_skip_shards(spark):
    """Against shards of the same rows in order of their ids."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    stats = hilbert.statistics(hilbert.shards(spark, docs, 40)).cache()
    by_id = docs.select("doc_id", "lang", "source", F.lit(0).alias("size"), (F.percent_rank().over(Window.orderBy("doc_id")) * 39.99).cast("int").alias("shard"))
    plain = hilbert.statistics(by_id).cache()
    opened = lambda s, **e: hilbert.pruned(s, **e).first()["opened"]
    some = docs.select("lang", "source").where("lang IS NOT NULL AND source IS NOT NULL").distinct().orderBy("lang", "source").limit(6).collect()
    curve, ids = (sum(opened(s, lang=r["lang"], source=r["source"]) for r in some) for s in (stats, plain))
    print("opened of", 40 * len(some), "along the curve", curve, "by id", ids)
    assert curve < 0.5 * ids


def test_arrow_slices_are_read_right():
    e = tokens.Encoder.of(BYTE)
    a = pa.array(["zero", None, "one two", "three"]).slice(1, 2)
    ids, off = e.encode(a, 2)
    assert off.tolist() == [0, 1, 4] and ids.tolist()[1:] == [*e.tokenizer.encode("one two").ids, 2]
