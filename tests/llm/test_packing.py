import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerolake.llm import packing
from aerolake.llm.common import crc_of_ids


def brute_pieces(rows, capacity=2048):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        out += [(r["doc_id"], k, a, b - a, crc_of_ids(np.array(ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    return out


def check_layout(rows, capacity=2048):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for got in bins.values():
        at = 0
        for offset, length in sorted(got):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def none_low(t):
    return tuple((x is not None, x or 0) for x in t)


@pytest.mark.parametrize("which", ["small_docs", "awkward"])
def test_pieces_and_layout(which, request):
    docs = request.getfixturevalue(which)
    got = packing.pack_documents(docs).collect()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted((tuple(r[k] for k in key) for r in got), key=none_low) == sorted(brute_pieces(docs.collect()), key=none_low)
    used = check_layout(got)
    bound = -(-sum(r["length"] for r in got) // 2048)
    assert bound <= used <= bound * 1.02 + 1


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_sequences_hold_the_ids(awkward):
    cut = packing.pieces(awkward, with_ids=True)
    rows = packing.pack(cut)
    seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def optimum(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, bins[:k] + [bins[k] + sizes[i]] + bins[k + 1:])
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best


def test_bounds_never_pass_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(60):
        capacity = int(rng.integers(5, 30))
        sizes = np.sort(rng.integers(1, capacity + 1, int(rng.integers(1, 9))))[::-1]
        bound = packing.lower_bound(*np.unique(sizes, return_counts=True), capacity)
        best = optimum(sizes.tolist(), capacity)
        bins, offsets, used = packing.best_fit_decreasing(sizes, capacity)
        assert bound <= best <= used
        assert (np.bincount(bins, weights=sizes) <= capacity).all()
    assert packing.lower_bound([6], [3], 10) == 3  # no two fit together
    assert packing.lower_bound([4], [5], 10) == 3  # two fit, not three


def test_partitions_exchange_documents(spark):
    rng = np.random.default_rng(5)
    sizes = [int(x) for x in rng.integers(300, 1500, 3000)]
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    alone = check_layout(packing.pack(cut, per_partition=100, patience=0).collect())
    rows = packing.pack(cut, per_partition=100).collect()
    assert sorted(r["length"] for r in rows) == sorted(sizes)
    assert check_layout(rows) <= alone
    seen = packing.certificate(packing.pack(cut, per_partition=100)).first()
    assert seen["lower_bound"] <= seen["sequences"] <= alone


@pytest.mark.parametrize("low, high", [(300, 1500), (1030, 1400), (500, 700)])
def test_certificates_hold(spark, low, high):
    """What a certified partition uses is the least that any packing of it could: no
    table with the same lengths does with fewer bins than the bounds' sum."""
    rng = np.random.default_rng(low)
    sizes = [int(x) for x in rng.integers(low, high, 1200)] + [2048] * 5
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    rows = packing.pack(cut, per_partition=80).collect()
    assert sorted(r["length"] for r in rows) == sorted(sizes)
    check_layout(rows)
    groups = {}
    for r in rows:  # the partition is what is left of the number of a sequence without its bin
        part = r["sequence_id"] >> 32 if r["sequence_id"] >= 0 else r["sequence_id"]
        groups.setdefault((part, r["bins"], r["bound"]), []).append(r)
    for (_, bins, bound), own in groups.items():
        assert all(r["certified"] == (bins == bound) for r in own)
        used = len({r["sequence_id"] for r in own})
        if any(sum(r["length"] for r in own if r["sequence_id"] == q) < 2048 for q in {r["sequence_id"] for r in own}):
            assert used == bins and bound <= bins
            assert packing.lower_bound(*np.unique([r["length"] for r in own], return_counts=True)) == bound
    if low == 1030:
        assert all(r["certified"] for r in rows)  # no two fit together, and the bound sees it


def test_exchange_goes_on_while_bins_are_saved(spark):
    rng = np.random.default_rng(8)
    sizes = [int(x) for x in rng.integers(150, 1100, 2400)]
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    used = [check_layout(packing.pack(cut, per_partition=60, patience=p).collect()) for p in (0, 1, 3)]
    assert used[2] <= used[1] < used[0], used
