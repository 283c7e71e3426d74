"""What the classifier's fit holds in memory, and that its rows and the near-dedup's products are the same."""

import tracemalloc

import numpy as np

from fleetlens.llm import minhash, quality


def peak(f):
    tracemalloc.start()
    try:
        return f(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fit_holds_little_beside_its_rows():
    rng = np.random.default_rng(4)
    label = np.arange(1200) % 2
    rows = [np.unique((rng.integers(0, 1 << 19, 9000) * 2 + y * rng.integers(0, 2, 9000)) % (1 << 20)).astype("<i4") for y in label]
    model, most = peak(lambda: quality.fit(rows, label))
    assert most < 11 * 8 * 2**quality.BITS  # arrays of all places; scaled copies of the rows would double it
    counts = quality._counts(rows)
    assert (counts == np.bincount(np.concatenate(rows), minlength=1 << quality.BITS)).all()
    assert model["slope"] > 0


def test_rows_are_learned_in_one_order():
    rng = np.random.default_rng(5)
    ids, label = rng.integers(0, 40, 200), rng.integers(0, 2, 200)
    rows = [rng.integers(0, 300, 2).astype("<i4") for _ in ids]
    key = lambda k: (ids[k], label[k], rows[k].tobytes())
    assert [key(k) for k in quality._in_order(ids, label, rows)] == sorted(map(key, range(200)))
    assert not len(quality._in_order(ids[:0], label[:0], []))


def test_overlaps_of_many_shingles():
    rng = np.random.default_rng(6)
    bags = [np.unique(rng.integers(0, 9000, 6000).astype(np.uint64), return_counts=True) for _ in range(120)]
    x, y = np.arange(0, 120, 2), np.arange(1, 120, 2)
    got = minhash._overlaps(bags, x, y)
    weights = np.zeros((120, 9000), int)
    for k, (h, w) in enumerate(bags):
        weights[k, h.astype(int)] = w
    assert (got == [[np.minimum(weights[a], weights[b]).sum() for b in y] for a in x]).all()
