"""Memory of a k-NN task follows its pieces, not the pairs that are left."""

import tracemalloc

import numpy as np
import pyarrow as pa

from lexis.operators import neighbors as N


def peak(fn) -> float:
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_routing_holds_no_list_of_all_pairs():
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((3000, 32))                      # no clusters: every leaf is left
    tree = N.BallTree.fit(x[:1000], 200)
    big = np.full(len(tree.centre), 1e9)
    index = N.Index(tree, x[:50], big, np.ones(len(tree.centre), np.int64), np.full(tree.n_leaves, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), N._lists_of(x)], ["id", "vec"])
    sizes = []
    assert peak(lambda: sizes.extend(b.num_rows for b in N._route(index, 2)([batch]))) < 30
    assert sum(sizes) == 3000 * 200 * 4 and max(sizes) < 2 << 14


def test_copies_are_compared_in_pieces():
    x = np.zeros((4096, 64))
    out = []
    assert peak(lambda: out.append(N._best(np.zeros((200, 64)), np.full(200, 1.0), x, np.arange(4096), 2))) < 250
    q, n, d = out[0]
    assert q.tolist() == [i for i in range(200) for _ in range(2)] and n.tolist() == [0, 1] * 200 and not d.any()
