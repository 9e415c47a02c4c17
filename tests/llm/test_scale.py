"""How the work of operators grows, where a count of it tells more than a clock."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from hourlake.llm import line_dedup, minhash


def lines_of_one_word(rng, n):
    """Rows of one group: n lines, of which each tenth is a copy of the one before but for its place."""
    bits = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
    bits[1::10] = bits[0::10][: len(bits[1::10])]
    doc, zeros = np.arange(n, dtype=np.int64), np.zeros(n, np.uint32)
    doc[0] = -(1 << 63)  # a null id
    place = zeros | line_dedup.EARLIER | line_dedup.LATER
    return line_dedup.Rows(zeros, doc, zeros, bits, np.zeros(n, np.uint64), np.full(n, 20, np.uint32), place)


def test_pairs_of_a_small_group_are_compared_at_once(monkeypatch):
    calls, candidates = [], line_dedup.Rows.candidates
    monkeypatch.setattr(line_dedup.Rows, "candidates", lambda self, x, y: calls.append(len(x)) or candidates(self, x, y))
    table = lines_of_one_word(np.random.default_rng(3), 250)
    x, y, more = table.pairs(2)
    assert sum(calls) == 250 * 249 // 2 and len(calls) == 1  # one call for each distance of rows before
    ys, xs = np.triu_indices(250, 1)
    want = candidates(table, xs, ys)
    assert set(zip(xs[want].tolist(), ys[want].tolist(), strict=True)) == set(zip(x.tolist(), y.tolist(), strict=True)) and len(x) >= 25 and not more.any()


def test_only_lines_that_may_have_a_heavy_word_are_ordered():
    often = np.zeros(line_dedup.COUNTERS, np.uint32)
    often[:30] = 2
    often[30:40] = 5000
    sets = [range(20), range(18, 40), range(26, 40)]  # of 20, 22 and 14 words; 5, 5 and 3 of them are the rarest
    rows = [line_dedup.pack(np.array(s, np.uint64)).tobytes() for s in sets]
    batch = pa.RecordBatch.from_arrays([pa.array([len(s) for s in sets], pa.int32()), pa.array(rows)], ["n", "words"])
    assert line_dedup.with_frequent(batch, often, 4096).num_rows == 0
    assert line_dedup.with_frequent(batch, often, 1).num_rows == 3
    few = pa.RecordBatch.from_arrays([pa.array([12], pa.int32()), pa.array([line_dedup.pack(np.array(range(28, 40), np.uint64)).tobytes()])], ["n", "words"])
    kept = line_dedup.with_frequent(few, often, 4096)
    assert kept.num_rows == 1 and (line_dedup.prefixes(kept, often)[0] >= 30).sum() == 1


def test_orders_by_one_sort_are_those_of_lexsort():
    rng = np.random.default_rng(5)
    for most in (1, 7, 1 << 20, 1 << 62):  # the last does not fit in 64 bits with the others
        keys = [rng.integers(0, most, 500) for _ in range(2)]
        assert line_dedup.sorted_order(*keys).tolist() == np.lexsort(keys[::-1]).tolist()
    assert line_dedup.sorted_order(np.empty(0, np.int64)).tolist() == []


def components(n, edges):
    up = list(range(n))
    for a, b in edges:
        p, q = up[a], up[b]
        up = [q if u == p else u for u in up]
    return {frozenset(k for k in range(n) if up[k] == r) for r in up}


def near_sets(rng, n):
    """Sets of 100 hashes in families of five that differ in few, sorted."""
    out = []
    for k in range(n):
        if k % 5 == 0:
            base = rng.integers(0, 1 << 64, 100, np.uint64, endpoint=False)
        own = base.copy()
        own[: k % 4 * 3] = rng.integers(0, 1 << 64, k % 4 * 3, np.uint64, endpoint=False)
        out.append(np.sort(own))
    return out


def test_rows_left_over_are_compared_with_a_part_and_not_with_each_other_again(monkeypatch):
    """Each part of a group gets all rows that are left over: comparing these with each other in every part would take cubic time."""
    sets = near_sets(np.random.default_rng(7), 300)
    registers = np.stack([minhash.sketch(s) for s in sets])
    asking, least = np.arange(0, 300, 2), minhash.least_estimate(80)
    compared, estimates = [], minhash.estimates
    monkeypatch.setattr(minhash, "estimates", lambda left, right: compared.append(len(left) * len(right)) or estimates(left, right))
    found, links = [], []
    for part in range(3):
        own = np.arange(part, 300, 3)
        found += minhash.asked_forest(registers, own, asking, least)
        links += minhash.asked_true_forest(sets, own, asking, 80)
    assert sum(compared) == 300 * len(asking)
    near = estimates(registers, registers) >= least
    asks = np.isin(np.arange(300), asking)
    near &= asks[:, None] | asks[None, :]
    assert components(300, found) == components(300, np.argwhere(near).tolist())
    shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    true = (100 * shared >= 80 * (200 - shared)) & (asks[:, None] | asks[None, :])
    assert components(300, links) == components(300, np.argwhere(true).tolist()) and len(links) > 100


def test_estimates_of_rows_with_empty_registers():
    rng = np.random.default_rng(9)
    rows = rng.integers(0, 3, (40, minhash.REGISTERS)).astype(np.uint16)
    rows[rng.random(rows.shape) < 0.4] = minhash.EMPTY
    rows[0] = minhash.EMPTY
    got = minhash.estimates(rows[:20], rows)
    for a in range(20):
        for b in range(40):
            used = (rows[a] != minhash.EMPTY) | (rows[b] != minhash.EMPTY)
            same, total = ((rows[a] == rows[b]) & used).sum(), max(used.sum(), 1)
            chance = total * minhash.collision_share()
            assert got[a, b] == max(same - chance, 0) / max(total - chance, 1e-9)


def test_pipeline_stages_send_small_batches_to_workers(spark):
    """Rows of long texts go to a worker in batches of a few MB, whatever their number."""
    from hourlake.llm import common

    before = spark.conf.get(common.BATCHES)
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('a b c d ', 1000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        corpus_pipeline.without_near_copies(spark, docs.limit(1), "")
        most = max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect())
    finally:
        spark.conf.set(common.BATCHES, before)
    assert most < 2 * int(common.BATCH)
