"""Packing goldens (block * batch reduced to 4) and boundaries."""

import pytest
from pyspark.sql import functions as F

from spindle.operators import packing

BLOCK, BATCH = 4, 1


def _docs(spark, lens=(3, 0, 5, 2)):
    rows, t = [], 0
    for i, n in enumerate(lens):
        rows.append((i, list(range(t, t + n))))
        t += n
    return spark.createDataFrame(rows, "doc_id bigint, ids array<int>")


def _prep(spark, lens=(3, 0, 5, 2)):
    e = _docs(spark, lens)
    return packing.with_offsets(e), packing.stream_total(e)


def _steps(df):
    return [r.x for r in df.orderBy("step").collect()]


def test_full_batches(spark):
    wo, tot = _prep(spark)
    assert _steps(packing.full_batches(wo, tot, BLOCK, BATCH)) == [[0, 1, 2, 3], [4, 5, 6, 7]]


def test_wrap(spark):
    wo, tot = _prep(spark)
    got = _steps(packing.pack_wrap(wo, tot, 5, BLOCK, BATCH))
    assert got == [[0, 1, 2, 3], [4, 5, 6, 7], [0, 1, 2, 3], [4, 5, 6, 7], [0, 1, 2, 3]]


def test_carry(spark):
    wo, tot = _prep(spark)
    got = _steps(packing.pack_carry(wo, tot, 5, BLOCK, BATCH))
    assert got == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 0, 1], [2, 3, 4, 5], [6, 7, 8, 9]]


def test_sliding(spark):
    wo, tot = _prep(spark)
    got = [r.x for r in packing.sliding_blocks(wo, tot, 4, 2).orderBy("window").collect()]
    assert got == [[0, 1, 2, 3], [2, 3, 4, 5], [4, 5, 6, 7], [6, 7, 8, 9]]


def test_exactly_two_batches(spark):
    wo, tot = _prep(spark, (8,))
    assert len(_steps(packing.pack_wrap(wo, tot, 2, BLOCK, BATCH))) == 2


def test_shorter_than_one_batch_is_an_error(spark):
    wo, tot = _prep(spark, (3,))
    with pytest.raises(Exception, match="shorter than one batch"):
        packing.pack_wrap(wo, tot, 2, BLOCK, BATCH).collect()


@pytest.mark.parametrize("tokens,steps", [(10, 5), (8, 7), (4, 3), (37, 30)])
def test_wrap_and_carry_equal_plain_python(spark, tokens, steps):
    lens = [tokens // 3, tokens // 3, tokens - 2 * (tokens // 3)]
    wo, tot = _prep(spark, lens)
    stream = list(range(tokens))
    n_full = tokens // 4
    wrap = [stream[(k % n_full) * 4:(k % n_full) * 4 + 4] for k in range(steps)]
    carry = [[stream[(k * 4 + j) % tokens] for j in range(4)] for k in range(steps)]
    assert _steps(packing.pack_wrap(wo, tot, steps, BLOCK, BATCH)) == wrap
    assert _steps(packing.pack_carry(wo, tot, steps, BLOCK, BATCH)) == carry


def test_blocks_are_stream_prefix_and_full(spark):
    lens = (5, 7, 0, 1, 9, 2)
    wo, tot = _prep(spark, lens)
    blocks = packing.pack_blocks(wo, 3, 2).orderBy("block").collect()
    flat = [t for b in blocks for t in b.x]
    assert flat == list(range(sum(lens)))
    assert all(len(b.x) == 3 for b in blocks[:-1])


def test_training_pairs_shift(spark):
    wo, tot = _prep(spark, (6, 5))
    rows = packing.training_pairs(wo, tot, shift=1, block=4, batch=1).orderBy("step").collect()
    assert [(r.x, r.y) for r in rows] == [([0, 1, 2, 3], [1, 2, 3, 4]), ([4, 5, 6, 7], [5, 6, 7, 8])]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_independent_of_shuffle_partitions(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        wo, tot = _prep(spark, (5, 7, 0, 1, 9, 2))
        got = _steps(packing.pack_carry(wo, tot, 9, BLOCK, BATCH))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    stream = list(range(24))
    assert got == [[stream[(k * 4 + j) % 24] for j in range(4)] for k in range(9)]


def test_tail_ids(spark):
    df = spark.createDataFrame([([],), ([1, 2, 3],)], "ids array<int>")
    got = [r.t for r in df.select(packing.tail_ids("ids", 2).alias("t")).collect()]
    assert got == [[], [2, 3]]


def test_hashed_ids_and_no_exchange_of_arrays(spark):
    """Sparse keys are packed alike, and encoding an ordered corpus moves no id array."""
    keys = [(i * 2_654_435_761) % 2 ** 40 for i in range(200)]
    df = spark.createDataFrame([(k, [k % 7] * (k % 5)) for k in keys], "doc_id bigint, ids array<int>")
    wo = packing.with_offsets(df.repartition(7))
    want, at = {}, 0
    for k in sorted(keys):
        want[k] = at
        at += k % 5
    assert {r.doc_id: r.offset for r in wo.collect()} == want

    from spindle.operators import codec
    from spindle.sources import corpus
    docs = corpus.read_corpus(spark, "/root/testdata/sf0.001/documents.parquet", ordered=True)
    v = codec.build_vocab(codec.explode_pretokens(docs), 100)
    from spindle.session import written
    enc = codec.encode(docs, codec.Vocab(written(v.df, "vocab"), v.size)).sortWithinPartitions("doc_id")
    plan = enc._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange rangepartitioning" in line or "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "rangepartitioning(doc_id" in moved[0], plan
    placed = packing.with_offsets(codec.encode(docs, codec.Vocab(written(v.df, "vocab"), v.size)), ordered=True)
    before = 0
    for r in placed.orderBy("doc_id").collect():
        assert r.offset == before
        before += len(r.ids)


def test_rows_out_of_range_order_are_an_error(spark):
    df = spark.createDataFrame([(i, [i]) for i in range(40)], "doc_id bigint, ids array<int>").repartition(4, "doc_id")
    with pytest.raises(ValueError, match="ranges"):
        packing.with_offsets(df, ordered=True)


def test_training_pairs_same(spark):
    wo, tot = _prep(spark, (6, 5))
    rows = packing.training_pairs(wo, tot, shift=0, block=4, batch=1).orderBy("step").collect()
    assert [(r.x, r.y) for r in rows] == [([0, 1, 2, 3], [0, 1, 2, 3]), ([4, 5, 6, 7], [4, 5, 6, 7])]
