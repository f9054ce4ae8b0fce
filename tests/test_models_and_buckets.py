"""Batched model masks; facts in buckets."""

import os

import numpy as np
from pyspark.sql import functions as F

from tessera import questions as Q
from tessera.operators.bucketing import bucket_count
from tessera.operators.frames import masked_replace, with_batched_mask
from tessera.plans import orders as O
from tessera.sources import tables as T

from .conftest import SMOKE_DIR


def recording_model(folder):
    def make():
        open(f"{folder}/load-{os.getpid()}-{os.urandom(4).hex()}", "w").close()

        def model(stack):
            open(f"{folder}/call-{len(stack)}-{os.urandom(6).hex()}", "w").close()
            if (stack[:, 0] == 13).any():
                raise ValueError("unlucky frame")
            return stack / 100.0

        return model

    return make


def test_model_is_loaded_once_a_worker_and_called_on_stacks(spark, scratch):
    rows = [(i, [float(i % 50)] * (4 if i % 3 else 7)) for i in range(400)] + [(900, None), (901, [])]
    df = spark.createDataFrame(rows, "frame_id int, pixels array<double>").repartition(3)
    out = masked_replace(with_batched_mask(df, "pixels", recording_model(scratch), frames_per_call=16), "pixels", "mask")
    got = {r.frame_id: (r.pixels, r.replaced) for r in out.collect()}
    for i, px in rows:
        if px and px[0] != 13:
            assert got[i] == ([192.0 if p > 20 else p for p in px], True)
        elif px:  # the failing frames stay, the others of their calls do not suffer
            assert got[i] == (px, False)
    assert got[900] == (None, False)
    names = os.listdir(scratch)
    loads = [n for n in names if n.startswith("load-")]
    assert len(loads) == len({n.split("-")[1] for n in loads}) <= 4
    stacks = [int(n.split("-")[1]) for n in names if n.startswith("call-")]
    single = sum(s == 1 for s in stacks)
    assert max(stacks) == 16 and len(stacks) - single < 400 / 8


def test_bucketed_facts_join_without_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, orders = O.bucketed_facts(spark, SMOKE_DIR)
        joined = items.join(Q.orders_in_year(orders, T.TARGET_YEAR).select("order_id"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        for counted in (joined.groupBy("order_id").count(),):  # nor does an aggregate on the key
            assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        answers = [sorted(map(str, Q.category_revenue(i, o, T.products(spark, SMOKE_DIR), T.TARGET_YEAR, T.MONEY_SCALE).collect()))
                   for i, o in ((items, orders), (T.order_items(spark, SMOKE_DIR), T.orders(spark, SMOKE_DIR)))]
        assert answers[0] == answers[1] and answers[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucket_counts():
    assert bucket_count(0, 1) == 1 and bucket_count(0, 6) == 8 and bucket_count(100 << 40, 8) == 1 << 19


def test_masks_are_numpy_rows(spark):
    df = spark.createDataFrame([(1, [0.5, -0.5])], "frame_id int, pixels array<float>")
    got = with_batched_mask(df, "pixels", lambda: (lambda s: np.abs(s).astype(float))).select(F.col("mask")).first()[0]
    assert got == [0.5, 0.5]
