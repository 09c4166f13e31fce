"""Scheduled ingest and daily counts: first arrivals, restarts, evicted state, late rows, bounded state."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from newslab.operators import ingest as I
from newslab.plans import context as C
from newslab.session import scratch_path
from newslab.sources.tables import read_table
from newslab.streaming import jobs
from tests.conftest import SF01

HEADS = "page_id long, pos int, title string, url string, at timestamp, day date, score double"


def paths(spark, name):
    return tuple(scratch_path(spark, f"{name}-{k}") for k in ("land", "store", "ckpt"))


def land(spark, landing, k, rows, schema=HEADS):
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{landing}/drop={k:05d}")
    return df.schema


def head(page, pos, title, n=0):
    from datetime import date, datetime

    return (page, pos, title, f"u{page}/{pos}/{n}", datetime(2024, 1, 1, 2, 3, 4, 567891 + n), date(2024, 5, 6), n / 3)


def first_arrivals(drops):
    best = {}
    for k, rows in enumerate(drops):
        for r in rows:
            at = (k, r[0] is not None, r[0] or 0, r[1], r[3])
            if r[2] not in best or at < best[r[2]][0]:
                best[r[2]] = (at, r)
    return sorted((r for _, r in best.values()), key=repr)


DROPS = [[head(5, 1, "a"), head(3, 2, "a"), head(3, 1, "b"), head(None, 0, "c"), head(2, 0, None), head(9, 0, 'quote " and \n line {x}')],
         [head(1, 0, "a"), head(-7, 0, "d"), head(7, 0, "d"), head(None, 3, "d"), head(4, 0, "c", 1), head(1, 1, None)],
         [head(0, 0, "b"), head(8, 10, "e"), head(8, 9, "e"), head(2**62, 0, "f"), head(8, 9, "e", 1)]]


@pytest.mark.parametrize("retention,files", [(30.0, None), (0.0, None), (30.0, 1)])
def test_first_arrival_wins(spark, retention, files):
    """Whatever the state has let go (a retention of 0 keeps nothing) is found in the store."""
    landing, store, ckpt = paths(spark, "first")
    for k, rows in enumerate(DROPS):
        schema = land(spark, landing, k, spark.createDataFrame(rows, HEADS).coalesce(1).collect() if files else rows)
        jobs.ingest_dedup_stream(spark, landing, schema, store, ckpt, buckets=4, order=("page_id", "pos", "url"), retention_days=retention,
                                 partitions=3)
    got = spark.read.parquet(store).select(*schema.names).collect()
    if not files:  # a drop in several micro-batches has an earlier arrival per file, so only titles are fixed then
        assert sorted(map(tuple, got), key=repr) == first_arrivals(DROPS)
    assert Counter(r.title for r in got) == Counter({r[2] for d in DROPS for r in d})


def test_restarts_and_catching_up(spark):
    """Runs after every drop, a run without news, and one run over all drops keep the same titles; a replay changes nothing."""
    landing, store, ckpt = paths(spark, "again")
    for k, rows in enumerate(DROPS):
        schema = land(spark, landing, k, rows)
        for _ in range(2):
            jobs.ingest_dedup_stream(spark, landing, schema, store, ckpt, buckets=2, order=("page_id", "pos", "url"), partitions=2)
    each = sorted(map(tuple, spark.read.parquet(store).select(*schema.names).collect()), key=repr)
    assert each == first_arrivals(DROPS)
    late_store, late_ckpt = scratch_path(spark, "late-store"), scratch_path(spark, "late-ckpt")
    jobs.ingest_dedup_stream(spark, landing, schema, late_store, late_ckpt, buckets=2, order=("page_id", "pos", "url"), partitions=2)
    at_once = sorted(map(tuple, spark.read.parquet(late_store).select(*schema.names).collect()), key=repr)
    assert at_once == first_arrivals([[r for d in DROPS for r in d]])


def test_hot_title_is_thinned_before_the_shuffle(spark):
    import pandas as pd

    parts = [pd.DataFrame({"title": ["x"] * 50 + [None], "packed": [f"{i:03d}" for i in range(51)], "arrived": pd.Timestamp("2024-01-01")})] * 3
    out = list(jobs._least(iter(parts)))
    assert [len(p) for p in out] == [2, 2, 2] and out[0]["packed"].tolist()[0] == "000"


def test_headlines_equal_batch_on_the_supplied_pages(spark):
    pages = read_table(spark, SF01, "pages").select("page_id", "url", "html")
    rows = I.headlines_from_pages(pages, C.HEADLINE_RULES, C.MIN_TITLE)
    rows = rows.withColumn("page_id", F.when(F.col("page_id") != 17, F.col("page_id")))  # a null order value must land too
    landing, store, ckpt = paths(spark, "pages")
    jobs.land_in_batches(rows, landing, "page_id", 3, after_each=lambda k: jobs.ingest_dedup_stream(
        spark, landing, rows.schema, store, ckpt, buckets=4, order=("page_id", "pos"), partitions=4))
    got = spark.read.parquet(store).select(*rows.columns).collect()
    assert Counter(got) == Counter(I.dedup_titles(rows).collect())


DAYS = [["2024-01-01 10:00", "2024-01-01 23:59", "2024-01-02 00:00"], ["2024-03-01 05:00", None],
        ["2024-01-01 12:00", "2024-02-01 00:00", "2024-03-01 07:00", "2024-02-29 23:00"], ["2023-12-31 00:00", "2024-03-05 00:00"], [],
        ["2024-03-01 01:00", "2024-01-01 00:00", "2024-03-05 08:00"]]


def day_rows(days):
    return [(d, s) for d in days for s in ("netral", "positif")]


@pytest.mark.parametrize("restart", [False, True])
def test_days_are_counted_however_late(spark, restart):
    landing, out, ckpt = paths(spark, "days")
    for k, days in enumerate(DAYS):
        df = spark.createDataFrame(day_rows(days), "d string, sentiment string").select(F.to_timestamp("d").alias("event_time"), "sentiment")
        df.write.parquet(f"{landing}/drop={k}")
        for _ in range(2 if restart else 1):
            progress = jobs.daily_sentiment_stream(spark, landing, df.schema, out, ckpt, partitions=2)
            state = progress.stateOperators[0].numRowsTotal if progress and progress.stateOperators else state
        want = Counter((d[:10], s) for drop in DAYS[:k + 1] for d, s in day_rows(drop) if d)
        assert {(r.day, r.sentiment): r.n for r in jobs.daily_counts(spark, out).collect()} == want
    assert state <= 12  # windows from the last day and a day of lateness, not all days seen


def test_late_rows_are_marked_not_dropped(spark):
    landing, out, ckpt = paths(spark, "marked")
    for k, days in enumerate([["2024-05-01 00:00"], ["2024-01-01 00:00"]]):
        df = spark.createDataFrame(day_rows(days), "d string, sentiment string").select(F.to_timestamp("d").alias("event_time"), "sentiment")
        df.write.parquet(f"{landing}/drop={k}")
        progress = jobs.daily_sentiment_stream(spark, landing, df.schema, out, ckpt, partitions=2)
    assert progress.stateOperators[0].numRowsDroppedByWatermark == 0
    late = spark.read.parquet(out).filter("date_format(window_start, 'yyyy-MM-dd') <> day").collect()
    assert {(r.day, r.n) for r in late} == {("2024-01-01", 1)}
