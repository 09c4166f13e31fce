"""Documents joined to labels and events by id: the same rows on every path, and no exchange of texts."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newslab.operators import prepare as P
from newslab.plans import context as C
from newslab.plans.queries import REGISTRY
from newslab.sources import by_id, stored
from newslab.sources.views import news_raw
from tests.conftest import SF001, SF01


def tables(spark, path):
    """Ids without label or event, labels and events without a document, repeated ids on each side, null ids."""
    docs = [(i, f"text number {i} of the set", "en", f"s{i % 3}", 9) for i in range(40)]
    docs += [(7, f"copy {k} of a hot id", "en", "s0", 9) for k in range(30)] + [(None, f"no id {k}", None, None, None) for k in range(5)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 50, 2)] + [(7, 1, 0), (9, 1, 0), (9, 0, 1), (None, 1, 1), (11, None, None)]
    events = [(i, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(0, 60, 3)] + [(9, datetime(2024, 2, 2)), (None, datetime(2024, 3, 3)), (12, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz").write.parquet(f"{path}/events.parquet")


def plain(spark, d, labelled_only, dated):
    docs, labels, events = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels", "events"))
    labels = labels.select("doc_id", by_id.base_label(F.col("toxic"), F.col("quality")).alias("lbl"))
    out = docs.select("doc_id", "text", "source").join(labels, "doc_id", "inner" if labelled_only else "left")
    if dated:
        out = out.join(events.select(F.col("event_id").alias("doc_id"), F.col("ts").alias("created_at")), "doc_id", "left")
    return out


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("labelled_only", [True, False])
@pytest.mark.parametrize("dated", [True, False])
@pytest.mark.parametrize("broadcast,hot,files", [(1_000_000, 200_000, 20_000), (0, 200_000, 20_000), (0, 20, 20_000), (0, 20, 0)])
def test_every_path_gives_the_plain_join(spark, tmp_path, monkeypatch, labelled_only, dated, broadcast, hot, files):
    tables(spark, tmp_path)
    for name, value in (("BROADCAST_ROWS", broadcast), ("HOT_ROWS", hot), ("MOST_FILES", files)):
        monkeypatch.setattr(by_id, name, value)
    got = by_id.documents_with_attributes(spark, str(tmp_path), ["doc_id", "text", "source"], labelled_only, dated)
    assert rows(got) == rows(plain(spark, tmp_path, labelled_only, dated))


def test_hot_and_missing_ids_stay_out_of_the_buckets(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    monkeypatch.setattr(by_id, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(by_id, "HOT_ROWS", 20)
    before = {t.name for t in spark.catalog.listTables()}
    news_raw(spark, str(tmp_path)).count()
    made = [t.name for t in spark.catalog.listTables() if t.name not in before and "documents" in t.name]
    ids = {r.doc_id for r in spark.table(made[0]).select("doc_id").collect()}
    assert ids == set(range(40)) - {7}


def exchanged(df) -> list[str]:
    """Output columns of every exchange in the plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    nodes = text.split("\n\n")
    return [n for n in nodes if "Exchange" in n.split("\n")[0] and n.startswith("(")]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_no_exchange_carries_text(spark, monkeypatch, limit):
    monkeypatch.setattr(by_id, "BROADCAST_ROWS", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (news_raw(spark, SF01), news_raw(spark, SF01, labelled_only=True, dated=False), P.news(spark, SF01)):
            assert not [n for n in exchanged(df) if "text" in n or "judul" in n], limit
        if limit == 0:
            plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
            assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2 and "Exchange" not in plan
        for key in ("stratified_split", "stratified_subset", "weighted_metrics"):
            assert not [n for n in exchanged(REGISTRY[key](spark, SF01)) if "clean_text" in n or " text" in n], key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_text_is_cleaned_once(spark):
    df = P.news(spark, SF001)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert plan.count("www") == 1


def test_stored_tables_follow_the_input(spark, tmp_path):
    tables(spark, tmp_path)
    d = str(tmp_path)
    assert news_raw(spark, d, dated=False).count() == 76
    assert stored.key(spark, d, "x") == stored.key(spark, d, "x") != stored.key(spark, d, "y")
    assert C.news(spark, d).count() == C.news(spark, d).count() > 0
