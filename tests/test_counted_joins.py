"""Joins with tables that look small by the bytes of their files: broadcast by counted rows only."""

import re

import pytest
from pyspark.sql import functions as F

from checks.inputs import legacy, scratch
from checks.queries import AS_OF, broken_text, empty_target, loaded
from padron.operators import identifiers, skew
from padron.plans import migration, stream
from tests.conftest import SF


@pytest.fixture
def low(monkeypatch):
    """A bound that every table of these tests exceeds."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 10, raising=False)


def broadcast_joins(frame):
    """The joins that Spark plans to broadcast for, by its estimates, of tables without a fixed bound."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"BroadcastHashJoin .*(?:LeftSemi|LeftAnti).*", plan)


def content(frame):
    return sorted(map(str, frame.collect()))


def test_loaded_rows_are_found_without_broadcast(spark, low):
    rows, target = legacy(spark, SF), loaded(spark, SF)
    run = migration.plan(rows, empty_target(spark), AS_OF, scratch(spark))
    found = migration.loaded(run, target)
    assert found.count() == target.count()
    assert not broadcast_joins(found)
    waiting = migration.pending(rows, target)
    assert waiting.count() == rows.count() - target.count()
    assert not broadcast_joins(waiting)


def test_stored_identifiers_are_met_without_broadcast(spark, low):
    rows = migration.transform(legacy(spark, SF), AS_OF)
    found = identifiers.load_conflicts(rows, loaded(spark, SF))
    assert not broadcast_joins(found)
    assert found.where("en_destino").select("id").distinct().count() > loaded(spark, SF).count() / 2


def test_small_tables_are_broadcast(spark):
    """Also those that the estimates take for large."""
    rows, target = legacy(spark, SF), loaded(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcast_joins(migration.pending(rows, target))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refresh_without_broadcast(spark, monkeypatch):
    rows = legacy(spark, SF).where("id < 600")
    first, _ = stream.refresh(rows, empty_target(spark), AS_OF, scratch(spark), None)
    first = scratch(spark).settle(first, "first")
    since = rows.agg(F.max("update_at")).first()[0]
    newer = rows.where("id % 6 = 1").withColumns({"nombre": F.lit("Nueva"), "update_at": F.lit(since) + F.expr("INTERVAL 1 HOUR")})
    feed = rows.unionByName(newer)
    want = content(stream.refresh(feed, first, AS_OF, scratch(spark), since)[0])
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 10, raising=False)
    second, _ = stream.refresh(feed, first, AS_OF, scratch(spark), since)
    # No id is repeated in it: that table is empty and may be broadcast.
    assert not [join for join in broadcast_joins(second) if "_fila" not in join]
    assert not broadcast_joins(stream.latest_versions(feed))
    assert content(second) == want


def test_broken_rows_leave_without_broadcast(spark, monkeypatch):
    """Rows that repeat an id and rows refused, more of them than may be broadcast."""
    raw = broken_text(spark, SF)
    usual = migration.plan(raw, empty_target(spark), AS_OF, scratch(spark))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 10, raising=False)
    run = migration.plan(raw, empty_target(spark), AS_OF, scratch(spark))
    typed = run.source.where("_error IS NULL").drop("_error")
    assert not broadcast_joins(migration.repeated_ids(typed))
    assert not broadcast_joins(run.loadable)
    assert run.repeats.count() == usual.repeats.count() > 10
    assert content(run.rejects) == content(usual.rejects)
    assert content(run.loadable) == content(usual.loadable)
