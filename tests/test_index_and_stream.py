"""The stored index of identifiers, the migration as a stream, and the refresh of changed rows."""

import shutil
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from checks.inputs import legacy, scratch
from checks.queries import AS_OF, loaded
from padron import model
from padron.operators import identifiers
from padron.operators.keyindex import build_index
from padron.plans import migration, stream
from padron.sources import tables
from tests.conftest import SF


def index_name():
    return f"claves_{uuid.uuid4().hex}"


def changed(rows):
    """Rows after changes: other values, values handed on, none at all."""
    return rows.withColumns({
        "pasaporte": F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 5 == 1, F.concat(F.lit("Z"), F.col("id"))).otherwise(F.col("pasaporte")),
        "cui": F.when(F.col("id") % 4 == 1, F.col("cui") + 1).otherwise(F.col("cui")),
    })


def test_index_answers_as_the_rows_do(spark):
    """After a load, an update and a removal, and a repeated turn: the same as a scan of the rows."""
    first = loaded(spark, SF).where("id < 900")
    index = build_index(first, index_name(), buckets=4)
    more = loaded(spark, SF).where("id BETWEEN 900 AND 1100")
    index.add(more, 1)
    old = first.where("id % 3 = 0")
    for _ in range(2):
        index.change(old, changed(old), 2)
    index.remove(first.where("id % 10 = 7"), 3)
    back = first.where("id = 17")
    index.add(back, 4)
    rows = (
        first.where("id % 3 <> 0 AND (id % 10 <> 7 OR id = 17)")
        .unionByName(changed(old).where("id % 10 <> 7"))
        .unionByName(more)
    )
    asked = loaded(spark, SF).withColumn("own", F.when(F.col("id") % 2 == 0, F.col("id")))
    for name in (index, index.compact(index_name())):
        for take in (
            lambda s: identifiers.identifiers_available(asked, s, "id", "own"),
            lambda s: identifiers.identifier_exists(asked, s),
        ):
            assert set(take(name).collect()) == set(take(rows).collect())
        assert set(name.violations().collect()) == set(identifiers.unique_violations(rows).collect())


def test_no_exchange_above_the_index(spark):
    index = build_index(loaded(spark, SF), index_name(), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = identifiers.identifier_rows(loaded(spark, SF).where("id < 50")).select(*identifiers.KEY).distinct()
        frame = index.held(asked)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0].splitlines()
    scan = next(i for i, line in enumerate(final) if "Scan parquet" in line and index.name in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*"))
    level, above = depth(final[scan]), []
    for line in reversed(final[:scan]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    assert "SortMergeJoin" in plan and not any("Exchange" in line for line in above)


def write_files(rows, folder, parts):
    for k, part in enumerate(parts):
        rows.where(part).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def content(frame):
    return set(frame.select("id", "expediente", "cui", "pasaporte", F.to_json("nombre").alias("n"), "estado").collect())


def test_stream_killed_between_append_and_commit(spark, tmp_path, monkeypatch):
    rows = legacy(spark, SF)
    source = write_files(rows, tmp_path / "in", ["id < 500", "id >= 500"])
    empty = spark.createDataFrame([], model.TARGET_SCHEMA)
    target, whole = str(tmp_path / "target"), str(tmp_path / "whole")
    for place in (target, whole):
        tables.append_target(empty, place)
    counters = migration.run(rows, tables.scan_target(spark, whole), whole, str(tmp_path / "log"), AS_OF).first()
    where = (source, target, str(tmp_path / "logs"), str(tmp_path / "checkpoint"))
    with monkeypatch.context() as broken:
        def dies(*_):
            raise OSError("killed")
        broken.setattr(migration, "gate_report", dies)
        with pytest.raises(Exception, match="killed"):
            stream.load_stream(spark, *where, AS_OF)
    assert tables.scan_target(spark, target).count() == counters["total_exitosos"]
    done = stream.load_stream(spark, *where, AS_OF).collect()
    assert len(done) == 1 and tuple(done[0])[1:] == tuple(counters)
    assert content(tables.scan_target(spark, target)) == content(tables.scan_target(spark, whole))
    # Nothing new: no batch. A file more: only that.
    assert stream.load_stream(spark, *where, AS_OF).count() == 1
    late = rows.limit(1).withColumns({"id": F.lit(99_999), "expediente": F.lit(77_777_777), "dpi": F.lit(None).cast("long"), "pasaporte": F.lit("LATE1")})
    late.select(*rows.columns).coalesce(1).write.mode("append").parquet(source)
    assert {r.lote: r.total_procesados for r in stream.load_stream(spark, *where, AS_OF).collect()} == {0: counters["total_procesados"], 1: 1}
    assert tables.scan_target(spark, target).count() == counters["total_exitosos"] + 1
    shutil.rmtree(tmp_path / "in")


def test_refresh_equals_a_fresh_load(spark, tmp_path):
    rows = legacy(spark, SF).where("id < 400").cache()
    empty = spark.createDataFrame([], model.TARGET_SCHEMA)
    mark = str(tmp_path / "mark")
    assert stream.watermark(spark, mark) is None
    first, run = stream.refresh(rows, empty, AS_OF, scratch(spark), stream.watermark(spark, mark))
    first = scratch(spark).settle(first, "first")
    stream.store_watermark(rows, mark)
    assert content(first) == content(migration.plan(rows, empty, AS_OF, scratch(spark)).loadable)
    later = stream.watermark(spark, mark) + timedelta(days=1)
    versions = rows.where("id % 6 = 1").withColumns({"nombre": F.lit("Nueva"), "update_at": F.lit(later)})
    older = versions.withColumns({"nombre": F.lit("Vieja"), "update_at": F.lit(later - timedelta(hours=1))})
    feed = rows.unionByName(older).unionByName(versions).unionByName(rows.where("id = 7").withColumn("id", F.lit(5000)).withColumn("expediente", F.lit(654321)).withColumn("dpi", F.lit(None).cast("long")).withColumn("pasaporte", F.lit(None).cast("string")))
    second, run = stream.refresh(feed, first, AS_OF, scratch(spark), stream.watermark(spark, mark))
    fresh = migration.plan(stream.latest_versions(feed), empty, AS_OF, scratch(spark)).loadable
    origin = lambda f: set(f.select(F.col("metadatos.id_origen").alias("o"), "expediente", "cui", "pasaporte", F.to_json("nombre").alias("n")).collect())
    assert origin(second) == origin(fresh)
    kept = {r.o: r.id for r in first.select(F.col("metadatos.id_origen").alias("o"), "id").collect()}
    assert all(kept.get(r.o, r.id) == r.id for r in second.select(F.col("metadatos.id_origen").alias("o"), "id").collect())
    assert second.select("id").distinct().count() == second.count()
    assert run.source.count() < feed.count() / 2
    rows.unpersist()
