"""Table operators: skewed keys, deep slices, loading twice, snapshots, plans."""

import os
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.inputs import scratch
from checks.queries import QUERIES, empty_target
from padron import model
from padron.functions.asof import AsOf
from padron.operators import identifiers, lookup, paging, quality, requests, skew
from padron.plans import maintenance, migration
from padron.sources import jdbc, tables
from tests.conftest import SF

AS_OF = AsOf.at("2024-06-30")


# --------------------------------------------------------------------------- skew


@pytest.fixture(params=[1000, 2])
def heavy_keys(request, monkeypatch):
    """Run with the usual bound and with one so low that most keys take the shuffled way."""
    monkeypatch.setattr(skew, "HEAVY_KEYS", request.param)


def skewed(n=3000, seed=5):
    """Keys of which the first holds a third of all rows."""
    rng = random.Random(seed)
    return [0 if i % 3 == 0 else rng.randint(1, n // 2) for i in range(n)]


def people(spark, rows):
    """id, expediente, cui, pasaporte."""
    return spark.createDataFrame(rows, "id long, expediente string, cui long, pasaporte string")


def test_lookup_join(spark, heavy_keys):
    keys = skewed()
    rows = spark.createDataFrame(list(enumerate(keys)), "fila int, clave int")
    table = rows.where("clave % 5 <> 3").groupBy("clave").agg(F.count("*").alias("n"))
    got = skew.lookup_join(rows, table, ["clave"], "n").collect()
    sizes = Counter(keys)
    assert sorted((r["fila"], r["clave"], r["n"]) for r in got) == sorted(
        (i, k, sizes[k]) for i, k in enumerate(keys) if k % 5 != 3
    )


def brute_violations(rows):
    first, out = {}, set()
    for row_id, *ids in sorted(rows):
        for field, value in zip(model.IDENTIFIERS, ids):
            if value is not None and first.setdefault((field, value), row_id) != row_id:
                out.add((row_id, field))
    return out


def test_unique_violations_with_hot_key(spark, heavy_keys):
    cuis = skewed()
    rows = [(i, str(i % 2900), c or 1000000000009, None if i % 4 else "") for i, c in enumerate(cuis)]
    got = identifiers.unique_violations(people(spark, rows))
    assert {(r["id"], r["campo"]) for r in got.collect()} == brute_violations(rows)


def test_load_conflicts_against_stored(spark, heavy_keys):
    rng = random.Random(9)
    new = [(i, str(rng.randint(0, 900)), rng.choice([None, 7, i]), None) for i in range(900)]
    old = [(i, str(i * 3), 7 if i == 5 else None, None) for i in range(100)]
    taken = {("expediente", r[1]) for r in old} | {("cui", 7)}
    got = identifiers.load_conflicts(people(spark, new), people(spark, old))
    want = brute_violations(new) | {
        (r[0], f) for r in new for f, v in (("expediente", r[1]), ("cui", r[2])) if (f, v) in taken
    }
    assert {(r["id"], r["campo"]) for r in got.collect()} == want


def test_availability(spark, heavy_keys):
    stored = [(1, "a", 10, None), (2, "b", 11, "P"), (3, "c", 10, "P"), (4, "", None, "")]
    asks = [(1, "a", 10, None, 1), (2, "b", None, "P", 2), (3, "z", 99, "Q", None),
            (4, "", 0, "", 4), (5, "a", 11, None, 0)]
    ask = spark.createDataFrame(asks, "id long, expediente string, cui long, pasaporte string, own long")
    got = identifiers.identifiers_available(ask, people(spark, stored), "id", "own").collect()
    assert {tuple(r) for r in got} == {
        (1, True, False, True),
        (2, True, True, False),
        (3, True, True, True),
        (4, True, True, True),
        (5, False, False, True),
    }
    exists = identifiers.identifier_exists(ask, people(spark, stored)).collect()
    assert {r["id"]: r["existe"] for r in exists} == {1: True, 2: True, 3: False, 4: False, 5: True}


def test_references_with_hot_missing_value(spark, heavy_keys):
    rng = random.Random(2)
    rows = [
        (i, 1000 + i if i % 7 else None, 888 if i % 3 == 0 else rng.randint(990, 2500),
         rng.choice([None, 0, 1005, 777]))
        for i in range(1500)
    ]
    frame = spark.createDataFrame(rows, "id int, expediente int, exp_madre int, exp_ref int")
    known = {r[1] for r in rows}
    got = quality.referential_integrity(frame).collect()
    want = [(i, "exp_madre", m) for i, _, m, _ in rows if m and m not in known]
    want += [(i, "exp_ref", x) for i, _, _, x in rows if x and x not in known]
    assert sorted((r["id"], r["campo"], r["valor"]) for r in got) == sorted(want)


def test_dense_index_over_sparse_keys(spark):
    rng = random.Random(4)
    keys = {rng.choice([rng.randint(-(2**62), 2**62), rng.randint(0, 200_000)]) for _ in range(4000)}
    frame = spark.createDataFrame([(k,) for k in keys], "id long")
    got = skew.dense_index(frame, "id", "n").collect()
    assert {r["id"]: r["n"] for r in got} == {k: i for i, k in enumerate(sorted(keys))}


# --------------------------------------------------------------------------- paging


def test_slices_at_any_depth(spark):
    rng = random.Random(8)
    keys = sorted(rng.sample(range(-500_000, 500_000), 3000))
    frame = spark.createDataFrame([(k,) for k in [*keys, None]], "id int").repartition(5)
    for offset, limit in ((0, 5), (2990, 100), (1234, 700), (5000, 10)):
        got = paging.slice_rows(frame, offset, limit, position="n").collect()
        assert [r["id"] for r in got] == keys[offset : offset + limit]
        assert [r["n"] for r in got] == list(range(offset, min(offset + limit, 3000)))
    assert [r["id"] for r in paging.slice_after(frame, keys[9], 3).collect()] == keys[10:13]
    with pytest.raises(ValueError):
        paging.slice_rows(frame.select(F.col("id").cast("string")), 0, 5)


def test_pages_read_their_range_of_ids(spark, tmp_path):
    spark.range(0, 400_000).repartitionByRange(4, "id").write.parquet(str(tmp_path / "t"))
    page = paging.slice_rows(spark.read.parquet(str(tmp_path / "t")), 300_000, 10)
    assert [r["id"] for r in page.collect()] == list(range(300_000, 300_010))
    plan = page._jdf.queryExecution().executedPlan().toString()
    # The scan's own filters compare the id with the two bounds, which are known when it starts.
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "subquery" in x.lower())
    assert "DataFilters: [isnotnull(id" in scan and "shiftleft" not in scan
    assert 0 < min(m["v"] for m in scanned(page)) <= 100_000


def scanned(frame) -> list[dict]:
    """Rows that each scan of an executed frame gave."""
    out = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet"):
            out.append({"v": node.metrics().get("numOutputRows").get().value()})
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return visit(node.plan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return out


def test_page_requests():
    assert paging.PageRequest(3, 25).skip == 50
    for page, size in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            paging.PageRequest(page, size)


def test_page_of_five(spark):
    frame = spark.range(5)
    rows = paging.paginate(frame, paging.PageRequest(1, 3)).collect()
    assert [(r["id"], r["total"], r["total_pages"]) for r in rows] == [(i, 5, 2) for i in range(3)]


def test_empty_search_keeps_everything(spark):
    assert lookup.search(spark.range(4), lookup.SearchParams()).count() == 4


# --------------------------------------------------------------------------- migration


def test_runs_add_up_and_repeat_nothing(spark, tmp_path):
    from checks.inputs import legacy

    rows = legacy(spark, SF)
    path = str(tmp_path / "target")
    tables.append_target(empty_target(spark), path)
    seen = []
    for i in range(2):
        stats = migration.run(rows, tables.scan_target(spark, path), path,
                              str(tmp_path / f"log{i}"), AS_OF).first()
        assert stats["total_exitosos"] + stats["total_errores"] == stats["total_procesados"]
        seen.append(stats)
    loaded = tables.scan_target(spark, path)
    assert loaded.count() == seen[0]["total_exitosos"] and seen[1]["total_exitosos"] == 0
    assert seen[1]["total_procesados"] == seen[0]["total_errores"]
    assert loaded.select("id").distinct().count() == loaded.count()
    flags = spark.read.parquet(str(tmp_path / "log0" / "flags"))
    origin = spark.read.parquet(str(tmp_path / "log0" / "origin")).first()
    assert flags.count() == origin["filas_con_problemas"] > 0
    assert identifiers.unique_violations(loaded).count() == 0


def test_bad_values_are_reported_not_lost(spark):
    from checks.inputs import legacy

    rows = legacy(spark, SF)
    raw = rows.select(*[
        (F.when(F.col("id") == 5, F.lit("x")).otherwise(F.col(c).cast("string")) if c == "dpi"
         else F.col(c).cast("string")).alias(c)
        for c in rows.columns
    ])
    run = migration.plan(raw, empty_target(spark), AS_OF, scratch(spark))
    assert [tuple(r)[:3] for r in run.failures.collect()] == [(5, 100004, "dpi: x no es bigint")]
    stats = migration.migration_stats(run).first()
    assert stats["total_exitosos"] == run.loadable.count()


def test_failed_append_can_be_repeated(spark, tmp_path, monkeypatch):
    """Nothing is logged as loaded, no work is left behind, and the same paths work again."""
    from checks.inputs import legacy

    rows, path, log = legacy(spark, SF), str(tmp_path / "target"), str(tmp_path / "log")
    tables.append_target(empty_target(spark), path)
    before = set(os.listdir(shared(spark)))

    def fails(*_):
        raise OSError("disk full")

    with monkeypatch.context() as broken:
        broken.setattr(migration, "append_target", fails)
        with pytest.raises(OSError):
            migration.run(rows, tables.scan_target(spark, path), path, log, AS_OF)
    assert not os.path.exists(log) and set(os.listdir(shared(spark))) == before
    for _ in range(2):
        stats = migration.run(rows, tables.scan_target(spark, path), path, log, AS_OF).first()
    assert stats["total_exitosos"] == 0
    assert tables.scan_target(spark, path).count() == 1500 - stats["total_errores"]
    assert set(os.listdir(shared(spark))) == before


def test_source_is_read_once(spark, tmp_path):
    """Later steps of a run read the written rows, not the source."""
    from checks.inputs import legacy

    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rows = legacy(spark, SF)
    source = rows.mapInArrow(counted, rows.schema)
    path = str(tmp_path / "target")
    tables.append_target(empty_target(spark), path)
    migration.run(source, tables.scan_target(spark, path), path, str(tmp_path / "log"), AS_OF)
    assert reads.value == 1500


def test_the_clock_is_read_once(spark):
    moment = AsOf().pinned(spark)
    assert moment.moment is not None and moment.pinned(spark) is moment


def test_dense_ids_follow_the_highest(spark):
    target = spark.createDataFrame([(40,)], "id long")
    rows = spark.createDataFrame([(9,), (2,), (7,)], "id long")
    dense = migration.assign_ids(rows, target, dense=True).collect()
    plain = migration.assign_ids(rows, target).collect()
    assert sorted(r["id"] for r in dense) == [41, 42, 43]
    assert sorted(r["id"] for r in plain) == [42, 47, 49]


# --------------------------------------------------------------------------- writes


def updates(spark, rows):
    """id, orden, campos, then the values of sexo, pasaporte, estado."""
    given = {"sexo": 3, "pasaporte": 4, "estado": 5}
    full = [
        (r[0], r[1], r[2], *[r[given[c]] if c in given else None for c in maintenance.UPDATABLE])
        for r in rows
    ]
    kinds = ", ".join(
        f"{c} {model.TARGET_SCHEMA[c].dataType.simpleString()}" for c in maintenance.UPDATABLE
    )
    return spark.createDataFrame(full, f"id long, orden int, campos array<string>, {kinds}")


def test_updates_fold_like_a_sequence(spark):
    frame = updates(spark, [
        (1, 1, ["sexo"], "M", "no", None),
        (1, 2, ["pasaporte"], None, "P1", None),
        (1, 3, ["sexo", "pasaporte"], "F", None, None),
        (2, 1, [], "M", None, None),
    ])
    got = {r["id"]: r for r in maintenance.fold_updates(frame, "orden").collect()}
    assert sorted(got[1]["campos"]) == ["pasaporte", "sexo"]
    assert (got[1]["sexo"], got[1]["pasaporte"]) == ("F", None)
    assert got[2]["campos"] == []


def test_null_overwrites_only_when_given(spark, tmp_path):
    from checks.queries import migrated

    stored = migrated(spark, SF).where("id IN (1, 11, 21)")
    done = maintenance.update_rows(stored, updates(spark, [
        (1, 0, ["pasaporte"], "F", None, None),
        (11, 1, ["sexo"], "F", None, None),
        (21, 2, ["estado"], None, None, None),
        (99, 3, ["sexo"], "F", None, None),
    ]), AS_OF, scratch(spark))
    rows = {r["id"]: r for r in done.rows.collect()}
    assert (rows[1]["pasaporte"], rows[1]["sexo"]) == (None, "M")
    assert (rows[11]["pasaporte"], rows[11]["sexo"]) == ("GT10", "F")
    assert rows[1]["actualizado_en"] == rows[11]["actualizado_en"] == datetime(2024, 6, 30)
    assert rows[21]["estado"] == "F" and rows[21]["actualizado_en"] != datetime(2024, 6, 30)
    assert {(r["id"], r["orden"], r["campo"]) for r in done.rejected.collect()} == {
        (21, 2, "estado"), (99, 3, "id")}


def test_each_request_stands_alone(spark):
    """A wrong request does not take a right one with it; the earlier of two wins; empty text collides."""
    from checks.queries import migrated

    stored = migrated(spark, SF).where("id IN (1, 11, 21, 1232)")
    assert {r["pasaporte"] for r in stored.collect()} >= {"GT0", "GT10", "GT20", ""}
    done = maintenance.update_rows(stored, updates(spark, [
        (1, 1, ["pasaporte"], None, "NEW9", None),
        (1, 2, ["sexo"], "Z", None, None),
        (1, 3, ["sexo"], "F", None, None),
        (21, 4, ["pasaporte"], None, "FREE1", None),
        (11, 5, ["pasaporte"], None, "FREE1", None),
        (11, 6, ["pasaporte"], None, "", None),
        (11, 7, ["pasaporte"], None, "GT10", None),
        (21, 8, ["pasaporte"], None, "NEW9", None),
    ]), AS_OF, scratch(spark))
    rows = done.rows.collect()
    assert sorted(r["id"] for r in rows) == [1, 11, 21, 1232]
    got = {r["id"]: (r["pasaporte"], r["sexo"]) for r in rows}
    assert got[1] == ("NEW9", "F") and got[11][0] == "GT10" and got[21][0] == "FREE1"
    assert {(r["orden"], r["campo"]) for r in done.rejected.collect()} == {
        (2, "sexo"), (5, "pasaporte"), (6, "pasaporte"), (8, "pasaporte")}


def test_json_kinds_never_mix(spark):
    from padron.functions.documents import json_contains

    doc = spark.createDataFrame([((7, True),)], "d struct<n:int,b:boolean>")
    kind = doc.schema["d"].dataType
    found = [{"n": 7}, {"n": "7"}, {"n": "abc"}, {"n": True}, {"b": True}, {"b": 1}, {"n": None}]
    row = doc.select(*[json_contains(F.col("d"), kind, p).alias(f"c{i}") for i, p in enumerate(found)]).first()
    assert list(row) == [True, False, False, False, True, False, False]


def test_long_domain_labels_are_no_mail(spark):
    from padron.functions import contract

    mails = ["a@" + "b" * 63 + ".gt", "a@" + "b" * 64 + ".gt", "a@" + ".".join(["c" * 60] * 5) + ".gt"]
    frame = spark.createDataFrame([(m,) for m in mails], "m string")
    assert [r[0] for r in frame.select(F.col("m").rlike(contract._EMAIL)).collect()] == [True, False, False]


def test_snapshots(spark, tmp_path):
    from checks.queries import migrated

    name = "pacientes_prueba"
    assert not tables.table_exists(spark, name)
    assert tables.create_target(spark, name, str(tmp_path / "first")).count() == 0
    assert tables.table_exists(spark, name)
    tables.replace_target(migrated(spark, SF), name, str(tmp_path))
    gone = spark.createDataFrame([(1,), (2,), (2,), (10**6,)], "id long")
    done = maintenance.delete_rows(spark.table(name), gone)
    assert [r["id"] for r in done.rejected.collect()] == [10**6]
    tables.replace_target(done.rows, name, str(tmp_path))
    assert spark.table(name).count() == 1498
    assert tables.create_target(spark, name, "unused").count() == 1498
    spark.sql(f"DROP TABLE {name}")


def test_database_options():
    db = jdbc.Database("jdbc:mysql://host/db", driver="d", properties={"user": "u"})
    options = jdbc.scan_options(db, 1, 72_879, 8, 500)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "72879")
    assert jdbc.bounds_options(db)["query"] == "SELECT MIN(id) AS lo, MAX(id) AS hi FROM pacientes"
    assert jdbc.append_options(db)["batchsize"] == "100"
    read = jdbc.target_options(db, 1, 9, 2, 10)
    assert read["dbtable"].startswith("(SELECT id, expediente, cui, pasaporte, CAST(nombre AS TEXT) AS nombre, sexo")
    assert read["dbtable"].endswith("FROM pacientes) AS t") and read["numPartitions"] == "2"
    with pytest.raises(ValueError):
        jdbc.scan_options(db, 1, 2, 0, 1)


def test_rows_of_a_database_become_typed(spark):
    from checks.queries import migrated
    from padron.functions.documents import documents_to_json

    rows = migrated(spark, SF)
    back = jdbc.typed_target(documents_to_json(rows))
    assert [f.dataType for f in back.schema] == [f.dataType for f in model.TARGET_SCHEMA]
    assert back.exceptAll(rows).count() == 0


def test_legacy_column_names(spark):
    from checks.inputs import legacy

    rows = legacy(spark, SF).withColumnRenamed("fecha_defuncion", "fechaDefuncion").withColumn(
        "hora_defuncion", F.lit("1970-01-01 10:30:00").cast("timestamp"))
    got = tables.conform_legacy(rows)
    assert got.columns == model.LEGACY_SCHEMA.fieldNames()
    assert got.first()["hora_defuncion"] == "10:30:00"


# --------------------------------------------------------------------------- plans


def local(path: str) -> str:
    return path.removeprefix("file:")


def shared(spark) -> str:
    return local(spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir"))


def plan_of(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", [
    "transform", "validar_paciente_completo", "referential_integrity", "unique_violations",
    "load_errors", "identifiers_available", "list_page_deep", "batch_summary", "update_rows",
    "estadisticas", "migration_status",
])
def test_no_python_and_no_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "NestedLoop", "CartesianProduct"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from checks.queries import migrated

    path = str(tmp_path / "t")
    tables.append_target(migrated(spark, SF), path)
    stored = tables.scan_target(spark, path)
    params = lookup.SearchParams(sexo="M", estado="V", cui=1000000000008, nombre="juan")
    plan = plan_of(lookup.search(stored, params).select("id"))
    assert "EqualTo(cui,1000000000008)" in plan and "EqualTo(sexo,M)" in plan
    scan = plan_of(lookup.migrados(stored).select("id"))
    assert "EqualTo(metadatos.sistema_origen,mysql_legacy)" in scan
    assert "ReadSchema: struct<id:bigint,metadatos:struct<sistema_origen:string>>" in scan


def test_asked_values_come_first(spark):
    """What is aggregated of the target are only the values that somebody asks for."""
    from checks.inputs import candidates
    from checks.queries import migrated

    frame = identifiers.identifier_exists(candidates(spark, SF), migrated(spark, SF), "fila")
    lines = frame._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    at = next(i for i, x in enumerate(lines) if "primera" in x and "Aggregate" in x)
    below = next(x for x in lines[at + 1 :] if "Join" in x or "Relation" in x)
    assert "LeftSemi" in below and depth(below) > depth(lines[at])


def test_work_folders_are_shared_and_removed(spark):
    with tables.Workspace(spark) as work:
        first, second = work.folder("x"), work.folder("x")
        assert first.startswith("file:") or first.startswith("/") and first != second
        assert work.settle(spark.range(3), "x").count() == 3
        assert os.path.exists(local(work.path))
    assert not os.path.exists(local(work.path))


def test_statistics_scan_once(spark, tmp_path):
    from checks.queries import migrated
    from padron.operators import stats

    path = str(tmp_path / "t")
    tables.append_target(migrated(spark, SF), path)
    frame = stats.estadisticas(tables.scan_target(spark, path))
    physical = frame._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("FileScan") == 1
    assert "contacto" not in physical.split("ReadSchema")[1]


def test_lookup_is_computed_once(spark):
    """The two uses of the per-key counts share one shuffle."""
    frame = QUERIES["unique_violations"](spark, SF)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_requests_equal_a_loop(spark):
    """Random requests over few values: what is freed, handed on, refused and asked again."""
    import random

    draw = random.Random(5)
    events, stored, want = [], [], set()
    fields = ("cui", "pasaporte")
    for world in range(60):
        rows = [world * 10 + i for i in range(4)]
        values = [f"{world}-{v}" for v in "abcd"]
        now = {}
        for f in fields:
            for row, value in zip(rows, draw.sample(values, 3), strict=False):
                now[row, f] = value
                stored.append((row, f, value))
        for turn in range(draw.choice((3, 8, 25))):
            order, row = turn * 1000 + world, draw.choice(rows)
            asked = {f: draw.choice([*values, None]) for f in fields if draw.random() < 0.7}
            events += [(order, row, f, v) for f, v in asked.items()]
            refused = [f for f, v in asked.items() if v is not None and any(k == f and o != row and held == v for (o, k), held in now.items())]
            want |= {(order, f) for f in refused}
            if not refused:
                now.update({(row, f): v for f, v in asked.items()})
    asked = spark.createDataFrame(events, "orden long, fila long, campo string, clave string").repartition(3)
    held = spark.createDataFrame(stored, "fila long, campo string, clave string")
    got = {tuple(r) for r in requests.refusals(asked, held, scratch(spark)).collect()}
    assert len(want) > 200 and got == want


def test_a_chain_of_requests_is_decided_to_its_end(spark):
    """Each takes what the one before has to give up; the last but one finds its value still held."""
    events = [(i, i, "cui", str(i - 1)) for i in range(1, 13)]
    stored = [(i, "cui", str(i)) for i in range(1, 12)]
    asked = spark.createDataFrame(events, "orden long, fila long, campo string, clave string")
    held = spark.createDataFrame(stored, "fila long, campo string, clave string")
    assert requests.refusals(asked, held, scratch(spark)).count() == 0
    backwards = asked.withColumn("orden", 20 - F.col("orden"))
    assert {r.orden for r in requests.refusals(backwards, held, scratch(spark)).collect()} == set(range(8, 19))


def test_only_accepted_requests_hold_and_free(spark):
    from checks.queries import migrated

    stored = migrated(spark, SF).where("id IN (1, 11, 21)")
    taken = stored.where("id = 21").first()["pasaporte"]
    done = maintenance.update_rows(stored, updates(spark, [
        (1, 1, ["pasaporte", "sexo"], "Z", "NEW1", None),
        (11, 2, ["pasaporte"], None, "NEW1", None),
        (21, 3, ["pasaporte"], None, "NEW3", None),
        (1, 4, ["pasaporte"], None, taken, None),
    ]), AS_OF, scratch(spark))
    got = {r["id"]: r["pasaporte"] for r in done.rows.collect()}
    assert got == {1: taken, 11: "NEW1", 21: "NEW3"}
    assert {(r["orden"], r["campo"]) for r in done.rejected.collect()} == {(1, "sexo")}


def test_counters_survive_a_failed_log(spark, tmp_path, monkeypatch):
    """The append succeeds, a log does not: the repeat loads nothing twice and counts the first attempt."""
    from checks.inputs import legacy

    path, log = str(tmp_path / "target"), str(tmp_path / "log")
    rows = legacy(spark, SF)
    other = str(tmp_path / "other")
    for place in (path, other):
        tables.append_target(spark.createDataFrame([], model.TARGET_SCHEMA), place)
    whole = migration.run(rows, tables.scan_target(spark, other), other, str(tmp_path / "otherlog"), AS_OF).first()
    with monkeypatch.context() as broken:
        def fails(*_):
            raise OSError("no log today")
        broken.setattr(migration, "gate_report", fails)
        with pytest.raises(OSError):
            migration.run(rows, tables.scan_target(spark, path), path, log, AS_OF)
    loaded = tables.scan_target(spark, path).count()
    assert loaded == whole["total_exitosos"] > 0
    again = migration.run(rows, tables.scan_target(spark, path), path, log, AS_OF).first()
    assert again == whole and tables.scan_target(spark, path).count() == loaded
    assert spark.read.parquet(f"{log}/warnings").count() == whole["total_advertencias"]
    assert not os.path.exists(f"{log}.open")
    assert migration.run(rows, tables.scan_target(spark, path), path, log, AS_OF).first()["total_exitosos"] == 0


def test_repeated_ids_and_fractions(spark):
    from checks.inputs import legacy

    base = legacy(spark, SF).where("id % 7 = 0 AND id < 300").withColumn("exp_madre", F.col("exp_madre").cast("double"))
    one = base.where("id = 21")
    other = one.withColumn("ocupacion", F.lit("~"))
    loose = base.unionByName(one).unionByName(other).unionByName(other).withColumn(
        "exp_madre", F.when(F.col("id") == 28, F.lit(3.7)).otherwise(F.col("exp_madre")))
    run = migration.plan(loose, spark.createDataFrame([], model.TARGET_SCHEMA), AS_OF, scratch(spark))
    kept = run.loadable.where("id = 21").collect()
    assert len(kept) == 1 and kept[0]["datos_extra"]["socioeconomicos"]["ocupacion"] != "~"
    found = [(r.id_mysql, r.error) for r in run.errors.where("id_mysql IN (21, 28)").collect()]
    assert sorted(found) == [(21, "id duplicado")] * 3 + [(28, "exp_madre: 3.7 no es int")]
    stats = migration.migration_stats(run).first()
    assert stats["total_procesados"] == loose.count() == stats["total_exitosos"] + stats["total_errores"]
