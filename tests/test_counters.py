"""Counters kept beside the target against a full pass over it."""

import random
import uuid

from padron.operators import counters, stats

SCHEMA = "id long, sexo string, estado string, cui long, metadatos struct<sistema_origen: string, expediente_duplicado: boolean>"


def rows(rng, ids):
    return {
        i: (i, rng.choice(["M", "F", "X", None]), rng.choice(["V", "F", None]), rng.choice([1, None]),
            rng.choice([None, ("mysql_legacy", True), ("mysql_legacy", None), (None, False)]))
        for i in ids
    }


def test_log_equals_full_pass(spark, tmp_path):
    rng = random.Random(5)
    frame = lambda held: spark.createDataFrame(list(held.values()), SCHEMA)
    path, held = f"{tmp_path}/{uuid.uuid4().hex}", rows(rng, range(60))
    ids = lambda some: spark.createDataFrame([(i,) for i in some], "id long")
    counters.append_counts(counters.counted(frame(held), "alta"), path)
    for run, touched in (("cambio", [*range(0, 60, 7), 7, 999]), ("baja", range(40)), ("nada", [1234])):
        after = {**held, **rows(rng, [i for i in touched if i in held])} if run == "cambio" else {i: r for i, r in held.items() if i not in touched}
        delta = counters.changed(frame(held), frame(after), ids(touched), run)
        for _ in range(2):  # a repeat changes nothing
            counters.append_counts(delta, path)
        held = after
        log = counters.read_counts(spark, path)
        assert counters.estadisticas(log).collect() == stats.estadisticas(frame(held)).collect()
        assert [r.total for r in counters.breakdown(log).where("nivel = ''").collect()] == [len(held)]


def test_empty_log(spark):
    none = spark.createDataFrame([], counters.SCHEMA)
    assert counters.estadisticas(none).collect() == stats.estadisticas(spark.createDataFrame([], SCHEMA)).collect()
