"""Search by stored runs of three letters: the same rows as the scan gives."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from checks.queries import loaded
from padron.operators import lookup
from padron.operators.lookup import SearchParams
from padron.operators.textindex import FREE_TEXT_FIELDS, TextIndex, build_text_index, postings, search_terms
from tests.conftest import SF


def new_index(rows, buckets=4) -> TextIndex:
    return build_text_index(rows, f"textos_{uuid.uuid4().hex}", buckets=buckets)


@pytest.fixture(scope="module")
def rows(spark):
    return loaded(spark, SF)


def ids(frame):
    return sorted(r.id for r in frame.select("id").collect())


def forms(rows) -> list[SearchParams]:
    """Pieces of stored texts, in either case, some with wildcards, some short, and some that fit nothing."""
    rng = random.Random(7)
    stored = rows.select("expediente", "pasaporte", "nombre.*").orderBy("primer_nombre", "primer_apellido").limit(300).collect()

    def piece(value):
        if not value:
            return None
        start = rng.randrange(len(value))
        text = value[start : start + rng.randint(1, 6)]
        if len(text) > 3 and rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("%_") + text[at + 1 :]
        return rng.choice([text, text.upper(), text.lower()])

    made = []
    for row in rng.sample(stored, 10):
        name = rng.choice([row.primer_nombre, row.segundo_nombre, row.otros_nombres])
        made.append(SearchParams(nombre=piece(name), apellido=piece(rng.choice([row.primer_apellido, row.segundo_apellido]))))
    made.append(SearchParams(expediente=stored[5].expediente, apellido="e"))
    made.append(SearchParams(pasaporte="gt1", sexo="F"))
    made.append(SearchParams(nombre="ningún nombre así"))
    made.append(SearchParams(nombre=r"mar\%a"))
    made.append(SearchParams(nombre="%_%", apellido="garcía"))
    return made


def test_index_finds_what_the_scan_finds(spark, rows):
    index = new_index(rows)
    found = 0
    for form in forms(rows):
        want = ids(lookup.search(rows, form))
        assert ids(index.search(rows, form)) == want, form
        found += len(want)
    assert found > 100
    for text in ("garcía", "ar", "", "zzz"):
        assert ids(index.search_nombre_completo(rows, text)) == ids(lookup.search_nombre_completo(rows, text))


def test_index_after_changes(spark, rows):
    """Changed rows add what they hold now; what they held, and rows that are gone, do no harm."""
    index = new_index(rows.where("id % 7 <> 0"))
    renamed = rows.where("id % 5 = 0").withColumn("nombre", F.col("nombre").withField("primer_nombre", F.lit("Ximena Ñandú")))
    now = rows.where("id % 5 <> 0 AND id % 11 <> 0").unionByName(renamed.where("id % 11 <> 0"))
    index.add(rows.where("id % 7 = 0"))
    for _ in range(2):
        index.add(renamed)
    fresh = index.compact(now, f"textos_{uuid.uuid4().hex}")
    for text in ("ximena", "ÑANDÚ", "juan", "a ñ"):
        form = SearchParams(nombre=text)
        want = ids(lookup.search(now, form))
        assert ids(index.search(now, form)) == want and ids(fresh.search(now, form)) == want
    assert ids(fresh.search(now, SearchParams(nombre="ximena")))


def test_lists_are_bounded_and_only_asked_buckets_are_read(spark, rows):
    lists = postings(rows)
    assert lists.where("size(ids) > 65536 OR size(ids) <> size(array_distinct(ids))").isEmpty()
    assert lists.groupBy("gram", "campo", "bloque").count().where("count > 1").isEmpty()
    index = new_index(rows, buckets=16)
    assert "In(gram, [arc,gar])" in index.candidates([(FREE_TEXT_FIELDS, "garc")])._jdf.queryExecution().executedPlan().toString()
    read = index.lists().where(F.col("gram").isin("gar", "arc")).select("ids")
    read.collect()
    scanned = read._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert 0 < scanned < index.lists().count() / 3
    assert index.candidates(search_terms(SearchParams(nombre="ab", apellido="c%d_e"))) is None


def test_few_blocks_become_ranges_of_the_scan(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "target"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "target"))
    found = new_index(rows).search(stored, SearchParams(apellido="garcía"))
    assert "GreaterThanOrEqual(id,0)" in found._jdf.queryExecution().executedPlan().toString()


def test_empty_target_and_nulls(spark, rows):
    empty = rows.limit(0)
    index = new_index(empty)
    assert ids(index.search(empty, SearchParams(nombre="juan"))) == []
    hollow = rows.limit(20).withColumns({
        "expediente": F.lit(None).cast("string"), "pasaporte": F.lit(""), "nombre": F.lit(None).cast(rows.schema["nombre"].dataType)})
    index = new_index(hollow)
    assert ids(index.search(hollow, SearchParams(nombre="juan"))) == []
    assert ids(index.search(hollow, SearchParams(sexo="M"))) == ids(lookup.search(hollow, SearchParams(sexo="M")))
