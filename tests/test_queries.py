"""Every registered query against its SQL on the smallest data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


# Rules whose records, as given, hold both right and wrong ones.
RULES = [n for n in QUERIES if n.startswith(("validar_", "schema_", "es_gemelo_type")) and n != "validar_origen"]


@pytest.mark.parametrize("name", RULES)
def test_rules_fire(spark, name):
    """No rule gives one answer for all rows."""
    frame = QUERIES[name](spark, SF)
    shown = [c for c in frame.columns if c not in ("id", "fila", "orden", "errores_por_campo")]
    assert frame.select(*shown).distinct().limit(2).count() == 2


def test_every_field_of_a_record_fails_somewhere(spark):
    from padron.functions import rules

    frame = QUERIES["validar_paciente_completo"](spark, SF)
    row = frame.agg(*[F.max(F.col(f)).alias(f) for f in rules.CHECK_FIELDS]).first()
    assert all(row[f] for f in rules.CHECK_FIELDS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(spark, con, SF, name) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
