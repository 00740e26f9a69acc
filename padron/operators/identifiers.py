"""Uniqueness and availability of the three identifiers.

All work on one long table (row, field, value): one shuffle serves the three identifiers,
and no join has an OR in its condition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.text import has_number, has_text
from padron.model import IDENTIFIERS
from padron.operators import skew
from padron.operators.skew import beside, few, lookup_join

KEY = ("campo", "clave")


def identifier_rows(
    rows: DataFrame, key: str = "id", given_only: bool = False, carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """Long form ``fila, campo, clave`` of the identifiers that are not null.

    ``given_only`` also leaves out empty texts and zero. ``carry`` adds columns of the row, so
    that nobody has to come back for them.
    """
    carry = carry or {}
    usable = {
        "expediente": has_text(F.col("expediente")),
        "cui": has_number(F.col("cui")),
        "pasaporte": has_text(F.col("pasaporte")),
    }
    entries = [
        F.struct(
            F.lit(c).alias("campo"),
            (F.when(usable[c], F.col(c)) if given_only else F.col(c))
            .cast("string")
            .alias("clave"),
        )
        for c in IDENTIFIERS
    ]
    return (
        rows.select(
            F.col(key).alias("fila"),
            *[v.alias(n) for n, v in carry.items()],
            F.explode(F.array(*entries)).alias("e"),
        )
        .select("fila", "e.campo", "e.clave", *carry)
        .where(F.col("clave").isNotNull())
    )


def key_owners(keys: DataFrame) -> DataFrame:
    """Per value: its lowest and highest row and how many rows carry it."""
    return keys.groupBy(*KEY).agg(
        F.min("fila").alias("primera"), F.max("fila").alias("ultima"), F.count("*").alias("n")
    )


def unique_violations(rows: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose value already belongs to a row with a lower id. Nulls never collide."""
    keys = identifier_rows(rows, key)
    repeated = key_owners(keys).where("n > 1").drop("ultima")
    return (
        lookup_join(keys, repeated, KEY, "n")
        .where(F.col("fila") > F.col("primera"))
        .select(F.col("fila").alias(key), *KEY, "primera")
    )


def held(keys: DataFrame, stored: DataFrame, small: bool | None = None) -> DataFrame:
    """Long rows of ``stored`` whose value is one of ``keys`` (distinct values).

    The values asked for come first: what is aggregated afterwards grows with them and not with
    the table. ``stored`` may be a stored index in place of the rows (``operators.keyindex``).
    ``small`` tells whether the values can be broadcast, if that is known.
    """
    if hasattr(stored, "held"):
        return stored.held(keys)
    asked = keys.select(*KEY)
    if small is not None:
        asked = beside(asked, small)
    return identifier_rows(stored).join(asked, list(KEY), "left_semi")


def load_conflicts(
    rows: DataFrame, stored: DataFrame, key: str = "id", carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """Unique violations within ``rows`` and against the rows already ``stored``.

    A rejected row still holds its values against later rows; the result is the same
    whatever the order of evaluation. ``en_destino`` tells the two cases apart.
    """
    # Three values a row, each some four times as large as a number.
    small = few(rows, skew.BROADCAST_ROWS // 12)
    keys = identifier_rows(rows, key, carry=carry)
    owners = key_owners(keys).drop("ultima")
    taken = held(owners, stored, small).select(*KEY).distinct().withColumn("_taken", F.lit(True))
    owners = (
        owners.join(beside(taken, small), list(KEY), "left_outer")
        .withColumn("en_destino", F.col("_taken").isNotNull())
        .drop("_taken")
        .where("n > 1 OR en_destino")
    )
    return (
        lookup_join(keys, owners, KEY, "n", small)
        .where(F.col("en_destino") | (F.col("fila") > F.col("primera")))
        .select(F.col("fila").alias(key), *KEY, *(carry or {}), "en_destino")
    )


def _matches(
    candidates: DataFrame, stored: DataFrame, key: str, carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """Candidate identifiers found among the stored ones, with the lowest and highest owner."""
    wanted = identifier_rows(candidates, key, given_only=True, carry=carry)
    weights = wanted.groupBy(*KEY).agg(F.count("*").alias("n"))
    found = weights.join(key_owners(held(weights, stored)).drop("n"), list(KEY))
    return lookup_join(wanted, found, KEY, "n")


def identifier_exists(candidates: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """``key, existe``: does any stored row share an identifier with the candidate."""
    hits = _matches(candidates, stored, key).select(F.col("fila").alias(key)).distinct()
    return (
        candidates.select(key)
        .join(hits.withColumn("_hit", F.lit(True)), key, "left_outer")
        .select(key, F.col("_hit").isNotNull().alias("existe"))
    )


def identifiers_available(
    candidates: DataFrame, stored: DataFrame, key: str = "id", exclude: str | None = None
) -> DataFrame:
    """Per candidate, whether each identifier is free.

    ``exclude`` names the column with the id of the candidate's own stored row; null or zero
    excludes nothing. A value is taken by another row exactly when its lowest or highest
    owner is not that row.
    """
    carry = None if exclude is None else {"_own": F.col(exclude)}
    hits = _matches(candidates, stored, key, carry)
    if exclude is not None:
        hits = hits.where(
            ~has_number(F.col("_own"))
            | (F.col("primera") != F.col("_own"))
            | (F.col("ultima") != F.col("_own"))
        )
    taken = hits.groupBy(F.col("fila").alias(key)).agg(
        *[F.bool_or(F.col("campo") == c).alias(f"_{c}") for c in IDENTIFIERS]
    )
    return (
        candidates.select(key)
        .join(taken, key, "left_outer")
        .select(
            key,
            *[
                (~F.coalesce(F.col(f"_{c}"), F.lit(False))).alias(f"{c}_disponible")
                for c in IDENTIFIERS
            ],
        )
    )
