"""SQL for DuckDB, one statement per query, written apart from the Spark expressions."""

from __future__ import annotations

import re

from checks.inputs import CANDIDATES_SELECT, LEGACY_SELECT, SOILED, UPDATES_SELECT

AS_OF = "DATE '2024-06-30'"
NOW = "TIMESTAMP '2024-06-30 00:00:00'"
MOMENT = "'2024-06-30T00:00:00'"
BL = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{BL}]+|[{BL}]+$', '', 'g')"


def word(x: str) -> str:
    return f"upper({strip(x)})"


def digits(x: str) -> str:
    return rf"regexp_replace({x}, '\P{{Nd}}', '', 'g')"


EMAIL = f"lower({strip('email')})"
DEATH_DAY = r"""CAST(CASE
    WHEN regexp_full_match(fd, '\d{4}-\d{1,2}-\d{1,2}') THEN try_strptime(fd, '%Y-%m-%d')
    WHEN regexp_full_match(fd, '\d{1,2}/\d{1,2}/\d{4}') THEN try_strptime(fd, '%d/%m/%Y')
    WHEN regexp_full_match(fd, '\d{4}/\d{1,2}/\d{1,2}') THEN try_strptime(fd, '%Y/%m/%d')
    WHEN regexp_full_match(fd, '\d{1,2}-\d{1,2}-\d{4}') THEN try_strptime(fd, '%d-%m-%Y')
    END AS DATE)"""
YES = "('SI', 'S', 'YES', 'Y', '1')"
LOCAL = "strftime({} + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S')"

CTES = {
    "legacy": LEGACY_SELECT + "orders",
    "parsed": f"""
SELECT *, regexp_extract_all(nombre, '[^{BL}]+') AS g, regexp_extract_all(apellido, '[^{BL}]+') AS f,
    {strip("fecha_defuncion")} AS fd
FROM legacy""",
    "mig": f"""
SELECT CAST(id AS BIGINT) AS id, created_at, dpi, expediente AS expediente_origen,
    expediente IS NULL OR expediente = 0 AS repetido,
    CASE WHEN expediente IS NULL OR expediente = 0 THEN concat('DUP-', id)
        ELSE CAST(expediente AS VARCHAR) END AS expediente,
    CASE WHEN regexp_full_match(CAST(dpi AS VARCHAR), '[0-9]{{13}}') THEN dpi END AS cui,
    pasaporte,
    g[1] AS primer_nombre, g[2] AS segundo_nombre,
    nullif(array_to_string(g[3:], ' '), '') AS otros_nombres,
    f[1] AS primer_apellido, nullif(array_to_string(f[2:], ' '), '') AS segundo_apellido,
    nullif(conyugue, '') AS apellido_casada,
    CASE WHEN {word("sexo")} IN ('M', 'MASCULINO', 'HOMBRE') THEN 'M'
        WHEN {word("sexo")} IN ('F', 'FEMENINO', 'MUJER') THEN 'F' ELSE 'NF' END AS sexo,
    nacimiento,
    CAST(nacimiento AS VARCHAR) AS fecha_nacimiento,
    nullif({digits("telefono")}, '') AS telefono_principal,
    CASE WHEN {EMAIL} NOT IN ('', 'n/a', 'na', 'null', 'none') THEN {EMAIL} END AS email,
    coalesce(direccion, '') <> '' OR coalesce(municipio, 0) <> 0 OR coalesce(depto, 0) <> 0
        AS con_direccion,
    CASE WHEN con_direccion THEN direccion END AS linea1,
    CASE WHEN con_direccion THEN municipio END AS municipio_id,
    CASE WHEN con_direccion THEN depto END AS departamento_id,
    padre, madre, exp_madre AS expediente_madre,
    coalesce(responsable, '') <> '' AS con_responsable,
    CASE WHEN con_responsable THEN responsable END AS resp_nombre,
    CASE WHEN con_responsable THEN parentesco END AS resp_parentesco_id,
    CASE WHEN con_responsable AND regexp_full_match(CAST(dpi_responsable AS VARCHAR), '[0-9]{{13}}')
        THEN dpi_responsable END AS resp_cui,
    CASE WHEN con_responsable THEN CAST(telefono_responsable AS VARCHAR) END AS resp_telefono,
    CASE WHEN con_responsable THEN exp_ref END AS resp_expediente,
    conyugue,
    CASE WHEN gemelo <> '' THEN upper(gemelo) IN {YES} END AS es_gemelo,
    nacionalidad AS nacionalidad_id, depto_nac AS departamento_nacimiento_id,
    lugar_nacimiento AS lugar_nacimiento_id, estado_civil AS estado_civil_id,
    pueblo AS pueblo_id, idioma AS idioma_id, educacion AS educacion_id, ocupacion,
    CAST({DEATH_DAY} AS VARCHAR) || 'T' || coalesce(hora_defuncion, '00:00:00') AS fecha_hora,
    CASE WHEN {word("estado")} IN ('F', 'FALLECIDO', 'MUERTO', 'DEAD') THEN 'F' ELSE 'V' END
        AS estado,
    'mysql_legacy' AS sistema_origen, parsed.id AS id_origen, created_by AS creado_por,
    {MOMENT} AS migrado_en, '1.0' AS version_migracion,
    expediente_origen IS NULL OR expediente_origen = 0 AS expediente_duplicado,
    CASE WHEN expediente_origen IS NULL OR expediente_origen = 0
        THEN 'Expediente marcado como duplicado o nulo' END AS notas,
    {LOCAL.format("created_at")} AS creado_en, {LOCAL.format("update_at")} AS actualizado_en
FROM parsed""",
    "resp": f"""
SELECT *,
    coalesce(nullif(concat_ws(' ', primer_nombre, segundo_nombre, otros_nombres, primer_apellido,
        segundo_apellido, 'de ' || apellido_casada), ''), 'Sin nombre') AS nombre_completo,
    CAST(year({AS_OF}) - year(nacimiento) - CASE WHEN strftime({AS_OF}, '%m%d')
        < strftime(nacimiento, '%m%d') THEN 1 ELSE 0 END AS INT) AS edad
FROM mig""",
    "claves": """
SELECT id, 'expediente' AS campo, expediente AS clave FROM mig WHERE expediente IS NOT NULL
UNION ALL SELECT id, 'cui', CAST(cui AS VARCHAR) FROM mig WHERE cui IS NOT NULL
UNION ALL SELECT id, 'pasaporte', pasaporte FROM mig WHERE pasaporte IS NOT NULL""",
    "previas": """
SELECT k.*, min(id) OVER (PARTITION BY campo, clave) AS primera
FROM claves k SEMI JOIN (SELECT id FROM mig WHERE created_at < TIMESTAMP '1999-01-01') USING (id)""",
    "stored": """
SELECT m.* FROM mig m WHERE created_at < TIMESTAMP '1999-01-01'
    AND id NOT IN (SELECT id FROM previas WHERE id > primera)""",
    "claves_stored": "SELECT k.* FROM claves k SEMI JOIN stored USING (id)",
    "pendientes": "SELECT m.* FROM mig m ANTI JOIN stored USING (id)",
    "conflictos": """
SELECT k.id, k.campo, s.clave IS NOT NULL AS en_destino,
    k.id > min(k.id) OVER (PARTITION BY k.campo, k.clave) AS repetida
FROM claves k SEMI JOIN pendientes USING (id)
LEFT JOIN (SELECT DISTINCT campo, clave FROM claves_stored) s USING (campo, clave)""",
    # A first complete run.
    "primeras": """
SELECT k.*, min(id) OVER (PARTITION BY campo, clave) AS primera FROM claves k""",
    "rechazos": """
SELECT id, string_agg(campo || ' duplicado', '; ' ORDER BY campo) AS error
FROM primeras WHERE id > primera GROUP BY id""",
    "cargadas": "SELECT m.* FROM mig m ANTI JOIN rechazos USING (id)",
    "claves_cargadas": "SELECT k.* FROM claves k SEMI JOIN cargadas USING (id)",
    "sucias": "SELECT * REPLACE (" + ", ".join(f"{v} AS {k}" for k, v in SOILED.items()) + ") FROM mig",
    "avisos": "SELECT * FROM mig WHERE dpi IS NOT NULL AND cui IS NULL",
    "candidatos": CANDIDATES_SELECT + "customer",
    "pedidos": UPDATES_SELECT + "customer",
}


def sql(body: str) -> str:
    """The statement with the common tables it mentions, and those they mention, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    used = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return (f"WITH {', '.join(used)}\n" if used else "") + body


FLAT = (
    "id, expediente, cui, pasaporte, primer_nombre, segundo_nombre, otros_nombres, "
    "primer_apellido, segundo_apellido, apellido_casada, sexo, fecha_nacimiento, "
    "telefono_principal, email, con_direccion, linea1, municipio_id, departamento_id, padre, "
    "madre, expediente_madre, con_responsable, resp_nombre, resp_parentesco_id, resp_cui, "
    "resp_telefono, resp_expediente, conyugue, es_gemelo, nacionalidad_id, "
    "departamento_nacimiento_id, lugar_nacimiento_id, estado_civil_id, pueblo_id, idioma_id, "
    "educacion_id, ocupacion, fecha_hora, estado, sistema_origen, id_origen, creado_por, "
    "migrado_en, version_migracion, expediente_duplicado, notas, creado_en, actualizado_en"
)
BRIEF = "id, expediente, cui, pasaporte, sexo, estado, nombre_completo, edad"


def page(where: str, number: int, size: int, total: str | None = None) -> str:
    counted = f"(SELECT count(*) FROM mig WHERE {total or where})"
    return (
        f"SELECT id, expediente, nombre_completo, edad, {counted} AS total, {number} AS page, "
        f"{size} AS page_size, ({counted} + {size} - 1) // {size} AS total_pages "
        f"FROM resp WHERE {where} ORDER BY id LIMIT {size} OFFSET {(number - 1) * size}"
    )


# --------------------------------------------------------------------------- rules


def check_total(x: str) -> str:
    text = f"CAST({x} AS VARCHAR)"
    return "(" + " + ".join(
        f"TRY_CAST(substr({text}, {i}, 1) AS INT) * {14 - i}" for i in range(1, 13)
    ) + ")"


def expected_digit(x: str) -> str:
    return f"(CASE 11 - {check_total(x)} % 11 WHEN 11 THEN 0 ELSE 11 - {check_total(x)} % 11 END)"


def check_message(x: str) -> str:
    digit = expected_digit(x)
    return (
        f"CASE WHEN {digit} = 10 THEN 'CUI con dígito verificador inválido (módulo 10)' "
        f"WHEN {digit} <> {x} % 10 THEN concat('Dígito verificador incorrecto (esperado: ', "
        f"{digit}, ')') END"
    )


def cui_message(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL "
        f"WHEN length(CAST({x} AS VARCHAR)) <> 13 THEN 'CUI debe tener 13 dígitos' "
        f"WHEN {x} < 0 THEN 'CUI debe contener solo números' ELSE {check_message(x)} END"
    )


def passport_message(x: str) -> str:
    return (
        rf"CASE WHEN {x} <> '' AND length({strip(x)}) > 50 THEN 'Pasaporte muy largo (máx 50)' "
        rf"WHEN {x} <> '' AND NOT (regexp_matches({x}, '\p{{L}}') AND "
        rf"regexp_matches({x}, '\p{{Nd}}')) THEN 'Pasaporte debe contener letras y números' END"
    )


def file_message(x: str) -> str:
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN 'Expediente es requerido' "
        f"WHEN length({strip(x)}) > 20 THEN 'Expediente muy largo (máx 20)' "
        f"WHEN {strip(x)} LIKE 'DUP-%' THEN NULL "
        rf"WHEN NOT regexp_full_match({strip(x)}, '\p{{Nd}}+') "
        "THEN 'Expediente debe ser numérico o formato DUP-{id}' END"
    )


def cases(*pairs: tuple[str, str]) -> str:
    """Messages of the conditions that hold."""
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in pairs) + ")"


LETTERS = f"[a-zA-ZáéíóúÁÉÍÓÚñÑüÜ{BL}''-]+"
NAMES = (
    "primer_nombre",
    "segundo_nombre",
    "otros_nombres",
    "primer_apellido",
    "segundo_apellido",
    "apellido_casada",
)
NOMBRE = cases(
    *[(f"coalesce({f}, '') = ''", f"{f} es requerido") for f in ("primer_nombre", "primer_apellido")],
    *[
        pair
        for f in NAMES
        for pair in (
            (f"length({f}) > 100", f"{f} muy largo (máx 100)"),
            (
                f"{f} <> '' AND NOT regexp_full_match({f}, '{LETTERS}')",
                f"{f} contiene caracteres inválidos",
            ),
        )
    ],
)
SIMPLE_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
CONTACT_CHECKS = [
    ("length(telefono_principal) > 20", "Teléfono muy largo (máx 20)"),
    (
        f"email <> '' AND NOT regexp_full_match(email, '{SIMPLE_EMAIL}')",
        "Formato de email inválido",
    ),
    ("con_direccion AND coalesce(linea1, '') = ''", "Dirección debe incluir al menos linea1"),
]
CONTACTO = cases(*CONTACT_CHECKS)
LOCAL_PHONE = (
    "telefono_principal <> '' AND NOT regexp_full_match(telefono_principal, '[2-7][0-9]{7}')",
    "Formato de teléfono inválido",
)
CONTACTO_LOCAL = cases(CONTACT_CHECKS[0], LOCAL_PHONE, *CONTACT_CHECKS[1:])
BIRTH = cases(
    (f"nacimiento > {AS_OF}", "Fecha de nacimiento no puede ser futura"),
    ("nacimiento < DATE '1874-06-30'", "Fecha de nacimiento muy antigua (máx 150 años)"),
)
DEATH = cases(
    ("fecha_hora IS NOT NULL AND TRY_CAST(fecha_hora AS TIMESTAMP) IS NULL",
     "Formato de fecha_hora de defunción inválido"),
    (f"TRY_CAST(fecha_hora AS TIMESTAMP) > {NOW}", "Fecha de defunción no puede ser futura"),
)
REFS = f"coalesce('CUI del responsable: ' || ({cui_message('resp_cui')}), '')"
IDS_BAD = (
    f"({file_message('x')}) IS NOT NULL AND ({cui_message('y')}) IS NOT NULL "
    f"AND ({passport_message('z')}) IS NOT NULL"
)
IDS = (
    f"concat_ws('|', {file_message('x')}, {cui_message('y')}, {passport_message('z')}, "
    f"CASE WHEN {IDS_BAD} THEN 'Debe proporcionar al menos un identificador válido' END)"
)
COMPLETE = f"""
SELECT id, CASE WHEN {IDS_BAD} THEN {IDS} ELSE '' END AS identificadores, {NOMBRE} AS nombre,
    {cases(("sexo NOT IN ('M', 'F', 'NF')", "Sexo debe ser uno de: M, F, NF"))} AS sexo,
    {BIRTH} AS fecha_nacimiento, {CONTACTO} AS contacto, {REFS} AS referencias,
    {DEATH} AS datos_extra,
    CASE WHEN estado = 'F' AND fecha_hora IS NULL
        THEN 'Paciente fallecido debe tener fecha de defunción' ELSE '' END AS estado
FROM (SELECT *, expediente AS x, cui AS y, pasaporte AS z FROM mig)"""
FIELDS = (
    "identificadores",
    "nombre",
    "sexo",
    "fecha_nacimiento",
    "contacto",
    "referencias",
    "datos_extra",
    "estado",
)

# --------------------------------------------------------------------------- contract

NOT_STRING = "Input should be a valid string"
ONE_OR_MORE = "Input should be greater than or equal to 1"
WELL_FORMED = (
    r"[\p{L}\p{Nd}!#$%&''*+/=?^_`{|}~-]+(\.[\p{L}\p{Nd}!#$%&''*+/=?^_`{|}~-]+)*"
    r"@([\p{L}\p{Nd}]([\p{L}\p{Nd}-]*[\p{L}\p{Nd}])?\.)+[\p{L}\p{Nd}]([\p{L}\p{Nd}-]*[\p{L}\p{Nd}])?"
)


def field(name: str, *checks: tuple[str, str]) -> str:
    """``name: message`` of the first check that fails."""
    whens = " ".join(f"WHEN {c} THEN '{m.replace(chr(39), chr(39) * 2)}'" for c, m in checks)
    return f"'{name}: ' || CASE {whens} END"


def longer(x: str, n: int) -> tuple[str, str]:
    return (f"length({x}) > {n}", f"String should have at most {n} characters")


def shorter(x: str, n: int) -> tuple[str, str]:
    unit = "character" if n == 1 else "characters"
    return (f"length({x}) < {n}", f"String should have at least {n} {unit}")


def name_field(path: str, x: str, required: bool) -> str:
    first = [(f"{x} IS NULL", NOT_STRING), shorter(x, 1)] if required else []
    bad = (
        f"NOT regexp_full_match({x}, '{LETTERS}')",
        "Value error, Debe contener solo letras, espacios, guiones y apóstrofes",
    )
    return field(path, *first, longer(x, 100), bad)


def phone_field(path: str, x: str) -> str:
    bad = (f"length({digits(x)}) <> 8", "Value error, Teléfono debe tener 8 dígitos")
    return field(path, shorter(x, 8), longer(x, 20), bad)


def email_field(path: str, x: str) -> str:
    ok = (
        f"regexp_full_match({x}, '{WELL_FORMED}') AND "
        f"split_part(lower({x}), '.', -1) NOT IN ('arpa', 'invalid', 'local', 'localhost', "
        "'onion', 'test')"
    )
    return field(path, (f"NOT ({ok})", "value is not a valid email address"))


def id_field(path: str, x: str) -> str:
    return field(path, (f"{x} < 1", ONE_OR_MORE))


def cui_field(path: str, x: str, sign: bool = True) -> str:
    extra = [(f"{x} < 0", "Value error, CUI debe contener solo números")] if sign else []
    bad = (f"length(CAST({x} AS VARCHAR)) <> 13", "Value error, CUI debe tener 13 dígitos")
    return field(path, bad, *extra)


def birth_field(x: str) -> str:
    return field(
        "fecha_nacimiento",
        (f"{x} > {AS_OF}", "Value error, Fecha de nacimiento no puede ser futura"),
        (f"{x} < DATE '1874-06-30'", "Value error, Fecha de nacimiento muy antigua (máx 150 años)"),
    )


def address_fields(prefix: str, exists: str) -> list[str]:
    return [
        field(
            prefix + "linea1", (f"{exists} AND linea1 IS NULL", NOT_STRING), shorter("linea1", 1),
            longer("linea1", 200),
        ),
        id_field(prefix + "municipio_id", "municipio_id"),
        id_field(prefix + "departamento_id", "departamento_id"),
    ]


def person_fields(prefix: str) -> list[str]:
    return [
        field(prefix + "nombre", longer("resp_nombre", 100)),
        id_field(prefix + "parentesco_id", "resp_parentesco_id"),
        cui_field(prefix + "cui", "resp_cui", sign=False),
        field(prefix + "telefono", shorter("resp_telefono", 8), longer("resp_telefono", 20)),
        id_field(prefix + "expediente", "resp_expediente"),
    ]


def family_fields(prefix: str) -> list[str]:
    return [
        field(prefix + "padre", longer("padre", 100)),
        field(prefix + "madre", longer("madre", 100)),
        id_field(prefix + "expediente_madre", "expediente_madre"),
        *person_fields(prefix + "responsable -> "),
        field(prefix + "conyugue", longer("conyugue", 100)),
        field(prefix + "es_gemelo", ("es_gemelo IS NULL", "Input should be a valid boolean")),
    ]


def death_field(prefix: str) -> str:
    return field(
        prefix + "fecha_hora",
        (
            "fecha_hora IS NOT NULL AND TRY_CAST(fecha_hora AS TIMESTAMP) IS NULL",
            "Input should be a valid datetime",
        ),
        (
            f"TRY_CAST(fecha_hora AS TIMESTAMP) > {NOW}",
            "Value error, Fecha de defunción no puede ser futura",
        ),
    )


def extra_fields(prefix: str) -> list[str]:
    demo = (
        "nacionalidad_id",
        "departamento_nacimiento_id",
        "lugar_nacimiento_id",
        "estado_civil_id",
        "pueblo_id",
        "idioma_id",
    )
    return [
        *[id_field(f"{prefix}demograficos -> {f}", f) for f in demo],
        id_field(prefix + "socioeconomicos -> educacion_id", "educacion_id"),
        field(prefix + "socioeconomicos -> ocupacion", longer("ocupacion", 100)),
        death_field(prefix + "defuncion -> "),
    ]


def meta_fields(prefix: str) -> list[str]:
    sizes = {"sistema_origen": 50, "creado_por": 50, "version_migracion": 20, "notas": 500}
    return [field(prefix + f, longer(f, n)) for f, n in sizes.items()]


def listed(fields: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(fields) + ")"


EXP_FIELD = field("expediente", longer("expediente", 20))
PASS_FIELD = field("pasaporte", longer("pasaporte", 50))
SEXO_FIELD = field(
    "sexo", ("sexo IS NULL OR sexo NOT IN ('M', 'F', 'NF')", "Input should be 'M', 'F' or 'NF'")
)
ESTADO_FIELD = field(
    "estado", ("estado IS NULL OR estado NOT IN ('V', 'F')", "Input should be 'V' or 'F'")
)
NO_ID = (
    "CASE WHEN coalesce(expediente, '') = '' AND coalesce(cui, 0) = 0 "
    "AND coalesce(pasaporte, '') = '' THEN 'Value error, Debe proporcionar al menos un "
    "identificador (expediente, CUI o pasaporte)' END"
)
DEATH_RULE = (
    "CASE WHEN estado = 'F' AND fecha_hora IS NULL "
    "THEN 'Value error, Paciente fallecido debe tener datos de defunción' "
    "WHEN coalesce(estado, '') <> 'F' AND fecha_hora IS NOT NULL "
    "THEN 'Value error, Paciente vivo no puede tener datos de defunción' END"
)
RESPONSE_FIELDS = [
    EXP_FIELD,
    cui_field("cui", "cui"),
    PASS_FIELD,
    *[name_field(f"nombre -> {f}", f, f in ("primer_nombre", "primer_apellido")) for f in NAMES],
    SEXO_FIELD,
    birth_field("nacimiento"),
    phone_field("contacto -> telefono_principal", "telefono_principal"),
    email_field("contacto -> email", "email"),
    *address_fields("contacto -> direccion -> ", "con_direccion"),
    *family_fields("referencias -> "),
    *extra_fields("datos_extra -> "),
    ESTADO_FIELD,
    *meta_fields("metadatos -> "),
]
CANDIDATE_ADDRESS = "CASE WHEN con_direccion THEN {} END"
CANDIDATE_FIELDS = [
    EXP_FIELD,
    cui_field("cui", "cui"),
    PASS_FIELD,
    name_field("nombre -> primer_nombre", "primer_nombre", True),
    name_field("nombre -> segundo_nombre", "segundo_nombre", False),
    name_field("nombre -> primer_apellido", "primer_apellido", True),
    SEXO_FIELD,
    birth_field("fecha_nacimiento"),
    phone_field("contacto -> telefono_principal", "telefono"),
    email_field("contacto -> email", "email"),
    field(
        "contacto -> direccion -> linea1", ("con_direccion AND linea1 IS NULL", NOT_STRING)
    ),
    field(
        "contacto -> direccion -> municipio_id", ("con_direccion AND municipio_id < 1", ONE_OR_MORE)
    ),
    death_field("datos_extra -> defuncion -> "),
    ESTADO_FIELD,
]
CTES["revisados"] = f"""
SELECT *, CASE WHEN por_campo <> '' THEN por_campo
    ELSE coalesce(': ' || coalesce({NO_ID}, {DEATH_RULE}), '') END AS errores
FROM (SELECT *, {listed(CANDIDATE_FIELDS)} AS por_campo FROM candidatos)"""
CTES["claves_pedidas"] = """
SELECT fila, 'expediente' AS campo, expediente AS clave FROM revisados
    WHERE errores = '' AND expediente IS NOT NULL
UNION ALL SELECT fila, 'cui', CAST(cui AS VARCHAR) FROM revisados
    WHERE errores = '' AND cui IS NOT NULL
UNION ALL SELECT fila, 'pasaporte', pasaporte FROM revisados
    WHERE errores = '' AND pasaporte IS NOT NULL"""
# Requests one after the other. A threat is an earlier request (0: a stored row) of another record
# for the same value; it holds unless it was refused or one of the requests ``despues``, which
# replace the value before this request comes, was accepted. The loop decides one request a step.
THREATS = """
SELECT k.orden, k.campo, coalesce(e.orden, -1) AS de, (SELECT coalesce(list(d.orden), []) FROM {events} d
    WHERE d.fila = e.fila AND d.campo = e.campo AND d.orden > coalesce(e.orden, -1) AND d.orden < k.orden) AS despues
FROM {events} k JOIN (
    SELECT orden, fila, campo, clave FROM {events} UNION ALL SELECT -1, {stored}, campo, clave FROM claves_cargadas) e
  ON k.campo = e.campo AND k.clave = e.clave AND k.fila <> e.fila AND e.orden < k.orden"""
IN_ORDER = """
SELECT unnest(malas) AS orden FROM (
WITH RECURSIVE turno AS (SELECT orden, row_number() OVER (ORDER BY orden) AS i FROM (SELECT DISTINCT orden FROM {threats})),
paso(i, malas) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT p.i + 1, CASE WHEN bool_or(NOT list_contains(p.malas, a.de) AND list_has_all(p.malas, a.despues))
      THEN list_append(p.malas, t.orden) ELSE p.malas END
  FROM paso p JOIN turno t ON t.i = p.i + 1 JOIN {threats} a ON a.orden = t.orden
  GROUP BY p.i, p.malas, t.orden)
SELECT malas FROM paso ORDER BY i DESC LIMIT 1)"""
CTES["sucesos_altas"] = "SELECT CAST(fila AS BIGINT) AS orden, -1 - fila AS fila, campo, clave FROM claves_pedidas"
CTES["amenazas_altas"] = THREATS.format(events="sucesos_altas", stored="id")
CTES["tomadas"] = f"SELECT orden AS fila FROM ({IN_ORDER.format(threats='amenazas_altas')})"

# Updates, folded to one per record.
GIVEN = ("cui", "pasaporte", "sexo", "estado")
CTES["plegados"] = f"""
SELECT id,
    {", ".join(f"bool_or(da_{f}) AS da_{f}" for f in (*GIVEN, "contacto"))},
    {", ".join(f"arg_max({{'v': {f}}}, orden) FILTER (WHERE da_{f}).v AS {f}" for f in GIVEN)},
    arg_max({{'v': telefono}}, orden) FILTER (WHERE da_contacto).v AS telefono
FROM pedidos GROUP BY id"""
UPDATE_FIELDS = [
    f"CASE WHEN da_cui THEN {cui_field('cui', 'cui', sign=False)} END",
    f"CASE WHEN da_pasaporte THEN {PASS_FIELD} END",
    "CASE WHEN da_sexo THEN "
    + field("sexo", ("sexo NOT IN ('M', 'F', 'NF')", "Input should be 'M', 'F' or 'NF'"))
    + " END",
    f"CASE WHEN da_contacto THEN {phone_field('contacto -> telefono_principal', 'telefono')} END",
]
NULL_ESTADO = "CASE WHEN da_estado AND estado IS NULL THEN 'estado: no admite nulos' END"
# Every request for itself; then those that stand, folded to one per record.
CTES["revision"] = f"""
SELECT p.*, {listed([*UPDATE_FIELDS, NULL_ESTADO])} AS errores
FROM pedidos p SEMI JOIN cargadas USING (id)"""
CTES["sucesos_cambios"] = """
SELECT CAST(orden AS BIGINT) AS orden, id AS fila, 'cui' AS campo, CAST(cui AS VARCHAR) AS clave FROM revision
    WHERE errores = '' AND da_cui
UNION ALL SELECT orden, id, 'pasaporte', pasaporte FROM revision WHERE errores = '' AND da_pasaporte"""
CTES["amenazas_cambios"] = THREATS.format(events="sucesos_cambios", stored="id")
CTES["rechazados"] = IN_ORDER.format(threats="amenazas_cambios")
CTES["choques"] = """
SELECT DISTINCT s.fila AS id, a.orden, a.campo
FROM amenazas_cambios a JOIN sucesos_cambios s USING (orden, campo)
WHERE NOT list_contains((SELECT list(orden) FROM rechazados), a.de)
  AND list_has_all((SELECT list(orden) FROM rechazados), a.despues)"""
CTES["aceptados"] = "SELECT * FROM revision WHERE errores = '' AND orden NOT IN (SELECT orden FROM choques)"
CTES["cambios"] = CTES["plegados"].replace("FROM pedidos", "FROM aceptados")

# --------------------------------------------------------------------------- statements

LEGACY_COLUMNS = re.findall(r"AS (\w+)(?:,\n|\nFROM)", LEGACY_SELECT)
LEGACY_TYPES = {
    "int": "id expediente nacionalidad depto_nac lugar_nacimiento estado_civil educacion pueblo "
    "idioma municipio depto parentesco telefono_responsable exp_madre exp_ref",
    "bigint": "dpi dpi_responsable",
    "date": "nacimiento",
    "timestamp_ntz": "created_at update_at",
}
TYPE_OF = {c: t for t, names in LEGACY_TYPES.items() for c in names.split()}
LEGACY_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}"
    if c == "nacimiento"
    else f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
    if c in ("created_at", "update_at")
    else c
    for c in LEGACY_COLUMNS
)
LEGACY_ISO = LEGACY_TEXT.replace("'%Y-%m-%d %H:%M:%S'", "'%Y-%m-%dT%H:%M:%S'")


def legacy(expr: str) -> str:
    return f"SELECT id, {expr} FROM legacy"


def target(expr: str) -> str:
    return f"SELECT id, {expr} FROM mig"


def brief(where: str = "true", tail: str = "") -> str:
    return f"SELECT {BRIEF} FROM resp WHERE {where} {tail}"


def doc(**fields: str) -> str:
    return "CAST(to_json({" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}) AS VARCHAR)"


SEARCH = (
    "expediente ILIKE '%1%' AND (primer_nombre ILIKE '%juan%' OR segundo_nombre ILIKE '%juan%' "
    "OR otros_nombres ILIKE '%juan%') AND (primer_apellido ILIKE '%pérez%' "
    "OR segundo_apellido ILIKE '%pérez%') AND sexo = 'M' AND estado = 'V' "
    "AND nacimiento BETWEEN DATE '1940-01-01' AND DATE '2015-12-31'"
)
NAMED = "(primer_nombre ILIKE '{0}' OR segundo_nombre ILIKE '{0}' OR otros_nombres ILIKE '{0}') AND (primer_apellido ILIKE '{1}' OR segundo_apellido ILIKE '{1}')"
MINORS = f"nacimiento BETWEEN DATE '2006-06-30' AND {AS_OF}"
STATS = """
SELECT (SELECT count(*) FROM {source}) AS total_procesados,
    (SELECT count(*) FROM {source}) - (SELECT count(*) FROM {errors}) AS total_exitosos,
    (SELECT count(*) FROM {errors}) AS total_errores,
    (SELECT count(*) FROM {warnings}) AS total_advertencias,
    (SELECT count(*) FROM {source} WHERE repetido) AS expedientes_duplicados,
    (SELECT count(*) FROM {warnings}) AS cui_invalidos"""
CHECK = """
count(*) AS total_registros, 37 AS total_columnas,
count(*) FILTER (WHERE expediente IS NULL) AS expedientes_nulos,
(SELECT count(*) FROM (SELECT expediente FROM legacy WHERE expediente IS NOT NULL
    GROUP BY expediente HAVING count(*) > 1)) AS expedientes_duplicados,
count(*) FILTER (WHERE length(CAST(dpi AS VARCHAR)) <> 13) AS cui_invalidos"""
LEGACY_RULES = cases(
    ("coalesce(nombre, '') = '' AND coalesce(apellido, '') = ''",
     "Debe tener al menos nombre o apellido"),
    (f"created_at > {NOW}", "Fecha de creación no puede ser futura"),
    ("(coalesce(fecha_defuncion, '') <> '') <> coalesce(estado IN ('F', 'FALLECIDO'), false)",
     "Inconsistencia: fecha de defunción no coincide con estado"),
)
BAD_BIRTH = (
    "fecha_defuncion IS NOT NULL AND NOT (regexp_full_match(fecha_defuncion, "
    r"'\d{4}-\d{1,2}-\d{1,2}') AND TRY_CAST(fecha_defuncion AS DATE) IS NOT NULL)"
)
DELETED = "(SELECT c_custkey * 13 AS id FROM customer)"
UPDATED = """
SELECT s.id, s.expediente, CASE WHEN u.da_cui THEN u.cui ELSE s.cui END AS cui,
    CASE WHEN u.da_pasaporte THEN u.pasaporte ELSE s.pasaporte END AS pasaporte,
    CASE WHEN u.da_sexo THEN u.sexo ELSE s.sexo END AS sexo,
    CASE WHEN u.da_estado THEN u.estado ELSE s.estado END AS estado,
    CASE WHEN u.da_contacto THEN {digits} ELSE s.telefono_principal END AS telefono,
    CASE WHEN u.da_contacto THEN NULL ELSE s.email END AS email,
    CASE WHEN u.id IS NOT NULL THEN '2024-06-30 00:00:00' ELSE s.actualizado_en END
        AS actualizado_en
FROM cargadas s LEFT JOIN cambios u ON u.id = s.id"""


def split_errors(key: str, source: str) -> str:
    """One row per error of a joined list."""
    return (
        f"SELECT {key}, split_part(e, ': ', 1) AS campo, "
        f"substr(e, length(split_part(e, ': ', 1)) + 3) AS mensaje "
        f"FROM (SELECT {key}, unnest(string_split(errores, '|')) AS e "
        f"FROM {source} WHERE errores <> '')"
    )


BODIES = {
    # sources
    "scan_legacy": f"SELECT {LEGACY_TEXT} FROM legacy",
    "scan_batch": "SELECT id, expediente, nombre, dpi FROM legacy ORDER BY id LIMIT 500 OFFSET 12300",
    "scan_batch_after": "SELECT id, expediente, dpi FROM legacy WHERE id > 777 ORDER BY id LIMIT 100",
    "scan_target": f"SELECT {FLAT} FROM mig",
    "append_target": "SELECT estado, sexo, count(*) AS filas, CAST(sum(id) AS BIGINT) AS suma_id "
    "FROM mig GROUP BY estado, sexo",
    "table_count": "SELECT count(*) AS total FROM legacy",
    "table_info": "SELECT posicion, columna, tipo, (SELECT count(*) FROM legacy) AS total_registros "
    "FROM (VALUES "
    + ", ".join(
        f"({i}, '{c}', '{TYPE_OF.get(c, 'string')}')" for i, c in enumerate(LEGACY_COLUMNS, 1)
    )
    + ") v(posicion, columna, tipo)",
    "counts_by_system": "SELECT (SELECT count(*) FROM legacy) AS origen_total, "
    "(SELECT count(*) FROM stored) AS destino_total",
    # normalisers
    "normalize_cui": legacy(
        "CASE WHEN regexp_full_match(CAST(dpi AS VARCHAR), '[0-9]{13}') THEN dpi END AS cui"
    ),
    "normalize_expediente": legacy(
        "coalesce(CAST(nullif(expediente, 0) AS VARCHAR), concat('DUP-', id)) AS expediente"
    ),
    "is_expediente_invalid": legacy("coalesce(expediente, 0) = 0 AS invalido"),
    "normalize_sexo": "SELECT CAST(id AS INT) AS id, sexo FROM mig",
    "normalize_estado": "SELECT CAST(id AS INT) AS id, estado FROM mig",
    "normalize_email": "SELECT CAST(id AS INT) AS id, email FROM mig",
    "parse_fecha_defuncion": "SELECT CAST(id AS INT) AS id, fecha_hora FROM mig",
    "split_nombres": "SELECT CAST(id AS INT) AS id, primer_nombre, segundo_nombre, otros_nombres FROM mig",
    "split_apellidos": "SELECT CAST(id AS INT) AS id, primer_apellido, segundo_apellido FROM mig",
    "clean_telefono": legacy(f"nullif({digits('telefono')}, '') AS telefono"),
    # documents
    "nombre_doc": f"SELECT CAST(id AS INT) AS id, {', '.join(NAMES)} FROM mig",
    "contacto_doc": "SELECT CAST(id AS INT) AS id, telefono_principal, email, con_direccion, linea1, "
    "municipio_id, departamento_id FROM mig",
    "referencias_doc": target(
        "padre, madre, expediente_madre, con_responsable, resp_nombre, resp_parentesco_id, "
        "resp_cui, resp_telefono, resp_expediente, conyugue, es_gemelo"
    ),
    "datos_extra_doc": "SELECT CAST(id AS INT) AS id, nacionalidad_id, departamento_nacimiento_id, "
    "lugar_nacimiento_id, estado_civil_id, pueblo_id, idioma_id, educacion_id, ocupacion, "
    "fecha_hora FROM mig",
    "metadatos_doc": "SELECT CAST(id AS INT) AS id, sistema_origen, id_origen, creado_por, "
    "migrado_en, version_migracion, expediente_duplicado, notas FROM mig",
    "documents_to_json": "SELECT id, "
    + doc(**{f: f for f in NAMES})
    + " AS nombre, "
    + doc(
        telefono_principal="telefono_principal",
        telefono_secundario="NULL",
        email="email",
        direccion="CASE WHEN con_direccion THEN {'linea1': linea1, 'linea2': NULL, "
        "'municipio_id': municipio_id, 'departamento_id': departamento_id} END",
    )
    + " AS contacto, "
    + doc(
        padre="padre",
        madre="madre",
        expediente_madre="expediente_madre",
        responsable="CASE WHEN con_responsable THEN {'nombre': resp_nombre, 'parentesco_id': "
        "resp_parentesco_id, 'cui': resp_cui, 'telefono': resp_telefono, 'expediente': "
        "resp_expediente} END",
        conyugue="conyugue",
        es_gemelo="es_gemelo",
    )
    + " AS referencias, "
    + doc(
        demograficos="{'nacionalidad_id': nacionalidad_id, 'departamento_nacimiento_id': "
        "departamento_nacimiento_id, 'lugar_nacimiento_id': lugar_nacimiento_id, "
        "'estado_civil_id': estado_civil_id, 'pueblo_id': pueblo_id, 'idioma_id': idioma_id}",
        socioeconomicos="{'educacion_id': educacion_id, 'ocupacion': ocupacion}",
        defuncion="CASE WHEN fecha_hora IS NOT NULL THEN {'fecha_hora': fecha_hora, "
        "'lugar': NULL, 'causa': NULL} END",
        notas_clinicas="NULL",
    )
    + " AS datos_extra, "
    + doc(
        **{
            f: f
            for f in (
                "sistema_origen",
                "id_origen",
                "creado_por",
                "migrado_en",
                "version_migracion",
                "expediente_duplicado",
                "notas",
            )
        }
    )
    + " AS metadatos FROM mig",
    "documents_from_json": f"SELECT {FLAT} FROM mig",
    "json_field_text": target(
        "primer_apellido, CASE WHEN expediente_duplicado THEN 'true' ELSE 'false' END AS duplicado, "
        "CAST(municipio_id AS VARCHAR) AS municipio"
    ),
    "json_contains": target(
        "coalesce(primer_apellido = 'Pérez', false) AS es_perez, "
        "coalesce(con_responsable AND resp_parentesco_id = 1 AND es_gemelo, false) "
        "AS gemelo_con_responsable, fecha_hora IS NULL AS sin_defuncion, false AS campo_ajeno"
    ),
    # derived columns
    "nombre_completo": "SELECT id, nombre_completo FROM resp",
    "nombre_completo_legacy": legacy(
        "coalesce(nullif(concat_ws(' ', nullif(nombre, ''), nullif(apellido, '')), ''), "
        "'Sin nombre') AS nombre_completo"
    ),
    "edad": "SELECT id, edad FROM resp",
    "mayor_de_edad": "SELECT id, edad >= 18 AS mayor, edad < 18 AS menor FROM resp",
    "fallecido": target("estado = 'F' AS fallecido"),
    "fallecido_legacy": legacy("coalesce(upper(estado) IN ('F', 'FALLECIDO'), false) AS fallecido"),
    "tiene_cui_valido": legacy(
        "coalesce(dpi <> 0 AND length(CAST(dpi AS VARCHAR)) = 13, false) AS valido"
    ),
    "tiene_expediente": legacy("coalesce(expediente > 0, false) AS tiene"),
    "tiene_datos_defuncion": legacy("coalesce(fecha_defuncion, '') <> '' AS tiene"),
    "es_gemelo": legacy(f"coalesce(upper(gemelo) IN {YES}, false) AS gemelo"),
    "contacto_accessors": target("telefono_principal, email, linea1 AS direccion_linea1"),
    "metadatos_accessors": target("expediente_duplicado, id_origen"),
    "export_target": "SELECT id, expediente, cui, pasaporte, primer_nombre, sexo, fecha_nacimiento, "
    "email, padre, ocupacion, estado, id_origen, "
    "strftime(created_at, '%Y-%m-%dT%H:%M:%S-06:00') AS creado_en, "
    "strftime(created_at, '%Y-%m-%dT%H:%M:%S-06:00') AS actualizado_en, nombre_completo, edad, "
    "edad >= 18 AS mayor_de_edad, estado = 'F' AS fallecido FROM resp",
    "export_legacy": f"SELECT {LEGACY_ISO}, coalesce(nullif(concat_ws(' ', nullif(nombre, ''), "
    "nullif(apellido, '')), ''), 'Sin nombre') AS nombre_completo, "
    "coalesce(length(CAST(dpi AS VARCHAR)) = 13, false) AS cui_valido, "
    "coalesce(upper(estado) IN ('F', 'FALLECIDO'), false) AS fallecido, "
    f"coalesce(upper(gemelo) IN {YES}, false) AS es_gemelo_flag FROM legacy",
    "enrich_response": brief(),
    # rules
    "validar_cui": legacy(
        f"{cui_message('dpi')} AS mensaje, ({cui_message('dpi')}) IS NULL AS es_valido"
    ),
    "cui_check_digit": target(
        f"{expected_digit('cui')} AS esperado, {check_message('cui')} AS mensaje"
    ),
    "validar_pasaporte": target(f"{passport_message('pasaporte')} AS mensaje"),
    "validar_expediente": target(f"{file_message('expediente')} AS mensaje"),
    "validar_identificadores": f"SELECT id, NOT ({IDS_BAD}) AS valido, {IDS} AS errores FROM "
    "(SELECT id, CAST(expediente AS VARCHAR) AS x, dpi AS y, pasaporte AS z FROM legacy)",
    "validar_nombre": target(f"{NOMBRE} AS errores"),
    "validar_sexo": legacy(
        cases(("coalesce(sexo, '') NOT IN ('M', 'F', 'NF')", "Sexo debe ser uno de: M, F, NF"))
        + " AS errores"
    ),
    "validar_fecha_nacimiento": target(f"{BIRTH} AS errores"),
    "validar_contacto": target(f"{CONTACTO} AS errores, {CONTACTO_LOCAL} AS con_telefono_local"),
    "validar_estado": legacy(
        cases(("coalesce(estado, '') NOT IN ('V', 'F')", "Estado debe ser uno de: V, F"))
        + " AS errores"
    ),
    "validar_referencias": target(f"{REFS} AS errores"),
    "validar_datos_extra": target(f"{DEATH} AS errores"),
    "validar_legacy": legacy(f"{LEGACY_RULES} AS errores"),
    "validar_paciente_completo": f"SELECT *, {' AND '.join(f + chr(32) + '=' + chr(39) * 2 for f in FIELDS)}"
    f" AS es_valido FROM ({COMPLETE})",
    "error_summary": "SELECT campo, mensaje, count(*) AS filas FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS campo, unnest(string_split({f}, '|')) AS mensaje FROM ({COMPLETE}) "
        f"WHERE {f} <> ''"
        for f in FIELDS
    )
    + ") GROUP BY campo, mensaje",
    # contract
    "schema_nombre": "SELECT fila, "
    + listed(
        [
            name_field("primer_nombre", "primer_nombre", True),
            name_field("segundo_nombre", "segundo_nombre", False),
            name_field("primer_apellido", "primer_apellido", True),
        ]
    )
    + f" AS errores, {strip('primer_nombre')} AS primer_nombre FROM candidatos",
    "schema_direccion": target(f"{listed(address_fields('', 'con_direccion'))} AS errores"),
    "schema_contacto": "SELECT fila, "
    + listed(
        [
            phone_field("telefono_principal", "telefono"),
            email_field("email", "email"),
            *CANDIDATE_FIELDS[10:12],
        ]
    ).replace("'contacto -> direccion", "'direccion")
    + f" AS errores, {digits('telefono')} AS telefono, split_part(email, '@', 1) || '@' || "
    "lower(split_part(email, '@', -1)) AS email FROM candidatos",
    "schema_responsable": target(f"{listed(person_fields(''))} AS errores"),
    "schema_referencias": target(f"{listed(family_fields(''))} AS errores"),
    "schema_datos_extra": target(f"{listed(extra_fields(''))} AS errores"),
    "schema_metadatos": target(f"{listed(meta_fields(''))} AS errores"),
    "schema_paciente": "SELECT fila, CASE WHEN e <> '' THEN e ELSE coalesce(': ' || "
    f"{NO_ID}, '') END AS errores FROM (SELECT *, "
    + listed(
        [
            EXP_FIELD,
            cui_field("cui", "cui"),
            PASS_FIELD,
            SEXO_FIELD,
            birth_field("fecha_nacimiento"),
            ESTADO_FIELD,
        ]
    )
    + " AS e FROM candidatos)",
    "schema_defuncion_coherente": target(f"{DEATH_RULE} AS mensaje"),
    "schema_update": f"SELECT orden, {listed([*UPDATE_FIELDS, NULL_ESTADO])} AS errores FROM pedidos",
    "response_conformance": "SELECT campo, mensaje, count(*) AS filas FROM ("
    + split_errors(
        "id",
        f"(SELECT id, CASE WHEN e <> '' THEN e ELSE coalesce(': ' || {DEATH_RULE}, '') END "
        f"AS errores FROM (SELECT *, {listed(RESPONSE_FIELDS)} AS e FROM mig))",
    )
    + ") GROUP BY campo, mensaje",
    # quality
    "null_expedientes": "SELECT count(*) FILTER (WHERE expediente IS NULL) AS expedientes_nulos FROM legacy",
    "duplicate_expedientes": "SELECT expediente, count(*) AS cantidad FROM legacy "
    "WHERE expediente IS NOT NULL GROUP BY expediente HAVING count(*) > 1",
    "invalid_cui_count": "SELECT count(*) AS cui_invalidos FROM legacy WHERE dpi IS NOT NULL "
    "AND length(CAST(dpi AS VARCHAR)) <> 13",
    "source_check": f"SELECT {CHECK} FROM legacy",
    "referential_integrity": """
SELECT id, campo, valor, concat('Expediente de ', quien, ' ', valor, ' no existe') AS mensaje
FROM (SELECT id, 'exp_madre' AS campo, 'madre' AS quien, exp_madre AS valor FROM legacy
    UNION ALL SELECT id, 'exp_ref', 'referencia', exp_ref FROM legacy)
WHERE valor <> 0
    AND valor NOT IN (SELECT expediente FROM legacy WHERE expediente IS NOT NULL)""",
    "mother_chains": """
SELECT * FROM (WITH RECURSIVE dado AS (SELECT expediente::BIGINT AS hijo, coalesce(exp_madre, CASE WHEN expediente % 1000 < 20 THEN expediente + CASE WHEN expediente % 20 = 19 THEN -19 ELSE 1 END
        WHEN expediente % 7 > 0 THEN expediente - expediente % 7 - 1 + expediente % 2 END)::BIGINT AS madre FROM legacy),
paso AS (SELECT hijo, min(madre) AS madre FROM dado WHERE hijo <> 0 AND madre <> 0 GROUP BY hijo),
camino AS (SELECT hijo, [hijo] AS visto, madre AS a FROM paso
    UNION ALL SELECT c.hijo, list_append(visto, c.a), p.madre FROM camino c JOIN paso p ON p.hijo = c.a WHERE NOT list_contains(visto, c.a)),
fin AS (SELECT hijo, arg_max(visto, len(visto)) AS visto, arg_max(a, len(visto)) AS a FROM camino GROUP BY hijo)
SELECT hijo AS expediente, CASE WHEN NOT ciclo THEN a END AS raiz, CASE WHEN NOT ciclo THEN len(visto) END AS pasos,
    CASE WHEN NOT ciclo THEN a IN (SELECT hijo FROM dado WHERE hijo <> 0) END AS raiz_existe,
    CASE WHEN ciclo THEN list_min(visto[list_position(visto, a):]) END AS ciclo
FROM (SELECT *, list_contains(visto, a) AS ciclo FROM fin))""",
    "unique_violations": "SELECT id, campo, clave, primera FROM primeras WHERE id > primera",
    "check_violations": """
SELECT fila AS id, 'check_sexo' AS restriccion FROM candidatos WHERE sexo NOT IN ('M', 'F', 'NF')
UNION ALL SELECT fila, 'estado_not_null' FROM candidatos WHERE estado IS NULL""",
    "identifier_exists": """
SELECT fila, EXISTS (SELECT 1 FROM mig m WHERE m.expediente = c.expediente AND c.expediente <> '')
    OR EXISTS (SELECT 1 FROM mig m WHERE m.cui = c.cui AND c.cui <> 0)
    OR EXISTS (SELECT 1 FROM mig m WHERE m.pasaporte = c.pasaporte AND c.pasaporte <> '') AS existe
FROM candidatos c""",
    "identifiers_available": """
SELECT id,
    expediente = '' OR count(*) OVER (PARTITION BY expediente) = 1 AS expediente_disponible,
    cui IS NULL OR count(*) OVER (PARTITION BY cui) = 1 AS cui_disponible,
    coalesce(pasaporte, '') = '' OR count(*) OVER (PARTITION BY pasaporte) = 1
        AS pasaporte_disponible
FROM mig""",
    # lookups
    "by_id": f"SELECT {FLAT} FROM mig WHERE id = 1001",
    "by_ids": brief("id IN (SELECT c_custkey * 3 FROM customer)"),
    "exists_id": "SELECT c_custkey * 13 AS id, c_custkey * 13 IN (SELECT id FROM mig) AS existe FROM customer",
    "by_expediente": brief("expediente = '100321'"),
    "by_cui": "SELECT 'valido' AS pedido, id, cui FROM mig WHERE cui = 1000000000009",
    "by_pasaporte": brief("pasaporte = 'GT120'"),
    "search": page(SEARCH, 2, 20),
    "search_all": brief(SEARCH),
    "search_nombre_completo": brief(
        "concat_ws(chr(10), primer_nombre, segundo_nombre, primer_apellido, segundo_apellido) "
        "ILIKE '%garcía%'",
        "ORDER BY id LIMIT 20",
    ),
    "search_text_index": " UNION ALL ".join(
        f"SELECT {BRIEF}, '{name}' AS pedido FROM resp WHERE {where}"
        for name, where in {
            "nombres": NAMED.format("%JUAN%", "%pérez%"),
            "comodin": NAMED.format("%mar%a%", "%garc_a%") + " AND sexo = 'F'",
            "corto": "expediente ILIKE '%12%' AND (primer_apellido ILIKE '%ez%' OR segundo_apellido ILIKE '%ez%')",
        }.items()
    ),
    "search_nombre_text_index": brief(
        "concat_ws(chr(10), primer_nombre, segundo_nombre, primer_apellido, segundo_apellido) "
        "ILIKE '%garcía%'",
        "ORDER BY id LIMIT 20",
    ),
    "fallecidos": brief("estado = 'F'"),
    "por_sexo": brief("sexo = 'NF'"),
    "por_rango_edad": brief("nacimiento BETWEEN DATE '1983-06-30' AND DATE '2006-06-30'"),
    "menores": brief(MINORS),
    "menores_page": page(MINORS, 3, 25, "nacimiento > DATE '2006-06-30'"),
    "sin_cui": brief("cui IS NULL"),
    "expedientes_duplicados": brief("expediente_duplicado"),
    "migrados": brief("sistema_origen = 'mysql_legacy'"),
    "list_page": page("true", 4, 50),
    "list_page_deep": page("true", 100, 100),
    "paginate": "SELECT n AS total, page, page_size, (n + page_size - 1) // page_size AS total_pages "
    "FROM (SELECT count(*) AS n FROM mig WHERE estado = 'F'), "
    "(VALUES (1, 100), (1000000, 7)) v(page, page_size)",
    # aggregates
    "count": "SELECT count(*) AS total FROM mig",
    "estadisticas": """
SELECT count(*) AS total_pacientes, count(*) FILTER (WHERE sexo = 'M') AS masculino,
    count(*) FILTER (WHERE sexo = 'F') AS femenino,
    count(*) FILTER (WHERE sexo NOT IN ('M', 'F')) AS no_especificado,
    count(*) FILTER (WHERE estado <> 'F') AS vivos,
    count(*) FILTER (WHERE estado = 'F') AS fallecidos,
    count(*) FILTER (WHERE cui IS NULL) AS sin_cui,
    count(*) FILTER (WHERE expediente_duplicado) AS expedientes_duplicados,
    count(*) FILTER (WHERE sistema_origen = 'mysql_legacy') AS registros_migrados,
    count(*) FILTER (WHERE sistema_origen <> 'mysql_legacy') AS registros_nuevos
FROM mig""",
    "estadisticas_counters": f"""
SELECT count(*) AS total_pacientes, count(*) FILTER (WHERE sexo = 'M') AS masculino,
    count(*) FILTER (WHERE sexo = 'F') AS femenino,
    count(*) FILTER (WHERE sexo NOT IN ('M', 'F')) AS no_especificado,
    count(*) FILTER (WHERE estado <> 'F') AS vivos,
    count(*) FILTER (WHERE estado = 'F') AS fallecidos,
    count(*) FILTER (WHERE cui IS NULL) AS sin_cui,
    count(*) FILTER (WHERE expediente_duplicado) AS expedientes_duplicados,
    count(*) FILTER (WHERE sistema_origen = 'mysql_legacy') AS registros_migrados,
    count(*) FILTER (WHERE sistema_origen <> 'mysql_legacy') AS registros_nuevos
FROM cargadas WHERE id NOT IN {DELETED}""",
    "breakdown_counters": f"""
SELECT concat_ws(',', CASE WHEN grouping(sexo) = 0 THEN 'sexo' END, CASE WHEN grouping(estado) = 0 THEN 'estado' END,
    CASE WHEN grouping(migrado) = 0 THEN 'migrado' END) AS nivel, sexo, estado, migrado, count(*) AS total
FROM (SELECT sexo, estado, coalesce(sistema_origen = 'mysql_legacy', false) AS migrado FROM cargadas WHERE id NOT IN {DELETED})
GROUP BY GROUPING SETS ((), (sexo), (estado), (migrado), (sexo, estado))""",
    "migration_status": """
SELECT o AS origen_total, d AS destino_total, d AS migrados, d - d AS nuevos,
    round_even(CAST(d AS DOUBLE) / o * 100, 2) AS porcentaje_migrado, o - d AS pendientes,
    d >= o AS completado
FROM (SELECT (SELECT count(*) FROM legacy) AS o, (SELECT count(*) FROM stored) AS d)""",
    "total_menores": "SELECT count(*) AS total_menores FROM mig WHERE nacimiento > DATE '2006-06-30'",
    "total_fallecidos": "SELECT count(*) AS total_fallecidos FROM mig WHERE estado = 'F'",
    "total_sin_cui": "SELECT count(*) AS total_sin_cui FROM mig WHERE cui IS NULL",
    # migration
    "transform": f"SELECT {FLAT} FROM mig",
    "warnings": "SELECT id_origen AS id_mysql, expediente_origen AS expediente, 'CUI_INVALIDO' AS tipo, "
    f"concat('CUI/DPI inválido: ', dpi) AS mensaje, {MOMENT} AS \"timestamp\" FROM avisos",
    "transform_errors": f"""
SELECT id AS id_mysql, expediente, CASE WHEN {BAD_BIRTH}
    THEN concat('nacimiento: ', fecha_defuncion, ' no es date')
    ELSE 'municipio: sin dato no es int' END AS error, 'ValueError' AS tipo,
    {MOMENT} AS "timestamp"
FROM legacy WHERE ({BAD_BIRTH}) OR id % 101 = 0""",
    "load_errors": f"""
SELECT p.id_origen AS id_mysql, p.expediente, string_agg(DISTINCT c.campo
    || CASE WHEN en_destino THEN ' ya existe' ELSE ' duplicado' END, '; '
    ORDER BY c.campo || CASE WHEN en_destino THEN ' ya existe' ELSE ' duplicado' END) AS error,
    'COMMIT_ERROR' AS tipo, {MOMENT} AS "timestamp"
FROM conflictos c JOIN pendientes p USING (id) WHERE en_destino OR repetida GROUP BY ALL""",
    "migrate_batch": """
SELECT * FROM (SELECT count(*) AS procesados, count(*) FILTER (WHERE NOT malo) AS exitosos,
    count(*) FILTER (WHERE malo) AS errores, 900 AS offset_siguiente, NULL AS mensaje
FROM (SELECT id, bool_or(id > primera) AS malo FROM (
    SELECT id, min(id) OVER (PARTITION BY campo, clave) AS primera FROM claves
    WHERE id IN (SELECT id FROM legacy ORDER BY id LIMIT 400 OFFSET 500)) GROUP BY id))
UNION ALL SELECT count(*), 0, 0, NULL, 'No hay más registros' FROM legacy WHERE false""",
    "migrate_all": f"SELECT * REPLACE (row_number() OVER (ORDER BY id) AS id) FROM (SELECT {FLAT} FROM cargadas)",
    "batch_summary": """
SELECT (n - 1) // 100 + 1 AS lote, count(*) AS procesados,
    count(*) FILTER (WHERE NOT malo) AS exitosos, count(*) FILTER (WHERE malo) AS errores
FROM (SELECT row_number() OVER (ORDER BY id) AS n, id IN (SELECT id FROM rechazos) AS malo FROM mig)
GROUP BY lote""",
    "migration_stats": STATS.format(source="mig", errors="rechazos", warnings="avisos"),
    "report_top_errors": """
SELECT * FROM (SELECT 'ERROR' AS seccion, CAST(id AS INT) AS id_mysql, 'COMMIT_ERROR' AS tipo,
    error AS texto, greatest((SELECT count(*) FROM rechazos) - 10, 0) AS restantes
    FROM rechazos ORDER BY id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'ADVERTENCIA', id_origen, 'CUI_INVALIDO',
    concat('CUI/DPI inválido: ', dpi), greatest((SELECT count(*) FROM avisos) - 10, 0)
    FROM avisos ORDER BY id LIMIT 10)""",
    "validar_origen": f"SELECT {CHECK}, count(*) FILTER (WHERE {LEGACY_RULES} <> '') "
    "AS filas_con_problemas FROM legacy",
    "resume": "SELECT id_origen AS id, expediente_origen AS expediente FROM pendientes",
    # writes
    "create_rows": f"""
SELECT (SELECT max(id) FROM cargadas) + row_number() OVER (ORDER BY fila) AS id, expediente, cui,
    pasaporte, {strip("primer_nombre")} AS primer_nombre, sexo, {digits("telefono")} AS telefono,
    split_part(email, '@', 1) || '@' || lower(split_part(email, '@', -1)) AS email, estado,
    '2024-06-30 00:00:00' AS creado_en
FROM revisados WHERE errores = '' AND fila NOT IN (SELECT fila FROM tomadas)""",
    "create_rows_rejected": split_errors("fila", "revisados")
    + " UNION ALL SELECT fila, 'identificadores', "
    "'Ya existe un paciente con alguno de estos identificadores' FROM tomadas",
    "fold_updates": "SELECT id, concat_ws(',', CASE WHEN da_contacto THEN 'contacto' END, "
    "CASE WHEN da_cui THEN 'cui' END, CASE WHEN da_estado THEN 'estado' END, "
    "CASE WHEN da_pasaporte THEN 'pasaporte' END, CASE WHEN da_sexo THEN 'sexo' END) AS campos, "
    "cui, pasaporte, sexo, estado, telefono FROM plegados",
    "update_rows": UPDATED.format(digits=digits("u.telefono")),
    "update_rows_rejected": "SELECT id, orden, 'id' AS campo, 'Paciente no encontrado' AS mensaje "
    "FROM pedidos WHERE id NOT IN (SELECT id FROM cargadas) UNION ALL "
    + split_errors("id, orden", "revision")
    + " UNION ALL SELECT id, orden, campo, 'Identificador no disponible' FROM choques",
    "delete_rows": f"SELECT id, expediente FROM cargadas WHERE id NOT IN {DELETED}",
    "delete_rows_missing": "SELECT DISTINCT id, 'id' AS campo, 'Paciente no encontrado' AS mensaje "
    f"FROM {DELETED} WHERE id NOT IN (SELECT id FROM cargadas)",
}
# The second run of two: what the first refused, against what it loaded.
BODIES["migrate_and_resume"] = (
    f"SELECT *, 1 AS corrida FROM ({BODIES['migration_stats']}) UNION ALL SELECT *, 2 FROM ("
    + STATS.format(
        source="(SELECT * FROM mig SEMI JOIN rechazos USING (id))",
        errors="""(SELECT DISTINCT id FROM (SELECT k.id, d.clave IS NOT NULL
    OR k.id > min(k.id) OVER (PARTITION BY k.campo, k.clave) AS malo
    FROM claves k SEMI JOIN rechazos USING (id)
    LEFT JOIN (SELECT DISTINCT campo, clave FROM claves SEMI JOIN cargadas USING (id)) d
        USING (campo, clave)) WHERE malo)""",
        warnings="(SELECT * FROM avisos SEMI JOIN rechazos USING (id))",
    )
    + ")"
)

# Loose text: rows with a value that fits no column, and what the others do among themselves.
_BAD = f"(id % 211 = 0 OR id % 103 = 0 OR ({BAD_BIRTH}) OR id % 101 = 0 OR (id % 79 = 0 AND depto IS NOT NULL))"
CTES["copias"] = "SELECT id, CASE WHEN id % 89 = 0 THEN 3 WHEN id % 83 = 0 THEN 2 ELSE 1 END AS n FROM legacy"
CTES["malas"] = f"""
SELECT id, CASE WHEN id % 211 = 0 THEN NULL ELSE id END AS id_mysql, expediente,
    CASE WHEN id % 211 = 0 THEN concat('id: x-', id, ' no es int')
        WHEN id % 103 = 0 THEN 'dpi: sin dpi no es bigint'
        WHEN {BAD_BIRTH} THEN concat('nacimiento: ', fecha_defuncion, ' no es date')
        WHEN id % 101 = 0 THEN 'municipio: sin dato no es int'
        ELSE concat('depto: ', CAST(depto + 0.5 AS DOUBLE), ' no es int') END AS error
FROM legacy WHERE {_BAD}"""
CTES["rechazos_buenas"] = """
SELECT id, string_agg(campo || ' duplicado', '; ' ORDER BY campo) AS error
FROM (SELECT k.*, min(id) OVER (PARTITION BY campo, clave) AS primera
    FROM claves k ANTI JOIN malas USING (id)) WHERE id > primera GROUP BY id"""
# Those refused for a value they share with a row that was not loaded itself pass the second time.
CTES["segundas"] = """
SELECT id FROM (SELECT k.id, d.clave IS NOT NULL
        OR k.id > min(k.id) OVER (PARTITION BY k.campo, k.clave) AS malo
    FROM claves k SEMI JOIN rechazos_buenas USING (id)
    LEFT JOIN (SELECT DISTINCT campo, clave FROM claves ANTI JOIN malas USING (id)
        ANTI JOIN rechazos_buenas USING (id)) d USING (campo, clave)) GROUP BY id HAVING bool_or(malo)"""
# Rows come in copies; of those of a good row one counts, the others repeat its id.
_COUNTERS = """
SELECT CAST(p AS BIGINT) AS total_procesados, CAST(p - e AS BIGINT) AS total_exitosos, CAST(e AS BIGINT) AS total_errores,
    CAST(a AS BIGINT) AS total_advertencias, CAST(d AS BIGINT) AS expedientes_duplicados, CAST(a AS BIGINT) AS cui_invalidos, {run} AS corrida
FROM (SELECT (SELECT coalesce(sum(n), 0) FROM {source} JOIN copias USING (id)) AS p,
    (SELECT coalesce(sum(n), 0) FROM malas JOIN copias USING (id)) + (SELECT count(*) FROM {rejected})
        + (SELECT coalesce(sum(n - 1), 0) FROM {source} ANTI JOIN malas USING (id) JOIN copias USING (id)) AS e,
    (SELECT coalesce(sum(n), 0) FROM {source} ANTI JOIN malas USING (id) JOIN copias USING (id)
        WHERE dpi IS NOT NULL AND cui IS NULL) AS a,
    (SELECT coalesce(sum(n), 0) FROM {source} JOIN copias USING (id) WHERE repetido) AS d)"""
BODIES["migrate_broken"] = (
    _COUNTERS.format(source="mig", rejected="rechazos_buenas", run=1)
    + " UNION ALL "
    + _COUNTERS.format(
        source="(SELECT * FROM mig WHERE id IN (SELECT id FROM malas UNION ALL SELECT id FROM rechazos_buenas))",
        rejected="segundas",
        run=2,
    )
)
BODIES["migrate_broken_errors"] = """
SELECT id_mysql, CAST(expediente AS VARCHAR) AS expediente, error, 'ValueError' AS tipo
FROM (SELECT m.*, unnest(range(n)) FROM malas m JOIN copias USING (id))
UNION ALL SELECT m.id, m.expediente, r.error, 'COMMIT_ERROR' FROM rechazos_buenas r JOIN mig m USING (id)
UNION ALL SELECT id, expediente, 'id duplicado', 'COMMIT_ERROR'
FROM (SELECT m.id, m.expediente, unnest(range(n - 1)) FROM mig m ANTI JOIN malas USING (id) JOIN copias USING (id))"""
BODIES["batch_summary_broken"] = """
SELECT lote, CAST(sum(n) AS BIGINT) AS procesados, CAST(sum(n - fallos) AS BIGINT) AS exitosos, CAST(sum(fallos) AS BIGINT) AS errores
FROM (SELECT CASE WHEN id % 211 = 0 THEN 0
        ELSE (row_number() OVER (PARTITION BY id % 211 = 0 ORDER BY id) - 1) // 100 + 1 END AS lote, n,
    CASE WHEN id IN (SELECT id FROM malas) THEN n
        ELSE n - 1 + CASE WHEN id IN (SELECT id FROM rechazos_buenas) THEN 1 ELSE 0 END END AS fallos
    FROM mig JOIN copias USING (id))
GROUP BY lote"""
CTES["vivas"] = "SELECT * FROM cargadas WHERE id % 13 <> 0 OR id % 39 = 0"
BODIES["identifier_index"] = """
SELECT fila, EXISTS (SELECT 1 FROM vivas m WHERE m.expediente = c.expediente AND c.expediente <> '')
    OR EXISTS (SELECT 1 FROM vivas m WHERE m.cui = c.cui AND c.cui <> 0)
    OR EXISTS (SELECT 1 FROM vivas m WHERE m.pasaporte = c.pasaporte AND c.pasaporte <> '') AS existe
FROM candidatos c"""
BODIES["migrate_stream"] = f"SELECT CAST(0 AS BIGINT) AS lote, * FROM ({BODIES['migration_stats']})"
BODIES["refresh_changed"] = """
SELECT id, expediente, cui, pasaporte, CASE WHEN id % 6 = 1 THEN 'Nueva' ELSE primer_nombre END AS primer_nombre
FROM cargadas"""
BODIES["slice_positions"] = """
SELECT * FROM (SELECT row_number() OVER (ORDER BY id) - 1 AS posicion, CAST(id * 97 AS INT) AS id,
    CASE WHEN posicion BETWEEN 600 AND 749 THEN 'cerca'
        WHEN posicion BETWEEN 12300 AND 14299 THEN 'lejos' END AS corte FROM legacy)
WHERE corte IS NOT NULL"""
BODIES["create_target"] = """
SELECT posicion, columna, tipo, (SELECT count(*) FROM cargadas) AS total_registros
FROM (VALUES (1, 'id', 'bigint'), (2, 'expediente', 'string'), (3, 'cui', 'bigint'),
    (4, 'pasaporte', 'string'), (5, 'nombre', 'struct'), (6, 'sexo', 'string'),
    (7, 'fecha_nacimiento', 'date'), (8, 'contacto', 'struct'), (9, 'referencias', 'struct'),
    (10, 'datos_extra', 'struct'), (11, 'estado', 'string'), (12, 'metadatos', 'struct'),
    (13, 'creado_en', 'timestamp'), (14, 'actualizado_en', 'timestamp')) v(posicion, columna, tipo)"""
BODIES["table_exists"] = "SELECT false AS antes, true AS despues, count(*) AS filas FROM cargadas"
BODIES["es_gemelo_type"] = (
    "SELECT id, CASE WHEN id % 6 IN (2, 3, 4) THEN 'es_gemelo debe ser true o false' ELSE '' END AS errores FROM legacy"
)

# Queries that read the loaded table, and those that read records with wrong values.
CTES["resp_cargadas"] = CTES["resp"].replace("FROM mig", "FROM cargadas")
LOADED = (
    "by_id by_ids exists_id by_expediente by_cui by_pasaporte search search_all search_nombre_completo "
    "search_text_index search_nombre_text_index "
    "fallecidos por_sexo por_rango_edad menores menores_page sin_cui expedientes_duplicados migrados "
    "list_page list_page_deep paginate count estadisticas total_menores total_fallecidos total_sin_cui "
    "export_target enrich_response response_conformance"
).split()
DIRTY = (
    "validar_pasaporte validar_expediente validar_nombre validar_fecha_nacimiento "
    "validar_contacto validar_referencias validar_datos_extra validar_paciente_completo error_summary "
    "schema_direccion schema_responsable schema_referencias schema_datos_extra schema_metadatos "
    "schema_defuncion_coherente"
).split()
for name in LOADED:
    BODIES[name] = re.sub(r"\bresp\b", "resp_cargadas", re.sub(r"\bmig\b", "cargadas", BODIES[name]))
for name in DIRTY:
    BODIES[name] = re.sub(r"\bmig\b", "sucias", BODIES[name])

ORACLE = {name: sql(body) for name, body in BODIES.items()}
