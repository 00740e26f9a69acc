"""Column builders against stated values and against plain Python on random text."""

import random
import string
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from padron import model
from padron.functions import contract, derived, documents, normalize, rules
from padron.functions.asof import AsOf
from padron.functions.text import BLANKS, digit_class, strip, words

AS_OF = AsOf.at("2024-06-30")


def values(spark, schema, data, *columns):
    """Rows of the computed columns, in input order."""
    keyed = [(i, *(d if isinstance(d, tuple) else (d,))) for i, d in enumerate(data)]
    frame = spark.createDataFrame(keyed, f"k int, {schema}")
    rows = frame.select("k", *[c.alias(f"v{i}") for i, c in enumerate(columns)]).collect()
    ordered = [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["k"])]
    return [r[0] for r in ordered] if len(columns) == 1 else ordered


@pytest.mark.parametrize(
    "build, schema, data, expected",
    [
        (normalize.normalize_cui, "long", [12345, 0, None, -123456789012, 1234567890123],
         [None, None, None, None, 1234567890123]),
        (normalize.normalize_sexo, "string",
         ["M", "F", "MASCULINO", "femenino ", "\tmujer", "X", "", None],
         ["M", "F", "M", "F", "F", "NF", "NF", "NF"]),
        (normalize.normalize_estado, "string", ["V", "F", "FALLECIDO", " dead", "", None],
         ["V", "F", "F", "F", "V", "V"]),
        (normalize.normalize_email, "string", [" A@B.gt ", "N/A", "", "  ", "None", None, "x"],
         ["a@b.gt", None, None, None, None, None, "x"]),
        (normalize.clean_telefono, "string", ["5555-6666", "+502 (44)", "sin", "", None],
         ["55556666", "50244", None, None, None]),
        (rules.es_cui_valido, "long",
         [1000000000009, 1000000000017, 1000000000025, 1234567890123, 12345, None],
         [True, True, True, False, False, True]),
        (rules.expected_check_digit, "long", [1234567890123, 2987654321098, 1111111111111],
         [0, 9, 9]),
        (rules.pasaporte_message, "string", ["GT1", "1234", "GT", "", None, " é٣ ", "A1" * 30],
         [None, "Pasaporte debe contener letras y números",
          "Pasaporte debe contener letras y números", None, None, None,
          "Pasaporte muy largo (máx 50)"]),
        (rules.expediente_message, "string",
         ["12345", "DUP-7", " 99 ", "²3", "TEST123", "", None, "1" * 21, " DUP-"],
         [None, None, None, None, "Expediente debe ser numérico o formato DUP-{id}",
          "Expediente es requerido", "Expediente es requerido",
          "Expediente muy largo (máx 20)", None]),
        (derived.has_13_characters, "long",
         [10**12, 10**13 - 1, 10**13, 10**12 - 1, -(10**11), -(10**12) + 1, -(10**12), None],
         [True, True, False, False, True, True, False, None]),
    ],
)
def test_stated_values(spark, build, schema, data, expected):
    assert values(spark, f"c {schema}", data, build(F.col("c"))) == expected


def test_expediente(spark):
    got = values(spark, "e int, id int", [(12345, 1), (None, 123), (0, 456)],
                 normalize.normalize_expediente(F.col("e"), F.col("id")))
    assert got == ["12345", "DUP-123", "DUP-456"]


def parse_like_python(text):
    """Four formats in turn; fields of one or two digits, a year of four."""
    text = text.strip()
    for pattern in ("%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y"):
        try:
            return datetime.strptime(text, pattern).date()
        except ValueError:
            continue
    return None


def test_dates(spark):
    rng = random.Random(7)
    data = ["2024-01-15", "5/1/2024", "2024-02-30", "05/01/24", "15-01-2024", "2024/01/15",
            "2024-1/5", "0000-01-01", "", "  2024-01-15　", "1999-001-01", "29/02/2023",
            "29/02/2024", "2024-00-10", "1-1-0001"]
    for _ in range(1500):
        sep = rng.choice("-/")
        day, month, year = rng.randint(0, 33), rng.randint(0, 14), rng.choice([24, 1999, 2024])
        parts = [str(day).zfill(rng.randint(1, 3)), str(month).zfill(rng.randint(1, 2)), str(year)]
        if rng.random() < 0.5:
            parts.reverse()
        data.append(sep.join(parts))
    got = values(spark, "c string", data, normalize.parse_fecha(F.col("c")))
    assert got == [parse_like_python(x) for x in data]


def test_moment_of_death(spark):
    got = values(spark, "f string, h string", [("2024-01-15", "10:30:00"), ("15/01/2024", None),
                                               ("x", "10:30:00"), (None, None)],
                 normalize.parse_fecha_defuncion(F.col("f"), F.col("h")))
    assert got == ["2024-01-15T10:30:00", "2024-01-15T00:00:00", None, None]


def test_blanks_are_those_of_python(spark):
    rng = random.Random(3)
    letters = BLANKS + "abñ´​᠎"
    data = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    names = normalize.split_nombres(F.col("c"))
    got = values(spark, "c string", data, strip(F.col("c")), words(F.col("c")), *names.values())
    for text, (stripped, parts, first, second, rest) in zip(data, got):
        want = text.split()
        assert stripped == text.strip()
        assert parts == (want or [""])
        assert (first, second, rest) == (
            want[0] if want else None,
            want[1] if len(want) > 1 else None,
            " ".join(want[2:]) or None,
        )


def test_digit_class_is_isdigit(spark):
    chars = [chr(i) for i in range(0x20, 0x3000) if not 0xD800 <= i < 0xE000]
    got = values(spark, "c string", chars, F.col("c").rlike(f"^[{digit_class()}]$"))
    # Java and Python may know different Unicode versions; both know these blocks.
    wrong = [c for c, g in zip(chars, got) if g != c.isdigit()]
    assert not wrong


def test_names(spark):
    got = values(spark, "n string, a string, c string",
                 [("Juan Carlos José", "Pérez García López", "López"), (None, "", "")],
                 documents.build_nombre(F.col("n"), F.col("a"), F.col("c")))
    assert tuple(got[0]) == ("Juan", "Carlos", "José", "Pérez", "García López", "López")
    assert tuple(got[1]) == (None,) * 6


def test_check_digit_like_long_hand(spark):
    rng = random.Random(11)
    data = [rng.randint(10**12, 10**13 - 1) for _ in range(3000)]

    def expected(cui):
        digits = [int(d) for d in str(cui)]
        rest = sum(d * w for d, w in zip(digits[:12], range(13, 1, -1))) % 11
        return 0 if rest == 0 else 11 - rest

    assert values(spark, "c long", data, rules.expected_check_digit(F.col("c"))) == [
        expected(x) for x in data
    ]


def test_age(spark):
    born = [date(2006, 6, 30), date(2006, 7, 1), date(2004, 2, 29), date(2999, 1, 1), None]
    got = values(spark, "c date", born, derived.edad(F.col("c"), AS_OF),
                 derived.mayor_de_edad(F.col("c"), AS_OF))
    assert got == [(18, True), (17, False), (20, True), (-975, False), (None, None)]


def test_iso_text_with_zone(spark):
    got = values(spark, "c string", ["2024-01-15 06:00:00", "2024-01-15 06:00:00.25",
                                     "2006-06-15 06:00:00"],
                 derived.iso_in_zone(F.col("c").cast("timestamp")),
                 derived.iso_in_zone(F.col("c").cast("timestamp"), "Asia/Kolkata"))
    assert got == [
        ("2024-01-15T00:00:00-06:00", "2024-01-15T11:30:00+05:30"),
        ("2024-01-15T00:00:00.250000-06:00", "2024-01-15T11:30:00.250000+05:30"),
        ("2006-06-15T01:00:00-05:00", "2006-06-15T11:30:00+05:30"),
    ]


def test_json_keeps_nulls_and_contains(spark):
    frame = spark.createDataFrame(
        [((None, ("a", None, 1, 2)),)],
        "contacto struct<telefono_principal:string,"
        "direccion:struct<linea1:string,linea2:string,municipio_id:int,departamento_id:int>>",
    )
    schema = frame.schema["contacto"].dataType
    doc = F.col("contacto")
    row = frame.select(
        documents.json_contains(doc, schema, {"direccion": {"municipio_id": 1}}).alias("a"),
        documents.json_contains(doc, schema, {"direccion": {"municipio_id": 2}}).alias("b"),
        documents.json_contains(doc, schema, {"telefono_principal": None}).alias("c"),
        documents.json_contains(doc, schema, {"direccion": None}).alias("d"),
        documents.json_contains(doc, schema, {"otro": 1}).alias("e"),
        documents.json_contains(doc, schema, {}).alias("f"),
    ).first()
    assert tuple(row) == (True, False, True, False, False, True)
    text = documents.documents_to_json(frame, ("contacto",)).first()[0]
    assert '"telefono_principal":null' in text and '"linea2":null' in text


def test_type_of_es_gemelo(spark):
    data = ['{"es_gemelo": true}', '{"es_gemelo": null}', "{}", '{"es_gemelo": "SI"}',
            '{"es_gemelo": 1}']
    got = values(spark, "c string", data,
                 rules.es_gemelo_type_messages(F.parse_json(F.col("c"))))
    assert [bool(g) for g in got] == [False, False, False, True, True]


def test_emails(spark):
    good = ["a@b.gt", "Ana.B+x@correo.com.gt", "ñ@ñandú.org"]
    bad = ["", "a", "a@b", "a@localhost", "a@x.test", ".a@b.gt", "a.@b.gt", "a..b@c.gt", "a@-b.gt",
           "a@b-.gt", "a@b.123", "a b@c.gt", "a@@b.gt", "x" * 65 + "@b.gt", "a@b.gt\n"]
    got = values(spark, "c string", good + bad + [None], contract.email_rule(F.col("c")).isNull())
    assert got == [True] * len(good) + [False] * len(bad) + [True]


def test_phones(spark):
    got = values(spark, "c string", ["12345678", "1234-5678", "123", "+502 12345678", "x" * 21, None],
                 contract.phone_rule(F.col("c")))
    assert got == [None, None, contract.too_short(8), contract.PHONE, contract.too_long(20), None]


def test_moments(spark):
    data = ["2024-01-15T10:30:00", "2024-01-15", "2024-01-15 10:30", "2024-01", "2024", "ayer",
            "2024-02-30T00:00:00", "2024-01-15T10:30:00.5", "2024-01-15T25:00:00", ""]
    got = values(spark, "c string", data, rules.parse_moment(F.col("c")).isNotNull())
    assert got == [True, True, True, False, False, False, False, True, False, False]


def record(spark, **changed):
    """A complete, valid record with some fields changed."""
    base = {
        "id": 1, "expediente": "12345", "cui": 1000000000009, "pasaporte": None,
        "nombre": ("Juan", None, None, "Pérez", None, None), "sexo": "M",
        "fecha_nacimiento": date(1990, 1, 15), "contacto": None, "referencias": None,
        "datos_extra": None, "estado": "V", "metadatos": None,
        "creado_en": datetime(2024, 1, 1), "actualizado_en": datetime(2024, 1, 1),
    }
    base.update(changed)
    return spark.createDataFrame(
        [tuple(base[c] for c in model.TARGET_COLUMNS)],
        # Nullable throughout: the rules have to see what a constraint would refuse.
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in model.TARGET_SCHEMA.fields),
    )


DEAD = (None, None, ("2020-05-06T07:08:09", None, None), None)


@pytest.mark.parametrize(
    "changed, field, message",
    [
        ({}, None, None),
        ({"estado": "F"}, "estado", "Paciente fallecido debe tener fecha de defunción"),
        ({"estado": "F", "datos_extra": DEAD}, None, None),
        ({"estado": "V", "datos_extra": DEAD}, None, None),
        ({"cui": 1000000000008}, None, None),
        ({"cui": 123, "expediente": "X", "pasaporte": "1"}, "identificadores", "CUI debe tener 13 dígitos"),
        ({"nombre": None}, "nombre", "Nombre debe ser un objeto JSON"),
        ({"nombre": ("Juan", "J2", None, None, None, None)}, "nombre", "primer_apellido es requerido"),
        ({"sexo": None}, "sexo", "Sexo debe ser uno de: M, F, NF"),
        ({"fecha_nacimiento": date(2024, 7, 1)}, "fecha_nacimiento", "Fecha de nacimiento no puede ser futura"),
        ({"fecha_nacimiento": date(1874, 6, 29)}, "fecha_nacimiento", "Fecha de nacimiento muy antigua (máx 150 años)"),
        ({"fecha_nacimiento": date(1874, 6, 30)}, None, None),
        ({"contacto": ("1" * 21, None, "x@y", ("", None, 1, 1))}, "contacto", "Formato de email inválido"),
        ({"referencias": (None, None, None, ("R", None, 7, None, None), None, None)}, "referencias",
         "CUI del responsable: CUI debe tener 13 dígitos"),
        ({"datos_extra": (None, None, ("2024-07-01", None, None), None)}, "datos_extra",
         "Fecha de defunción no puede ser futura"),
        ({"estado": "X"}, "estado", "Estado debe ser uno de: V, F"),
    ],
)
def test_record_rules(spark, changed, field, message):
    row = rules.check_record(record(spark, **changed), AS_OF).first()
    found = {f: m for f, m in row["errores"].asDict().items() if m}
    assert row["es_valido"] == (field is None)
    assert set(found) == ({field} if field else set())
    if field:
        assert message in found[field]


@pytest.mark.parametrize(
    "changed, errors",
    [
        ({}, []),
        ({"cui": 1234567890123}, []),
        ({"expediente": "", "cui": None}, [": " + contract.NO_IDENTIFIER]),
        ({"expediente": "", "cui": None, "sexo": "X"}, ["sexo: " + contract.BAD_SEXO]),
        ({"estado": "F"}, [": " + contract.DEATH_MISSING]),
        ({"datos_extra": DEAD}, [": " + contract.DEATH_UNEXPECTED]),
        ({"cui": -123456789012}, ["cui: " + contract.CUI_DIGITS]),
        ({"nombre": ("", None, None, "P9", "x" * 101, None)},
         ["nombre -> primer_nombre: " + contract.too_short(1),
          "nombre -> primer_apellido: " + contract.LETTERS,
          "nombre -> segundo_apellido: " + contract.too_long(100)]),
        ({"contacto": (None, "1", "malo", (None, "y" * 201, 0, None))},
         ["contacto -> telefono_secundario: " + contract.too_short(8),
          "contacto -> email: " + contract.BAD_EMAIL,
          "contacto -> direccion -> linea1: " + contract.NOT_STRING,
          "contacto -> direccion -> linea2: " + contract.too_long(200),
          "contacto -> direccion -> municipio_id: Input should be greater than or equal to 1"]),
        ({"referencias": ("p" * 101, None, 0, (None, 0, 5, "1", 0), None, None)},
         ["referencias -> padre: " + contract.too_long(100),
          "referencias -> expediente_madre: Input should be greater than or equal to 1",
          "referencias -> responsable -> nombre: " + contract.NOT_STRING,
          "referencias -> responsable -> parentesco_id: Input should be greater than or equal to 1",
          "referencias -> responsable -> cui: " + contract.CUI_LENGTH,
          "referencias -> responsable -> telefono: " + contract.too_short(8),
          "referencias -> responsable -> expediente: Input should be greater than or equal to 1",
          "referencias -> es_gemelo: " + contract.NOT_BOOLEAN]),
        ({"estado": "F", "datos_extra": (None, (0, "o" * 101), ("2030-01-01", "l" * 201, "c" * 501), "n" * 1001)},
         ["datos_extra -> socioeconomicos -> educacion_id: Input should be greater than or equal to 1",
          "datos_extra -> socioeconomicos -> ocupacion: " + contract.too_long(100),
          "datos_extra -> defuncion -> fecha_hora: " + contract.DEATH_FUTURE,
          "datos_extra -> defuncion -> lugar: " + contract.too_long(200),
          "datos_extra -> defuncion -> causa: " + contract.too_long(500),
          "datos_extra -> notas_clinicas: " + contract.too_long(1000)]),
        ({"metadatos": ("s" * 51, 1, None, "ayer", "v" * 21, None, None)},
         ["metadatos -> sistema_origen: " + contract.too_long(50),
          "metadatos -> migrado_en: " + contract.BAD_MOMENT,
          "metadatos -> version_migracion: " + contract.too_long(20),
          "metadatos -> expediente_duplicado: " + contract.NOT_BOOLEAN]),
    ],
)
def test_contract_rules(spark, changed, errors):
    frame = contract.record_errors(record(spark, **changed), AS_OF)
    assert frame.first()["errores"] == errors
    split = contract.explode_errors(frame, "id").collect()
    assert [f"{r['campo']}: {r['mensaje']}" for r in split] == errors


def test_cleaned_documents(spark):
    frame = record(spark, nombre=(" Ana\t", None, None, "Paz ", None, None),
                   contacto=("5555-6666", None, "Ana@X.GT", None))
    row = frame.select(contract.clean_nombre(F.col("nombre")).alias("n"),
                       contract.clean_contacto(F.col("contacto")).alias("c")).first()
    assert (row["n"]["primer_nombre"], row["n"]["primer_apellido"]) == ("Ana", "Paz")
    assert (row["c"]["telefono_principal"], row["c"]["email"]) == ("55556666", "Ana@x.gt")


def test_letters_pattern(spark):
    good = ["Ana", "O'Neil-Díaz", "María José", " ", "Ü"]
    bad = ["Ana9", "Zoë", "a.b", "ﬁ", string.punctuation]
    got = values(spark, "c string", good + bad, F.col("c").rlike(rules.NAME_PATTERN))
    assert got == [True] * len(good) + [False] * len(bad)
