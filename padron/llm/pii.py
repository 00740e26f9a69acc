"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span
classifier decides.

Base spans (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and always stay. Beside
them wider patterns propose candidates, also of the kinds ``ssn``, ``iban`` and ``name``. On every
candidate, base spans included, three sorts of labelers vote for, against or not at all:

* patterns: the strict form, check digits and ranges, what touches the span,
* gazetteers: top-level domains, card issuers, country codes, given names; known sham values,
* context: words before and after that speak for the kind, or for a number of another sort.

How often each pattern of votes occurs is counted over all documents (a pattern is one of at most
3 to the number of labelers for a kind). Expectation-maximisation on these counts estimates for each
kind how common true spans are and how each labeler votes on true and on false ones. The resulting
probabilities are the labels of a logistic regression on hashed features of the span and of the
words around it, which sees no votes. It learns from equal examples once, weighted by their number:
at most ``SAMPLE`` different ones, the first by a hash of their features, all where there are fewer.
Candidates that are no base spans are added where the classifier gives ``SURE`` or more and the
labelers' own probability is at least one half; added spans of a kind never overlap another one.

The texts are read once. Votes and features are kept per document, without its text, and
everything after works on that table; no document is shuffled.

A null or empty text has no spans. Texts are read whole; patterns take time in proportion to the
text, however long its runs are. Each row is judged for itself, repeated rows and rows without an
id as well. Without candidates (also in an empty table) there is no model and base spans are all.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban", "name")

#: Different examples the classifier learns from, and the size of its table of features.
SAMPLE = 20_000
FEATURES = 1 << 14
STEPS = 150
ROUNDS = 60
SURE = 0.8
#: Letters of context a labeler looks at on either side.
AROUND = 48

# ------------------------------------------------------------------ base spans

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number that fails from its first digit on fails from every later one.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile("[^0-9]+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def emails(text: str) -> list[Span]:
    """As the pattern finds them from the left; time in proportion to the text."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        done = domain.end() if domain else at + 1
        at = text.find("@", done)
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    cards = [m.span() for m in CARD.finditer(text) if 13 <= len(d := NOT_DIGITS.sub("", m[0])) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15] if "+" in text else []
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


# ------------------------------------------------------------------ candidates

SPELT_AT = re.compile(r"\s?[\[(]\s?at\s?[\])]\s?", re.IGNORECASE)
SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)[A-Za-z0-9-]{1,63}){1,5}", re.IGNORECASE)
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
WIDER = {
    "phone": re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9A-Za-z]|[./_-][0-9])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"),
    "iban": re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
}
NAME = re.compile(r"(?<![\w-])[A-ZÀ-Þ][a-zß-ÿ]{1,30}(?:\x20[A-ZÀ-Þ][a-zß-ÿ'-]{1,30}){1,2}(?![\w-])")

# What the gazetteers know.
DOMAINS = frozenset("com org net edu gov mil int info biz io de fr es it uk us ca au at ch nl be se no dk fi pl pt br mx ar jp cn in ru eu".split())
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "351", "352", "353", "358", "420", "502", "503")
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35")
GIVEN_NAMES = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew George Peter Edward "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Emily Anna Laura Emma Julia Alice "
    "Hans Klaus Jürgen Wolfgang Stefan Andreas Sabine Monika Ursula Katrin Jean Pierre Michel François Luc Marie Camille Sophie Nathalie Claire "
    "José Juan Carlos Luis Miguel Javier Antonio María Carmen Ana Isabel Lucía Sofía Elena Marta".split()
)
TITLES = re.compile(r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Sr|Sra|Herr|Frau|Mme|M)\.?|\b(?:name is|named|contact|attn:?|signed(?: by)?|name:))\s*$", re.IGNORECASE)
SHAM = {
    "email": re.compile(r"^(?:noreply|no-reply|user|name|foo|test)@|@(?:localhost|domain)\b", re.IGNORECASE),
    "ip": re.compile(r"^(?:0\.|127\.|255\.|224\.)|\.0\.0(?:\.|$)|^0{1,4}(?::0{1,4}){6}"),
    "card": re.compile(r"^([0-9])(?:[^0-9]?\1)+$|^1234|^0"),
    "phone": re.compile(r"123.?4567?|^([0-9])\1{2}.?\1{3}|^[01]"),
    "ssn": re.compile(r"^(?:000|666|9)|-00-|-0000$|^123-45-6789$"),
    "iban": re.compile(r"^(?!(?:AD|AE|AL|AT|BE|BG|BR|CH|CR|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GI|GR|GT|HR|HU|IE|IL|IS|IT|KW|LB|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|QA|RO|SA|SE|SI|SK|TR)[0-9])"),
    "name": re.compile(r"(?:^|\x20)(?:The|This|That|In|On|At|Of|New|United|San|Saint|Der|Die|Das|Le|La|El|Los|Street|University|City|River|North|South|East|West)(?:\x20|$)"),
}
FOR = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach|reply)\b", re.IGNORECASE),
    "ip": re.compile(r"\b(?:ip|ipv[46]|address|host|server|login|logged|from)\b", re.IGNORECASE),
    "card": re.compile(r"\b(?:card|credit|debit|visa|mastercard|amex|payment|pay|cvv|tarjeta|carte|karte)\b", re.IGNORECASE),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|dial|sms|text|telefon|teléfono|téléphone)\b", re.IGNORECASE),
    "ssn": re.compile(r"\b(?:ssn|social security|taxpayer|tin)\b", re.IGNORECASE),
    "iban": re.compile(r"\b(?:iban|account|bank|transfer|konto|cuenta|compte)\b", re.IGNORECASE),
    "name": re.compile(r"\b(?:born|lives?|wife|husband|sincerely|regards|patient|customer|dear|my name|i am|employee)\b", re.IGNORECASE),
}
AGAINST = re.compile(r"\b(?:version|ver|v|order|invoice|isbn|issn|part|serial|sku|ticket|page|figure|fig|section|chapter|table|total|sum|commit|build|release|model|hash|checksum|key|token|id)\b[\s:#=.\"']*$|[#$€£/=_]\s*$", re.IGNORECASE)


def overlaps(spans: list[Span], start: int, stop: int) -> bool:
    return any(a < stop and start < b for a, b in spans)


def wider(text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    """Candidates that are no base spans and do not overlap one."""
    taken = sorted(s for spans in base.values() for s in spans)
    found: list[tuple[str, int, int]] = []
    if "at" in text or "AT" in text:
        for m in SPELT_AT.finditer(text):
            start = m.start()
            while start > 0 and m.start() - start < 64 and text[start - 1] in LOCAL:
                start -= 1
            domain = SPELT_DOMAIN.match(text, m.end())
            if start < m.start() and domain:
                found.append(("email", start, domain.end()))
    if text.count(":") > 6:
        found += [("ip", *m.span()) for m in IPV6.finditer(text)]
    for kind, pattern in WIDER.items():
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    for m in NAME.finditer(text):
        given = any(w in GIVEN_NAMES for w in m[0].split(" ")[:-1])
        if given or TITLES.search(text[max(0, m.start() - AROUND) : m.start()]):
            found.append(("name", *m.span()))
    found.sort(key=lambda c: (c[1], c[2], c[0]))
    out, i, last = [], 0, 0
    for kind, start, stop in found:
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if start >= last and not overlaps(taken[i : i + len(BASE_KINDS)], start, stop):
            out.append((kind, start, stop))
            last = stop
    return out


# ------------------------------------------------------------------ labelers


def checked(kind: str, span: str) -> int:
    """Check digits and ranges."""
    digits = NOT_DIGITS.sub("", span)
    if kind == "card":
        return 1 if luhn(digits) else -1
    if kind == "iban":
        plain = span.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
        return 1 if int(number) % 97 == 1 else -1
    if kind == "phone":
        national = digits[-10:]
        return 1 if len(national) == 10 and national[0] not in "01" and national[3] not in "01" else 0
    if kind == "ssn":
        return 0 if SHAM["ssn"].search(span) else 1
    return 0


def known(kind: str, span: str) -> int:
    """What the gazetteers know."""
    if kind == "email":
        last = re.split(r"\.|[\[(]\s?dot\s?[\])]\s?", span, flags=re.IGNORECASE)[-1].strip()
        return 1 if last.lower() in DOMAINS else -1
    if kind == "card":
        return 1 if ISSUERS.match(NOT_DIGITS.sub("", span)) else -1
    if kind == "phone" and span.startswith("+"):
        return 1 if span[1:].lstrip().startswith(COUNTRY_CODES) else -1
    if kind == "name":
        return 1 if span.split(" ")[0] in GIVEN_NAMES else 0
    return 0


def votes(kind: str, span: str, before: str, after: str) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    touches = (before[-1:].isalnum() or before[-1:] in ("_", "+", "=")) or (after[:1].isalnum() or after[:1] == "_")
    cued = TITLES.search(before) if kind == "name" else None
    return (
        -1 if touches else 1,
        checked(kind, span),
        known(kind, span),
        -1 if SHAM[kind].search(span) else 0,
        1 if cued or FOR[kind].search(before) else 0,
        1 if FOR[kind].search(after[: AROUND // 2]) else 0,
        -1 if AGAINST.search(before) else 0,
    )


WORD = re.compile(r"\w+")


def features(kind: str, span: str, before: str, after: str) -> list[int]:
    """Hashed features of a span: its shape, the words and signs around it."""
    shape = re.sub(r"(.)\1+", r"\1", re.sub("[a-zß-ÿ]", "a", re.sub("[A-ZÀ-Þ]", "A", re.sub("[0-9]", "9", span))))
    ahead, behind = WORD.findall(before.lower())[-2:], WORD.findall(after.lower())[:1]
    told = ["", f"shape {shape[:24]}", f"size {min(len(span), 48) // 4}", f"left {'a' if before[-1:].isalpha() else before[-1:]}", f"right {'a' if after[:1].isalpha() else after[:1]}"]
    told += [f"before {w}" for w in ahead] + [f"after {w}" for w in behind]
    return sorted({zlib.crc32(f"{kind} {t}".encode()) % FEATURES for t in told})


CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))])
CANDIDATES = "doc_id {}, found array<struct<kind:int,start:bigint,stop:bigint,base:boolean,votes:string,features:array<int>>>"


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` of every row: all candidates with votes and features, base spans first."""
    signs = {1: "+", 0: "0", -1: "-"}

    def of(text: str) -> list[dict]:
        base = base_spans(text)
        spans = [(k, a, b, True) for k in BASE_KINDS for a, b in base[k]] + [(*c, False) for c in wider(text, base)]
        out = []
        for kind, a, b, is_base in spans:
            inside, before, after = text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND]
            voted = "".join(signs[v] for v in votes(kind, inside, before, after))
            out.append({"kind": KINDS.index(kind), "start": a, "stop": b, "base": is_base, "votes": voted, "features": features(kind, inside, before, after)})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [of((t.as_py() or b"").decode(errors="replace")) for t in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.list_(CANDIDATE))], names=["doc_id", "found"])

    given = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_batches(given, run, CANDIDATES.format(dict(given.dtypes)["doc_id"]))


# ------------------------------------------------------------------ weights

SIGNS = "-0+"
#: First guess at the weight of each labeler, in the order of ``votes``: a sham value or a word that
#: names another sort of number says more than a sign that is missing beside the span.
FIRST_WEIGHTS = np.array([0.5, 1.0, 1.0, 3.0, 1.0, 0.5, 3.0])


def label_model(counts: dict[str, int]) -> dict[str, float]:
    """Probability of a true span for each pattern of votes of one kind, by
    expectation-maximisation from a weighted majority on."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    votes_of = np.array([[SIGNS.index(c) for c in p] for p in patterns])
    guess = (votes_of - 1) @ FIRST_WEIGHTS[: votes_of.shape[1]]
    true = 1 / (1 + np.exp(-guess))
    seen = np.eye(3)[votes_of]
    for _ in range(ROUNDS):
        odds = np.log((n @ true + 1) / (n @ (1 - true) + 1)) * np.ones(len(n))
        for weight, sign in ((n * true, 1), (n * (1 - true), -1)):
            share = (np.einsum("p,pjv->jv", weight, seen) + 1) / (weight.sum() + 3)
            odds += sign * np.log(share)[np.arange(votes_of.shape[1]), votes_of].sum(axis=1)
        # A share of the first guess keeps the two classes from changing places.
        true = 1 / (1 + np.exp(-np.clip(odds + 0.25 * guess, -30, 30)))
    return dict(zip(patterns, true.tolist(), strict=True))


def span_classifier(examples: list[tuple[list[int], float, float]]) -> np.ndarray:
    """Weights of the features by logistic regression: (features, probability, weight) each."""
    weights, squares = np.zeros(FEATURES), np.full(FEATURES, 1e-8)
    if not examples:
        return weights
    owner = np.repeat(np.arange(len(examples)), [len(f) for f, _, _ in examples])
    index = np.concatenate([f for f, _, _ in examples])
    label = np.array([p for _, p, _ in examples])
    size = np.array([w for _, _, w in examples])
    size = size / size.mean()
    for _ in range(STEPS):
        score = np.bincount(owner, weights=weights[index], minlength=len(label))
        error = size * (1 / (1 + np.exp(-score)) - label)
        slope = np.bincount(index, weights=error[owner], minlength=FEATURES) / len(label) + 1e-5 * weights
        squares += slope * slope
        weights -= 0.5 * slope / np.sqrt(squares)
    return weights


def fit(found: DataFrame) -> tuple[dict[tuple[int, str], float], np.ndarray]:
    """The label model, as a probability per kind and pattern, and the classifier's weights."""
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.features")
    examples = settle(each.groupBy("kind", "votes", "features").agg(F.count("*").alias("n")), "pii-examples")
    by_kind: dict[int, dict[str, int]] = {}
    for r in examples.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect():
        by_kind.setdefault(r.kind, {})[r.votes] = r.n
    true = {(kind, p): x for kind, counts in by_kind.items() for p, x in label_model(counts).items()}
    chosen = examples.orderBy(F.xxhash64("kind", "votes", "features"), "kind", "votes", "features").limit(SAMPLE).collect()
    return true, span_classifier([(r.features, true[r.kind, r.votes], math.log1p(r.n)) for r in chosen])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, found`` of every row: lists of kind, start, stop and score, by kind and start."""
    found = settle(candidates(docs), "pii-candidates")
    true, weights = fit(found)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            base, all_spans = [], []
            for row in rows.column(1).to_pylist():
                kept = []
                for c in row:
                    score = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[c["features"]].sum())))))
                    if c["base"] or (score >= SURE and true[c["kind"], c["votes"]] >= 0.5):
                        kept.append((c["kind"], c["start"], c["stop"], score, c["base"]))
                kept.sort()
                told = [({"kind": KINDS[k], "start": a, "stop": b, "score": s}, is_base) for k, a, b, s, is_base in kept]
                base.append([x for x, is_base in told if is_base])
                all_spans.append([x for x, _ in told])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(base, pa.list_(span)), pa.array(all_spans, pa.list_(span))], names=["doc_id", "base", "found"])

    spans = "array<struct<kind:string,start:bigint,stop:bigint,score:double>>"
    return found.mapInArrow(run, f"doc_id {dict(found.dtypes)['doc_id']}, base {spans}, found {spans}")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def written(spans: str) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
