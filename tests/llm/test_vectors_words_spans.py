"""Clusters, spelling variants and personal data against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from padron.llm import clusters, pii, spelling
from padron.llm.queries import QUERIES
from tests.llm.fixtures import SF, edge, empty, given, write

# ------------------------------------------------------------------ clusters

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def plain_clusters(rows):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:8]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(10):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if groups[k] else c for k, c in enumerate(centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, k, d in found:
        inertia[k] += d
    return Counter((i, k, d, inertia[k], sum(inertia.values()), ",".join(map(str, centroids[k]))) for i, k, d in found)


def odd_vectors():
    r = np.random.default_rng(1)
    rows = [(i, r.normal(0, 0.1, 64).astype(np.float32).tolist()) for i in range(40)]
    rows += [(1, rows[0][1]), (2, rows[1][1]), (2, rows[1][1]), (None, rows[3][1]), (None, None), (90, []), (91, [0.5] * 63), (92, [0.5] * 65)]
    rows += [(93, [None] + [0.0] * 63), (94, [math.nan] * 64), (95, [math.inf] + [0.0] * 63), (96, [0.0] * 64), (97, [-0.0001] * 64)]
    return rows


def test_clusters_equal_plain_version(spark):
    known = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    for rows in (known, odd_vectors(), odd_vectors()[:3], []):
        frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], VECTORS).repartition(3)
        got = Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in clusters.clusters(frame).collect())
        assert got == plain_clusters(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [3000.5 * (i + 1) * (-1) ** j for j in range(64)]) for i in range(12)] + [(50, [1e12] + [0.25] * 63)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.cluster): r.distance for r in clusters.clusters(frame).collect()}
    want = {(i, k): d if d < 1 << 63 else None for i, k, d, *_ in plain_clusters(rows)}
    assert got == want


def test_progressive_search_equals_full_distances():
    r = np.random.default_rng(2)
    vectors, centroids = r.integers(-900, 900, (500, 64)), r.integers(-900, 900, (8, 64))
    centroids[5] = centroids[2]
    vectors[:3] = centroids[2]
    full = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    number, distance = clusters.nearest(vectors, centroids)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    both = clusters.transform(vectors)
    assert ((both**2).sum(axis=1) == 64 * (vectors**2).sum(axis=1)).all()


# ------------------------------------------------------------------ spelling


def plain_variants(rows):
    counts = Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
        return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])

    out = set()
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


TWIN = "abcdefgh" * 12
WORDS = [
    "color colour " * 9 + "colors " * 3 + "COLOR Color " * 2,
    "aaaaa aaaaaa aaaaaaa " * 3 + "baaaaa abaaaa aaaaab " * 4,
    "straße strasse strase " * 3 + "Àbcdef àbcdef " * 3 + "naïve naive " * 5,
    f"{TWIN} " * 3 + f"{TWIN[:50]}x{TWIN[51:]} " * 8 + f"{TWIN[1:]} " * 4 + f"{TWIN}y " * 3,
    f"{'q' * 31} " * 3 + f"{'q' * 32} " * 6 + f"{'q' * 33} " * 12 + f"{'q' * 34} " * 24,
    "abcd " * 9 + "abcde " * 3 + "abxde " * 2,
]


@pytest.mark.parametrize("which", ["words", "documents"])
def test_variants_equal_plain_version(spark, which):
    if which == "words":
        rows = [(i, t) for i, t in enumerate(WORDS)] + [(None, WORDS[0]), (None, None), (3, ""), (4, "  ")]
        frame = spark.createDataFrame([(i, t, "a", "b", 1, "n") for i, t in rows], "doc_id long, text string, word string, node string, n long, form string")
    else:
        frame, found = given(spark)
        frame, rows = frame.where("doc_id < 1120 OR doc_id IS NULL"), [(i, t) for i, t, *_ in found if i is None or i < 1120]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame.repartition(3)).collect()}
    assert got == plain_variants(rows)


def test_edges_stay_shared_by_hot_prefixes(spark, monkeypatch):
    """The broadcast of crowded nodes changes no result."""
    rows = [(i, f"inter{a}{b}al inter{a}{b}ally ") for i in range(3) for a in "abcdef" for b in "nmrt"]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = set(spelling.variants(frame).collect())
    monkeypatch.setattr(spelling, "HEAVY", 1)
    assert set(spelling.variants(frame).collect()) == whole
    assert {tuple(r) for r in whole} == plain_variants(rows)


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


ODD = [
    "a@b.c@d.e.f x@y @z.com a@b. é@x.com ü.a@b-c.d.e..f %+-@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3.4567 0.0.0.0 ..1.2.3.4 1.2..3.4",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5555555555554444-5555555555554444",
    "+1 (555) 123-4567 ++49 30 1234567 +1 +12 34 56 78 9 x+44.20.7946.0958- +1(((((((9 +123456789012345678",
    "\U0001f600 mail: jo@ex.org, tel +34 600 111 222\n",
]


def test_base_spans_equal_the_patterns(spark):
    _, rows = given(spark)
    for text in ODD + [t or "" for _, t, *_ in rows]:
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_no_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "@" * 300_000, "a@" * 150_000, "Aa " * 100_000):
        pii.base_spans(text)
        pii.wider(text, pii.base_spans(text))


def test_query_counts_and_digests(spark, tmp_path):
    frame, rows = given(spark)
    got = Counter(tuple(r) for r in QUERIES["op13_pii"](spark, write(frame, tmp_path)).drop("spans").collect())
    want = Counter()
    for key, text, *_ in rows:
        spans = plain_spans(text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)
        want[(key, *[len(v) for v in spans.values()], hashlib.sha256(told.encode()).hexdigest())] += 1
    assert got == want


def made_up(spark):
    """Documents with true spans of several sorts, some of them outside the base patterns, and look-alikes."""
    def card(k):
        head = f"4{k:03d}55{k % 10}0{k:05d}"[:15].ljust(15, "7")
        return head + next(c for c in "0123456789" if pii.luhn(head + c))

    rows, planted, sham = [], {}, set()
    for i in range(400):
        n = card(i % 900)
        kind, text = [
            ("email", f"write a mail to user{i}@mail.com please"),
            ("email", f"contact me by email at someone{i} [at] mail [dot] com today"),
            ("phone", f"call my phone +1 415 {200 + i % 700} {1000 + i} now"),
            ("phone", f"call my phone (415) {200 + i % 700}-{1000 + i} now"),
            ("card", f"pay by card {n} soon"),
            ("card", f"pay by card {n[:4]}.{n[4:8]}.{n[8:12]}.{n[12:]} soon"),
            ("ssn", f"her ssn {200 + i % 400}-{10 + i % 80}-{1000 + i} is known"),
            (None, f"order {100 + i}-{10 + i % 80}-{1000 + i} was sent, invoice 555 {200 + i % 700} {1000 + i} paid"),
            (None, "The quiet river runs on and on through the Old Town Hall."),
        ][i % 9]
        rows.append((i, text))
        if kind:
            planted[i] = kind
        else:
            sham.add(i)
    return spark.createDataFrame(rows, "doc_id long, text string"), planted, sham


def test_added_spans_find_what_is_planted(spark):
    frame, planted, sham = made_up(spark)
    found = {r.doc_id: {s.kind for s in r.found} for r in pii.scan(frame).collect()}
    caught = sum(kind in found[i] for i, kind in planted.items())
    assert caught >= 0.9 * len(planted)
    assert sum(bool(found[i]) for i in sham) <= 0.05 * len(sham)


def test_label_model_finds_the_bad_labeler():
    """Two labelers that agree outweigh one that votes at random."""
    r = np.random.default_rng(3)
    counts = Counter()
    for true in (r.random(4000) < 0.4).tolist():
        good = ["+" if (true if r.random() < 0.9 else not true) else "-" for _ in range(3)]
        counts["".join(good) + ("+" if r.random() < 0.5 else "-")] += 1
    p = pii.label_model(counts)
    assert p["+++-"] > 0.9 and p["---+"] < 0.1
    assert abs(p["++-+"] - p["++--"]) < 0.2


def test_edge_rows_and_empty_tables(spark, tmp_path):
    rows = edge(spark)
    assert pii.scan(rows).count() == rows.count()
    assert pii.scan(empty(spark)).count() == 0
    assert spelling.variants(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(None, None, None, None, None)] * 3, empty(spark).schema)
    assert [tuple(r) for r in pii.scan(nothing).collect()] == [(None, [], [])] * 3
    assert spelling.variants(nothing).count() == 0
    folder = write(rows.withColumns({c: F.lit(1) for c in ("found", "base", "word", "root", "votes")}), tmp_path)
    assert QUERIES["op13_pii"](spark, folder).count() == rows.count()
    assert QUERIES["op12_spelling"](spark, folder).columns == ["word", "form", "root", "n", "n_near", "form_n"]
