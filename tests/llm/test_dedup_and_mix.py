"""Exact, near and substring deduplication, mixing, language and packing against brute force."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from padron.llm import exact, langid, mixing, packing, simhash, suffix
from padron.llm import components as contraction
from padron.llm.components import components
from padron.llm.queries import ORACLE, QUERIES, tokenizer_path
from tests.llm import fixtures

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    frame, rows = fixtures.given(spark)
    return fixtures.write(frame.repartition(4), tmp_path_factory.mktemp("docs")), rows


def test_exact(spark, table):
    folder, rows = table
    ids = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids[text or ""].append(doc_id)
    got = QUERIES["op8_exact"](spark, folder).collect()
    last = {sha(t): max(g, key=lambda i: (i is not None, i or 0)) for t, g in ids.items()}
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(
        (d, last[sha(t or "")], len(ids[t or ""]), sha(t or "")) for d, t, *_ in rows
    )
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == Counter(last.keys()) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_index_persists(spark):
    docs, index = fixtures.edge(spark), "digests_of_test"
    first = exact.deduplicate(docs, index)
    assert sorted(map(str, (r.text or "" for r in first.collect()))) == sorted({r[1] or "" for r in fixtures.ROWS})
    assert first.columns == docs.columns
    assert exact.decisions(docs, index).where("kept OR NOT indexed").count() == 0
    more = spark.createDataFrame([(1, "quite new", None, None, None), (2, "", None, None, None)], fixtures.SCHEMA)
    assert [r.doc_id for r in exact.decisions(more, index).where("kept").collect()] == [1]
    assert spark.table(index).count() == len({r[1] or "" for r in fixtures.ROWS}) + 1
    plan = exact.new_digests(exact.groups(exact.digests(more)), index)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_exact_turns_meet_the_index(spark):
    """Whatever the number of turns, the same rows stay; a later turn finds what an earlier one stored."""
    rows = [(i, f"text {i % 7}", None, "a", 1) for i in range(60)] + [(None, "text 3", None, "a", 1), (None, "alone", None, "a", 1), (59, "text 3", None, "a", 1)]
    docs = spark.createDataFrame(rows, fixtures.SCHEMA).repartition(4)
    want = None
    for turns in (1, 2, 5):
        index = f"digests_of_turns_{turns}"
        got = Counter(tuple(r) for r in exact.decisions(docs, index, 4, turns).select("doc_id", "keep_id", "group_size", "kept", "indexed", F.hex("digest")).collect())
        want = want or got
        assert got == want and spark.table(index).count() == 8
        assert sum(n for r, n in got.items() if r[3]) == 8 and not any(r[4] for r in got)
    parts = exact.in_turns(docs, 3)
    assert sum(p.count() for p in parts) == len(rows) and all(p.count() for p in parts)
    assert exact.decisions(spark.createDataFrame([], fixtures.SCHEMA), "digests_of_nothing").count() == 0
    assert exact.decisions(docs.where("doc_id IS NULL"), "digests_of_no_ids").where("kept").count() == 2


def test_every_language_is_learned(spark):
    """More languages than the sample would hold at its size for few: each has rows in it."""
    rows = spark.range(460 * 25).select("id", F.concat(F.lit("l"), F.col("id") % 460).alias("lang"))
    docs = rows.select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), "lang")
    per = langid.training_rows(docs, documents=100).groupBy("lang").count().collect()
    assert len(per) == 460 and sum(r["count"] for r in per) < 460 * 25
    assert langid.training_rows(docs.limit(0)).count() == 0


def test_unknown_splitting_goes_through_the_tokenizer(tmp_path):
    """A tokenizer whose file states another normalisation is not taken for the known one."""
    import json

    with open(tokenizer_path(), encoding="utf-8") as file:
        stated = json.load(file)
    assert packing.splits_as_known(stated)
    text = "It's A Test of 12 Words, naïve CAFÉ!"
    changes = {
        "normalizer": {"type": "NFC"},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Whitespace"}, stated["pre_tokenizer"]["pretokenizers"][1]]},
    }
    for part, value in changes.items():
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps({**stated, part: value}), encoding="utf-8")
        other = packing.WordTokenizer(str(path))
        assert not other.short and other(text) == other.encode(text)
        assert other(text) != packing.WordTokenizer(tokenizer_path())(text)


def test_mixing(spark, table):
    folder, rows = table
    got = QUERIES["op2_mixing"](spark, folder).collect()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else weight[s] * left / open_ for s in order}
        over = {s for s in order if target[s] > 2 * sizes[s]}
        if not over - full:
            break
        full |= over
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    assert sorted(r["size"] for r in got) == sorted(len(WORD.findall(t or "")) for _, t, *_ in rows)
    for source in order:
        largest = max(len(WORD.findall(t or "")) for _, t, _, s in rows if s == source)
        assert abs(taken[source] - target[source]) <= largest / 2 + 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, QUERIES["op2_mixing"](spark, folder).collect()))


def test_mix_repeats_rows_and_follows_preference(spark):
    docs = fixtures.edge(spark)
    plan = Counter()
    for r in mixing.plan(docs).collect():
        plan[r.doc_id] += r.copies
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +plan
    many = spark.createDataFrame([(i, "w " * 10, None, f"s{i % 3}", 0) for i in range(3000)], fixtures.SCHEMA)
    from pyspark.sql import functions as F

    liked = mixing.plan(many, preference=F.when(F.col("doc_id") < 1500, 9.0).otherwise(1.0))
    some = {r.low: r.n for r in liked.groupBy((F.col("doc_id") < 1500).alias("low")).agg(F.sum("copies").alias("n")).collect()}
    assert some[True] > some[False]


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(fps):
    """Smallest reachable id by fingerprint, from all pairs."""
    values = sorted(set(fps.values()))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("crowd", [simhash.CROWD, 2])
def test_simhash(spark, table, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    folder, rows = table
    fps = {(d, t): fingerprint(t) for d, t, *_ in rows}
    root = reachable(fps)
    least = {}
    for (d, _), fp in fps.items():
        if d is not None:
            least[root[fp]] = min(d, least.get(root[fp], d))
    want = Counter((d, f"{fps[d, t]:016x}", least.get(root[fps[d, t]])) for d, t, *_ in rows)
    assert Counter(map(tuple, QUERIES["op3_simhash"](spark, folder).collect())) == want


@pytest.mark.parametrize("thresholds", [[0, 0, 0, 0], [1, 1], [1, 0, 0], [3, -1], [-1, 2, 0]])
def test_every_allocation_finds_all_links(spark, thresholds):
    """Fingerprints around a few centres: chains, crowds and strangers."""
    random = np.random.default_rng(5)
    fps = set()
    for centre in random.integers(0, 1 << 63, 12):
        for _ in range(25):
            fps.add(int(centre) ^ sum(1 << int(b) for b in random.integers(0, 64, random.integers(0, 5))))
    fps = sorted(fps)
    groups = [sorted(map(int, g)) for g in np.array_split(random.permutation(64), len(thresholds))]
    frame = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    links = simhash.linked(simhash.probes(frame, simhash.masks(groups, thresholds)), None).select("a", "b")
    found = {r.node: r.root for r in components(links).collect()}
    root = reachable({x: x for x in fps})
    mine, theirs = defaultdict(set), defaultdict(set)
    for x in fps:
        mine[found.get(simhash.signed(x), simhash.signed(x))].add(x)
        theirs[root[x]].add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_allocation_is_optimal():
    random = np.random.default_rng(1)
    for parts in (2, 3, 4):
        costs = random.random((parts, 4)).cumsum(axis=1).tolist()
        from itertools import product

        every = [c for c in product(range(-1, 4), repeat=parts) if sum(t + 1 for t in c) == 4]
        best = min(sum(costs[i][t] for i, t in enumerate(c) if t >= 0) for c in every)
        value, chosen = simhash.allocate(costs)
        assert value == pytest.approx(best) and sum(t + 1 for t in chosen) == 4


@pytest.mark.parametrize("held", [0, 40, contraction.HELD])
def test_components_of_a_chain(spark, monkeypatch, held):
    monkeypatch.setattr(contraction, "HELD", held)
    links = spark.range(0, 300).selectExpr("id AS a", "id + 1 AS b").union(spark.range(1).selectExpr("id + 1000 AS a", "id + 1001 AS b"))
    found = {r.node: r.root for r in components(links).collect()}
    assert len({found[i] for i in range(301)}) == 1 and found[1000] == found[1001] != found[0]


def removed(rows, length=50):
    first = {}
    key = lambda d: -(2**63) if d is None else d
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, key(d)), key(d))
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < key(d):
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        yield d, len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone, strict=False) if not g))


def test_substrings(spark, table, monkeypatch):
    monkeypatch.setattr(suffix, "PART_BYTES", 50_000)
    folder, rows = table
    assert Counter(map(tuple, QUERIES["op4_substrings"](spark, folder).collect())) == Counter(removed(rows))


def test_every_window_asks_once_and_equal_windows_alike(monkeypatch):
    """Also where a text is longer than a chunk."""
    random = np.random.default_rng(9)
    texts = [bytes(random.integers(97, 100, n).astype(np.uint8)) for n in (0, 49, 50, 51, 700, 2000, 120)]
    texts.append(texts[4])
    kinds = set()
    for size in (1 << 19, 300):
        monkeypatch.setattr(suffix, "CHUNK", size)
        windows, asked = Counter(), {}
        for data, place, owner, start in suffix.chunks(texts):
            part, at, first, last, seed, _ = suffix.asking_positions(data, place)
            for p, a, f, z, s in zip(part, at, first, last, seed, strict=True):
                shift = start[p] - place[p]
                windows.update((int(owner[p]), int(x + shift)) for x in range(f, z + 1))
                for x in range(f, z + 1):
                    asked.setdefault(texts[owner[p]][x + shift : x + shift + 50], set()).add((int(a - x), int(s)))
        assert windows == Counter((i, x) for i, t in enumerate(texts) for x in range(len(t) - 49))
        assert all(len(v) == 1 for v in asked.values())
        kinds.add(tuple(sorted((k, *v) for k, v in asked.items())))
    assert len(kinds) == 1


def test_packed_lists_are_exact():
    values = np.unique(np.random.default_rng(2).integers(0, 1 << 48, 5000, dtype=np.uint64))
    assert (suffix.unpack(suffix.pack(values)) == values).all() and len(suffix.unpack(suffix.pack(values[:0]))) == 0


@pytest.mark.parametrize("crowd", [suffix.CROWD, 3])
def test_substrings_at_all_offsets(spark, tmp_path, monkeypatch, crowd):
    """Shared passages of 49, 50, 51 and more bytes in changing surroundings, and runs of one byte."""
    monkeypatch.setattr(suffix, "CROWD", crowd)
    random = np.random.default_rng(3)
    text = lambda n: "".join(chr(97 + int(x)) for x in random.integers(0, 3, n))
    passage = text(200)
    rows = [(i, text(int(random.integers(0, 30))) + passage[: 45 + i] + text(20) + passage[i : i + 40 + i], None, None, None) for i in range(40)]
    rows += [(50 + i, "ab" * (20 + i), None, None, None) for i in range(12)] + [(70, passage, None, None, None), (70, passage[:60], None, None, None)]
    folder = fixtures.write(spark.createDataFrame(rows, fixtures.SCHEMA).repartition(5), tmp_path)
    assert Counter(map(tuple, QUERIES["op4_substrings"](spark, folder).collect())) == Counter(removed(rows))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{fixtures.SF}/{table}.parquet')")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    frame = QUERIES[name](spark, fixtures.SF)
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(cursor.fetchall())


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op9_language"](spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got) and len(got) == len(truth)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and sum(r.accepted for r in got) / len(got) > 0.99


def test_language_of_awkward_texts(spark, table):
    folder, rows = table
    for r in QUERIES["op9_language"](spark, folder).collect():
        texts = [t for d, t, *_ in rows if d == r.doc_id]
        if all(t is None or not any(c.isalpha() for c in t) for t in texts):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        elif all(t is not None and any(c.isalpha() for c in t) for t in texts):
            assert r.lang_pred in {"en", "de", "fr", "es"}


def test_unlearned_languages_and_noise_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~F.coalesce(langid.crc_part() == 2, F.lit(False))))
    random = np.random.default_rng(4)
    of = lambda letters, n: "".join(random.choice(list(letters), n))
    strange = [
        "Nopea ruskea kettu hyppää laiskan koiran yli ja juoksee kotiin, koska yöllä tulee kylmä eikä metsässä ole enää mitään syötävää.",
        "A gyors barna róka átugrik a lusta kutya fölött, és hazaszalad, mert éjszaka hideg lesz, és az erdőben már nincs mit enni.",
        "Быстрая коричневая лиса прыгает через ленивую собаку и бежит домой, потому что ночью будет холодно.",
        of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 400),
        " ".join(of("asdfghjklqwertzuiopyxcvbnm", 7) for _ in range(60)),
    ]
    assert [model.predict(t)[2] for t in strange] == [False] * 5
    clean = docs.where(langid.crc_part() == 2).select("text", "lang").collect()
    found = [model.predict(r.text) for r in clean]
    assert sum(x[2] for x in found) / len(clean) > 0.98


def test_the_error_bound_is_not_capped():
    """Where only scores near 1 are right often enough, lower ones are rejected."""
    random = np.random.default_rng(6)
    y = random.integers(0, 2, 2000)
    logits = np.where(np.arange(2)[None] == y[:, None], 1.0, 0.0) * np.repeat([9.0, 1.0], 1000)[:, None]
    wrong = np.arange(2000) >= 1700
    logits[wrong] = logits[wrong][:, ::-1]
    model = langid.Model(["a", "b"], np.zeros((2, 1)), np.zeros(2), 1.0, 0.0, np.zeros(1), np.zeros(2), np.zeros(2))
    langid.calibrate(model, logits, y)
    scores = langid.softmax(logits / model.temperature)
    accepted = scores.max(axis=1) >= model.least_score
    assert accepted.sum() == 1000 and not wrong[accepted].any()


def test_subwords_do_not_cross_words():
    a = Counter(langid.subwords(langid.letters_of("ab cd")).tolist())
    b = Counter(langid.subwords(langid.letters_of("ab")).tolist()) + Counter(langid.subwords(langid.letters_of("cd")).tolist())
    assert a == b
    assert (langid.letters_of("aÉ1-") == [97, 233, 32, 32]).all()


def sets_of(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_of_the_stage(spark):
    """Texts with a few substituted words, at and around a five-word similarity of 0.8."""
    random = np.random.default_rng(11)
    rows, pairs = [], 0
    for i in range(60):
        words = [f"w{x}" for x in random.integers(0, 10**6, 300)]
        other = list(words)
        for x in random.choice(300, 1 + i % 10, replace=False):
            other[x] = f"v{i}x{x}"
        rows += [(2 * i, " ".join(words), None, None, None), (2 * i + 1, " ".join(other), None, None, None)]
    kept = {r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(rows, fixtures.SCHEMA), "").collect()}
    assert kept >= set(range(0, 120, 2))
    for i in range(60):
        a, b = sets_of(rows[2 * i][1]), sets_of(rows[2 * i + 1][1])
        if len(a & b) / len(a | b) < 0.8:
            assert 2 * i + 1 in kept
        else:
            pairs += 1
    assert len(kept) - 60 <= (60 - pairs) + 0.1 * pairs and pairs > 20


def test_near_copies_are_dropped_by_row(spark):
    words = [f"w{i}" for i in range(300)]
    near = lambda n: " ".join([*words, *["more"] * n])
    unique = " ".join(f"u{i}" for i in range(300))
    lone = " ".join(f"n{i}" for i in range(300))
    rows = [(1, near(0)), (2, near(1)), (2, unique), (3, lone), (3, lone + " x"), (None, near(2)), (None, near(3)), (None, "only here " + unique[::-1])]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], fixtures.SCHEMA)
    kept = [(r.doc_id, r.text) for r in simhash.deduplicate(docs).collect()]
    assert len(kept) == 4 and set(kept) >= {(1, near(0)), (2, unique), (None, rows[-1][1])}


def test_packing(spark, table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    folder, rows = table
    got = QUERIES["op10_packing"](spark, folder).collect()
    want = Counter()
    for d, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        start = 0
        for n in packing.piece_lengths(len(ids)):
            part = ids[start : start + n]
            want[d, start, n, zlib.crc32(struct.pack(f"<{n}I", *part)), len(ids)] += 1
            start += n
        assert start == len(ids)
    assert Counter(tuple(r)[:5] for r in got) == want
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 for r in got)
    assert [r.length for r in sorted(got, key=lambda r: r.sequence_id)] == sorted((r.length for r in got), reverse=True)


def test_words_give_the_tokenizers_ids():
    tokenize = packing.WordTokenizer(tokenizer_path(), cache_words=50)
    texts = ["it's DON'T 123 ¿Qué? «ÀÖß»", "a<|endoftext|>b", "İ ﬁ é é", "x\x1cy z", "...!!! a.b_c", "ª º µ", ""]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{fixtures.SF}/documents.parquet'").fetchall()]
    assert all(tokenize(t) == tokenize.encode(t) for t in texts)


@pytest.mark.parametrize("name", ["op2_mixing", "op3_simhash", "op4_substrings", "op8_exact", "op9_language", "op10_packing"])
def test_empty_table(spark, tmp_path, name):
    assert QUERIES[name](spark, fixtures.write(fixtures.empty(spark), tmp_path)).collect() == []


def test_pipeline_stages(spark, table):
    """Each stage against what its operator says of the rows the stage got."""
    docs = fixtures.edge(spark)
    columns = docs.columns
    from padron.llm.common import settle

    by_language = settle(corpus_pipeline.language_id(spark, docs, ""), "stage")
    assert by_language.columns == columns and {r.doc_id for r in by_language.collect()} >= {1, 2, 12}
    assert not {r.text for r in by_language.collect()} & {None, "", "   \n\t\n"}
    once = settle(corpus_pipeline.exact_dedup(spark, by_language, ""), "stage")
    assert Counter(r.text for r in once.collect()) == Counter({r.text for r in by_language.collect()})
    apart = settle(corpus_pipeline.simhash_near_dedup(spark, once, ""), "stage")
    named = {r.doc_id: r.component_id for r in simhash.classes(once).collect()}
    assert {r.doc_id for r in apart.collect()} == set(named.values()) | {d for d in named if d is None}
    mixed = settle(corpus_pipeline.mix_sources(spark, apart, ""), "stage")
    assert mixed.columns == columns
    packed = corpus_pipeline.pack(spark, mixed, "").collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(r.doc_id for r in mixed.collect())
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in packed)


def test_pipeline_runs(spark, tmp_path):
    assert corpus_pipeline.run(spark, fixtures.SF).count() > 0
    assert corpus_pipeline.run(spark, fixtures.write(fixtures.empty(spark), tmp_path)).count() == 0


def test_near_components_equal_brute_force(spark, monkeypatch):
    """Chains and a large family of near copies, where most pairs lie on both sides of the limit."""
    random = np.random.default_rng(12)
    texts = []
    for family, members in ((0, 70), (1, 20), (2, 5)):
        base = [f"f{family}w{x}" for x in range(200)]
        for m in range(members):
            own = list(base)
            for x in random.choice(200, int(random.integers(0, 5)), replace=False):
                own[x] = f"e{family}-{m}-{x}"
            texts.append(" ".join(own))
    texts += ["", " ", "lone text", texts[0] + "  ", texts[3].upper()]
    sets = [sets_of(t.lower()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or (sets[i] | sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], fixtures.SCHEMA).repartition(3)
    for pairs in (simhash.NEAR_PAIRS, 1):
        monkeypatch.setattr(simhash, "NEAR_PAIRS", pairs)
        found = simhash.near_classes(docs, simhash.NEAR_SHINGLE, simhash.NEAR_DISTANCE, simhash.SIMILARITY).collect()
        groups = {}
        for r in found:
            groups.setdefault(r.root, set()).add(find(r.doc_id))
        assert len(found) == len(texts)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(i) for i in range(len(texts))})


def test_recall_of_near_copies_at_the_limit(spark):
    """Of pairs at a similarity of 0.80 to 0.84, at least nine in ten meet at a key and are candidates."""
    random = np.random.default_rng(13)
    rows, want = [], set()
    while len(want) < 300:
        i = len(rows)
        words = [f"w{x}" for x in random.integers(0, 10**7, 300)]
        other = list(words)
        for x in random.choice(300, int(random.integers(5, 9)), replace=False):
            other[x] = f"v{i}x{x}"
        a, b = sets_of(" ".join(words)), sets_of(" ".join(other))
        if 0.8 <= len(a & b) / len(a | b) < 0.84:
            rows += [(i, " ".join(words), None, None, None), (i + 1, " ".join(other), None, None, None)]
            want.add(i)
    found = simhash.near_classes(spark.createDataFrame(rows, fixtures.SCHEMA), 5, simhash.NEAR_DISTANCE, 0.8).collect()
    root = {r.doc_id: r.root for r in found}
    met = sum(root[i] == root[i + 1] for i in want)
    assert met >= 0.9 * len(want)
    assert len(set(root.values())) == len(rows) - met


def test_texts_beside_a_large_group_make_no_row_a_pair(spark, monkeypatch):
    """Verified pairs grow with the texts, not with those that stay apart times the group beside them."""
    random = np.random.default_rng(14)
    base = [f"w{x}" for x in range(300)]

    def changed(name, n):
        own = list(base)
        for x in random.choice(300, n, replace=False):
            own[x] = f"{name}-{x}"
        return " ".join(own)

    rows, asked, verified = {}, {}, simhash.verified
    for m in (60, 240):
        texts = [changed(f"g{i}", i % 3) for i in range(m)] + [changed(f"a{i}", 10) for i in range(m // 4)]
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], fixtures.SCHEMA)
        counted = []
        monkeypatch.setattr(simhash, "verified", lambda pairs, *more: counted.append(pairs.count()) or verified(pairs, *more))  # noqa: B023
        rows[m], asked[m] = simhash.deduplicate(docs).count(), sum(counted)
        sets = [sets_of(t) for t in texts]
        assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets[m:]) for b in sets[: m + i])
    assert rows == {m: 1 + m // 4 for m in rows}
    assert asked[240] <= 6 * asked[60]


@pytest.mark.parametrize("fragment", [500, 1 << 20])
def test_crowded_keys_in_parts_equal_brute_force(spark, monkeypatch, fragment):
    """Links that lie in any two parts of a key are found: one group, a chain and texts apart."""
    random = np.random.default_rng(15)
    base = [f"w{x}" for x in range(200)]
    chain, texts = list(base), []
    for i in range(25):
        own = list(base)
        for x in random.choice(200, i % 7, replace=False):
            own[x] = f"g{i}-{x}"
        chain[7 * i] = f"c{i}"
        texts += [" ".join(own), " ".join(chain)]
    sets, root = [sets_of(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                root = [root[j] if r == root[i] else r for r in root]
    monkeypatch.setattr(simhash, "NEAR_PAIRS", 0)
    monkeypatch.setattr(simhash, "FRAGMENT", fragment)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], fixtures.SCHEMA).repartition(3)
    found = {r.doc_id: r.root for r in simhash.near_classes(docs, 5, simhash.NEAR_DISTANCE, 0.8).collect()}
    assert len(found) == len(texts) and len({(found[i], root[i]) for i in found}) == len(set(found.values())) == len(set(root))
