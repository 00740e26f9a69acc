"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are the runs of one to three letters inside words, with a mark at word
boundaries. Each is hashed into a table of embeddings; the average goes through a linear softmax.
Both layers are trained together by stochastic gradient descent in numpy on a bounded sample:
``PER_LANGUAGE`` documents a language and ``MAX_DOCUMENTS`` in all, but ``LEAST_DOCUMENTS`` a language
however many there are (every language is learned), chosen by a hash of the id,
and ``BAG`` subwords of each, drawn from its whole text in the tasks. A fixed part of the sample is
kept from training to fit the temperature of the softmax and the score below which a prediction
is rejected: the lowest score at which the accepted part has an error of at most ``MAX_ERROR``. If
that is so over everything, it is by a margin the low end of the scores of right predictions.

A softmax only compares the languages it knows. Whether a text is of any of them is told by its
familiarity: the mean logarithm of how frequent its subwords are in the training texts, every
language counting alike. A prediction is rejected too where it is less familiar than nearly all
held-back texts of the predicted language, by a margin.

With fewer than ``10 * HELD_BACK`` usable texts nothing can be held back, no limit can be fitted,
and only texts without a letter are rejected.

As the average is linear, prediction multiplies the two layers once and then only averages one
row of a table per subword of the whole text.

A null text, or one without a letter, is ``und`` with score 0 and rejected. With no labelled
document everything is. Rows with a null language teach nothing. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle

UNKNOWN = "und"
TABLE_BITS = 16
DIMENSIONS = 16
ORDERS = (1, 2, 3)

PER_LANGUAGE = 1500
MAX_DOCUMENTS = 8000
LEAST_DOCUMENTS = 20
BAG = 2048
#: Subwords drawn from a document for one training step.
DRAWN = 256
EPOCHS = 6
RATE = 4.0
HELD_BACK = 5
MAX_ERROR = 0.005
#: So small a part of the right held-back predictions is left out of account as too low.
LOW = 0.001
#: Where the error over everything is small enough, a score may have odds so many times less than that.
ODDS = 8
#: Familiarity may be so much less than that: subwords about e times as rare.
MARGIN = 1.0

#: An average over few subwords says little: it counts as if so many neutral ones were added.
FEW = 8

#: Characters worked on at once.
CHUNK = 1 << 18

MULTIPLIERS = tuple(np.uint32(m) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def letters_of(text: str) -> np.ndarray:
    """Code points, lower-cased, with 32 for whatever is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_letter = (points >= 97) & (points <= 122)
    high = points >= 128
    if high.any():
        other = np.unique(points[high])
        alpha = other[[chr(c).isalpha() for c in other]]
        return np.where(ascii_letter | np.isin(points, alpha), points, np.uint32(32))
    return np.where(ascii_letter, points, np.uint32(32))


def subwords(points: np.ndarray, bits: int = TABLE_BITS) -> np.ndarray:
    """Table rows of all subwords; those that only cross a gap between words are left out."""
    mark = np.uint32(32)
    padded = np.concatenate([[mark], points, [mark]]).astype(np.uint32)
    out = []
    code = np.zeros(len(padded), dtype=np.uint32)
    inner = np.ones(len(padded), dtype=bool)
    for order in ORDERS:
        n = len(padded) - order + 1
        if n <= 0:
            break
        last = padded[order - 1 :]
        code = (code[:n] + last + np.uint32(order)) * MULTIPLIERS[order % 3]
        code ^= code >> np.uint32(15)
        # A space may begin or end a subword, not stand inside it.
        inner = inner[:n] if order < 3 else inner[:n] & (padded[order - 2 : order - 2 + n] != mark)
        real = inner & ((padded[:n] != mark) | (last != mark))
        out.append((code[real] >> np.uint32(32 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # one row of logits per subword
    bias: np.ndarray
    temperature: float
    least_score: float
    frequency: np.ndarray  # logarithm, one per subword
    usual: np.ndarray  # median familiarity of each language
    least_familiar: np.ndarray

    def read(self, text: str) -> tuple[np.ndarray, float, int] | None:
        """Logits and familiarity, averages over the whole text, a chunk at a time, and the number
        of subwords; None without a letter."""
        total, known, n = np.zeros(len(self.languages)), 0.0, 0
        letters = False
        for start in range(0, len(text), CHUNK):
            points = letters_of(text[start : start + CHUNK])
            letters = letters or bool((points != 32).any())
            found = subwords(points)
            for column in range(len(self.languages)):
                total[column] += self.table[column][found].sum(dtype=np.float64)
            known += float(self.frequency[found].sum(dtype=np.float64))
            n += len(found)
        return (total / (n + FEW) + self.bias, known / n, n) if letters else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = self.read(text) if text and self.languages else None
        if found is None:
            return UNKNOWN, 0.0, False
        logits, known, n = found
        scores = softmax(logits / self.temperature)
        best = int(scores.argmax())
        familiar = eased(known, n, self.usual[best]) >= self.least_familiar[best]
        return self.languages[best], float(scores[best]), bool(familiar and scores[best] >= self.least_score)


def eased(known, n, usual):
    """Familiarity with FEW usual subwords added, as few subwords say little."""
    return (known * n + usual * FEW) / (n + FEW)


def drawn_bag(text: str) -> tuple[int, np.ndarray]:
    """Number of subwords of a text and up to BAG of them, drawn without replacement."""
    found = np.concatenate([np.zeros(0, dtype=np.int64), *[subwords(letters_of(text[i : i + CHUNK])) for i in range(0, len(text), CHUNK)]])
    if len(found) > BAG:
        random = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
        return len(found), random.choice(found, BAG, replace=False).astype(np.uint16)
    return len(found), found.astype(np.uint16)


def train(sizes: list[int], bags: list[np.ndarray], labels: list[str], seed: int = 0) -> Model:
    """Embeddings and softmax by SGD with decreasing rate; then temperature and rejection."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros(0), 1.0, 1.0, np.zeros(0), np.zeros(0), np.zeros(0))
    random = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels])
    usable = np.array([i for i, b in enumerate(bags) if len(b)], dtype=np.int64)
    held = usable[usable % HELD_BACK == 0] if len(usable) >= 10 * HELD_BACK else usable
    fitted = np.setdiff1d(usable, held) if len(held) < len(usable) else usable
    embeddings = random.normal(0, 0.1, (1 << TABLE_BITS, DIMENSIONS)).astype(np.float32)
    weights = random.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    batch, step, steps = 32, 0, EPOCHS * (len(fitted) // 32 + 1)
    for _ in range(EPOCHS):
        order = random.permutation(fitted)
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            drawn = np.stack([random.choice(bags[r], DRAWN) for r in rows])
            mean = embeddings[drawn].mean(axis=1)
            error = softmax(mean @ weights + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            rate = np.float32(RATE * (1 - step / steps))
            back = (error @ weights.T * rate * 8 / DRAWN).astype(np.float32)
            weights -= rate * (mean.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            np.subtract.at(embeddings, drawn.ravel(), np.repeat(back, DRAWN, axis=0))
            step += 1
    table = np.ascontiguousarray((embeddings @ weights).T.astype(np.float32))
    frequency = frequencies(bags, y, fitted, len(languages))
    nothing = np.zeros(len(languages))
    model = Model(languages, table, bias.astype(np.float64), 1.0, 0.0, frequency, nothing, nothing - np.inf)
    if len(held):
        logits = np.stack([table[:, bags[i]].mean(axis=1) * sizes[i] / (sizes[i] + FEW) + bias for i in held]).astype(np.float64)
        calibrate(model, logits, y[held])
        known = np.array([frequency[bags[i]].mean() for i in held])
        if len(held) == len(usable):
            model.least_score = 0.0
            return model
        acquaint(model, known, np.array([sizes[i] for i in held]), y[held], logits.argmax(axis=1) == y[held])
    return model


def frequencies(bags: list[np.ndarray], y: np.ndarray, fitted: np.ndarray, languages: int) -> np.ndarray:
    """Logarithm of each subword's share, the mean of its shares in the languages."""
    share = np.zeros(1 << TABLE_BITS)
    for language in range(languages):
        rows = [bags[i] for i in fitted if y[i] == language]
        counts = np.bincount(np.concatenate(rows), minlength=len(share)) if rows else np.zeros(len(share))
        share += (counts + 0.01) / (counts.sum() + 0.01 * len(share)) / languages
    return np.log(share).astype(np.float32)


def calibrate(model: Model, logits: np.ndarray, y: np.ndarray) -> None:
    """The temperature at which the mean score equals the rate of right predictions (with one
    right and one wrong added, as no finite sample shows certainty), then the lowest score with
    a small enough error; with none nothing is accepted."""
    rate = ((logits.argmax(axis=1) == y).sum() + 1) / (len(y) + 2)
    grid = np.exp(np.linspace(np.log(0.02), np.log(50), 120))
    mean = np.array([softmax(logits / t).max(axis=1).mean() for t in grid])
    model.temperature = float(grid[int(np.abs(mean - rate).argmin())])
    scores = softmax(logits / model.temperature)
    best, right = scores.max(axis=1), scores.argmax(axis=1) == y
    order = np.argsort(-best)
    errors = np.cumsum(~right[order]) / np.arange(1, len(y) + 1)
    # Equal scores are accepted together.
    last = np.append(np.diff(best[order]) != 0, True)
    good = np.flatnonzero((errors <= MAX_ERROR) & last)
    if not len(good):
        model.least_score = np.inf
    elif good[-1] < len(y) - 1:
        model.least_score = float(best[order][good[-1]])
    else:
        low = float(np.quantile(best[right], LOW, method="lower"))
        odds = low / max(1 - low, 1e-12) / ODDS
        model.least_score = odds / (1 + odds)


def acquaint(model: Model, known: np.ndarray, sizes: np.ndarray, y: np.ndarray, right: np.ndarray) -> None:
    """The usual and the least familiarity of each language; one without right held-back texts takes those of all."""
    for language in range(len(model.languages)):
        rows = right & (y == language)
        rows = rows if rows.any() else right if right.any() else np.ones(len(y), dtype=bool)
        usual = float(np.median(known[rows]))
        model.usual[language] = usual
        low = float(np.quantile(eased(known[rows], sizes[rows], usual), LOW, method="lower"))
        model.least_familiar[language] = low - MARGIN


def crc_part(column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(4))


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE, documents: int = MAX_DOCUMENTS) -> DataFrame:
    """About ``per_language`` labelled rows of each language, fewer where ``documents`` in all
    would be exceeded, but about ``LEAST_DOCUMENTS`` of each at least, by a hash of the id."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    counts = settle(labelled.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    quota = max(min(per_language, documents / max(counts.count(), 1)), min(per_language, LEAST_DOCUMENTS))
    place = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000)) + 0.5) / 1_000_000
    # The counts are a written table of known size: Spark broadcasts it only if it is small.
    return labelled.join(counts, "lang").where(place * F.col("n") < quota).drop("n")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, documents: int = MAX_DOCUMENTS) -> Model:
    """A model of ``docs``; the driver gets a bounded number of subwords and no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            found = [drawn_bag(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([zlib.crc32(f"{i} {zlib.crc32(t.encode('utf-8', 'surrogatepass'))}".encode()) for i, t in zip(ids, texts, strict=True)], pa.int64()),
                    rows.column(2),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([b.tobytes() for _, b in found], pa.binary()),
                ],
                names=["place", "lang", "size", "bag"],
            )

    sample = training_rows(docs, per_language, documents).select("doc_id", "text", "lang")
    rows = map_batches(sample, run, "place long, lang string, size long, bag binary").collect()
    rows.sort(key=lambda r: (r.place, r.lang, r.size, bytes(r.bag)))
    return train([r.size for r in rows], [np.frombuffer(r.bag, dtype=np.uint16) for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all), with lang_pred, score and accepted (replaced if there)."""
    names = [c for c in columns or docs.columns if c not in ("lang_pred", "score", "accepted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*[docs[c] for c in names], docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [shared.value.predict(t) for t in rows.column(len(names)).to_pylist()]
            lang, score, accepted = zip(*found, strict=True) if found else ((), (), ())
            added = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(i) for i in range(len(names))] + added, names=[*names, "lang_pred", "score", "accepted"]
            )

    types = dict(given.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in names] + ["lang_pred string", "score double", "accepted boolean"])
    return map_batches(given, run, schema)
