"""Secret scan in Spark's own expressions.

Three patterns find assignments, access keys and long hexadecimal runs. Beyond them, strings of
one character class are candidates: a window slides over each, the counts of its characters and
the sum of c * log2(c) are updated by the one character that enters and the one that leaves, and
the Shannon entropy follows from that sum. The windows at or above the threshold of the class
make one span, unless the candidate is on the allow-list or touches a span of the patterns.

Positions: ``split`` gives the gaps between matches and ``regexp_extract_all`` the matches, so
running sums of their lengths are the positions, in code points, end exclusive.

Nulls and empty texts have no spans. Rows are independent of each other. Columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import text_of

# The three patterns and the least lengths of what they find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX = r"[0-9a-f]+"
HEX_LENGTH = 24


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    pattern: str
    alphabet: str
    window: int
    least_entropy: float
    must_have: str


CLASSES = (
    CharacterClass(
        "entropy64",
        r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        24,
        3.9,
        r"(?=.*[0-9])(?=.*[A-Za-z])",
    ),
    CharacterClass("entropy16", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{20,}+(?![0-9A-Za-z])", "0123456789abcdef", 20, 3.0, r"(?=.*[0-9])(?=.*[A-Fa-f])"),
)

# Names of checksums and identifiers: as the last thing before a candidate, save for what may stand
# between a name and its value, or as a part of its own at the head of the candidate.
LABEL = r"(?:sha-?(?:1|224|256|384|512)|md5|crc32|checksum|digest|commit|revision|integrity|etag|uuid|guid|base64,)"
BETWEEN = " \t\n\x0b\f\r:=_\"'-"
ALLOWED_BEFORE = f"(?i){LABEL}$"
ALLOWED_HEAD = f"(?i)^(?:[A-Za-z0-9]{{1,24}}[=_-]+){{0,2}}{LABEL}[=_-]"
# What lies in samples.
ALLOWED_INSIDE = r"(?i)example|sample|placeholder|changeme|dummy|xxxx|your[_-]|0123456789|abcdefgh"

KINDS = ("assign", "access", "hex", *[c.kind for c in CLASSES])
SPAN = "array<struct<start:bigint,kind_no:int,stop:bigint,kind:string>>"


def spans(text: Column, pattern: str, kind: str, ok=None, group: int = 0) -> Column:
    """Spans of all leftmost matches that do not overlap. ``ok`` judges group ``group``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    facts = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), F.right(F.rtrim(g, F.lit(BETWEEN)), F.lit(24)).alias("before"))),
        judged,
        lambda x, v: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), x["before"].alias("before"), v.alias("value")),
    )
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["pos"] + x["gap"]
        stop = begin + F.coalesce(x["size"], F.lit(0))
        one = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), stop.alias("stop"), F.lit(kind).alias("kind"))
        good = x["value"].isNotNull() & (F.lit(True) if ok is None else ok(x))
        return F.struct(stop.alias("pos"), F.when(good, F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"))

    return F.aggregate(facts, start, step, lambda s: s["out"])


def c_log_c(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(0.0)


def high_entropy(value: Column, of: CharacterClass) -> Column:
    """First start and last end of the windows of high entropy (``first`` null: none)."""
    letters = F.lower(value) if of.alphabet == of.alphabet.lower() else value
    at = lambda i: F.instr(F.lit(of.alphabet), F.substring(letters, i, F.lit(1))) - 1
    none = F.lit(None).cast("int")
    start = F.struct(
        F.array_repeat(F.lit(0), len(of.alphabet)).alias("counts"), F.lit(0.0).alias("total"), none.alias("first"), none.alias("last")
    )

    def step(s: Column, i: Column) -> Column:
        enters, leaves = at(i), F.when(i > of.window, at(i - of.window)).otherwise(-1)
        same = enters == leaves
        counts, there = s["counts"], lambda j: F.get(s["counts"], j)
        total = s["total"] + F.when(same, 0.0).otherwise(
            c_log_c(there(enters) + 1) - c_log_c(there(enters))
            + F.when(leaves >= 0, c_log_c(there(leaves) - 1) - c_log_c(there(leaves))).otherwise(0.0)
        )
        changed = F.transform(counts, lambda c, j: c + F.when(j == enters, 1).otherwise(0) - F.when(j == leaves, 1).otherwise(0))
        entropy = F.log2(F.lit(float(of.window))) - total / of.window
        high = (i >= of.window) & (entropy >= of.least_entropy - 1e-9)
        return F.struct(
            changed.alias("counts"),
            total.alias("total"),
            F.coalesce(s["first"], F.when(high, i - of.window)).alias("first"),
            F.when(high, i).otherwise(s["last"]).alias("last"),
        )

    numbers = F.sequence(F.lit(1), F.length(value))
    return F.aggregate(numbers, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def candidates(text: Column, of: CharacterClass) -> Column:
    """Spans of high entropy, with the allow-list applied."""
    allowed = lambda x: x["before"].rlike(ALLOWED_BEFORE) | x["value"].rlike(ALLOWED_HEAD) | x["value"].rlike(ALLOWED_INSIDE)
    whole = spans(text, of.pattern, of.kind, ok=lambda x: x["value"].rlike(of.must_have) & ~allowed(x))

    def part(s: Column) -> Column:
        inside = F.substring(text, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))
        return F.struct(s.alias("whole"), high_entropy(inside, of).alias("part"))

    found = F.filter(F.transform(whole, part), lambda x: x["part"]["first"].isNotNull())
    return F.transform(
        found,
        lambda x: F.struct(
            (x["whole"]["start"] + x["part"]["first"]).alias("start"),
            x["whole"]["kind_no"].alias("kind_no"),
            (x["whole"]["start"] + x["part"]["last"]).alias("stop"),
            x["whole"]["kind"].alias("kind"),
        ),
    )


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base_spans`` (patterns) and ``found_spans`` (all), each by start, then kind."""
    text = text_of()
    none = F.array().cast(SPAN)
    # Each pattern is gated by one plain search, so a text without a secret costs only those.
    base = F.concat(
        F.when(text.rlike(ASSIGN), spans(text, ASSIGN, "assign", lambda x: F.length(x["value"]) >= ASSIGN_VALUE, 2)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS, "access", lambda x: x["size"] >= ACCESS_LENGTH)).otherwise(none),
        F.when(text.rlike(f"[0-9a-f]{{{HEX_LENGTH}}}"), spans(text, HEX, "hex", lambda x: x["size"] >= HEX_LENGTH)).otherwise(none),
    )
    more = F.concat(*[F.when(text.rlike(c.pattern), candidates(text, c)).otherwise(none) for c in CLASSES])
    marked = docs.withColumn("base_spans", F.array_sort(base)).withColumn("found_spans", more)
    touches = lambda e: F.exists("base_spans", lambda b: (b["start"] < e["stop"]) & (e["start"] < b["stop"]))
    # A candidate of both classes is reported as the narrower one.
    narrow = F.filter("found_spans", lambda e: ~touches(e))
    marked = marked.withColumn("found_spans", F.array_sort(F.concat("base_spans", narrow)))
    return marked


def written(column: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
