"""Secrets in texts: fixed patterns and windowed entropy, in DataFrame functions only.

Three pattern kinds (assign, access, hex) give the base spans.  Beside them,
candidate strings (long runs of key characters) fall into a character class;
a window slides over the candidate, the Shannon entropy of its characters is
updated from the counts of the character that leaves and the one that enters,
and a candidate whose best window reaches its class's limit becomes an
`entropy` span.  What base spans cover is taken out of a candidate, and of one
that looks like a path each segment is a candidate of its own; parts shorter
than the window add none.  Nor do candidates that have an allowed form as a
whole (plain words, paths, dotted names, numbers, UUIDs) or name an example.

Offsets are code points, the end exclusive.  Null and empty texts have no
spans.  Rows are independent: repeated rows give repeated results, columns
other than the text pass through, an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base patterns as Java expressions.  A run of a greedy class is taken whole,
#: so minimum lengths of such runs can stand in the pattern; `assign` is
#: matched first and measured after, as a short value uses up its text.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"
#: Candidates of these forms are suppressed: (what must be found, what must not).
#: No form repeats a group, which would take stack for each repetition.
ALLOWED = (
    (r"^[A-Za-z]++$", None),                                # a word
    (r"^[A-Z]?[a-z][A-Za-z/_=-]*+$", r"[A-Za-z][A-Z]"),     # words joined by punctuation, capitals at their starts
    (r"^[0-9+/_=-]++$", None),                              # numbers, dates, rules
    (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", None),  # UUID
    (r"(?i)example|placeholder|xxxx|changeme|dummy", None),
    (r"^(?=[A-Za-z/_-]++$)/?[A-Za-z_-]++/[A-Za-z_-]", r"//"),  # a path of two segments or more
)
#: Values with two segments that are words are judged segment by segment.
PATH = r"(?:^|/)[A-Z]?[a-z][a-z_-]+/(?:.*/)?[A-Z]?[a-z][a-z_-]+(?:/|$)"


@dataclass(frozen=True)
class EntropyLimits:
    """Window length, and bits for each character class."""
    window: int = 20
    hex_bits: float = 3.0
    alnum_bits: float = 3.6
    base64_bits: float = 3.8


#: (class, form, alphabet), the first form that a candidate fits.
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+$", "0123456789abcdefABCDEF"),
    ("alnum", r"^[0-9A-Za-z]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base64", r"", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"),
)


def _placed(text: Column, pattern: str, matches: Column) -> Column:
    """array of (start, end, value): where the matches of a pattern lie, from
    the lengths of the matches and of the text between them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda s: F.char_length(s))
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    walked = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.char_length(x["m"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"),
                (acc["at"] + x["gap"] + F.char_length(x["m"])).alias("end"), x["m"].alias("value")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(F.size(matches) > 0, walked).otherwise(none)


def best_entropy(value: Column, alphabet: str, window: int) -> Column:
    """The largest Shannon entropy, in bits, of `window` neighbouring
    characters of `value` (all of it where it is shorter).

    The state holds a count for each character of the alphabet, the sum of
    c log2 c, and the length of a full window, which is measured once; a step changes the two counts concerned and the sum by what the
    two contribute before and after."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    steps = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), window), codes),
                       lambda a, b: F.struct(F.coalesce(a, F.lit(-1)).alias("into"), b.alias("out")))
    steps = F.slice(steps, F.lit(1), F.char_length(value))
    weight = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    at = lambda counts, i: F.coalesce(F.get(counts, i), F.lit(0))
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
                    F.lit(0).alias("n"), F.lit(0.0).alias("best"),
                    F.least(F.char_length(value), F.lit(window)).alias("full"))

    def leave(acc, x):
        c = at(acc["counts"], x["out"])
        return acc["sum"] - F.when(x["out"] >= 0, weight(c) - weight(c - 1)).otherwise(F.lit(0.0))

    def enter(acc, x):
        c = at(acc["counts"], x["into"]) - (x["into"] == x["out"]).cast("int")
        return weight(c + 1) - weight(c)

    def step(acc, x):
        total = leave(acc, x) + enter(acc, x)
        n = acc["n"] + (x["out"] < 0).cast("int")
        counts = F.transform(acc["counts"], lambda c, i: c + (i == x["into"]).cast("int") - (i == x["out"]).cast("int"))
        bits = F.log2(n.cast("double")) - total / n
        # shorter beginnings count only where the whole value is shorter
        return F.struct(counts.alias("counts"), total.alias("sum"), n.alias("n"),
                        F.when(n == acc["full"], F.greatest(acc["best"], bits)).otherwise(acc["best"]).alias("best"),
                        acc["full"].alias("full"))

    return F.aggregate(steps, zero, step, lambda acc: acc["best"])


def entropy_hit(value: Column, limits: EntropyLimits) -> Column:
    bits = {"hex": limits.hex_bits, "alnum": limits.alnum_bits, "base64": limits.base64_bits}
    allowed = F.lit(False)
    for form, against in ALLOWED:
        fits = value.rlike(form)
        allowed = allowed | (fits if against is None else fits & ~value.rlike(against))
    hit = F.lit(False)
    for name, form, alphabet in reversed(CLASSES):
        hit = F.when(value.rlike(form), best_entropy(value, alphabet, limits.window) >= bits[name]).otherwise(hit)
    return F.when(allowed, F.lit(False)).otherwise(hit)


def _parts(p: Column, base: Column, window: int) -> Column:
    """array of (start, end, value): what base spans, sorted by their start,
    leave of a placed candidate; of a path its segments."""
    piece = lambda lo, hi, value: F.struct(lo.alias("start"), hi.alias("end"), value.alias("value"))
    inside = lambda lo, hi: piece(lo, hi, F.substring(p["value"], lo - p["start"] + 1, hi - lo))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    state = lambda at, out: F.struct(at.alias("at"), out.alias("out"))
    add = lambda out, lo, hi: F.when(hi - lo >= window, F.concat(out, F.array(inside(lo, hi)))).otherwise(out)
    touching = F.filter(base, lambda b: (b["start"] < p["end"]) & (b["end"] > p["start"]))
    left = F.when(F.size(touching) == 0, F.array(p)).otherwise(F.aggregate(
        touching, state(p["start"], none),
        lambda acc, b: state(F.greatest(acc["at"], b["end"]), add(acc["out"], acc["at"], b["start"])),
        lambda acc: add(acc["out"], acc["at"], p["end"])))

    def segments(x):
        walked = F.aggregate(
            F.split(x["value"], "/", -1), state(x["start"], none),
            lambda acc, s: state(acc["at"] + F.char_length(s) + 1, F.when(F.char_length(s) >= window, F.concat(
                acc["out"], F.array(piece(acc["at"], acc["at"] + F.char_length(s), s)))).otherwise(acc["out"])),
            lambda acc: acc["out"])
        return F.when(x["value"].rlike(PATH), walked).otherwise(F.array(x))

    return F.flatten(F.transform(left, segments))


def scan(df: DataFrame, text_col: str = "text", limits: EntropyLimits = EntropyLimits()) -> DataFrame:
    """`df` without the text, with base_spans and spans: arrays of (start,
    kind_order, kind, end), by start and then kind."""
    candidate = CANDIDATE % limits.window
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = df.withColumns({
        "_t": text,
        "_assign": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)),
        "_values": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        "_access": F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        "_hex": F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        "_candidates": F.regexp_extract_all(text, F.lit(candidate), F.lit(0)),
    }).drop(text_col)
    t = F.col("_t")

    def spans(kind: str, placed: Column) -> Column:
        return F.transform(placed, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_order"), F.lit(kind).alias("kind"),
            x["end"].alias("end")))

    long_enough = F.transform("_values", lambda v: F.char_length(v) >= ASSIGN_VALUE)
    assign = F.transform(F.filter(F.zip_with(_placed(t, ASSIGN, F.col("_assign")), long_enough,
                                             lambda p, ok: F.struct(p.alias("p"), ok.alias("ok"))),
                                  lambda x: x["ok"]), lambda x: x["p"])
    base = found.withColumn("base_spans", F.sort_array(F.concat(
        spans("assign", assign), spans("access", _placed(t, ACCESS, F.col("_access"))),
        spans("hex", _placed(t, HEX, F.col("_hex"))))))
    parts = base.withColumn("_parts", F.flatten(F.transform(
        _placed(t, candidate, F.col("_candidates")), lambda p: _parts(p, F.col("base_spans"), limits.window))))
    hits = F.filter("_parts", lambda p: entropy_hit(p["value"], limits))
    return (parts.withColumn("spans", F.sort_array(F.concat("base_spans", spans("entropy", hits))))
            .drop("_t", "_assign", "_values", "_access", "_hex", "_candidates", "_parts"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
