"""Secret scans: fixed patterns plus sliding-window Shannon entropy, SQL only.

Candidate strings are long runs of token characters. A window of WIDTH
characters slides over each. An array holds how often each character of the class
stands in the window: one count goes up as a character enters, one goes down as one
leaves, and with them the integer sum of c*log2(c) in millionths of a bit, so that
every engine gets the same decision. The least entropy asked for depends on the
character class. An allow-list suppresses candidates of this method that are known
not to be secrets; spans of the fixed patterns always stay, and what an entropy span
has beyond them on either side is a span too, from PART characters on.

Defined cases: a null text counts as empty and has no spans; repeated rows are
each scanned; offsets are code points, ends exclusive; an empty table gives an empty
result; other columns are not read by the scan, and stay as they are in redaction.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the three base kinds and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 or more characters
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates of the entropy scan, the width of its window, and for each
#: character class (first match wins) its pattern and least bits a character.
CANDIDATE, WIDTH, PART = r"[A-Za-z0-9+/_=-]{20,}", 20, 8
#: The characters of a candidate, in the order of their counts.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASSES = (("hex", r"^[0-9a-fA-F]+$", 2.9), ("upper", r"^[A-Z0-9]+$", 3.3), ("token", r"^[A-Za-z0-9+/_=-]+$", 3.6))
#: The allow-list: candidates that match any of these are not reported.
ALLOWED = (
    r"^[A-Z+/_=-]+$",  # capitals only: a name, a path or a rule of dashes
    r"^[^A-Za-z]+$",  # no letter: a number, a date or a telephone number
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # a UUID
    r"^[a-z]+(-[a-z0-9]+)+$",  # a slug
    r"(?i)example|placeholder|changeme|your_?key|x{6}|0{8}|1234567",
)
#: Candidates that don't show this are allowed too: words, capitalised or joined.
NO_WORDS = r"[0-9]|[A-Z]([^a-z]|$)"
#: WIDTH * log2(WIDTH), and c * log2(c) for each count, in millionths.
FULL = round(1e6 * WIDTH * math.log2(WIDTH))
TABLE = [0] + [round(1e6 * c * math.log2(c)) for c in range(1, WIDTH + 1)]


def least(bits: float) -> int:
    return round(1e6 * WIDTH * bits)


def _spans(text: Column, pattern: str, kind: int, keep=None, groups=()) -> Column:
    """All matches of a pattern that never matches nothing, as an array of
    (start, kind, end). Pieces between matches give the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    more = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("hit"), *[m.alias(f"g{i}") for i, m in enumerate(more)])
    def step(acc: Column, x: Column) -> Column:
        end = acc["end"] + F.length(x["piece"]) + F.coalesce(F.length(x["hit"]), F.lit(0))
        return F.struct(end.alias("end"), F.concat(acc["ends"], F.array(end)).alias("ends"))

    # arrays_zip names its fields by the columns' aliases; where each match ends, then where it starts
    ends = F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("end"), F.expr("CAST(array() AS array<bigint>)").alias("ends")), step, lambda acc: acc["ends"])

    def row(x: Column, end: Column) -> Column:
        return F.struct((end - F.length(x["hit"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("hit"), (x["g0"] if more else F.lit("")).alias("extra"))

    all_ = F.filter(F.zip_with(zipped, ends, row), lambda s: s["hit"].isNotNull())
    kept = F.filter(all_, keep) if keep else all_
    return F.when(F.rlike(text, F.lit(pattern)), F.transform(kept, lambda s: F.struct(s["start"], s["kind"], s["end"]))).otherwise(F.expr("CAST(array() AS array<struct<start:bigint,kind:int,end:bigint>>)"))


def _entropy_least(hit: Column) -> Column:
    """The smallest sum of c*log2(c) of any window: its entropy is greatest. The fold
    keeps the counts of the window's characters, two of which change in a step."""
    table = F.array(*[F.lit(v).cast("bigint") for v in TABLE])
    place = F.transform(F.regexp_extract_all(hit, F.lit("."), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    steps = F.transform(place, lambda p, i: F.struct(p.alias("enter"), F.when(i >= WIDTH, F.get(place, i - WIDTH)).alias("leave")))
    none = F.array_repeat(F.lit(0), len(ALPHABET))

    def counted(counts: Column, at: Column, by: int) -> Column:
        return F.concat(F.slice(counts, F.lit(1), at), F.array(F.get(counts, at) + by), F.slice(counts, at + 2, F.lit(len(ALPHABET))))

    def step(acc: Column, x: Column) -> Column:
        gone = F.get(acc["n"], x["leave"])
        less = F.when(x["leave"].isNull(), acc["n"]).otherwise(counted(acc["n"], x["leave"], -1))
        total = acc["s"] - F.coalesce(F.get(table, gone) - F.get(table, gone - 1), F.lit(0).cast("bigint"))
        held = F.get(less, x["enter"])
        total = total + F.get(table, held + 1) - F.get(table, held)
        whole = acc["size"] >= WIDTH - 1
        return F.struct(counted(less, x["enter"], 1).alias("n"), (acc["size"] + 1).alias("size"), total.alias("s"), F.when(whole, F.least(acc["low"], total)).otherwise(acc["low"]).alias("low"))

    start = F.struct(none.alias("n"), F.lit(0).alias("size"), F.lit(0).cast("bigint").alias("s"), F.lit(2**40).cast("bigint").alias("low"))
    return F.aggregate(steps, start, step, lambda acc: acc["low"])


def _is_secret(hit: Column) -> Column:
    allowed = ~F.rlike(hit, F.lit(NO_WORDS))
    for pattern in ALLOWED:
        allowed = allowed | F.rlike(hit, F.lit(pattern))
    limit = F.lit(None).cast("bigint")
    for _, pattern, bits in reversed(CLASSES):
        limit = F.when(F.rlike(hit, F.lit(pattern)), F.lit(FULL - least(bits)).cast("bigint")).otherwise(limit)
    return F.when(allowed, False).otherwise(_entropy_least(hit) <= limit)


def with_spans(docs: DataFrame, text: str = "text", prefix: str = "_secret") -> DataFrame:
    """``docs`` with arrays of (start, kind, end): ``<prefix>_base`` of the fixed
    patterns and ``<prefix>_all`` with the entropy scan's, each in order."""
    t = F.coalesce(F.col(text), F.lit(""))
    assign = _spans(t, ASSIGN, 0, keep=lambda s: F.length(s["extra"]) >= ASSIGN_LEAST, groups=(2,))
    base = F.array_sort(F.concat(assign, _spans(t, ACCESS, 1), _spans(t, HEX, 2)))
    more = _spans(t, CANDIDATE, 3, keep=lambda s: _is_secret(s["hit"]))
    out = docs.withColumns({f"{prefix}_base": base, f"{prefix}_more": more})
    # what a span has before the first and after the last base span that it meets
    base_ = F.col(f"{prefix}_base")

    def parts(s: Column) -> Column:
        met = F.filter(base_, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        span = lambda a, b: F.struct(a.alias("start"), s["kind"].alias("kind"), b.alias("end"))
        sides = F.array(span(s["start"], F.array_min(F.transform(met, lambda b: b["start"]))), span(F.array_max(F.transform(met, lambda b: b["end"])), s["end"]))
        return F.when(F.size(met) == 0, F.array(span(s["start"], s["end"]))).otherwise(F.filter(sides, lambda x: x["end"] - x["start"] >= PART))

    apart = F.flatten(F.transform(F.col(f"{prefix}_more"), parts))
    return out.withColumn(f"{prefix}_all", F.array_sort(F.concat(base_, apart))).drop(f"{prefix}_more")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, all spans."""
    d = with_spans(docs.select(F.col(key), F.col(text).alias("_text")), "_text", "_s")

    def n(spans: str, kind: int) -> Column:
        return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("bigint")

    return d.select(
        key,
        n("_s_base", 0).alias("n_assign"), n("_s_base", 1).alias("n_access"), n("_s_base", 2).alias("n_hex"),
        F.sha2(_joined(F.col("_s_base")), 256).alias("base_sha256"), _joined(F.col("_s_all")).alias("spans"), n("_s_all", 3).alias("n_entropy"),
    )


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span in ``text`` replaced by ``mark``; where spans
    overlap, their union is replaced once. A null text stays null."""
    d = with_spans(docs, text, "_secret")
    t, spans = F.col(text), F.col("_secret_all")

    def step(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["pos"], F.concat(F.substr(t, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit(mark))).otherwise("")
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("out"))
    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(t, acc["pos"] + 1, F.length(t).cast("bigint"))))
    return d.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(t)).select(*docs.columns)
