"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust scores.

Everything is a DataFrame expression.  Positions come from splitting a text at a pattern: what lies
between the matches has known lengths.  Patterns are written so that no text makes them slow: repeats
that can't give anything back are possessive, and a run of characters is tried from its first one only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, whole_text

_MAIL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"  # a number of at most 255
#: Patterns of each kind, in the order in which kinds are listed.  Where a pattern begins with a run of
#: characters, a match begins at the run's start or where the match before ended (\G).
PATTERNS = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
#: What a text must hold for a kind to be sought at all; each is implied by the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: Words near a span (WINDOW characters on each side) that speak for its kind.
CONTEXT = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|host|server", "card": "card|visa|credit|payment|master",
    "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank|transfer", "ssn": "ssn|social|security|tax",
}
WINDOW = 40
#: Scores without context and what context adds; added kinds need THRESHOLD, base kinds always stay.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_SCORE, THRESHOLD = 0.4, 0.6


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of value pass Luhn's check."""
    text = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(text, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 check: letters count from 10, the head goes last."""
    text = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def add(total: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (total * 100 + code - 55) % 97).otherwise((total * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda t, c: F.when(c == "", t).otherwise(add(t, c))) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), luhn(value)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return F.when(F.length(value) >= 15, mod97(value)).otherwise(False)
    if kind == "ssn":
        return ~value.rlike("^(?:000|666|9)") & ~value.rlike("-00-|-0000$")
    return F.lit(True)


def _found(kind: str) -> Column:
    """array<struct<start, end, value>> of all matches in __text, confirmed or not."""
    pattern = F.lit(PATTERNS[kind])
    values = F.regexp_extract_all("__text", pattern, F.lit(0))
    gaps = F.split("__text", PATTERNS[kind], -1)
    pairs = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(values)), F.length).alias("gap"), values.alias("value"))
    none = F.expr("CAST(array() AS array<struct<start: int, `end`: int, value: string>>)")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    spans = F.when(F.col("__text").rlike(PATTERNS[kind]), F.aggregate(pairs, begin, add, lambda s: s["spans"])).otherwise(none)
    return F.when(F.contains("__text", F.lit(NEEDS[kind])), spans).otherwise(none) if kind in NEEDS else spans


def _scored(kind: str, rank: int) -> Column:
    """Confirmed spans as structs that sort by start, then kind."""

    def finding(span: Column) -> Column:
        left = F.greatest(F.lit(0), span["start"] - WINDOW)
        near = F.concat_ws(
            " ",
            F.substring("__text", left + 1, span["start"] - left),
            F.substring("__text", span["end"] + 1, F.lit(WINDOW)),
        )
        score = F.least(F.lit(1.0), SCORES[kind] + F.when(F.lower(near).rlike(CONTEXT[kind]), CONTEXT_SCORE).otherwise(0.0))
        return F.struct(
            span["start"].alias("start"), F.lit(rank).alias("rank"), span["end"].alias("end"),
            F.lit(kind).alias("kind"), span["value"].alias("value"), score.alias("score"),
        )

    return F.transform(F.filter(F.col(f"__{kind}"), lambda s: confirmed(kind, s["value"])), finding)


def findings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, __text and __findings: array of (start, rank, end, kind, value, score) by start,
    then kind, in code points, end exclusive.  Null and empty texts have none; rows are independent."""
    out = docs.select(*keep, whole_text().alias("__text"))
    out = out.select("*", *(_found(kind).alias(f"__{kind}") for kind in PATTERNS))
    parts = []
    for rank, kind in enumerate(PATTERNS):
        scored = _scored(kind, rank)
        parts.append(scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= THRESHOLD))
    return out.select(*keep, "__text", F.array_sort(F.concat(*parts)).alias("__findings"))


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, findings."""
    rows = findings(docs)
    base = F.filter("__findings", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("__findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("__findings")).alias("spans"), F.col("__findings").alias("findings")
    )


def redacted(docs: DataFrame) -> DataFrame:
    """docs with every finding replaced by its kind in brackets; overlapping ones by the first's kind.
    Null texts stay null; other columns are kept as they are."""
    names = docs.columns
    rows = findings(docs, tuple(names))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substring("__text", state["at"] + 1, s["start"] - state["at"])
        new = F.concat(state["done"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, new).otherwise(state["done"]).alias("done")
        )

    rest = F.expr("length(__text)")
    whole = F.aggregate(
        "__findings", begin, add, lambda s: F.concat(s["done"], F.substring("__text", s["at"] + 1, rest - s["at"]))
    )
    clean = F.when(F.size("__findings") == 0, F.col("text")).otherwise(whole).alias("text")
    return rows.select(*(clean if c == "text" else c for c in names))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns; findings (with values) stay inside."""
    return digests(read(spark, sf_dir, "documents")).drop("findings")
