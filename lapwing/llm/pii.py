"""Personal data: patterns propose, checksums confirm, context adjusts (native).

Every kind has one pattern.  ``split`` and ``regexp_extract_all`` cut a text into
matches and the gaps between them, so positions are running sums of lengths in
code points.  Validators then drop proposals: address parts over 255, Luhn for
cards, mod-97 for account numbers, digit counts for phones.  What is left gets a
score: a prior for its kind, more for a checksum that held, more for a telling
word in the ``CONTEXT_CHARS`` characters of gap on either side.

The base kinds (``email ip card phone``) stay whatever their score; the further
kinds (``iban ssn``) stay from ``THRESHOLD`` on.

The patterns are possessive rewrites of the plain ones.  Each can start only
where the plain one could first succeed (not inside a run that has just failed,
except right after a match), so a long run costs linear time and no deep stack.

Defined results: null and empty texts have no spans; spans never overlap within a
kind; a span's end is exclusive; repeated rows give repeated results; extra
columns are kept by :func:`detect` unless they are called, in whatever case, like
its output; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwing.llm._common import other_columns, read_table, text_or_empty

CONTEXT_CHARS = 40
THRESHOLD = 0.5
#: Matches are summed in blocks of this many, so that running sums stay near linear.
_BLOCK = 512

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + EXTRA_KINDS

_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Cheap necessary conditions, so that most texts skip the real patterns.
GATES = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
PRIORS = {"email": 0.7, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.3, "ssn": 0.3}
CHECKED_BONUS = 0.4
CONTEXT_BONUS = 0.25
CHECKED = ("card", "iban")
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|correo|courriel|kontakt)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|tarjeta|carte|karte)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|tel[eé]fono)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social security|tax id)\b",
}


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn's check over a string of ASCII digits."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d >= 5, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97_ok(account: Column) -> Column:
    """ISO 7064 mod 97-10: the first four characters moved to the end leave 1."""
    a = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substr(a, F.lit(5)), F.substr(a, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(c >= 65, acc * 100 + c - 55).otherwise(acc * 10 + c - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(16, 19), luhn_ok(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return mod97_ok(m)
    if kind == "ssn":
        return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _scan(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each element what ``join`` makes of 0 and all before it, in blocks (see
    ``_BLOCK``)."""
    block, zero = F.lit(_BLOCK), F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")

    def scan(xs: Column, from_: Column) -> Column:
        return F.aggregate(
            xs,
            F.struct(from_.cast("bigint").alias("at"), none.alias("out")),
            lambda a, x: F.struct(join(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        )

    def blocks(xs: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")),
            lambda b: F.slice(xs, b * block + 1, block),
        )

    parts = blocks(values)
    whole = F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: join(a, x)))
    chunked = F.flatten(F.zip_with(parts, scan(whole, zero)["out"], lambda p, o: scan(p, o)["out"]))
    return F.when(F.size(values) <= _BLOCK, scan(values, zero)["out"]).otherwise(chunked)


def _prefix_sums(lengths: Column) -> Column:
    """For each element the sum of those before it."""
    return _scan(lengths, lambda a, x: a + x)


def _proposals(text: Column, kind: str) -> Column:
    """``array<struct<kind, start, end, text, score>>`` of a kind, validated."""
    pattern = PATTERNS[kind]
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    n = F.size(found)
    lengths = F.zip_with(F.slice(gaps, F.lit(1), n), found, lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
    rows = F.arrays_zip(
        found.alias("m"), F.slice(gaps, F.lit(1), n).alias("before"), F.slice(gaps, F.lit(2), n).alias("after"), _prefix_sums(lengths).alias("at")
    )
    rows = F.filter(rows, lambda r: _valid(kind, r["m"]))

    def shape(r: Column) -> Column:
        near = F.concat_ws(" ", F.right(r["before"], F.lit(CONTEXT_CHARS)), F.left(r["after"], F.lit(CONTEXT_CHARS)))
        start = r["at"] + F.length(r["before"])
        score = F.lit(PRIORS[kind] + (CHECKED_BONUS if kind in CHECKED else 0.0)) + F.when(
            near.rlike(CONTEXT[kind]), F.lit(CONTEXT_BONUS)
        ).otherwise(F.lit(0.0))
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(r["m"])).alias("end"), r["m"].alias("text"), F.least(score, F.lit(1.0)).alias("score")
        )

    spans = F.transform(rows, shape)
    if kind in EXTRA_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    kind_type = "array<struct<kind:string,start:bigint,end:bigint,text:string,score:double>>"
    return F.when(text.rlike(GATES[kind]), spans.cast(kind_type)).otherwise(F.array().cast(kind_type))


def detect(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` and a column of spans ordered by kind (as in ``KINDS``), then start."""
    text = text_or_empty(F.col(text_col))
    kept = [F.col(f"`{docs.columns[i]}`") for i in other_columns(docs, out_col)]
    return docs.select(*kept, F.concat(*[_proposals(text, k) for k in KINDS]).alias(out_col))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind.  Spans that overlap are one,
    of the kind that starts first (of those, the longest).  Null stays null."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    ends = F.transform(ordered, lambda s: -s["end"])
    rows = F.zip_with(ordered, _scan(ends, F.greatest), lambda s, b: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), b.alias("before")))
    rows = F.filter(rows, lambda r: r["start"] >= r["before"])
    cut = lambda start, end: F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))
    pieces = F.transform(rows, lambda r: F.concat(cut(r["before"], r["start"]), F.lit("<"), r["kind"], F.lit(">")))
    rest = F.substr(text, (F.array_max(ends) + 1).cast("int"))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)


def _listing(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(docs).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listing(base), 256).alias("base_sha256"),
        _listing(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
