"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators (digit counts, Luhn, mod 97) confirm
them, and words nearby raise or lower the score. Patterns use possessive
quantifiers and start only where a run of their characters starts (or the last
match ended), so that a very long run costs one pass and no deep recursion;
the matches stay those of the plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before and after a span in which context words count.
NEAR = 48
#: Matches whose running positions are summed at once.
BLOCK = 512


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def mod_97(x: Column) -> Column:
    """The remainder of an account number, letters read as 10 to 35, its first four characters last."""
    plain = F.regexp_replace(x, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(total: Column, c: Column) -> Column:
        one = (total * 10 + F.ascii(c) - 48) % 97
        two = (total * 100 + F.ascii(c) - 55) % 97
        return F.when(c <= F.lit("9"), one).otherwise(two)

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


#: How many characters an IBAN of each country has.
IBAN_LENGTHS = {
    x[:2]: int(x[2:])
    for x in """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27
GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27
MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24
SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30
""".split()
}


def _iban() -> str:
    """Account numbers in groups of four, as long as their country has them.

    The match ends where the number ends, whatever follows. Only codes without a
    known length take as many groups as there are.
    """
    one_length = []
    for length in sorted(set(IBAN_LENGTHS.values())):
        groups, rest = divmod(length - 4, 4)
        codes = "|".join(c for c, n in IBAN_LENGTHS.items() if n == length)
        last = rf"[\x20]?[A-Z0-9]{{{rest}}}" if rest else ""
        one_length.append(rf"(?:{codes})[0-9]{{2}}(?:[\x20]?[A-Z0-9]{{4}}){{{groups}}}{last}")
    other = rf"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}[0-9]{{2}}(?:[\x20]?[A-Z0-9]{{4}}){{2,7}}+(?:[\x20]?[A-Z0-9]{{1,3}})?+"
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(one_length)}|{other})(?![A-Za-z0-9])"


_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, a cheap test that must hold first, validator, score and context words."""

    name: str
    pattern: str
    gate: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str = ""
    against: str = ""
    least: float = 0.0


#: The base kinds, in the order of the contract, then the kinds that the method adds.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda m: F.lit(True),
        0.8,
        "mail|contact|write|reach|address",
        "example|noreply",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        lambda t: t.rlike(r"\.[0-9]++\."),
        lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        0.6,
        "ip|host|server|address|login|from",
        "version|release|section|chapter",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
        lambda m: F.length(digits(m)).between(14, 19) & F.coalesce(F.call_function("luhn_check", digits(m)), F.lit(False)),
        0.8,
        "card|credit|debit|visa|master|amex|pay|carte|karte|tarjeta",
        "order|tracking|serial|isbn",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        lambda m: F.length(digits(m)).between(10, 15),
        0.7,
        "phone|call|tel|mobile|fax|whatsapp|handy",
    ),
    Kind(
        "iban",
        _iban(),
        lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
        lambda m: F.length(F.regexp_replace(m, "[^A-Z0-9]", "")).between(15, 34) & (mod_97(m) == 1),
        0.9,
        "iban|bank|account|konto|cuenta|compte",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"),
        lambda m: F.lit(True),
        0.4,
        "ssn|social|security|tax|taxpayer",
        "",
        0.5,
    ),
)
BASE = 4
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def once(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``x``, evaluated a single time although lambdas in it use it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def running(lengths: Column) -> Column:
    """Sums of all earlier numbers of an array, in blocks so that copies stay few."""
    return once(lengths, _running)


def _running(lengths: Column) -> Column:

    def sums(block: Column, first: Column) -> Column:
        grown = F.aggregate(block, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(grown, 1, F.size(block))

    count = F.size(lengths)
    last = F.floor((F.greatest(count, F.lit(1)) - 1) / F.lit(BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    zero = F.lit(0).cast("bigint")

    def offset(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda x: F.aggregate(x, zero, lambda a, b: a + b))
        return F.flatten(F.zip_with(blocks, sums(totals, zero), sums))

    return once(blocks, offset)


def spans_of(kind: Kind, rank: int, found: Column, pieces: Column) -> Column:
    """The confirmed spans of one kind; ``pieces`` is the text around the matches ``found``."""
    count = F.size(found)
    steps = F.zip_with(found, F.slice(pieces, 1, count), lambda m, p: (F.length(m) + F.length(p)).cast("bigint"))
    before = running(steps)

    def span(one: Column) -> Column:
        m = one["m"]
        start = one["before"] + F.length(one["left"])
        near = F.lower(F.concat(F.right(one["left"], F.lit(NEAR)), F.lit(" "), F.left(one["right"], F.lit(NEAR))))
        score = F.lit(kind.score)
        if kind.words:
            score = score + F.when(near.rlike(rf"\b(?:{kind.words})"), 0.15).otherwise(0.0)
        if kind.against:
            score = score - F.when(near.rlike(rf"\b(?:{kind.against})"), 0.2).otherwise(0.0)
        kept = kind.valid(m) & (score >= kind.least) if kind.least else kind.valid(m)
        row = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.length(m)).alias("end"),
            F.lit(kind.name).alias("kind"),
            F.least(F.lit(1.0), F.round(score, 2)).alias("score"),
        )
        return F.when(kept, row)

    zipped = F.arrays_zip(
        found.alias("m"), before.alias("before"), F.slice(pieces, 1, count).alias("left"), F.slice(pieces, 2, count).alias("right")
    )
    zipped = zipped.cast("array<struct<m:string,before:bigint,left:string,right:string>>")
    made = F.filter(F.transform(zipped, span), lambda x: x.isNotNull())
    return F.when(count > 0, made).otherwise(F.array().cast(_SPAN))


def find(docs: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of every document, and ``spans``: its spans by start, then kind.

    A span has ``start``, ``rank`` (of its kind), ``end`` (code points, end
    exclusive), ``kind`` and ``score`` (0 to 1). A null or empty text has none;
    repeated documents give a row each. Where a kept column is called ``spans``,
    ``prefix`` sets the result apart.
    """
    at = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    empty = F.array().cast("array<string>")
    found = {
        f"__{k.name}": F.when(k.gate(F.col("__text")), F.regexp_extract_all("__text", F.lit(k.pattern), F.lit(0))).otherwise(empty)
        for k in KINDS
    }
    at = at.select(*keep, "__text", *[c.alias(n) for n, c in found.items()])
    around = [
        F.when(F.size(f"__{k.name}") > 0, F.split("__text", k.pattern, -1)).otherwise(empty).alias(f"__{k.name}_around") for k in KINDS
    ]
    at = at.select(*keep, *found, *around)
    parts = [spans_of(k, i, F.col(f"__{k.name}"), F.col(f"__{k.name}_around")) for i, k in enumerate(KINDS)]
    return at.select(*keep, F.array_sort(F.concat(*parts)).alias(f"{prefix}spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of each document."""

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank].name}")

    def joined(spans: Column) -> Column:
        return F.concat_ws(
            ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        )

    base = F.filter("spans", lambda s: s["rank"] < BASE)
    return found.select(
        "doc_id",
        *[count(i) for i in range(BASE)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: s["score"].cast("string"))).alias("scores"),
    )
