"""Personal data in texts: patterns propose spans, checks confirm them, words nearby
move their scores. Column expressions only.

A pattern's matches are marked in the text and the text is cut at the marks, which
gives each match with what stands around it; starts follow from the lengths of the
parts. All patterns are possessive or of bounded length, so that no text makes the
matcher go back far or deep.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import free_name

# Marks that no pattern matches; a text that holds them has STAND_IN in their place.
MARK, CUT, STAND_IN = "", "", ""
# Characters looked at on either side of a match, and the score a span needs.
NEARBY = 40
ENOUGH = 0.5
# Lengths are summed in stretches of this many parts.
STRETCH = 128

# Characters of an IBAN by country: the registry's, then those in partial use.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST AO CV GW MZ", 26: "IS TR DZ IR",
    27: "BI DJ FR GR IT MC MR SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")[0-9]{2}"
# As many signs as the country has; of codes not listed any number, but none that begin another.
_IBAN = "|".join(
    [f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
    + [f"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!{_KNOWN}))?[A-Z0-9]){{11,30}}"]
)

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))


def _is_iban(match: Column) -> Column:
    """Mod-97 over the digits, letters counting as 10 to 35, the first four last."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.regexp_extract_all(turned, F.lit("."), 0), F.lit(0), step) == 1


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a text without a match of it has none of the pattern
    score: float  # of a confirmed match, before its surroundings count
    words: str  # words nearby that speak for it
    valid: Callable[[Column], Column] = lambda match: F.lit(True)


BASE = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "mail|contact|write",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.7, "address|host|server|login",
        lambda match: match.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"),
    ),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9]", 0.8, "card|visa|credit|pay", _is_card),
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|call|tel|fax",
        lambda match: F.length(_digits(match)).between(10, 15),
    ),
)
MORE = (
    Kind(
        "iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.8,
        "iban|account|bank", _is_iban,
    ),
    Kind("secret", r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])", "[0-9a-f]{32}", 0.3, "token|secret|key|password"),
)
KINDS = BASE + MORE


def _clean(text: Column) -> Column:
    known = F.coalesce(text, F.lit(""))
    marked = known.contains(MARK) | known.contains(CUT)
    return F.when(marked, F.translate(known, MARK + CUT, STAND_IN * 2)).otherwise(known)


def _parts(text: Column, kind: Kind) -> Column:
    """The text before the first match, then each match, CUT and the text behind it."""
    marked = F.regexp_replace(text, kind.pattern, f"{MARK}$0{CUT}")
    return F.when(text.rlike(kind.hint), F.split(marked, MARK)).otherwise(F.array(text))


def _starts(sizes: Column) -> Column:
    """For each size the sum of those before it."""

    def running(stretch: Column, first: Column) -> Column:
        zero = F.struct(first.cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("out"))
        return F.aggregate(
            stretch,
            zero,
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    stretches = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / STRETCH).cast("int")),
        lambda k: F.slice(sizes, k * STRETCH + 1, F.lit(STRETCH)),
    )
    totals = F.transform(stretches, lambda s: F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x))
    return F.flatten(F.zip_with(stretches, running(totals, F.lit(0)), running))


def _around(parts: Column, k: Column) -> Column:
    """What stands on either side of the match in part `k`, other matches of its kind left out."""

    def between(part: Column) -> Column:
        return F.substring_index(part, CUT, -1)

    def joined(own: Column, begin: Column, number: Column, cut: Callable[[Column, Column], Column]) -> Column:
        # Other parts count only if their neighbour is short.
        more = F.transform(F.slice(parts, begin, number), lambda p: cut(between(p), F.lit(NEARBY)))
        return cut(F.when(F.length(own) >= NEARBY, own).otherwise(F.array_join(more, "")), F.lit(NEARBY))

    left = joined(between(F.get(parts, k - 1)), F.greatest(k - NEARBY, F.lit(0)) + 1, F.least(k, F.lit(NEARBY)), F.right)
    right = joined(between(F.get(parts, k)), k + 1, F.lit(NEARBY), F.left)
    return F.lower(F.concat(left, F.lit(" "), right))


def _spans(parts: Column, starts: Column, kind: Kind) -> Column:
    """The confirmed matches with their scores; base kinds stay whatever the score."""

    def span(k: Column) -> Column:
        match = F.substring_index(F.get(parts, k), CUT, 1)
        begin = F.get(starts, k)
        near = _around(parts, k).rlike(kind.words)
        return F.struct(
            begin.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind.name).alias("kind"),
            (begin + F.length(match)).alias("end"),
            F.when(kind.valid(match), F.when(near, min(1.0, kind.score + 0.3)).otherwise(kind.score)).alias("score"),
        )

    def stays(s: Column) -> Column:
        return s["score"].isNotNull() if kind in BASE else F.coalesce(s["score"] >= ENOUGH, F.lit(False))

    return F.when(
        F.size(parts) > 1, F.filter(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), span), stays)
    )


def find_spans(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """`docs` with a column `name`: array of (start, rank, kind, end, score), by start, then kind.

    Positions count code points from 0, the end is exclusive. Per kind the matches
    are the leftmost non-overlapping ones; those a check refutes are dropped and
    not tried again. Spans of different kinds may overlap. Null and empty texts have
    an empty array. Repeated rows and other columns stay as they are; a column of the
    same name is replaced.
    """
    clean = free_name("_text", docs.columns)
    of = {(s, k): free_name(f"_{s}_{k.name}", docs.columns) for k in KINDS for s in "pnsf"}
    out = docs.withColumn(clean, _clean(F.col(text)))
    out = out.withColumns({of["p", k]: _parts(F.col(clean), k) for k in KINDS})
    # The last character counted of a part is its CUT, except in the first.
    sizes = {
        of["n", k]: F.transform(of["p", k], lambda p, i: F.length(p) - F.when(i > 0, 1).otherwise(0)) for k in KINDS
    }
    out = out.withColumns(sizes)
    out = out.withColumns({of["s", k]: _starts(F.col(of["n", k])) for k in KINDS})
    found = [_spans(F.col(of["p", k]), F.col(of["s", k]), k) for k in KINDS]
    out = out.withColumns({of["f", k]: f for k, f in zip(KINDS, found, strict=True)})
    empty = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>)")
    each = [F.coalesce(F.col(of["f", k]), empty) for k in KINDS]
    return out.withColumn(name, F.array_sort(F.concat(*each))).drop(clean, *of.values())


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `id`, the number of spans of each base kind, a digest of the base spans,
    and all spans as text."""
    found = find_spans(docs.select(id, text), text)

    def number(kind: Kind) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == kind.name)
        return F.size(own).cast("long").alias(f"n_{kind.name}")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select(
        id, *map(number, BASE), F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans")
    )


def _replaced(parts: Column, kind: Kind) -> Column:
    """The text of the parts, with the kind's name for its confirmed matches."""

    def put(k: Column) -> Column:
        part = F.get(parts, k)
        match, behind = F.substring_index(part, CUT, 1), F.substring_index(part, CUT, -1)
        taken = kind.valid(match)
        if kind.score < ENOUGH:
            taken = taken & _around(parts, k).rlike(kind.words)
        return F.concat(F.when(taken, f"<{kind.name}>").otherwise(match), behind)

    rest = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), put)
    return F.when(F.size(parts) > 1, F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(
        F.get(parts, F.lit(0))
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every span of `text` replaced by its kind, as in `<email>`.

    Kinds are replaced one after another, so of overlapping spans the kind listed
    first counts. A null text stays null. A text that holds MARK or CUT gets STAND_IN
    for them.
    """
    clean, parts = free_name("_text", docs.columns), free_name("_parts", docs.columns)
    out = docs.withColumn(clean, _clean(F.col(text)))
    for kind in KINDS:
        out = out.withColumn(parts, _parts(F.col(clean), kind))
        out = out.withColumn(clean, _replaced(F.col(parts), kind))
    return out.withColumn(text, F.when(F.col(text).isNotNull(), F.col(clean))).drop(clean, parts)
