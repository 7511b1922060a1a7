"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

A score tells how sure a confirmed span is: each kind's own, raised where a word of its field stands
nearby and lowered where one says that the value is made up. Spans of the base kinds always count;
those of added kinds count from ``KEEP_FROM`` on, in the result and in masking alike.

Everything is built from SQL functions. A pattern cuts a text into matches and the gaps between
them; positions are running sums of their lengths in code points, and the words near a match are the
ends of the gaps beside it, so a text is scanned once per kind and never searched again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import prepared

CONTEXT = 40
# Positions are summed in blocks of this many matches, so a text full of matches stays cheap.
BLOCK = 256

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """True if the digits of a text pass the Luhn check."""
    digits = F.split(F.reverse(_digits(text)), "")
    doubled = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(text: Column) -> Column:
    """True if a text, its first four characters moved behind, is 1 modulo 97 (A = 10 ... Z = 35)."""
    plain = F.regexp_replace(text, " ", "")
    moved = F.split(F.concat(F.substring(plain, 5, 1 << 20), F.substring(plain, 1, 4)), "")
    values = F.transform(
        F.filter(moved, lambda c: c != ""),
        lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55),
    )
    return (
        F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, a * 100 + v).otherwise(a * 10 + v) % 97) == 1
    )


def _length(text: Column, least: int, most: int) -> Column:
    return F.length(_digits(text)).between(least, most)


# Characters of an account number by country, as registered.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """An account number of its country's length with no letter or digit behind it, in blocks of four
    with or without blanks; failing that, any run of such blocks, as far as it goes.
    """
    fixed = [
        f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}"
        + (f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else "")
        for length, names in LENGTHS.items()
    ]
    free = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    return f"(?=[A-Z]{{2}}[0-9]{{2}})(?:(?:{'|'.join(fixed)})(?![A-Za-z0-9])|{free})"


@dataclass(frozen=True)
class Kind:
    """A pattern, its check, the score of a confirmed span, and words that raise it.

    Patterns use possessive steps and look-behinds where these match the same spans as the plain
    form, so long runs of letters or digits cost linear time and no deep recursion.
    """

    name: str
    pattern: str
    check: object
    score: float
    words: str
    # A character without which a text cannot match; it spares most texts the pattern.
    sign: str = ""

    def matches(self, text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(self.pattern), 0)
        return F.when(F.contains(text, F.lit(self.sign)), found).otherwise(F.array().cast("array<string>"))


KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        lambda m: F.lit(True),
        0.9,
        "mail|contact|write|kontakt|correo",
        sign="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        0.6,
        "ip|address|host|server|adresse",
    ),
    Kind(
        "card",
        "[0-9](?:[ -]?[0-9])++",
        lambda m: _length(m, 13, 19) & luhn(m),
        0.7,
        "card|visa|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda m: _length(m, 9, 15),
        0.6,
        "phone|call|tel|fax|mobile",
        sign="+",
    ),
    # Beyond the base kinds: account numbers, which a second checksum confirms.
    Kind(
        "iban",
        _iban(),
        mod97,
        0.8,
        "iban|account|bank|konto|compte|cuenta",
    ),
)
BASE = KINDS[:4]
BONUS, MALUS = 0.1, 0.4
# Whole words that call a value an example rather than somebody's; as part of an address they do not.
MADE_UP = (
    "(?:^|[^a-z@.])(?:example|sample|dummy|fictitious|beispiel|muster|exemple|fictif|ejemplo|ficticio)(?:[^a-z@.]|$)"
)
# Added kinds count from this score on.
KEEP_FROM = 0.5


def score_of(kind: Kind, before: Column, behind: Column) -> Column:
    """The score of a span with these texts around it, of which the next 40 characters matter."""
    around = F.lower(F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(behind, F.lit(CONTEXT))))
    raised = F.when(around.rlike(f"(?:{kind.words})"), F.lit(BONUS)).otherwise(F.lit(0.0))
    lowered = F.when(around.rlike(MADE_UP), F.lit(MALUS)).otherwise(F.lit(0.0))
    return F.round(F.lit(kind.score) + raised - lowered, 2)


def counts(kind: Kind, score: Column) -> Column:
    """Whether a confirmed span counts: always for the base kinds, by its score for added ones."""
    return F.lit(True) if kind in BASE else score >= KEEP_FROM


def _running(lengths: Column) -> Column:
    """Sums of all elements before each element, in blocks: sums of blocks first, then inside."""

    def before(values: Column) -> Column:
        start = F.array(F.lit(0).cast("long"))
        return F.aggregate(values, start, lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)

    count = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    offsets = before(F.transform(blocks, total))
    inner = F.zip_with(
        blocks,
        F.slice(offsets, 1, F.size(blocks)),
        lambda values, offset: F.transform(F.slice(before(values), 1, F.size(values)), lambda v: v + offset),
    )
    return F.flatten(inner)


def with_spans(docs: DataFrame, text: str, kind: Kind, out: str) -> DataFrame:
    """Add an array of ``kind, start, end, score, value`` with the confirmed spans of one kind."""
    found, gaps, starts, span = (f"{out}_{x}" for x in ("found", "gaps", "starts", "span"))
    any_ = F.size(found) > 0
    steps = docs.withColumn(found, kind.matches(F.col(text)))
    steps = steps.withColumn(gaps, F.when(any_, F.split(text, kind.pattern, -1)))
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(found)), found, lambda g, m: (F.char_length(g) + F.char_length(m)).cast("long")
    )
    steps = steps.withColumn(starts, F.when(any_, pairs))
    steps = steps.withColumn(starts, F.when(any_, _running(F.col(starts))))
    spans = F.transform(
        found,
        lambda m, i: F.struct(
            F.lit(kind.name).alias("kind"),
            (F.col(starts)[i] + F.char_length(F.col(gaps)[i])).alias("start"),
            (F.col(starts)[i] + F.char_length(F.col(gaps)[i]) + F.char_length(m)).alias("end"),
            score_of(kind, F.col(gaps)[i], F.col(gaps)[i + 1]).alias("score"),
            m.alias("value"),
        ),
    )
    sure = F.filter(spans, lambda s: kind.check(s["value"]) & counts(kind, s["score"]))
    steps = steps.withColumn(span, F.when(any_, sure))
    kept = F.coalesce(span, F.array().cast(_SPANS))
    return steps.withColumn(out, kept).drop(found, gaps, starts, span)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,value:string>>"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per input row: ``id`` and ``spans``, an array of ``kind, start, end, score, value``.

    Positions count code points, the end is exclusive, spans come by kind as listed, then start. Per
    kind the matches are leftmost and non-overlapping; those that fail their check are dropped
    without another try. An account number ends at its country's registered length if no letter or
    digit follows, so words behind it do not join it; other countries' numbers end where the run of
    blocks of four ends. Spans of different kinds may overlap. The score is the kind's own, raised by
    0.1 if one of its context words stands within 40 characters before or after (not beyond the kind's
    next match) and lowered by 0.4 if a word for an example does. Spans of base kinds are kept whatever
    their score, those of added kinds (account numbers) from 0.5 on.

    A null text counts as empty and has no spans; null ids and repeated rows are rows like others;
    an empty table gives no rows. Only the two named columns are read. Long texts are read whole.
    """
    prepared(docs.sparkSession)
    steps = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    for kind in kinds:
        steps = with_spans(steps, "text", kind, f"of_{kind.name}")
    return steps.select("id", F.concat(*[F.col(f"of_{k.name}") for k in kinds]).alias("spans"))


def masked(text: Column, kind: Kind) -> Column:
    """A text with the spans of one kind that count replaced by its name in brackets."""
    tag = F.lit(f"[{kind.name.upper()}]")
    found, gaps = kind.matches(text), F.split(text, kind.pattern, -1)

    def sure(m: Column, i: Column) -> Column:
        return kind.check(m) if kind in BASE else kind.check(m) & counts(kind, score_of(kind, gaps[i], gaps[i + 1]))

    swapped = F.transform(found, lambda m, i: F.when(sure(m, i), tag).otherwise(m))
    whole = F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size(found)), swapped, lambda g, m: F.concat(g, m)), ""), F.element_at(gaps, -1))
    return F.when(F.contains(text, F.lit(kind.sign)) & text.rlike(kind.pattern), whole).otherwise(text)


# Longer forms first: an account number holds digit runs that could pass as a card.
MASK_ORDER = ("iban", "email", "phone", "card", "ip")


def without_personal_data(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The documents, all columns kept, with personal data masked as ``[KIND]``.

    What counts is what ``personal_data`` keeps: confirmed spans, of added kinds those with a score of
    at least 0.5 by the words around them. Kinds are masked one after the other, so overlapping spans
    are masked once, by the first kind of ``MASK_ORDER``. Null texts stay null and empty ones empty; every
    row stays, repeated rows alike; an empty table gives no rows. Only the text column is replaced, so
    further columns, of whatever name, stay as they are. Texts of any length are masked whole.
    """
    prepared(docs.sparkSession)
    by_name = {k.name: k for k in kinds}
    for name in [n for n in MASK_ORDER if n in by_name] + [n for n in by_name if n not in MASK_ORDER]:
        docs = docs.withColumn(text_col, masked(F.col(text_col), by_name[name]))
    return docs
