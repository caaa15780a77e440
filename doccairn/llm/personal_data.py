"""Personal data: patterns propose spans, checks confirm them, context moves their score.

Built from SQL functions only. A pattern's matches and the text between them come from
``regexp_extract_all`` and ``split``; their lengths add up to code-point positions. The patterns
use possessive runs and start only at the head of a run or where the last match ended
(``\\G``), which finds the same leftmost matches and stays linear in long runs.

Confirmed kinds: ``email``, ``ip`` (parts up to 255), ``card`` (14 to 19 digits, Luhn), ``phone``
(10 to 15 digits), and the method's own ``iban`` (country length range, mod-97). A match that
fails its check is dropped and not tried again. Words of the kind within ``CONTEXT`` code points
add to the score; base kinds stay whatever their score, ``iban`` needs its check.

Defined results: a null text counts as empty; empty texts have no spans. Rows are handled one by
one, so null or repeated ids, repeated rows and other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Code points before and after a span that are searched for words of its kind.
CONTEXT = 40
LOCAL = r"[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A character, or a simple pattern, that every text with a match holds.
    needs: str
    context: str
    prior: float


KINDS = (
    Kind("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         r"(?i)\b(?:e-?mail|contact|write|mailto|reply)\b", 0.8),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]",
         r"(?i)\b(?:ip|address|host|server|login|from)\b", 0.5),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){14}",
         r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment)\b", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+",
         r"(?i)\b(?:tel|phone|call|mobile|fax|dial)\b", 0.6),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}",
         r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b", 0.8),
)
BASE = ("email", "ip", "card", "phone")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string is a multiple of ten; counted from the right."""
    places = F.split(F.reverse(digits), "")

    def weight(character: Column, place: Column) -> Column:
        value = character.cast("int")
        doubled = value * 2
        return F.when(place % 2 == 0, value).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(places, weight), F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) % 10 == 0


def _mod97(match: Column) -> Column:
    packed = F.regexp_replace(match, " ", "")
    turned = F.split(F.concat(F.substring(packed, 5, 40), F.substring(packed, 1, 4)), "")

    def step(rest: Column, character: Column) -> Column:
        code = F.ascii(character)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.when(character == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & _mod97(match)
    return F.lit(True)


def _spans(kind: Kind, order: int, text: Column) -> Column:
    """Confirmed spans of one kind, with their start and end in code points and their score."""
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    lengths = F.zip_with(gaps, matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,match:string>>").alias("found"))

    def add(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        found = F.when(piece["match"].isNull(), state["found"]).otherwise(
            F.concat(state["found"], F.array(F.struct(begin.alias("start"), piece["match"].alias("match")))))
        return F.struct((begin + F.coalesce(F.length(piece["match"]), F.lit(0))).alias("at"), found.alias("found"))

    placed = F.aggregate(lengths, start, add, lambda state: state["found"])

    def scored(span: Column) -> Column:
        end = span["start"] + F.length(span["match"])
        around = F.concat_ws(
            " ",
            F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT))),
            F.substring(text, end + 1, F.lit(CONTEXT)),
        )
        score = F.lit(kind.prior) + F.when(around.rlike(kind.context), 0.2).otherwise(0.0)
        return F.struct(
            span["start"].alias("start"), F.lit(order).alias("rank"), F.lit(kind.name).alias("kind"),
            end.alias("end"), score.alias("score"),
        )

    held = F.filter(placed, lambda span: _confirmed(kind.name, span["match"]))
    possible = F.contains(text, F.lit(kind.needs)) if len(kind.needs) == 1 else text.rlike(kind.needs)
    return F.when(possible, F.transform(held, scored)).otherwise(empty)


def find(documents: DataFrame, text: str = "text", output: str = "pii") -> DataFrame:
    """Add ``output``: an array of (start, rank, kind, end, score), by start, then kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    parts = [_spans(kind, order, body) for order, kind in enumerate(KINDS)]
    return documents.withColumn(output, F.array_sort(F.concat(*parts)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
