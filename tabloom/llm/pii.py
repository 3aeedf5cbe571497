"""Personal data in texts: patterns propose spans, checksums confirm, context adjusts.

Each ``Kind`` names a pattern, a cheap gate that most texts fail, a check of the
matched text (digits, Luhn, mod-97), a score and words that raise the score when
they stand near.  A span is reported from ``THRESHOLD`` on.  The kinds of
``BASE`` pass on pattern and check alone; the kinds of ``ADDED`` need a checksum
or a context word, and give way to base spans that they overlap.

Spans are counted in code points, end exclusive.  Their starts follow from the
pieces between the matches, so each text is split and matched by Spark's own
expressions; no Python runs.  Patterns are written so that a match never needs
nested backtracking: long runs of digits or letters cost linear time.

Edge cases: a null or empty text has no spans; texts are searched as a whole;
rows are independent, so ids, ties, repeated rows and other columns do not
matter.  Work per text grows in proportion to its length and its number of spans
(``redact`` reads the text once more per ``REDACTED`` spans).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabloom.llm.common import bound, running

THRESHOLD = 0.5
#: A context word counts within this many code points before or after a span.
WINDOW = 40
CONTEXT_BONUS = 0.4
#: Matches of this many code points at least, so that so many of them fill a window.
SHORTEST = 5
#: Spans that are replaced in one part of the text.
REDACTED = 256
SPAN = "struct<start:int,place:int,end:int,kind:string,score:double>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str
    check: Callable[[Column], Column]
    score: float
    context: tuple[str, ...] = ()


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid Luhn checksum."""

    def value(digit: Column, place: Column) -> Column:
        doubled = digit.cast("int") * (1 + place % 2)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    values = F.transform(F.split(F.reverse(number), ""), value)
    return F.aggregate(values, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN leaves the remainder 1."""
    compact = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))

    def step(rest: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _octets(address: Column) -> Column:
    parts = F.transform(F.split(address, "\\."), lambda part: F.regexp_replace(part, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda part: (F.length(part) <= 3) & (F.substring(part, 1, 3).cast("int") <= 255))


def _card(text: Column) -> Column:
    number = digits(text)
    return F.length(number).between(14, 19) & luhn(number)


def _iban(text: Column) -> Column:
    return F.length(F.replace(text, F.lit(" "), F.lit(""))).between(15, 34) & mod97(text)


#: (?<!x)|\G keeps the leftmost start of a run, also right after the match before it.
BASE = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda text: F.lit(True),
        0.9,
    ),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", ".", _octets, 0.6, ("ip", "host", "server", "address")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", _card, 0.8, ("card", "visa", "credit", "payment")),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        lambda text: F.length(digits(text)).between(10, 15),
        0.7,
        ("phone", "call", "tel", "mobile", "fax"),
    ),
)
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "",
        _iban,
        0.8,
        ("iban", "account", "bank"),
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "-",
        lambda text: ~text.rlike("^(000|666|9)|-00-|-0000$"),
        0.3,
        ("ssn", "social security"),
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        "",
        lambda text: F.lit(True),
        0.3,
        ("phone", "call", "tel", "mobile", "fax"),
    ),
)


def _positions(text: Column, pattern: str, context: bool) -> Column:
    """start, end, text, and the text around of all matches, from the pieces between them."""
    matched = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda piece, match: F.struct(piece.alias("piece"), match.alias("match")),
    )

    def step(at: Column, pair: Column) -> Column:
        start = at + F.length(pair["piece"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        value = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("state"), value.alias("value"))

    def placed(pairs: Column) -> Column:
        return running(pairs, F.lit(0), step, "struct<start:int,end:int,match:string>")

    # Pieces and matches in order; so many of them fill a window.
    many = 2 * (WINDOW // SHORTEST) + 1

    def cut(pairs: Column, side: Callable[[Column, Column], Column]) -> Column:
        parts = F.transform(pairs, lambda p: F.array(*[side(p[name], F.lit(WINDOW)) for name in ("piece", "match")]))
        return F.flatten(parts)

    def around(pairs: Column) -> Column:
        def one(span: Column, i: Column, ends: Column, heads: Column) -> Column:
            first = F.greatest(2 * i + 2 - many, F.lit(1))
            before = F.array_join(F.slice(ends, first, 2 * i + 2 - first), "")
            after = F.array_join(F.slice(heads, 2 * i + 3, F.lit(many)), "")
            return F.struct(
                span["start"].alias("start"), span["end"].alias("end"), span["match"].alias("match"),
                F.right(before, F.lit(WINDOW)).alias("before"), F.left(after, F.lit(WINDOW)).alias("after"),
            )

        return bound(
            cut(pairs, F.right),
            lambda ends: bound(
                cut(pairs, F.left),
                lambda heads: F.transform(placed(pairs), lambda span, i: one(span, i, ends, heads)),
            ),
        )

    spans = bound(matched, around if context else placed)
    return F.filter(spans, lambda span: span["match"].isNotNull())


def _found(text: Column, kind: Kind, place: int) -> Column:
    """Spans of one kind with their scores."""
    gate = F.contains(text, F.lit(kind.gate)) if kind.gate else F.lit(True)
    if kind.name in ("ip", "card", "iban", "ssn", "local_phone"):
        gate &= text.rlike({"ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}"}.get(kind.name, kind.pattern))
    near = "(?i)(?<![A-Za-z])(?:" + "|".join(kind.context) + ")(?![A-Za-z])"

    def scored(span: Column) -> Column:
        score = F.lit(kind.score)
        if kind.context:
            close = span["before"].rlike(near) | span["after"].rlike(near)
            score = F.least(F.lit(1.0), score + F.when(close, CONTEXT_BONUS).otherwise(0.0))
        return F.struct(
            span["start"].alias("start"), F.lit(place).alias("place"), span["end"].alias("end"),
            F.lit(kind.name).alias("kind"), score.alias("score"),
        )

    checked = F.filter(_positions(text, kind.pattern, bool(kind.context)), lambda span: kind.check(span["match"]))
    kept = F.filter(F.transform(checked, scored), lambda span: span["score"] >= THRESHOLD)
    return F.when(gate, kept.cast(f"array<{SPAN}>")).otherwise(F.from_json(F.lit("[]"), f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_found(text, kind, i) for i, kind in enumerate(BASE)]))


def all_spans(text: Column, base: Column) -> Column:
    """``base`` and the spans of the added kinds that overlap none of them, by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    added = F.concat(*[_found(text, kind, len(BASE) + i) for i, kind in enumerate(ADDED)])
    is_base = F.lit(len(BASE))

    def from_left(reached: Column, span: Column) -> Column:
        value = F.struct(span.alias("span"), (span["start"] < reached).alias("covered"))
        end = F.when(span["place"] < is_base, F.greatest(reached, span["end"])).otherwise(reached)
        return F.struct(end.alias("state"), value.alias("value"))

    def from_right(following: Column, seen: Column) -> Column:
        span = seen["span"]
        value = F.struct(span.alias("span"), (seen["covered"] | (following < span["end"])).alias("covered"))
        first = F.when(span["place"] < is_base, F.least(following, span["start"])).otherwise(following)
        return F.struct(first.alias("state"), value.alias("value"))

    def merged(more: Column) -> Column:
        kind = f"struct<span:{SPAN},covered:boolean>"
        left = running(F.array_sort(F.concat(base, more)), F.lit(0), from_left, kind)
        both = F.reverse(running(F.reverse(left), F.length(text), from_right, kind))
        kept = F.filter(both, lambda x: (x["span"]["place"] < is_base) | ~x["covered"])
        return F.when(F.size(more) == 0, base).otherwise(F.transform(kept, lambda x: x["span"]))

    return bound(added, merged)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    shape = "struct<start:int,end:int,label:string>"

    def step(at: Column, span: Column) -> Column:
        """Where the text goes on before this span, and its label if it is apart from the span before."""
        apart = span["start"] >= at
        label = F.when(apart, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        value = F.struct(F.when(apart, at).alias("start"), span["start"].alias("end"), label.alias("label"))
        return F.struct(F.greatest(at, span["end"]).alias("state"), value.alias("value"))

    def parts(cuts: Column) -> Column:
        def part(number: Column) -> Column:
            """The text of so many cuts, read from a piece of the text that begins with the first."""
            some = F.slice(cuts, number * REDACTED + 1, F.lit(REDACTED))
            first, last = some[0]["start"], F.element_at(some, -1)["end"]
            return bound(
                F.struct(F.substr(text, first + 1, last - first).alias("text"), first.alias("at")),
                lambda piece: F.array_join(
                    F.transform(
                        some,
                        lambda cut: F.concat(
                            F.substr(piece["text"], cut["start"] - piece["at"] + 1, cut["end"] - cut["start"]), cut["label"]
                        ),
                    ),
                    "",
                ),
            )

        numbers = F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / REDACTED).cast("int"))
        return F.array_join(F.transform(numbers, part), "")

    cuts = F.filter(running(spans, F.lit(0), step, shape), lambda cut: cut["label"].isNotNull())
    last = F.aggregate(spans, F.lit(0), lambda at, span: F.greatest(at, span["end"]))
    changed = F.concat(bound(cuts, parts), F.substr(text, last + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(changed)
