"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

All in SQL functions. Positions need no loop over characters: splitting a text at a pattern gives
what lies between its matches, so running sums of lengths give code point offsets. Patterns that
would repeat a group (which overflows the regex engine's stack on long runs) work on a copy of the text
in which a separator inside a run is one control character, so a run is one character class.
Kinds whose mark does not occur in a text are not looked for in it.

A span's score is its pattern's, 0 if the checksum fails, raised by a context word within CONTEXT
characters before it. Spans of THRESHOLD and more count. The base kinds count by their checksums
alone; context only raises their score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quaymill.llm.common import own_column

CONTEXT = 40
THRESHOLD = 0.5
RAISE = 0.35

# Stands for a separator inside a run; where texts hold it themselves it counts as OTHER.
JOIN, OTHER = "\u0001", "\u0002"
_LABEL_DOT = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"
_DIGIT_GAP = r"(?<=[0-9])[\x20-](?=[0-9])"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, size - place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (IBAN, no spaces) leaves 1 modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.left(account, F.lit(4)))

    def step(rest: Column, place: Column) -> Column:
        char = F.substr(turned, place, F.lit(1))
        letter = F.ascii(char) - 55
        return F.when(char.between("0", "9"), (rest * 10 + F.ascii(char) - 48) % 97).otherwise(
            (rest * 100 + letter) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _ip_parts(value: Column) -> Column:
    """Whether all parts are at most 255, leading zeros aside."""
    parts = F.transform(F.split(value, r"\."), lambda part: F.ltrim(part, F.lit("0")))
    return F.forall(
        parts, lambda part: (F.length(part) <= 3) & (F.coalesce(part.try_cast("int"), F.lit(0)) <= 255)
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(14, 19) & luhn(digits)


@dataclass(frozen=True)
class Kind:
    """``mark`` tells cheaply whether a text can hold the kind; ``on`` names the copy searched."""

    name: str
    pattern: str
    score: float
    words: str
    mark: Callable[[Column], Column]
    valid: Callable[[Column], Column] = lambda value: F.lit(True)
    on: str = "text"
    base: bool = True


# Fixed patterns of the base kinds, in their order; the method's own kinds follow.
KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<![A-Za-z0-9._%+{JOIN}-]))[A-Za-z0-9._%+{JOIN}-]++@[A-Za-z0-9-]++{JOIN}[A-Za-z0-9{JOIN}-]++",
        0.9,
        "mail|contact|write|send",
        lambda text: F.contains(text, F.lit("@")),
        on="dots",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.7,
        "ip|server|host|address|login",
        lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        _ip_parts,
    ),
    Kind(
        "card",
        rf"[0-9][0-9{JOIN}]++",
        0.8,
        "card|visa|credit|payment|debit",
        lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
        _card,
        on="runs",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.7,
        "phone|telephone|tel|call|fax|mobile|cell",
        lambda text: F.contains(text, F.lit("+")),
        lambda value: F.length(_digits(value)).between(10, 15),
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
        0.8,
        "iban|account|bank|konto|compte|cuenta",
        lambda text: text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"),
        lambda value: mod97(F.replace(value, F.lit(" "), F.lit(""))),
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        "ssn|social|security",
        lambda text: text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        lambda value: ~value.rlike("^(?:000|666|9)|-00-|-0000$"),
        base=False,
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
        0.3,
        "phone|telephone|tel|call|fax|mobile|cell",
        lambda text: text.rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"),
        base=False,
    ),
)
BASE = [kind.name for kind in KINDS if kind.base]
_SPAN = "struct<start:int,kind_no:int,end:int,score:double>"
_CHUNK = 256
# No CONTEXT characters hold more matches of one kind: a match and the gap after it have three or more.
_EARLIER = CONTEXT // 3 + 1


def _score(kind: Kind, value: Column, before: Column) -> Column:
    """The pattern's score, raised by a context word just before, 0 where the checksum fails."""
    near = F.lower(F.right(before, F.lit(CONTEXT))).rlike(rf"\b(?:{kind.words})s?\b")
    raised = F.lit(kind.score) + F.when(near, RAISE).otherwise(0.0)
    return F.when(kind.valid(value), F.least(raised, F.lit(1.0))).otherwise(0.0)


def _matches(kind: Kind, source: Column) -> Column:
    """All matches of a kind: the length of the gap before, their own length, their score."""
    # One more gap than matches: the last pair has no match.
    parts = F.zip_with(
        F.split(source, kind.pattern, -1),
        F.regexp_extract_all(source, F.lit(kind.pattern), F.lit(0)),
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )

    def measured(parts: Column) -> Column:
        def measure(part: Column, at: Column) -> Column:
            first = F.greatest(at - _EARLIER, F.lit(0))
            earlier = F.transform(
                F.slice(parts, first + 1, at - first),
                lambda one: F.concat(F.right(one["gap"], F.lit(CONTEXT)), one["value"]),
            )
            short = F.length(part["gap"]) < CONTEXT
            before = F.when(short, F.concat(F.array_join(earlier, ""), part["gap"])).otherwise(part["gap"])
            return F.struct(
                F.length(part["gap"]).alias("gap"),
                F.length(part["value"]).alias("size"),
                F.when(part["value"].isNotNull(), _score(kind, part["value"], before)).alias("score"),
            )

        return F.transform(parts, measure)

    # Bound by a lambda, the parts are found once.
    found = F.transform(F.array(parts), measured)[0]
    return F.filter(found, lambda match: match["size"].isNotNull())


def _sums(matches: Column, start: Column, number: int) -> Column:
    """Spans of consecutive matches, from the place where the first one's gap begins."""

    def add(state: Column, match: Column) -> Column:
        begin = state["at"] + match["gap"]
        span = F.struct(
            begin.alias("start"),
            F.lit(number).alias("kind_no"),
            (begin + match["size"]).alias("end"),
            F.coalesce(match["score"], F.lit(0.0)).alias("score"),
        )
        spans = F.concat(state["spans"], F.array(span))
        return F.struct((begin + match["size"]).alias("at"), spans.alias("spans"))

    zero = F.struct(start.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    return F.aggregate(matches, zero, add, lambda state: state["spans"])


def _spans(matches: Column, number: int) -> Column:
    """The confirmed spans. Sums run chunk by chunk, so many matches cost no square of copies."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _CHUNK).cast("int")),
        lambda n: F.slice(matches, n * _CHUNK + 1, F.lit(_CHUNK)),
    )
    lengths = F.transform(
        chunks,
        lambda chunk: F.aggregate(chunk, F.lit(0), lambda at, match: at + match["gap"] + match["size"]),
    )
    starts = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda state, length: F.struct(
            (state["at"] + length).alias("at"),
            F.concat(state["starts"], F.array(state["at"])).alias("starts"),
        ),
        lambda state: state["starts"],
    )
    spans = F.flatten(F.zip_with(chunks, starts, lambda chunk, at: _sums(chunk, at, number)))
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.filter(spans, lambda span: span["score"] >= THRESHOLD)
    return F.when(F.size(F.coalesce(matches, F.array())) > 0, spans).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """Append an array of spans (start, kind_no, end, score) by start, then kind.

    Offsets are code points, the end exclusive; kinds are numbered as in KINDS. Null texts are empty
    and have no spans. Spans of different kinds may overlap. Rows are independent, so repeated
    rows and ties change nothing; an empty table stays empty. ``name`` gets trailing underscores if taken.
    """
    names = {key: own_column(docs, f"pii_{key}") for key in ("text", "dots", "runs")}
    name = own_column(docs, name)
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn(names["text"], body)
    # A text that holds the control characters themselves must not pass them off as joints.
    plain = F.translate(names["text"], JOIN, OTHER)
    email, card = KINDS[0], KINDS[2]
    out = out.withColumns(
        {
            names["dots"]: F.when(
                email.mark(F.col(names["text"])), F.regexp_replace(plain, _LABEL_DOT, JOIN)
            ),
            names["runs"]: F.when(
                card.mark(F.col(names["text"])), F.regexp_replace(plain, _DIGIT_GAP, JOIN)
            ),
        }
    )
    found = {kind.name: own_column(docs, f"pii_{kind.name}") for kind in KINDS}
    out = out.withColumns(
        {
            found[kind.name]: F.when(
                kind.mark(F.col(names["text"])), _matches(kind, F.col(names[kind.on]))
            )
            for kind in KINDS
        }
    )
    spans = [_spans(F.col(found[kind.name]), number) for number, kind in enumerate(KINDS)]
    out = out.withColumn(name, F.sort_array(F.concat(*spans)))
    return out.drop(*names.values(), *found.values())


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(kind.name) for kind in KINDS])
    told = F.transform(
        spans,
        lambda span: F.concat_ws(
            ":", F.get(kinds, span["kind_no"]), span["start"].cast("string"), span["end"].cast("string")
        ),
    )
    return F.array_join(told, ",")


def pii_digest(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, counts per base kind, the digest of the base spans, all spans as text."""
    found = find_pii(docs, text, "pii")
    pii = own_column(docs, "pii")
    base = F.filter(pii, lambda span: span["kind_no"] < len(BASE))

    def count(number: int) -> Column:
        return F.size(F.filter(pii, lambda span: span["kind_no"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(BASE)]
    return found.select(
        *keep,
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col(pii)).alias("spans"),
    )


def redact_pii(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns, each stretch of personal data in the text replaced by its kind.

    Overlapping spans form one stretch, named after its first. ``n_chars``, if there, gets the new
    length of texts that changed. Null texts stay null.
    """
    pii = own_column(docs, "pii")
    found = find_pii(docs, text, pii)
    stretch = "struct<start:int,end:int,kind_no:int>"

    def merge(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(
            last["start"].alias("start"),
            F.greatest(last["end"], span["end"]).alias("end"),
            last["kind_no"].alias("kind_no"),
        )
        fresh = F.struct(span["start"].alias("start"), span["end"].alias("end"), span["kind_no"].alias("kind_no"))
        return F.when(
            span["start"] < last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        ).otherwise(F.concat(done, F.array(fresh)))

    merged = F.aggregate(F.col(pii), F.array().cast(f"array<{stretch}>"), merge)
    found = found.withColumn(pii, F.when(F.size(pii) > 0, merged))
    # Each stretch is preceded by the text since the last one; the rest follows the last.
    names = F.array(*[F.lit(f"[{kind.name.upper()}]") for kind in KINDS])
    before = F.concat(F.array(F.lit(0)), F.transform(F.col(pii), lambda span: span["end"]))
    pieces = F.zip_with(
        F.col(pii),
        before,
        lambda span, at: F.when(span.isNull(), F.substr(F.col(text), at + 1)).otherwise(
            F.concat(
                F.substr(F.col(text), at + 1, span["start"] - at), F.get(names, span["kind_no"])
            )
        ),
    )
    changed = F.col(pii).isNotNull()
    new_text = F.when(changed, F.array_join(pieces, "")).otherwise(F.col(text))
    out = found.withColumn(text, new_text)
    if n_chars in docs.columns:
        size = F.length(text).cast(docs.schema[n_chars].dataType)
        out = out.withColumn(n_chars, F.when(changed, size).otherwise(F.col(n_chars)))
    return out.select(*docs.columns)
