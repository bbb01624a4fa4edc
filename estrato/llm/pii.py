"""Personal data in texts (operator 1), with DataFrame functions only.

Regular expressions propose spans, checksums (Luhn, mod-97) confirm them, and words shortly before a span
raise its score.  A text is split by each expression; the lengths of the gaps and of the matches give the
positions, in code points, the end exclusive.  Expressions take whole runs possessively and start at the
beginning of a run, so their time is in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return m.rlike(rf"\A{part}(?:\.{part}){{3}}\z")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    size = F.length(digits)

    def value(i: Column) -> Column:
        digit = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        twice = digit * 2
        return F.when((size - i) % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def _card(m: Column) -> Column:
    digits = _digits(m)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


def mod97(account: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1 modulo 97 (A is 10, Z is 35)."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (acc * F.when(value >= 10, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _iban(m: Column) -> Column:
    account = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """What a kind of span looks like, what confirms it, and how sure that makes it.

    ``base`` kinds stay whatever their score; others need ``KEPT``.
    """

    name: str
    pattern: str
    needs: str  # a character without which no text has a match, or an expression for it
    confirm: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


_LOCAL = "[A-Za-z0-9._%+-]"

#: In the order in which spans are listed.
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 0.8, "mail|write|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _octets, 0.6, "ip|host|server|address|adresse|login"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "[0-9]", _card, 0.8, "card|visa|karte|tarjeta|carte|credit|pay"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", lambda m: F.length(_digits(m)).between(9, 15), 0.7, "phone|call|tel|mobil|fax|sms"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", _iban, 0.8, "iban|account|konto|cuenta|compte|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", lambda m: F.lit(True), 0.3, "ssn|social|security|insurance", False),
)
#: Score that a span of a kind outside the base needs, what a context word adds, and characters before a span in which it counts.
KEPT, CONTEXT, NEAR = 0.5, 0.3, 40

#: Spans have code points for their readers (start, end) and bytes to cut by.
_SPAN = "struct<kind:string,start:int,end:int,score:double,first:int,last:int>"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, zero: Column, after: Callable, out: Callable, kind: str) -> Column:
    """``out(state, item)`` of every item, the state being ``zero`` and then ``after(state, item)`` of the item before.

    An array that grows by one is copied each time, so the items are taken in chunks of about the square root of their
    number: first the state before each chunk, then the items of each chunk from there.
    """

    def chunks(x: Column) -> Column:
        def part(c: Column) -> Column:
            return F.slice(x["items"], c * x["width"] + 1, x["width"])

        def before(acc: Column, c: Column) -> Column:
            return F.struct(F.aggregate(part(c), acc["state"], after).alias("state"), F.array_append(acc["states"], acc["state"]).alias("states"))

        def inside(state: Column, c: Column) -> Column:
            def step(acc: Column, item: Column) -> Column:
                return F.struct(after(acc["state"], item).alias("state"), F.array_append(acc["out"], out(acc["state"], item)).alias("out"))

            start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
            return F.aggregate(part(c), start, step, lambda acc: acc["out"])

        numbers = F.sequence(F.lit(0), ((F.size(x["items"]) - 1) / x["width"]).cast("int"))
        first = F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("states"))
        states = F.aggregate(numbers, first, before, lambda acc: acc["states"])
        return F.flatten(F.zip_with(states, numbers, inside))

    width = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(items))).cast("int"))
    # Passed through, as slices of an array in Spark's row format would read all of it.
    passed = F.transform(items, lambda x: x)
    return _with(F.struct(passed.alias("items"), width.alias("width")), chunks)


def _spans(text: Column, kind: Kind) -> Column:
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def lengths(x: Column, unit: Callable) -> tuple[Column, Column]:
        return unit(x["gap"]), F.coalesce(unit(x["found"]), F.lit(0))

    def after(state: Column, x: Column) -> Column:
        (gap, own), (gap_bytes, own_bytes) = lengths(x, F.length), lengths(x, F.octet_length)
        return F.struct((state["at"] + gap + own).alias("at"), (state["byte"] + gap_bytes + own_bytes).alias("byte"))

    def span(state: Column, x: Column) -> Column:
        (gap, own), (gap_bytes, own_bytes) = lengths(x, F.length), lengths(x, F.octet_length)
        start, first = state["at"] + gap, state["byte"] + gap_bytes
        near = F.lower(F.substring(x["gap"], -NEAR, NEAR)).rlike(rf"\b(?:{kind.context})")
        score = F.lit(kind.score) + F.when(near, CONTEXT * (1 - kind.score) if kind.base else CONTEXT).otherwise(0.0)
        right = F.coalesce(kind.confirm(x["found"]), F.lit(False))
        kept = x["found"].isNotNull() & right & (F.lit(True) if kind.base else score >= KEPT)
        values = {"kind": F.lit(kind.name), "start": start, "end": start + own, "score": score, "first": first, "last": first + own_bytes}
        return F.when(kept, F.struct(*[v.alias(n) for n, v in values.items()]).cast(_SPAN))

    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("found"))
    has = F.contains(text, F.lit(kind.needs)) if len(kind.needs) == 1 else text.rlike(kind.needs)
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("byte"))
    all_spans = F.filter(_scan(pairs, zero, after, span, _SPAN), lambda s: s.isNotNull())
    return F.when(has, all_spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def spans(text: Column) -> Column:
    """All spans in a text, by kind as in ``KINDS``, then by start; none in a null or empty text."""
    whole = F.coalesce(text, F.lit(""))
    return F.concat(*[_spans(whole, kind) for kind in KINDS])


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out``: the spans of ``text`` with kind, start, end and score.

    A column that is already called ``out`` is replaced; repeated rows stay.
    """
    return docs.withColumn(out, spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of personal data in ``text`` replaced by its kind, as in ``<EMAIL>``.

    Of spans that overlap, what they cover together goes, under the name of the one that starts first (the
    longest of several).  A null text stays null, and a text without spans stays as it is.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    order = F.transform(spans(F.col("text")), lambda s: F.struct(s["first"].alias("first"), (-s["last"]).alias("back"), s["kind"].alias("kind")))

    def without(x: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            return F.decode(F.substring(x["bytes"], start + 1, end - start), "UTF-8")

        def piece(at: Column, s: Column) -> Column:
            """What stands between the spans before and this one, and its kind; nothing of a span that others cover."""
            return F.when(s["first"] >= at, F.concat(cut(at, s["first"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")

        pieces = _scan(x["spans"], F.lit(0), lambda at, s: F.greatest(at, -s["back"]), piece, "string")
        end = F.array_max(F.transform(x["spans"], lambda s: -s["back"]))
        return F.when(F.size(x["spans"]) > 0, F.concat(F.array_join(pieces, ""), cut(end, F.octet_length(x["bytes"]))))

    clean = F.coalesce(_with(F.struct(F.array_sort(order).alias("spans"), F.encode("text", "UTF-8").alias("bytes")), without), F.col("text"))
    return packed.select("row.*", clean.alias("__clean")).select(*[F.col("__clean").alias(c) if c == text else F.col(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each text: one row per row of ``docs`` (doc_id, text)."""

    def joined(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [k.name for k in KINDS if k.base]
    found = docs.select("doc_id", spans(F.col("text")).alias("all"))
    kinds = F.col("all")["kind"]
    counts = [(F.size("all") - F.size(F.array_remove(kinds, k.name))).cast("long").alias(f"n_{k.name}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.filter("all", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
        F.array_join(F.transform("all", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
