"""Personal data by patterns, checksums and context, in native expressions.

Regular expressions propose spans; validators confirm them (Luhn for cards,
mod-97 for IBANs, part and digit ranges for IPs and phones); words near a span
raise or lower its score, which ranks spans and takes none away. All of it are built-in functions: the text between
matches comes from ``split``, the matches from ``regexp_extract_all``, and a fold
over their lengths yields positions. Texts without a digit or an ``@`` are not folded.
Text around and between spans is cut from pieces of PIECE code points, never from
the whole text, so that a text of very many spans costs little more than its length.

The patterns use possessive repeats, and look back so that a run of characters
is tried once only: time stays linear and the matcher needs no deep stack on very
long runs, while the matches are those of the plain patterns.

Defined results: null text counts as empty and has no span; offsets are code
points, end exclusive. Spans of different kinds may overlap; within a kind they
are leftmost and do not. Repeated rows are treated alike; extra columns are
ignored by ``find_pii`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

#: Code points on either side of a span that count as its context, with the rest
#: of a word cut there. As many code points of the rest as REST are read: a piece
#: as long as that is part of no context word, so that more would change nothing.
REACH = 40
REST = 16
_WORD = r"[\p{L}\p{M}\p{N}_]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    base: float
    helps: str  # context words that raise the score
    hurts: str  # whole context words that lower it


#: In the order in which spans of one start are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write|address", "example"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", 0.7, r"\bip\b|host|server|address|login|client", "version|release|v"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.8, "card|visa|master|credit|debit|pay", "isbn|order|invoice|serial|tracking"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.8, r"phone|\btel|call|mobile|fax|contact", "isbn|serial"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", 0.9, "iban|bank|account|konto|compte|cuenta", "serial"),
)


#: Code points of a piece of the text, and entries that a fold gathers before it appends them.
PIECE = 256
GATHERED = 512


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))


def _near(pieces: Column, start: Column, length: Column) -> Column:
    """At most PIECE code points of the text from ``start`` on."""
    at = F.floor(start / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(pieces, at), F.lit("")), F.coalesce(F.get(pieces, at + 1), F.lit("")))
    return two.substr(start - at * PIECE + 1, length)


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, of any length."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    many = F.array_join(F.slice(pieces, first + 1, last - first + 1), "").substr(start - first * PIECE + 1, end - start)
    return F.when(end - start <= PIECE, _near(pieces, start, end - start)).otherwise(many)


def _gather(items: Column, number: Column, step, last=None) -> Column:
    """A fold over ``items`` with one number, that writes one entry an item: ``step``
    gives the next number and the entry's text. The entries as an array of strings.

    Entries go into a short string, which is appended to the long one every
    GATHERED entries, so that few long strings are copied."""

    def fold(acc: Column, item: Column) -> Column:
        at, entry = step(acc["at"], item)
        now = F.concat(acc["now"], entry, F.lit(","))
        full = acc["n"] >= GATHERED
        return F.struct(at.alias("at"), F.when(full, F.lit(0)).otherwise(acc["n"] + 1).alias("n"), F.when(full, F.lit("")).otherwise(now).alias("now"), F.when(full, F.concat(acc["out"], now)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(number.alias("at"), F.lit(0).alias("n"), F.lit("").alias("now"), F.lit("").alias("out"))
    tail = (lambda acc: F.concat(last(acc["at"]), F.lit(","))) if last else (lambda acc: F.lit(""))
    return F.filter(F.split(F.aggregate(items, zero, fold, lambda acc: F.concat(acc["out"], acc["now"], tail(acc))), ","), lambda x: x != "")


def _context(pieces: Column, start: Column, end: Column) -> Column:
    """The words near a span, lower-case, those cut at REACH up to their ends."""
    first = F.greatest(start - REACH - REST, F.lit(0))
    before = F.regexp_extract(_near(pieces, first, start - first), rf"(?s)(?:{_WORD}{{1,{REST}}}(?={_WORD}))?.{{0,{REACH}}}\z", 0)
    after = F.regexp_extract(_near(pieces, end, F.lit(REACH + REST)), rf"(?s)\A.{{0,{REACH}}}(?:(?<={_WORD}){_WORD}{{1,{REST}}})?", 0)
    return F.lower(F.concat(before, F.lit(" "), after))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def mod97(iban: Column) -> Column:
    """The remainder by which a right IBAN is 1: its first four characters moved
    to the end, letters read as 10 to 35."""
    flat = F.regexp_replace(iban, " ", "")
    turned = F.concat(flat.substr(F.lit(5), F.length(flat)), flat.substr(F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # A part of more than 9 digits may be zeros before a small number.
        return F.forall(F.split(match, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))).between(0, 3) & (F.coalesce(F.ltrim(part, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(match)).between(12, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match) == 1
    return F.lit(True)


def _starts(text: Column, matches: Column, kind: Kind) -> Column:
    """Where the matches of a kind start: strings of numbers, in order."""
    between = F.split(text, kind.pattern, -1)
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("match")))

    def step(at: Column, size: Column) -> tuple[Column, Column]:
        start = at + size["gap"]
        return start + size["match"], start.cast("string")

    return _gather(sizes, F.lit(0), step)


def _spans(pieces: Column, matches: Column, starts: Column, number: int, kind: Kind) -> Column:
    """Confirmed spans of one kind: array of (start, number of kind, end, score)."""

    def span(match: Column, written: Column) -> Column:
        start = written.cast("int")
        end = start + F.length(match)
        near = _context(pieces, start, end)
        hurt = near.rlike(f"(?<!{_WORD})(?:{kind.hurts})(?!{_WORD})")
        score = F.lit(kind.base) + F.when(near.rlike(kind.helps), 0.1).otherwise(0.0) - F.when(hurt, 0.4).otherwise(0.0)
        held = F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end"), F.round(F.least(score, F.lit(1.0)), 2).alias("score"))
        return F.when(valid(kind.name, match), held)

    return F.filter(F.zip_with(matches, starts, span), lambda s: s.isNotNull())


def with_spans(documents: DataFrame, out: str) -> DataFrame:
    """``documents`` with a column ``out``: array of (kind, start, end, score)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digit, at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    needed = {"email": at, "phone": digit & F.contains(text, F.lit("+"))}
    none = F.array().cast("array<string>")
    proposed = documents.withColumns({f"__{k.name}": F.when(needed.get(k.name, digit), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS})
    some = reduce(or_, [F.size(f"__{k.name}") > 0 for k in KINDS])
    placed = proposed.withColumns({
        "__pieces": F.when(some, _pieces(text)).otherwise(none),
        **{f"__at_{k.name}": F.when(F.size(f"__{k.name}") > 0, _starts(text, F.col(f"__{k.name}"), k)).otherwise(none) for k in KINDS},
    })
    empty = F.array().cast("array<struct<start:int,number:int,end:int,score:double>>")
    parts = [F.when(F.size(f"__{k.name}") > 0, _spans(F.col("__pieces"), F.col(f"__{k.name}"), F.col(f"__at_{k.name}"), i, k)).otherwise(empty) for i, k in enumerate(KINDS)]
    names = F.array(*[F.lit(k.name) for k in KINDS])
    ordered = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(names[s["number"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return placed.withColumn(out, ordered).drop("__pieces", *[f"__{k.name}" for k in KINDS], *[f"__at_{k.name}" for k in KINDS])


def find_pii(documents: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end, score) of every whole text."""
    return with_spans(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "spans").select("doc_id", "spans")


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with every confirmed span, whatever its score, replaced by
    its kind in brackets; overlapping spans become one, named by the first."""
    text = F.col("text")

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        fresh = s["start"] >= at
        written = F.concat_ws(":", at.cast("string"), s["start"].cast("string"), F.upper(s["kind"]))
        return F.greatest(at, s["end"]), F.when(fresh, written).otherwise("")

    cuts = _gather(F.col("__found"), F.lit(0), step, lambda at: at.cast("string"))
    found = with_spans(documents, "__found")
    cut = found.withColumns({"__cuts": F.when(F.size("__found") > 0, cuts), "__pieces": F.when(F.size("__found") > 0, _pieces(text))})

    def written(entry: Column) -> Column:
        part = F.split(entry, ":")
        end = F.coalesce(F.get(part, F.lit(1)).cast("int"), F.length(text))
        kind = F.get(part, F.lit(2))
        return F.concat(_between(F.col("__pieces"), part[0].cast("int"), end), F.when(kind.isNull(), "").otherwise(F.concat(F.lit("["), kind, F.lit("]"))))

    redacted = F.array_join(F.transform("__cuts", written), "")
    return cut.withColumn("text", F.when(F.size("__found") > 0, redacted).otherwise(text)).drop("__found", "__cuts", "__pieces")
