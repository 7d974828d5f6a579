r"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings, in built-in expressions only.

Patterns (``BASE``): credentials that are assigned, access keys, long hexadecimal runs. Spans are found left to right without overlap per kind;
their places come from the lengths of matches and of the gaps between them, in code points, with exclusive ends.

Entropy (``CLASSES``): runs of one character class, of a window's length at least, are cut at the allow-list's words; candidates are the parts of a
window's length at least, so just the windows that overlap a word are suppressed, and a key beside one is found. A run that is allowed as a whole has
no candidate. A window slides over a candidate while counts per character are kept: each step adds one character and drops one, and the sum of
``c * log2(c)`` over the counts changes by two terms. That sum is kept as an integer (millionths), so equal windows compare equally everywhere. A
candidate with a window of the class's entropy gives a span from its first such window to the end of its last. Pattern spans stay.

A step costs the same in any candidate, spans are placed by running sums in blocks, and masked texts are joined from blocks, so the work is linear in a
text's length and its number of spans; every text is scanned whole, and nothing is shuffled.

Edge cases: null and empty texts have no spans; the digest of no spans is that of the empty string; repeated rows give repeated results, an empty
table none; columns besides id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.quality_rules import let

#: Fixed patterns, in the order in which spans of equal start are listed: kind, pattern, group and its least length.
BASE = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``alphabet`` (a class of a regular expression) that hold a window of ``entropy`` bits a character."""

    kind: str
    alphabet: str
    characters: str
    entropy: float
    must_hold: str = ""


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
WINDOW = 20
CLASSES = (
    CharacterClass("entropy_hex", "[0-9A-Fa-f]", DIGITS + "abcdefABCDEF", 2.9, "[0-9]"),
    CharacterClass("entropy_base64", "[A-Za-z0-9+/=_-]", LOWER + LOWER.upper() + DIGITS + "+/=_-", 3.8, "[0-9]"),
)
#: No secrets: runs that are a UUID as a whole; in any run, words of documentation, characters in order, one character again and again.
ALLOWED_RUNS = "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
ALLOWED_WORDS = (
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Dd][Uu][Mm][Mm][Yy]|[Ss][Aa][Mm][Pp][Ll][Ee]"
    "|0123456789|abcdefghij|ABCDEFGHIJ|0{12,}|x{12,}|X{12,}|={8,}|-{8,}|_{8,}"
)
COUNT_BITS, PACKED = 5, 12  # a count's bits, and how many counts are in a long
RUNNING_BLOCK, MASK_BLOCK = 256, 4096


def weight(count: int) -> int:
    """``count * log2(count)`` in millionths."""
    return round(count * math.log2(count) * 1e6) if count else 0


def limit(entropy: float, window: int = WINDOW) -> int:
    """The largest sum of weights of a window that has the entropy."""
    return math.floor((math.log2(window) - entropy) * window * 1e6)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Each element combined with all before it; ``combine`` gets null for none. The array isn't empty.

    Elements are taken in blocks, so that what is copied per element is bounded.
    """
    none = F.array().cast("array<bigint>")

    def last(array: Column) -> Column:
        return F.get(array, F.size(array) - 1)

    def append(out: Column, x: Column) -> Column:
        return F.concat(out, F.array(combine(last(out), x)))

    def joined(blocks: Column) -> Column:
        bases = F.aggregate(blocks, none, lambda out, block: append(out, last(block)))
        return let(bases, lambda base: F.flatten(F.transform(blocks, lambda block, b: F.transform(block, lambda x: combine(F.get(base, b - 1), x)))))

    places = F.sequence(F.lit(1), F.size(values), F.lit(RUNNING_BLOCK))
    return let(F.transform(places, lambda at: F.aggregate(F.slice(values, at, RUNNING_BLOCK), none, append)), joined)


def plus(before: Column, x: Column) -> Column:
    return F.coalesce(before, F.lit(0).cast("bigint")) + x


def pieces(text: Column, pattern: str) -> Column:
    """The parts of a text between the matches of a pattern: where each begins (``at``), the part (``gap``), and the match behind it, or null."""

    def of(cut: Column) -> Column:
        sizes = F.transform(cut["gaps"], lambda gap, i: (F.length(gap) + F.coalesce(F.length(F.get(cut["matches"], i)), F.lit(0))).cast("bigint"))

        def placed(ends: Column) -> Column:
            return F.transform(
                cut["gaps"], lambda gap, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0).cast("bigint")).alias("at"), gap.alias("gap"), F.get(cut["matches"], i).alias("match"))
            )

        return let(running(sizes, plus), placed)

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("matches")), of)


NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _located(text: Column, pattern: str, spans_of: Callable[[Column, Column], Column]) -> Column:
    """Concatenated ``spans_of(match, start)`` over all matches; an empty array for a text without one."""

    def of(found: Column) -> Column:
        return F.flatten(F.transform(F.filter(found, lambda piece: piece["match"].isNotNull()), lambda piece: spans_of(piece["match"], piece["at"] + F.length(piece["gap"]))))

    return F.when(text.rlike(pattern), let(pieces(text, pattern), of)).otherwise(F.array().cast(NO_SPANS))


def _span(start: Column, rank: int, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), F.lit(rank).alias("kind"), end.cast("bigint").alias("end"))


def pattern_spans(text: Column, rank: int) -> Column:
    _, pattern, group, least = BASE[rank]

    def of(match: Column, start: Column) -> Column:
        value = F.regexp_extract(match, pattern, group) if group else match
        return F.filter(F.array(_span(start, rank, start + F.length(match))), lambda _: F.length(value) >= least)

    return _located(text, pattern, of)


def dense_windows(candidate: Column, characters: str, entropy: float, window: int = WINDOW) -> Column:
    """(first, last): ends of the candidate's first and last window with the entropy, counted from 1; nulls if there is none.

    The window's counts are packed, ``PACKED`` to a long, so a step changes a few longs, however large the alphabet is.
    """
    if window + 1 >= 1 << COUNT_BITS:
        raise ValueError("the window's length doesn't fit into a packed count")
    weights = F.array(*(F.lit(weight(c)) for c in range(window + 2)))
    words, shifts = divmod(len(characters) + PACKED - 1, PACKED)[0], [COUNT_BITS * (p % PACKED) for p in range(len(characters))]

    def slot(character: Column) -> Column:
        place = F.call_function("instr", F.lit(characters), character) - 1
        return let(place, lambda p: F.struct(*(F.get(F.array(*map(F.lit, of)), p).alias(name) for name, of in (("word", [q // PACKED for q in range(len(characters))]), ("shift", shifts), ("unit", [1 << x for x in shifts])))))

    def slide(slots: Column) -> Column:
        def held(counts: Column, own: Column) -> Column:
            return F.call_function("shiftright", F.get(counts, own["word"]), own["shift"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

        def change(count: Column, by: int) -> Column:
            return F.get(weights, count + by) - F.get(weights, count)

        # A step: beyond the first window one character goes out, and one comes in.
        def step(state: Column, i: Column) -> Column:
            comes, goes = F.get(slots, i), F.get(slots, i - window)

            def moved(h: Column) -> Column:
                entering = h["in"] - F.when(h["same"], 1).otherwise(0)
                total = state["total"] + F.coalesce(change(h["out"], -1), F.lit(0)) + change(entering, 1)
                counts = F.transform(state["counts"], lambda c, j: c + F.when(j == comes["word"], comes["unit"]).otherwise(0) - F.when(j == goes["word"], goes["unit"]).otherwise(0))

                def seen(now: Column) -> Column:
                    dense = (i >= window - 1) & (now <= limit(entropy, window))
                    return F.struct(
                        counts.alias("counts"), now.alias("total"), F.coalesce(state["first"], F.when(dense, i + 1)).alias("first"), F.coalesce(F.when(dense, i + 1), state["last"]).alias("last")
                    )

                return let(total, seen)

            return let(F.struct(held(state["counts"], comes).alias("in"), held(state["counts"], goes).alias("out"), F.coalesce(comes == goes, F.lit(False)).alias("same")), moved)

        none = F.lit(None).cast("int")
        begin = F.struct(F.array_repeat(F.lit(0).cast("bigint"), words).alias("counts"), F.lit(0).alias("total"), none.alias("first"), none.alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(slots) - 1), begin, step, lambda state: F.struct(state["first"].alias("first"), state["last"].alias("last")))

    return let(F.transform(F.split(candidate, ""), slot), slide)


def entropy_spans(text: Column, cls: CharacterClass, rank: int) -> Column:
    empty = F.array().cast(NO_SPANS)

    def of(candidate: Column, start: Column) -> Column:
        found = dense_windows(candidate, cls.characters, cls.entropy)
        spans = let(found, lambda w: F.filter(F.array(_span(start + w["first"] - WINDOW, rank, start + w["last"])), lambda s: s["start"].isNotNull()))
        wanted = F.length(candidate) >= WINDOW
        if cls.must_hold:
            wanted = wanted & candidate.rlike(cls.must_hold)
        return F.when(wanted, spans).otherwise(empty)

    def candidates(match: Column, start: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).cast("bigint").alias("at"), match.alias("gap"), F.lit(None).cast("string").alias("match")))
        parts = F.when(match.rlike(ALLOWED_WORDS), pieces(match, ALLOWED_WORDS)).otherwise(whole)
        return F.when(match.rlike(ALLOWED_RUNS), empty).otherwise(F.flatten(F.transform(parts, lambda part: of(part["gap"], start + part["at"]))))

    return _located(text, f"{cls.alphabet}{{{WINDOW},}}", candidates)


def _base_spans(text: Column) -> Column:
    return F.concat(*(pattern_spans(text, rank) for rank in range(len(BASE))))


def _more_spans(text: Column) -> Column:
    return F.concat(*(entropy_spans(text, cls, len(BASE) + i) for i, cls in enumerate(CLASSES)))


def _all_spans(text: Column) -> Column:
    return F.sort_array(F.concat(_base_spans(text), _more_spans(text)))


def scan(texts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, and arrays ``base`` and ``spans`` of (start, kind, end), ordered; ``kind`` counts through ``KINDS``."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))

    def of(text: Column) -> Column:
        return let(_base_spans(text), lambda found: F.struct(F.sort_array(found).alias("base"), F.sort_array(F.concat(found, _more_spans(text))).alias("spans")))

    return texts.select(F.col(f"`{id_column}`").alias(id_column), let(text, of).alias("_s")).select(id_column, "_s.*")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with each run of overlapping or touching spans (ordered by start) replaced by ``mask``."""

    def of(cut: Column) -> Column:
        def between(begin: Column, end: Column) -> Column:
            """The characters from ``begin`` to ``end``, from the blocks that hold them."""
            first = F.floor(begin / MASK_BLOCK).cast("int")
            some = F.slice(cut["blocks"], first + 1, F.greatest(F.ceil(end / MASK_BLOCK).cast("int") - first, F.lit(0)))
            return F.substr(F.array_join(some, ""), (begin - first * MASK_BLOCK + 1).cast("int"), (end - begin).cast("int"))

        def before(i: Column) -> Column:
            return F.coalesce(F.get(cut["ends"], i - 1), F.lit(0).cast("bigint"))

        opening = F.filter(F.transform(spans, lambda span, i: F.struct(i.alias("i"), before(i).alias("at"), span["start"].alias("start"))), lambda s: (s["i"] == 0) | (s["start"] > s["at"]))
        kept = F.transform(opening, lambda s: F.concat(between(s["at"], s["start"]), F.lit(mask)))
        return F.concat(F.array_join(kept, ""), between(F.array_max(cut["ends"]), F.length(text).cast("bigint")))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{MASK_BLOCK}}}"), 0)
    ends = running(F.transform(spans, lambda span: span["end"]), lambda highest, x: F.greatest(highest, x))
    return F.when(F.size(spans) == 0, text).otherwise(let(F.struct(blocks.alias("blocks"), ends.alias("ends")), of))


MASK = "[SECRET]"


def redact(texts: DataFrame, text_column: str = "text", mask: str = MASK) -> DataFrame:
    """``texts`` with every secret masked; a null text stays null."""
    name = f"`{text_column}`"
    empty = F.array().cast(NO_SPANS)

    def of(text: Column) -> Column:
        return let(_all_spans(text), lambda found: masked(text, F.coalesce(found, empty), mask))

    text = F.col(name).cast("string")
    return texts.withColumn(text_column, F.when(text.isNotNull(), let(text, of)))


KINDS = tuple(kind for kind, *_ in BASE) + tuple(cls.kind for cls in CLASSES)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def document_secrets(documents: DataFrame) -> DataFrame:
    found = scan(documents)

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == rank)).cast("long").alias(f"n_{BASE[rank][0]}")

    counts = map(count, range(len(BASE)))
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
