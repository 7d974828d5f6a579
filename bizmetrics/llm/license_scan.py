r"""License scans: ordered signature rules, gated by a keyword prefilter, with overlapping detections resolved.

Each rule is a regular expression with a label, a priority, a confidence and keywords. One Aho-Corasick pass over a text finds which
keywords it holds, and only rules with a keyword present are run. Overlaps are then resolved in order of priority: of two detections of which
one's interval contains the other's, the one with the higher priority stays (of equal priority, the longer; then the earlier rule).

The rules are composed from tables of hand-written parts: a family's names, versions, addresses, notices and SPDX identifiers. The base, places
of fixed phrases over words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, is found apart and always kept.

Texts are matched with A-Z in lower case and whitespace as it is. Every text is scanned whole, in its own task; nothing is shuffled.

Edge cases: null and empty texts have no words, labels or places and score 0; repeated rows give repeated results; columns besides id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.common import alnum_words, ship_package, utf8

#: Phrases, as words, and their labels.
BASE = (((b"cc", b"by"), "cc-by"), ((b"general", b"public", b"license"), "gpl"), ((b"all", b"rights", b"reserved"), "reserved"))


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[str, ...]  # one of them must be in the text
    priority: int  # higher wins
    confidence: float


@dataclass(frozen=True)
class Family:
    """A family of licenses; ``name`` and ``notice`` are regular expressions over lower-case text.

    ``keyword`` has, between bars, as many words as it takes for every alternative of ``name`` to hold one.
    """

    label: str
    name: str
    keyword: str
    versions: tuple[str, ...] = ()
    spdx: str = ""
    url: str = ""
    notice: str = ""
    notice_keyword: str = ""


#: Names and versions of public licenses, with their SPDX identifiers and addresses.
FAMILIES = (
    Family("gpl", r"gnu\s+general\s+public\s+licen[sc]e", "general", ("1.0", "2.0", "3.0"), "gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl", r"free\s+software[;:,]?\s+you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+general", "redistribute"),
    Family("lgpl", r"gnu\s+(?:lesser|library)\s+general\s+public\s+licen[sc]e", "general", ("2.0", "2.1", "3.0"), "lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general", "general"),
    Family("agpl", r"gnu\s+affero\s+general\s+public\s+licen[sc]e", "affero", ("1.0", "3.0"), "agpl", r"gnu\.org/licenses/agpl", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+affero", "affero"),
    Family("gfdl", r"gnu\s+free\s+documentation\s+licen[sc]e", "documentation", ("1.1", "1.2", "1.3"), "gfdl", r"gnu\.org/licenses/fdl", r"with\s+no\s+invariant\s+sections", "invariant"),
    Family("apache", r"apache(?:\s+software)?\s+licen[sc]e", "apache", ("1.0", "1.1", "2.0"), "apache", r"apache\.org/licenses", r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+licen[sc]e", "compliance"),
    Family("mit", r"\bmit\s+licen[sc]e", "mit", (), "mit", r"opensource\.org/licenses/mit", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy", "hereby"),
    Family("bsd", r"\bbsd\s+licen[sc]e", "bsd", (), "", r"opensource\.org/licenses/bsd", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without\s+modification", "redistribution"),
    Family("bsd-2-clause", r"(?:2|two)[\s-]clause\s+(?:\"?simplified\"?\s+)?bsd|simplified\s+bsd", "bsd", (), "bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    Family("bsd-3-clause", r"(?:3|three)[\s-]clause\s+bsd|(?:new|revised|modified)\s+bsd", "bsd", (), "bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause", r"neither\s+the\s+name\s+of\s+.{1,80}?\s+nor\s+the\s+names\s+of\s+its\s+contributors", "neither"),
    Family("bsd-4-clause", r"(?:4|four)[\s-]clause\s+bsd|original\s+bsd", "bsd", (), "bsd-4-clause", "", r"all\s+advertising\s+materials\s+mentioning\s+features", "advertising"),
    Family("isc", r"\bisc\s+licen[sc]e", "isc", (), "isc", r"opensource\.org/licenses/isc", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software", "permission"),
    Family("mpl", r"mozilla\s+public\s+licen[sc]e", "mozilla", ("1.0", "1.1", "2.0"), "mpl", r"mozilla\.org/mpl", r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla", "mozilla"),
    Family("epl", r"eclipse\s+public\s+licen[sc]e", "eclipse", ("1.0", "2.0"), "epl", r"eclipse\.org/(?:legal|org/documents)/epl", r"program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under", "accompanying"),
    Family("edl", r"eclipse\s+distribution\s+licen[sc]e", "eclipse", ("1.0",), "", r"eclipse\.org/org/documents/edl"),
    Family("cddl", r"common\s+development\s+and\s+distribution\s+licen[sc]e", "common", ("1.0", "1.1"), "cddl", r"opensource\.org/licenses/cddl"),
    Family("cpl", r"common\s+public\s+licen[sc]e", "common", ("1.0",), "cpl", r"opensource\.org/licenses/cpl"),
    Family("eupl", r"european\s+union\s+public\s+licen[sc]e", "european", ("1.0", "1.1", "1.2"), "eupl", r"eupl\.eu"),
    Family("artistic", r"artistic\s+licen[sc]e", "artistic", ("1.0", "2.0"), "artistic", r"opensource\.org/licenses/artistic"),
    Family("afl", r"academic\s+free\s+licen[sc]e", "academic", ("1.1", "1.2", "2.0", "2.1", "3.0"), "afl"),
    Family("osl", r"open\s+software\s+licen[sc]e", "open", ("1.0", "2.0", "2.1", "3.0"), "osl"),
    Family("ofl", r"(?:sil\s+)?open\s+font\s+licen[sc]e", "font", ("1.0", "1.1"), "ofl", r"scripts\.sil\.org/ofl", r"reserved\s+font\s+name", "font"),
    Family("bsl", r"boost\s+software\s+licen[sc]e", "boost", ("1.0",), "bsl", r"boost\.org/license"),
    Family("unlicense", r"\bunlicense\b", "unlicense", (), "unlicense", r"unlicense\.org", r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain", "unencumbered"),
    Family("wtfpl", r"do\s+what\s+the\s+f\S{1,4}\s+you\s+want\s+to\s+public\s+licen[sc]e", "public", (), "wtfpl", r"wtfpl\.net"),
    Family("zlib", r"\bzlib(?:/libpng)?\s+licen[sc]e", "zlib", (), "zlib", r"opensource\.org/licenses/zlib", r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked", "plainly"),
    Family("psf", r"python\s+software\s+foundation\s+licen[sc]e", "python", ("2.0",), "psf"),
    Family("ruby", r"\bruby\s+licen[sc]e", "ruby", (), "ruby"),
    Family("php", r"\bphp\s+licen[sc]e", "php", ("3.0", "3.01"), "php", r"php\.net/license"),
    Family("zpl", r"zope\s+public\s+licen[sc]e", "zope", ("1.1", "2.0", "2.1"), "zpl"),
    Family("w3c", r"w3c\s+software(?:\s+notice)?(?:\s+and)?\s+licen[sc]e", "w3c", (), "w3c"),
    Family("x11", r"\bx11\s+licen[sc]e", "x11", (), "x11"),
    Family("ncsa", r"university\s+of\s+illinois/ncsa|ncsa\s+open\s+source\s+licen[sc]e", "ncsa", (), "ncsa"),
    Family("ms-pl", r"microsoft\s+public\s+licen[sc]e", "microsoft", (), "ms-pl"),
    Family("ms-rl", r"microsoft\s+reciprocal\s+licen[sc]e", "microsoft", (), "ms-rl"),
    Family("sspl", r"server\s+side\s+public\s+licen[sc]e", "server", ("1.0",), "sspl"),
    Family("busl", r"business\s+source\s+licen[sc]e", "business", ("1.1",), "busl", "", r"change\s+date:.{1,60}?change\s+licen[sc]e", "change"),
    Family("elastic", r"elastic\s+licen[sc]e", "elastic", ("2.0",), "elastic"),
    Family("odbl", r"open\s+(?:data\s+commons\s+open\s+)?database\s+licen[sc]e", "database", ("1.0",), "odbl", r"opendatacommons\.org/licenses/odbl"),
    Family("odc-by", r"open\s+data\s+commons\s+attribution\s+licen[sc]e", "attribution", ("1.0",), "odc-by", r"opendatacommons\.org/licenses/by"),
    Family("pddl", r"public\s+domain\s+dedication\s+and\s+licen[sc]e", "dedication", ("1.0",), "pddl", r"opendatacommons\.org/licenses/pddl"),
    Family("cc0", r"\bcc0\b|creative\s+commons\s+zero", "cc0|zero", ("1.0",), "cc0", r"creativecommons\.org/publicdomain/zero"),
    Family("upl", r"universal\s+permissive\s+licen[sc]e", "universal", ("1.0",), "upl"),
    Family("vim", r"\bvim\s+licen[sc]e", "vim", (), "vim"),
    Family("openssl", r"openssl\s+licen[sc]e", "openssl", (), "openssl"),
    Family("cecill", r"\bcecill(?:-[bc])?\b", "cecill", ("1.0", "2.0", "2.1"), "cecill", r"cecill\.info"),
    Family("rail", r"(?:open)?rail(?:-m)?\s+licen[sc]e|responsible\s+ai\s+licen[sc]e", "rail|responsible", (), ""),
)
#: The elements of Creative Commons licenses, and their versions.
CC_ELEMENTS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": r"attribution", "sa": r"share[\s-]?alike", "nd": r"no[\s-]?deriv(?:ative)?s?", "nc": r"non[\s-]?commercial"}
#: Notices that are no license of a family.
NOTICES = (
    Rule("public-domain", r"(?:released|placed|dedicated)\s+(?:in)?to\s+the\s+public\s+domain", ("domain",), 20, 0.8),
    Rule("public-domain", r"\bpublic\s+domain\b", ("domain",), 10, 0.5),
    Rule("proprietary", r"proprietary\s+and\s+confidential|confidential\s+and\s+proprietary", ("proprietary",), 20, 0.9),
    Rule("proprietary", r"unauthorized\s+(?:copying|reproduction|distribution)[^.]{0,80}?\bprohibited", ("unauthorized", "prohibited"), 15, 0.8),
    Rule("proprietary", r"may\s+not\s+be\s+(?:copied|reproduced|redistributed)\s+without", ("without",), 15, 0.7),
    Rule("reserved", r"\ball\s+rights\s+(?:are\s+)?reserved\b", ("reserved",), 10, 0.7),
    Rule("reserved", r"\bsome\s+rights\s+reserved\b", ("reserved",), 10, 0.5),
    Rule("copyright", r"(?:copyright|\(c\)|©)\s*(?:(?:\(c\)|©)\s*)?(?:19|20)\d\d", ("copyright", "(c)", "©"), 5, 0.4),
    Rule("license-file", r"\bsee\s+(?:the\s+)?(?:accompanying\s+)?licen[sc]e(?:\.txt|\.md)?\s+(?:file\s+)?for\s+(?:details|the\s+full)", ("licen",), 5, 0.3),
    Rule("warranty", r"without\s+warrant(?:y|ies)\s+(?:or\s+conditions\s+)?of\s+any\s+kind", ("warrant",), 5, 0.3),
    Rule("warranty", r"\bprovided\s+\"?as\s+is\"?,?\s+without\s+warranty", ("warrant",), 5, 0.3),
)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in order."""
    made: list[Rule] = []

    def number(version: str) -> str:
        return re.escape(version) if not version.endswith(".0") else re.escape(version[:-2]) + r"(?:\.0)?(?![.\d])"

    for f in FAMILIES:
        keywords = tuple(f.keyword.split("|"))
        for v in f.versions:
            label = f"{f.label}-{v}"
            made.append(Rule(label, rf"(?:{f.name})[,;]?\s+(?:version\s+|v\.?\s*){number(v)}", keywords, 60, 0.95))
            made.append(Rule(label, rf"version\s+{number(v)}\s+of\s+the\s+(?:{f.name})", keywords, 60, 0.95))
            if f.spdx:
                made.append(Rule(label, rf"spdx-license-identifier:\s*{f.spdx}-{re.escape(v)}(?:-only)?\b", ("spdx",), 90, 1.0))
                made.append(Rule(f"{label}-or-later", rf"spdx-license-identifier:\s*{f.spdx}-{re.escape(v)}(?:-or-later|\+)", ("spdx",), 95, 1.0))
                made.append(Rule(label, rf"\b{f.spdx}[\s-]?v?{number(v)}\b", (f.spdx,), 40, 0.8))
            if f.url:
                made.append(Rule(label, rf"{f.url}[-/]?{number(v)}", (f.url.split("\\")[0].split("(")[0],), 70, 0.95))
            if f.label.endswith("gpl"):
                made.append(Rule(f"{label}-or-later", rf"(?:{f.name})\s.{{0,120}}?version\s+{number(v)},?\s+or\s+(?:\(at\s+your\s+option\)\s+)?any\s+later", keywords, 80, 1.0))
        if f.spdx and not f.versions:
            made.append(Rule(f.label, rf"spdx-license-identifier:\s*{re.escape(f.spdx)}\b", ("spdx",), 90, 1.0))
        if f.url:
            made.append(Rule(f.label, f.url, (f.url.split("\\")[0].split("(")[0],), 50, 0.9))
        if f.notice:
            made.append(Rule(f.label, f.notice, (f.notice_keyword,), 50, 0.9))
        made.append(Rule(f.label, f"(?:{f.name})", keywords, 30, 0.8))
    for e in CC_ELEMENTS:
        words = r"[\s,-]+".join(CC_WORDS[part] for part in e.split("-"))
        plain = e.replace("-", r"[\s-]")
        for v in CC_VERSIONS:
            made.append(Rule(f"cc-{e}-{v}", rf"\bcc[\s-]{plain}[\s-]{number(v)}", ("cc",), 70 + 2 * len(e), 1.0))
            made.append(Rule(f"cc-{e}-{v}", rf"creativecommons\.org/licenses/{e}/{number(v)}", ("creativecommons",), 70 + 2 * len(e), 1.0))
            made.append(Rule(f"cc-{e}-{v}", rf"creative\s+commons\s+{words}\s+(?:\w+\s+)?(?:licen[sc]e\s+)?{number(v)}", ("creative",), 60 + 2 * len(e), 0.95))
        made.append(Rule(f"cc-{e}", rf"\bcc[\s-]{plain}\b", ("cc",), 30 + 2 * len(e), 0.8))
        made.append(Rule(f"cc-{e}", rf"creative\s+commons\s+{words}", ("creative",), 30 + 2 * len(e), 0.8))
    return (*made, *NOTICES)


class Scanner:
    """The compiled rules. ``base`` and ``detect`` look at one text."""

    def __init__(self) -> None:
        import ahocorasick

        self.rules = rules()
        self.patterns = [re.compile(r.pattern, re.DOTALL) for r in self.rules]
        gated: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            for k in r.keywords:
                gated.setdefault(k, []).append(i)
        self.keywords = ahocorasick.Automaton()
        for k, which in gated.items():
            self.keywords.add_word(k, (k, which))
        self.keywords.make_automaton()
        self.heads = {phrase[0]: (phrase, label) for phrase, label in BASE}

    def base(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Place of the first word, and label, of every phrase."""
        found = []
        for head, (phrase, label) in self.heads.items():
            at = -1
            for _ in range(words.count(head)):
                at = words.index(head, at + 1)
                if tuple(words[at : at + len(phrase)]) == phrase:
                    found.append((at, label))
        return sorted(found)

    def detect(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, confidence) of the detections that remain, by start; ``text`` in lower case."""
        gated: set[int] = set()
        for _, (_, which) in self.keywords.iter(text):
            gated.update(which)
        found = []
        for i in sorted(gated):
            r = self.rules[i]
            found += [(-r.priority, m.start() - m.end(), i, m.start(), m.end()) for m in self.patterns[i].finditer(text)]
        return resolve([(p, w, i, s, e) for p, w, i, s, e in found if e > s], self.rules)


def resolve(found: list[tuple[int, int, int, int, int]], ordered: tuple[Rule, ...]) -> list[tuple[int, int, str, float]]:
    """Drop each detection whose interval contains, or lies in, that of one which comes before it by priority, length, rule and place.

    Winners never contain one another, so by start they are by end too, and one binary search sees both neighbours that matter.
    """
    from bisect import bisect_left, bisect_right

    starts: list[int] = []
    ends: list[int] = []
    kept: list[tuple[int, int, str, float]] = []
    for _, _, i, start, end in sorted(found):
        at = bisect_right(starts, start)
        inside = at > 0 and ends[at - 1] >= end
        first = bisect_left(starts, start)
        contains = first < len(starts) and ends[first] <= end
        if not inside and not contains:
            starts.insert(at, start)
            ends.insert(at, end)
            kept.insert(at, (start, end, ordered[i].label, ordered[i].confidence))
    return kept


_SCANNER: list[Scanner] = []
_UPPER = {c: c + 32 for c in range(65, 91)}


def scan_text(text: str | None) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, float]]]:
    """Number of words, base places, and detections of one text."""
    if not _SCANNER:
        _SCANNER.append(Scanner())
    words = alnum_words(text)
    return len(words), _SCANNER[0].base(words), _SCANNER[0].detect((text or "").translate(_UPPER))


SCHEMA = """n_words long, base array<struct<word: long, label: string>>,
    detections array<struct<start: long, end: long, label: string, confidence: double>>, score double"""


def scan(texts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each text: number of words, base places, resolved detections (code points), and a score.

    The score is 1 - the product of (1 - confidence) over the labels found, each with its best confidence; a base phrase alone has 0.5.
    """
    ship_package(texts.sparkSession)
    kind = texts.schema[id_column].dataType
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py()) for t in batch.column("text")]
            scores = []
            for _, base, found in rows:
                best: dict[str, float] = {label: 0.5 for _, label in base}
                for _, _, label, confidence in found:
                    best[label] = max(best.get(label, 0.0), confidence)
                rest = 1.0
                for label in sorted(best):
                    rest *= 1.0 - best[label]
                scores.append(1.0 - rest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([[{"word": w, "label": x} for w, x in base] for _, base, _ in rows], base_type),
                    pa.array([[dict(zip(("start", "end", "label", "confidence"), d, strict=True)) for d in found] for _, _, found in rows], found_type),
                    pa.array(scores, pa.float64()),
                ],
                names=["id", "n_words", "base", "detections", "score"],
            )

    return given.mapInArrow(run, f"id {kind.simpleString()}, {SCHEMA}").withColumnRenamed("id", id_column)


def document_licenses(documents: DataFrame) -> DataFrame:
    found = scan(documents)
    labels, words = F.transform("base", lambda b: b["label"]), F.transform("base", lambda b: b["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        "score",
    )
