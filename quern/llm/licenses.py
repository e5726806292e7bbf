"""License scans by ordered signature rules.

A text becomes a row of words (A-Z lower-cased, digits, letters and everything beyond ASCII). A rule is a
regular expression over the words joined by single spaces, with a priority and a confidence: signatures of license texts
written by hand, and names of licenses in sentence frames. The literals that every match of a rule holds are
read off its parsed expression, never written beside it; one automaton finds all of them in a single pass
over a text, and a rule is tried only where it has its literals. What the rules find competes: a detection
inside the interval of one with a better priority, or of the same priority and longer, is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre  # private to Python's re: its tree of a pattern, as Python 3.11 to 3.14 have it
from re import _parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text, with_results
from .license_signatures import SIGNATURES

#: Phrases that always count, with their labels; their words must stand consecutively.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# License labels, the words of their names as a pattern, SPDX identifiers in words.
FAMILIES = [
    ("mit", "mit(?: x11)?", "mit"),
    ("mit-0", "mit no attribution", "mit 0"),
    ("apache-2", "apache(?: software)?(?: license| licence)? (?:version |v )?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache(?: software)?(?: license| licence)? (?:version |v )?1 1", "apache 1 1"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("gpl-1", "(?:gnu )?(?:general public license|gpl)(?: version| v)? 1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "(?:gnu )?(?:general public license|gpl)(?: version| v)? 2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "(?:gnu )?(?:general public license|gpl)(?: version| v)? 3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "(?:gnu )?(?:(?:lesser|library) general public license|lgpl)(?: version| v)? 2(?: 1| 0)?", "lgpl 2 [01](?: only| or later)?"),
    ("lgpl-3", "(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? 3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "(?:gnu )?(?:affero general public license|agpl)(?: version| v)? 3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("mpl-1.1", "(?:mozilla public license|mpl)(?: version| v)? 1 1", "mpl 1 1"),
    ("mpl-2", "(?:mozilla public license|mpl)(?: version| v)? 2(?: 0)?", "mpl 2 0"),
    ("epl-1", "(?:eclipse public license|epl)(?: version| v)? 1(?: 0)?", "epl 1 0"),
    ("epl-2", "(?:eclipse public license|epl)(?: version| v)? 2(?: 0)?", "epl 2 0"),
    ("cddl-1", "(?:common development and distribution license|cddl)(?: version| v)?(?: 1(?: 0)?)?", "cddl 1 0"),
    ("cpl-1", "common public license(?: version| v)?(?: 1(?: 0)?)?", "cpl 1 0"),
    ("artistic-1", "artistic license(?: version| v)? 1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic license(?: version| v)? 2(?: 0)?", "artistic 2 0"),
    ("bsl-1", "boost software license(?: version| v)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("busl-1.1", "business source license(?: version| v)?(?: 1 1)?", "busl 1 1"),
    ("eupl-1.2", "(?:european union public licen[cs]e|eupl)(?: version| v)?(?: 1 [012])?", "eupl 1 2"),
    ("osl-3", "open software license(?: version| v)?(?: 3(?: 0)?)?", "osl 3 0"),
    ("ms-pl", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "(?:do what the fuck you want to public license|wtfpl)", "wtfpl"),
    ("ofl-1.1", "(?:sil )?open font license(?: version| v)?(?: 1 [01])?", "ofl 1 1"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2", "(?:python software foundation|psf)(?: license)?(?: version| v)?(?: 2(?: 0)?)?", "(?:python 2 0|psf 2 0)"),
    ("php-3", "php license(?: version| v)?(?: 3(?: 0?1?)?)?", "php 3 01"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("odbl-1", "(?:open database license|odbl)(?: version| v)?(?: 1(?: 0)?)?", "odbl 1 0"),
    ("gfdl-1.3", "(?:gnu )?(?:free documentation license|gfdl)(?: version| v)?(?: 1 [123])?", "gfdl 1 3(?: only| or later)?"),
    ("cc0", "(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "(?:cc by|creative commons attribution)(?: [1234] 0)?(?: international)?", "cc by [1234] 0"),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)(?: [1234] 0)?(?: international)?", "cc by sa [1234] 0"),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: [1234] 0)?(?: international)?", "cc by nd [1234] 0"),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] 0)?(?: international)?", "cc by nc [1234] 0"),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] 0)?(?: international)?", "cc by nc sa [1234] 0"),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: [1234] 0)?(?: international)?", "cc by nc nd [1234] 0"),
]

# Sentence frames around a license's name or identifier: frame, priority, confidence.
FRAMES = [
    ("spdx license identifier {spdx}", 0, 1.0),
    ("(?:licensed|released|distributed|provided|published|available|redistributed) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name}(?: licen[cs]e)?", 1, 0.95),
    ("(?:licensed|released|published) (?:as|with|by) (?:the )?{name}(?: licen[cs]e)?", 2, 0.9),
    ("(?:covered|governed|protected) by (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?", 2, 0.9),
    ("subject to (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?", 2, 0.9),
    ("licen[cs]e (?:is |type )?{name}(?: licen[cs]e)?", 3, 0.8),
    ("(?:the )?{name} licen[cs]e(?: agreement| terms| text)?", 4, 0.7),
    ("{name} licensed", 4, 0.7),
]

#: Versions and names that stand alone: frames of their own for the public licenses whose names say it all.
ALONE = ("gpl", "lgpl", "agpl", "mpl", "epl", "cddl", "osl", "ofl", "eupl", "apache", "cc", "odbl", "gfdl", "artistic", "bsl", "busl")


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    pattern: re.Pattern
    keywords: tuple[frozenset[bytes], ...]  # of each set one stands in every match
    priority: int
    confidence: float


def literals(parsed) -> list[frozenset[bytes]]:
    """Sets of byte strings of a parsed pattern, such that every match holds one of each set."""
    out, run = [], b""
    for op, arg in [*parsed, (None, None)]:
        if op is sre.LITERAL:
            run += bytes([arg])
            continue
        if run:
            out.append(frozenset([run]))
        if op is sre.BRANCH:  # the parser moves what alternatives begin with before them
            each = [_rarest([*literals(x), frozenset([run + _beginning(x)])]) for x in arg[1]]
            out += [frozenset().union(*each)] if all(map(all, each)) else []
        elif op is sre.SUBPATTERN:
            out += literals(arg[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
            out += literals(arg[2])
        run = b""
    return out


def _beginning(parsed) -> bytes:
    """The literals that a pattern begins with."""
    out = b""
    for op, arg in parsed:
        if op is not sre.LITERAL:
            break
        out += bytes([arg])
    return out


def _rarest(sets: list[frozenset[bytes]]) -> frozenset[bytes]:
    """The set whose shortest member is longest."""
    return max(sets, key=lambda x: min(map(len, x)), default=frozenset())


def _keywords(pattern: str) -> tuple[frozenset[bytes], ...]:
    """The two best sets of a rule; a literal of fewer than three characters tells nothing."""
    sets = [x for x in literals(_parser.parse(pattern.encode())) if min(map(len, x)) > 2]
    return tuple(sorted(sets, key=lambda x: -min(map(len, x)))[:2])


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules in their order: signatures, every family in every frame, and names that stand alone."""
    rows = [*SIGNATURES]
    rows += [(label, frame.format(name=name, spdx=spdx), priority, sure) for frame, priority, sure in FRAMES for label, name, spdx in FAMILIES]
    rows += [(label, name, 5, 0.6) for label, name, _ in FAMILIES if label.startswith(ALONE)]
    rows.sort(key=lambda r: r[2])
    return [Rule(n, label, re.compile(f"(?<= )(?:{p})(?= )".encode()), _keywords(p), priority, sure) for n, (label, p, priority, sure) in enumerate(rows)]


@lru_cache(maxsize=1)
def gate() -> tuple[ahocorasick.Automaton, dict[int, list[tuple[Rule, tuple[frozenset[int], ...]]]], list[Rule]]:
    """An automaton that gives each keyword's number, the rules by the numbers of their first set, and rules without keywords."""
    numbers: dict[bytes, int] = {}
    by_first: dict[int, list] = {}
    for rule in rules():
        sets = tuple(frozenset(numbers.setdefault(k, len(numbers)) for k in keys) for keys in rule.keywords)
        for n in sets[0] if sets else ():
            by_first.setdefault(n, []).append((rule, sets))
    automaton = ahocorasick.Automaton()
    for k, n in numbers.items():
        automaton.add_word(k.decode("latin-1"), n)
    automaton.make_automaton()
    return automaton, by_first, [r for r in rules() if not r.keywords]


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def tried(row: bytes) -> list[Rule]:
    """The rules whose keywords stand in the row, in their order."""
    automaton, by_first, always = gate()
    seen = {n for _, n in automaton.iter(row.decode("latin-1"))}
    found = {r.number: r for n in seen & by_first.keys() for r, sets in by_first[n] if all(keys & seen for keys in sets)}
    return sorted([*always, *found.values()], key=lambda r: r.number)


def scan(text: str) -> dict:
    """Words, base places and surviving detections (label, rule, start and end word, confidence) of one text."""
    words = _WORD.findall(text.encode("utf-8", "replace").lower())
    row = b" " + b" ".join(words) + b" "
    places = sorted(_places(row))
    return {"n_words": len(words), "places": places, "detections": _resolved(_detections(row))}


def _word_starts(row: bytes) -> list[int]:
    return [m.start() for m in re.finditer(b" ", row)]


def _places(row: bytes) -> list[tuple[int, str]]:
    out = []
    for phrase, label in PHRASES.items():
        sought, at, seen, counted = f" {phrase} ".encode(), -1, 0, 0
        while (at := row.find(sought, at + 1)) >= 0:
            seen, counted = seen + row.count(b" ", counted, at), at
            out.append((seen, label))
    return out


def _detections(row: bytes) -> list[tuple[int, int, Rule]]:
    out, spaces = [], None
    for rule in tried(row):
        for m in rule.pattern.finditer(row):
            spaces = spaces or _word_starts(row)
            out.append((bisect_left(spaces, m.start() - 1), bisect_right(spaces, m.end()) - 1, rule))
    return out


def _resolved(found: list[tuple[int, int, Rule]]) -> list[dict]:
    """Keeps what lies in no interval kept before it, in the order of priority, length, place and rule."""
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    ends: list[int] = []  # the furthest end of any interval kept that starts here or before
    for start, end, rule in sorted(found, key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].number)):
        k = bisect_right(starts, start)
        if k and ends[k - 1] >= end:
            continue
        kept.append((start, end, rule))
        starts.insert(k, start)
        ends.insert(k, max(end, ends[k - 1] if k else 0))
        for j in range(k + 1, len(ends)):
            if ends[j] >= end:
                break
            ends[j] = end
    return [{"label": r.label, "rule": r.number, "start": s, "end": e, "confidence": r.confidence} for s, e, r in sorted(kept, key=lambda d: (d[0], d[1]))]


KIND = "struct<n_words: bigint, places: array<struct<start: bigint, label: string>>, detections: array<struct<label: string, rule: int, start: bigint, end: bigint, confidence: double>>>"
_PLACE = pa.struct([("start", pa.int64()), ("label", pa.string())])
_DETECTION = pa.struct([("label", pa.string()), ("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])
_ARROW = pa.struct([("n_words", pa.int64()), ("places", pa.list_(_PLACE)), ("detections", pa.list_(_DETECTION))])


def _work(texts: list[str]) -> pa.Array:
    rows = [scan(t) for t in texts]
    for r in rows:
        r["places"] = [{"start": s, "label": x} for s, x in r["places"]]
    return pa.array(rows, _ARROW)


def scan_documents(docs: DataFrame, text: str = "text", result: str = "licenses") -> DataFrame:
    """Adds ``result``: the number of words, base places and detections of each whole text.

    A null or empty text has no words, places or detections. Rows, repeated ones too, and other columns
    stay; an input column called like the result gives way. An empty table gives an empty one.
    """
    return with_results(docs, {result: F.arrow_udf(per_text(_work, _ARROW), KIND)(F.col(f"`{text}`").cast("string"))})


def digests(scanned: DataFrame) -> DataFrame:
    """The base counts, labels and score of scanned documents; the score is the best confidence, 0.95 for a base place."""
    found = F.col("licenses")
    starts, base, own = found["places"]["start"], found["places"]["label"], found["detections"]["label"]
    sure = F.coalesce(F.array_max(found["detections"]["confidence"]), F.lit(0.0))
    return scanned.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(sure, F.when(F.size(starts) > 0, 0.95).otherwise(0.0)).alias("score"),
    )
