"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table and decoded by Viterbi in numpy batches over all words of all texts.
Features are of a word, or of one neighbour, so the scores of a place are a sum of rows that are
computed once for each distinct word. Most places need no Viterbi step: where O beats every other label by more than
transitions and neighbours could make up for, every best path has O there. The bound is proven for
each place (see :meth:`Field.open_places`), so what is decoded between such places is what whole sentences give.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, per_text, with_results
from .pii_examples import examples, luhn

#: Kinds in the order in which spans of one start are listed; the field alone finds secrets.
KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
#: Rows of the labelled table that training reads at most unless told otherwise, its passes, its regularisation, and how often it must meet a feature.
MAX_LABELLED, PASSES, L2, LEAST_MET = 50_000, 60, 0.02, 3
#: Distinct words, and distinct shapes, that a worker remembers, and the characters of the longest word.
REMEMBERED, LONGEST = 200_000, 64
#: Places whose scores are looked at together.
PLACES = 1 << 16

# ---------------------------------------------------------------- base patterns

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and without overlap for each kind, by start and kind."""
    out, done = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                done = m.end()
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---------------------------------------------------------------- features

_CANDIDATE = re.compile("[0-9@]")
_WORD = re.compile(f"[^{WHITE}]+")
_SHAPES = str.maketrans({**{c: "9" for c in "0123456789"}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}})
_BEYOND = re.compile(r"[^\x00-\x7f]")
_RUN = re.compile(r"(.)\1+", re.S)
_HEX = re.compile(r"[\"'(]*[0-9a-fA-F]{16,}[\"')]*[^0-9a-zA-Z]*$")
_CORE = re.compile("[0-9A-Za-z](?:.*[0-9A-Za-z])?", re.S)


def shape_of(word: str) -> str:
    """Digits as 9, letters as a or A, other characters as they are."""
    shape = word.translate(_SHAPES)
    return shape if shape.isascii() else _BEYOND.sub(lambda m: "a" if m[0].isalpha() else m[0], shape)


def core_of(word: str) -> str:
    """The word from its first to its last ASCII letter or digit."""
    found = _CORE.search(word)
    return found[0] if found else ""


def facts_of(word: str) -> tuple[str, bool, bool | None, bool | None]:
    """All that the features of a word by itself depend on: its shape, whether it is a number in base 16, and whether its octets and its check digit are right."""
    shape = shape_of(word)
    based = len(word) >= 16 and _HEX.match(word) is not None
    if "9" not in shape:
        return shape, based, None, None
    core = core_of(word)
    parts = core.split(".")
    octets = all(len(p) < 4 and int(p) <= 255 for p in parts) if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) else None
    digits = _NOT_DIGIT.sub("", core)
    return shape, based, octets, luhn(digits) if 12 <= len(digits) <= 19 and not re.search("[A-Za-z@]", core) else None


def own_features(facts: tuple[str, bool, bool | None, bool | None]) -> list[str]:
    """Features of a word by what :func:`facts_of` has of it."""
    shape, based, octets, checked = facts
    core = core_of(shape)
    out = [
        "bias",
        "runs=" + _RUN.sub(r"\1", shape),
        "core=" + _RUN.sub(r"\1", core),
        "digits=" + str(min(core.count("9"), 20)),
        "length=" + str(min(len(shape), 40) // 4),
        "at=" + str(min(core.count("@"), 2)),
        "dots=" + str(min(core.count("."), 4)),
        "colons=" + str(min(core.count(":"), 4)),
        "dashes=" + str(min(core.count("-"), 3)),
        "first=" + shape[0],
        "alldigits=" + str(core != "" and not core.strip("9")),
        "hex=" + str(based),
        "quoted=" + str(shape[0] in "\"'"),
    ]
    if len(core) <= 14:
        out.append("exact=" + core)
    return [*out, *[f"{name}={told}" for name, told in (("octets", octets), ("luhn", checked)) if told is not None]]


def context(word: str | None) -> str:
    """What a neighbour tells: a plain word in lower case with a sign that announces something, one with a digit or at sign by its shape."""
    if word is None:
        return "none"
    core = core_of(word)
    if _CANDIDATE.search(word):
        return "~" + _RUN.sub(r"\1", shape_of(core))
    return core.lower() + "=" * (word[-1] in ":=") if core else _RUN.sub(r"\1", word)


#: Where a neighbour stands, and what its features begin with.
SIDES = {-2: "before2=", -1: "before=", 1: "after="}


def features(words: list[str | None], at: int) -> list[str]:
    """All features of the word at a place; beyond both ends there is none."""
    inside = range(len(words))
    return [*own_features(facts_of(words[at])), *[name + context(words[at + k] if at + k in inside else None) for k, name in SIDES.items()]]


# ---------------------------------------------------------------- the field


def allowed() -> np.ndarray:
    """Which label may follow which: inside a kind only after its beginning or inside."""
    ok = np.ones((len(LABELS), len(LABELS)), bool)
    for b, label in enumerate(LABELS):
        if label[0] == "I":
            ok[:, b] = [a[1:] == label[1:] and a != "O" for a in LABELS]
    return ok


NEVER = -1e9
#: The row of neighbours that tell the field nothing.
UNMET = 1


class _Words(dict):
    """Words to codes: the row of what a word's own facts score, and the row of what it tells its neighbours.

    Row zero of the scores is what lies beyond a text. Neighbours of which the field has met nothing share the row UNMET.
    """

    def __init__(self, field: Field):
        super().__init__({None: 0})
        self.field, self.facts = field, {None: 0}
        self.own = np.zeros((1024, len(LABELS)), np.float32)
        told = sorted({f[len(name) :] for f in field.at for name in SIDES.values() if f.startswith(name)} - {"none"})
        self.told = {t: k for k, t in enumerate(["none", None, *told])}
        self.sides = np.array([[self._scores([name + (t or "")] if t is not None else []) for name in SIDES.values()] for t in self.told], np.float32)

    def _scores(self, names: list[str]) -> np.ndarray:
        at, emit = self.field.at, self.field.emit
        return emit[[at[f] for f in names if f in at]].sum(axis=0)

    def __missing__(self, word: str) -> int:
        facts = facts_of(word)
        # of a long word only a digest is kept, so that what is remembered is bounded in bytes: some 200 for each of REMEMBERED words and shapes
        key = facts if len(word) <= LONGEST else blake2b(repr(facts).encode("utf-8", "replace"), digest_size=16).digest()
        if (row := self.facts.get(key)) is None:
            row = self.facts[key] = len(self.facts)
            if row == len(self.own):
                self.own = np.r_[self.own, np.zeros_like(self.own)]
            self.own[row] = self._scores(own_features(facts))
        code = row << 32 | self.told.get(context(word), UNMET)
        if len(word) <= LONGEST:
            self[word] = code
        return code


class Field:
    """Weights of features by label, and of transitions; sequences start after and end before an O."""

    def __init__(self, names: list[str], emit: np.ndarray, move: np.ndarray):
        self.at, self.emit = {n: k for k, n in enumerate(names)}, emit
        self.move = np.where(allowed(), move, NEVER)
        self.words: _Words | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": None}

    def codes_of(self, words: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each word the rows of its own score and of what it tells its neighbours, and both tables of scores."""
        if self.words is None or len(self.words) > REMEMBERED or len(self.words.facts) > REMEMBERED:
            self.words = _Words(self)
        known = self.words
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return codes >> 32, codes & 0xFFFFFFFF, known.own, known.sides

    def open_places(self, words: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Places where the best path may have another label than O, in order, and their scores of all labels.

        ``words`` have two None before, between and after texts. A path with label y at a
        place can have O there instead. The step into the place then loses at most the largest
        ``move[a, y] - move[a, O]`` of any label a that may stand before y. After the place, a label that may follow O stays;
        an I becomes the B of its kind, after which the same labels may follow, and that costs what ``move`` and the
        scores of the next place say. Where O leads y by more than these losses, no best path has y there; where
        an I can't stand, the place before has no such cost, and where neither B nor I can, no I follows.
        """
        m, kinds = self.move, range(len(KINDS))
        b_of, i_of = [1 + 2 * k for k in kinds], [2 + 2 * k for k in kinds]
        ends = [0, *b_of]
        into_b = np.array([max(m[a, b] - m[a, 0] for a in range(len(LABELS))) for b in b_of], np.float32)
        into_i = np.array([max(m[a, i] - m[a, 0] for a in (b, i)) for b, i in zip(b_of, i_of, strict=True)], np.float32)
        stay_b = np.array([max(m[b, c] - m[0, c] for c in ends) for b in b_of], np.float32)
        stay_i = np.array([max(m[i, c] - m[0, c] for c in ends) for i in i_of], np.float32)
        after = [max(m[i, c] - m[b, c] for c in (*ends, i)) for b, i in zip(b_of, i_of, strict=True)]
        goes_b = np.array([m[b, i] - m[0, b] + x for b, i, x in zip(b_of, i_of, after, strict=True)], np.float32)
        goes_i = np.array([m[i, i] - m[0, b] + x for b, i, x in zip(b_of, i_of, after, strict=True)], np.float32)
        at, told, own, sides = self.codes_of(words)
        places, scores = [np.zeros(0, np.int64)], [np.zeros((0, len(LABELS)))]
        for first in range(2, len(at) - 2, PLACES):
            last = min(first + PLACES, len(at) - 2)
            # one place more on either side, as each test asks the next place or the one before
            low, high = max(first - 1, 2), min(last + 2, len(at) - 2)
            x = own[at[low:high]]
            for n, k in enumerate(SIDES):
                x += sides[told[low + k : high + k], n]
            there = (at[low:high] > 0)[:, None]
            turn = np.zeros((len(x), len(KINDS)), np.float32)
            turn[:-1] = x[1:, 2::2] - x[1:, 1::2]
            can_i = there & (x[:, :1] - x[:, 2::2] <= into_i + np.maximum(stay_i, goes_i + turn) + 1e-3)
            cost = np.full_like(turn, 1) * stay_b
            cost[:-1] = np.where(can_i[1:], np.maximum(stay_b, goes_b + turn[:-1]), stay_b)
            can_b = there & (x[:, :1] - x[:, 1::2] <= into_b + cost + 1e-3)
            # an I needs a B before it with nothing but I between; before the first place anything may stand
            here = np.arange(len(x))[:, None]
            broken, begun = (np.maximum.accumulate(np.where(c, here, 0), axis=0) for c in (~can_i, can_b))
            can_i[1:] &= begun[:-1] >= broken[1:]
            open_ = np.flatnonzero((can_b | can_i).any(axis=1)[first - low : last - low]) + (first - low)
            places.append(open_ + low)
            scores.append(x[open_].astype(np.float64))
        return np.concatenate(places), np.concatenate(scores)

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each run of emission scores, by Viterbi over runs of like length at once."""
        out: list[np.ndarray | None] = [None] * len(runs)
        order = sorted(range(len(runs)), key=lambda k: len(runs[k]))
        k = 0
        while k < len(order):
            longest = len(runs[order[k]]) * 2
            group = []
            while k < len(order) and len(runs[order[k]]) <= longest and len(group) < 4096:
                group.append(order[k])
                k += 1
            for n, path in zip(group, self._viterbi([runs[n] for n in group]), strict=True):
                out[n] = path
        return out

    def _viterbi(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        lens = np.array([len(r) for r in runs])
        steps = int(lens.max())
        x = np.zeros((len(runs), steps, len(LABELS)))
        for k, r in enumerate(runs):
            x[k, : len(r)] = r
        best = self.move[0] + x[:, 0]
        back = np.zeros((steps, len(runs), len(LABELS)), np.int8)
        rows = np.arange(len(runs))
        for t in range(1, steps):
            total = best[:, :, None] + self.move[None]
            choice = total.argmax(axis=1)
            new = np.take_along_axis(total, choice[:, None, :], 1)[:, 0] + x[:, t]
            live = t < lens
            back[t] = choice
            best = np.where(live[:, None], new, best)
        last = (best + self.move[:, 0]).argmax(axis=1)
        paths = np.zeros((len(runs), steps), np.int64)
        for t in range(steps - 1, -1, -1):
            ends = t == lens - 1
            inside = t < lens - 1
            paths[ends, t] = last[ends]
            if inside.any():
                paths[inside, t] = back[t + 1, rows[inside], paths[inside, t + 1]]
        return [paths[k, :n] for k, n in enumerate(lens)]


def expected(x: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences of emission scores (sequence, step, label): the probability of each label, and the expected number of each transition.

    Forward and backward sums are scaled at each step, which cancels where they are multiplied.
    """
    n, steps, m = x.shape
    a, e = np.exp(move), np.exp(x - x.max(axis=2, keepdims=True))
    fwd, bwd = np.zeros((n, steps, m)), np.zeros((n, steps, m))
    for t in range(steps):
        new = (fwd[:, t - 1] @ a if t else a[None, 0]) * e[:, t]
        fwd[:, t] = np.where(mask[:, t, None], new / new.sum(axis=1, keepdims=True), fwd[:, t - 1])
    bwd[:, -1] = a[:, 0]
    for t in range(steps - 2, -1, -1):
        new = (e[:, t + 1] * bwd[:, t + 1]) @ a.T
        bwd[:, t] = np.where(mask[:, t + 1, None], new / new.sum(axis=1, keepdims=True), a[:, 0])
    p = fwd * bwd
    p /= p.sum(axis=2, keepdims=True)
    last = np.arange(n), mask.sum(axis=1) - 1
    moves = np.zeros((m, m))
    moves[0] = p[:, 0].sum(axis=0)
    moves[:, 0] += p[last].sum(axis=0)
    for t in range(1, steps):
        live = mask[:, t]
        f, g = fwd[live, t - 1], e[live, t] * bwd[live, t]
        moves += a * ((f / np.einsum("na,ab,nb->n", f, a, g)[:, None]).T @ g)
    return p, moves


class Adam:
    """Steps of gradient ascent, with the usual constants."""

    def __init__(self, weights: np.ndarray, rate: float = 0.1):
        self.w, self.rate, self.n = weights, rate, 0
        self.first, self.second = np.zeros_like(weights), np.zeros_like(weights)

    def step(self, g: np.ndarray) -> None:
        self.n += 1
        self.first += 0.1 * (g - self.first)
        self.second += 0.001 * (g * g - self.second)
        self.w += self.rate * (self.first / (1 - 0.9**self.n)) / (np.sqrt(self.second / (1 - 0.999**self.n)) + 1e-8)


def train(rows: Iterable[tuple[int, int, str, str]], passes: int = PASSES) -> Field:
    """A field fitted to (sentence, position, word, tag) by gradient ascent on the regularised likelihood.

    Features met fewer than LEAST_MET times are left out.
    """
    sentences: dict[int, list[tuple[int, str, str]]] = {}
    for s, p, w, t in rows:
        sentences.setdefault(s, []).append((p, w, t))
    runs: list[tuple[list[list[str]], list[int]]] = []
    for s in sorted(sentences):
        words, tags = zip(*((w, t) for _, w, t in sorted(sentences[s])), strict=True)
        runs.append(([features(list(words), k) for k in range(len(words))], [LABELS.index(t) for t in tags]))
    met = Counter(f for r, _ in runs for x in r for f in x)
    names = {f: k for k, f in enumerate(sorted(f for f, n in met.items() if n >= LEAST_MET))}
    emit, move, ok = np.zeros((len(names), len(LABELS))), np.zeros((len(LABELS), len(LABELS))), allowed()
    if not runs or not names:
        return Field(list(names), emit, move)
    n, m, steps = len(runs), len(LABELS), max(len(tags) for _, tags in runs)
    gold, lens = np.zeros((n, steps), np.int64), np.array([len(tags) for _, tags in runs])
    for k, (_, tags) in enumerate(runs):
        gold[k, : len(tags)] = tags
    mask = np.arange(steps) < lens[:, None]
    end = np.arange(n), lens - 1
    held = [[names[f] for f in x if f in names] for r, _ in runs for x in r]  # of each word, in the order of the mask
    wide = max(map(len, held))
    grid = np.array([x + [len(names)] * (wide - len(x)) for x in held])
    by_name = np.argsort(grid.ravel(), kind="stable")
    word_of = by_name // wide
    ordered = grid.ravel()[by_name]
    real = np.searchsorted(ordered, len(names))
    starts = np.searchsorted(ordered[:real], np.arange(len(names)))

    def gathered(p: np.ndarray) -> np.ndarray:
        """Sums over the words of each feature."""
        return np.add.reduceat(p[word_of[:real]], starts)

    seen_emit, seen_move = gathered(np.eye(m)[gold[mask]]), np.zeros((m, m))
    np.add.at(seen_move, (np.c_[np.zeros(n, np.int64), gold[:, :-1]][mask], gold[mask]), 1.0)
    np.add.at(seen_move, (gold[end], 0), 1.0)
    climb_emit, climb_move = Adam(emit), Adam(move)
    for _ in range(passes):
        x = np.zeros((n, steps, m))
        x[mask] = np.r_[emit, np.zeros((1, m))][grid].sum(axis=1)
        p, got_move = expected(x, mask, np.where(ok, move, NEVER))
        climb_emit.step((seen_emit - gathered(p[mask]) - L2 * emit) / n)
        climb_move.step((seen_move - got_move - L2 * move) / n)
    return Field(list(names), emit, move)


# ---------------------------------------------------------------- documents


def tag(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of what the field finds in each text."""
    words: list[str | None] = [None, None]
    firsts = []
    for text in texts:
        firsts.append(len(words))
        words += _WORD.findall(text)
        words += (None, None)
    places, scores = field.open_places(words)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if not len(places):
        return out
    starts = np.r_[0, np.flatnonzero(np.diff(places) > 1) + 1]
    path = np.concatenate(field.decode(np.split(scores, starts[1:])))
    found = np.flatnonzero(path)
    text_of = np.searchsorted(firsts, places[found], side="right") - 1
    for n in np.unique(text_of):
        spans = [m.span() for m in _WORD.finditer(texts[n])]
        here = found[text_of == n]
        j = 0
        while j < len(here):
            label, k = LABELS[path[here[j]]], j + 1
            while k < len(here) and here[k] == here[k - 1] + 1 and LABELS[path[here[k]]] == "I-" + label[2:]:
                k += 1
            first, last = (int(places[here[x]]) - firsts[n] for x in (j, k - 1))
            if span := trimmed(texts[n], spans[first][0], spans[last][1], label[2:]):
                out[n].append((label[2:], *span))
            j = k
    return out


def trimmed(text: str, start: int, end: int, kind: str) -> tuple[int, int] | None:
    """The span without the marks around it; a phone keeps its plus sign or bracket."""
    while start < end and not (text[start].isalnum() or kind == "phone" and text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return (start, end) if start < end else None


def find(texts: list[str], field: Field) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by start and kind: base ones, and the field's where no base one is."""
    out = []
    for text, tagged in zip(texts, tag(texts, field), strict=True):
        base = base_spans(text) if _CANDIDATE.search(text) else []  # every pattern has a digit or an at sign
        spans = [(*s, True) for s in base]
        ends = sorted(base, key=lambda s: s[1])
        starts = [s[1] for s in ends]
        reach = np.maximum.accumulate([s[2] for s in ends]) if ends else np.zeros(0, np.int64)
        for kind, a, b in tagged:
            n = int(np.searchsorted(starts, b)) if starts else 0  # base spans that start before b
            if not n or reach[n - 1] <= a:
                spans.append((kind, a, b, False))
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))
    return out


def redact(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, or what of it an earlier one leaves, as its kind in angle brackets."""
    out, done = [], 0
    for kind, a, b, _ in spans:
        if b > done:
            out += [text[done:a] if a >= done else "", f"<{kind.upper()}>" if a >= done else ""]
            done = b
    return "".join(out) + text[done:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
_SPANS = pa.list_(_SPAN)
SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"


def _packed(found: list[list[tuple[str, int, int, bool]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b, "base": c} for k, a, b, c in spans] for spans in found], _SPANS)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(examples())


def trained(labelled: DataFrame, most: int = MAX_LABELLED) -> Field:
    """A field from a table (sentence, position, word, tag) of at most ``most`` rows, the first sentences of a larger one."""
    rows = labelled.where("word is not null and word <> '' and tag is not null").orderBy("sentence", "position").limit(most).collect()
    return train((r.sentence, r.position, r.word, r.tag) for r in rows)


def _shared(docs: DataFrame, field: Field | None):
    return docs.sparkSession.sparkContext.broadcast(field or default_field())


def find_in(docs: DataFrame, text: str = "text", result: str = "spans", field: Field | None = None) -> DataFrame:
    """Adds ``result``: the spans (kind, start, end in code points, whether a base pattern) of each whole text.

    A null or empty text has none. Rows, repeated ones too, and other columns stay; an input column called
    like the result gives way. An empty table gives an empty one. Texts and words of any length are read whole, and of words
    longer than LONGEST nothing is remembered but a digest of their shape; a text that is all matches takes some 600 bytes a match.
    """
    model = _shared(docs, field)
    work = per_text(lambda texts: _packed(find(texts, model.value)), _SPANS)
    return with_results(docs, {result: F.arrow_udf(work, SPANS)(F.col(f"`{text}`").cast("string"))})


def redacted(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """The documents with every span of the column ``text`` (in any case) replaced by its kind in angle brackets.

    A null text stays null and an empty one empty. Rows, repeated ones too, and all other columns stay as they are, whatever they are
    called. An empty table gives an empty one. Texts of any length are read whole.
    """
    model = _shared(docs, field)

    def work(texts: list[str]) -> pa.Array:
        return pa.array([redact(t, s) for t, s in zip(texts, find(texts, model.value), strict=True)], pa.string())

    meant = [c for c in docs.columns if c == text] or [c for c in docs.columns if c.lower() == text.lower()]
    if len(meant) != 1:
        raise ValueError(f"{len(meant)} columns are called {text}")
    new = F.arrow_udf(per_text(work, pa.string()), "string")(F.col(f"`{text}`").cast("string"))
    return docs.select(*[F.when(F.col(f"`{c}`").isNotNull(), new).alias(c) if c == meant[0] else F.col(f"`{c}`") for c in docs.columns])


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts and checksum of the base spans, and all spans, of documents with ``spans``."""
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", _is_base(k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _is_base(kind: str):
    return lambda s: s["base"] & (s["kind"] == F.lit(kind))
