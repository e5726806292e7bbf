"""Periodic runs of words, by Main and Lorentz's divide and conquer on interned word ids.

A run is a stretch of words that repeats with a period, has at least LEAST words and two periods, and can't be
extended. A stretch that crosses a midpoint has a whole period on one side of it, and how far the words a period apart
agree, forwards and backwards, is told for all periods at once by four Z-functions of the two halves. Every run lies
whole in the smallest part that contains it, and crosses that part's midpoint; in smaller parts it is found cut off, and
dropped as it could be extended. Of equal intervals the smallest period stays.

All parts of one depth, of all texts of a batch, are looked through at once in numpy: a run that crosses a midpoint
repeats the word before it in the right half, or the one behind it in the left half. Only where some repetition agrees for long
enough, or for longer than AGREE words, are the Z-functions of the two halves computed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_CHARS, text_slices, with_results

#: Words of the shortest run; words that are compared before the Z-functions are asked.
LEAST, AGREE = 12, 32
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on agree with the beginning; zero for the first."""
    n = len(s)
    z = [0] * n
    left = right = 0  # the stretch that agrees with the beginning and ends last
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def crossing(x: np.ndarray, low: int, mid: int, high: int) -> np.ndarray:
    """(start, end, period) of all repetitions of at least two periods in low..high that hold the words on both sides of mid."""
    left, right = x[low:mid].tolist(), x[mid:high].tolist()
    a, b = len(left), len(right)
    ahead = np.array(z_function([*right, -1, *left, *right]), np.int64)
    left.reverse()
    right.reverse()
    back = np.array(z_function([*left, -1, *right, *left]), np.int64)
    out = []
    # a whole period behind mid: how far mid.. agrees with mid + p.., and what is before mid with what is before mid + p
    p = np.arange(1, b + 1)
    f, g = ahead[p], back[a + 1 + b - p]
    out.append(np.stack([mid - g, mid + p + f, p], axis=1)[(f + g >= np.maximum(p, LEAST - p)) & (g > 0)])
    # a whole period before it
    p = np.arange(1, a + 1)
    f, g = ahead[b + 1 + a - p], back[p]
    out.append(np.stack([mid - p - g, mid + f, p], axis=1)[(f + g >= np.maximum(p, LEAST - p)) & (f > 0)])
    return np.concatenate(out)


def _agreeing(x: np.ndarray, first: np.ndarray, p: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``first`` on agree with those p ahead, at most ``room`` and AGREE of them; ``step`` is 1 or -1."""
    n, live = np.zeros(len(first), np.int64), np.flatnonzero(room > 0)
    for k in range(AGREE):
        at = first[live] + step * k
        live = live[x[at] == x[at + p[live]]]
        n[live] += 1
        live = live[room[live] > k + 1]
        if not len(live):
            break
    return n


def promising(x: np.ndarray, bounds: np.ndarray, mid: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parts (between bounds) that may have a run across their midpoint; ``at`` are places that repeat a word next to it."""
    part = np.searchsorted(bounds, at, "right") - 1
    m, low, high = mid[part], bounds[part], bounds[part + 1]
    p = np.where(at >= m, at - m + 1, m - at)
    first = np.where(at >= m, m, m - p)
    need, ahead, behind = np.maximum(p, LEAST - p), high - first - p, first - low
    some = np.flatnonzero(ahead + behind >= need)
    part, p, first, need, ahead, behind = part[some], p[some], first[some], need[some], ahead[some], behind[some]
    f, g = _agreeing(x, first, p, ahead, 1), _agreeing(x, first - 1, p, behind, -1)
    return np.unique(part[(f == AGREE) | (g == AGREE) | (f + g >= need)])


def find(x: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All runs (start, end, period) of word ids in order, and the text of each; text k is texts[k] to texts[k + 1]."""
    found, bounds = [np.zeros((0, 3), np.int64)], np.asarray(texts, np.int64)
    while (large := np.diff(bounds) >= LEAST).any():
        mid = (bounds[:-1] + bounds[1:]) // 2
        beside = np.full((len(mid), 2), -1, x.dtype)
        beside[large, 0], beside[large, 1] = x[mid[large]], x[mid[large] - 1]
        sizes = np.stack([mid - bounds[:-1], bounds[1:] - mid], axis=1)
        at = np.flatnonzero(x == np.repeat(beside.ravel(), sizes.ravel()))
        for k in promising(x, bounds, mid, at).tolist():
            found.append(crossing(x, int(bounds[k]), int(mid[k]), int(bounds[k + 1])))
        bounds = np.sort(np.r_[bounds, mid[large]])
    s, e, p = np.concatenate(found).T
    owner = np.searchsorted(texts, s, "right") - 1
    low, high = np.asarray(texts)[owner], np.asarray(texts)[owner + 1]
    longer = (s > low) & (x[np.maximum(s - 1, 0)] == x[s - 1 + p])
    longer |= (e < high) & (x[np.minimum(e, max(len(x) - 1, 0))] == x[e - p])
    s, e, p, owner = (v[~longer] for v in (s, e, p, owner))
    order = np.lexsort((p, e, s))
    s, e, p, owner = (v[order] for v in (s, e, p, owner))
    new = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])][: len(s)]
    s, e, p, owner = (v[new] for v in (s, e, p, owner))
    order = np.lexsort((p, s))
    return np.stack([s, e, p], axis=1)[order], owner[order]


def wrapped(ids: np.ndarray, g: int) -> np.ndarray:
    """The words from number g % n on replaced by repetitions of a stretch there, some 3 to 10 of them."""
    n = len(ids)
    if not n:
        return ids
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.r_[ids[:a], ids[a + np.arange(n - a) % p]]


def _found(texts: list[str], turns: list[int | None]) -> pa.Array:
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = []
    for t, g in zip(texts, turns, strict=True):
        data = t.encode("utf-8", "replace")
        words = data.split() if len(data) <= SLICE_CHARS else (m[0] for m in _WORD.finditer(data))  # of bytes: ASCII white space alone
        own = np.fromiter(map(known.__getitem__, words), np.int32)
        ids.append(own if g is None else wrapped(own, g))
    table = list(known)
    sizes = np.array([len(i) for i in ids], np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    x = np.concatenate([np.zeros(0, np.int32), *ids])
    runs, owner = find(x, starts)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    steps = np.zeros(len(x) + 1, np.int64)  # over 0 where a run drops the word
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    stays = np.cumsum(steps[:-1]) == 0
    kept = [b" ".join([table[k] for k in x[a:b][stays[a:b]].tolist()]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    each = pa.StructArray.from_arrays([pa.array(runs[:, 0] - starts[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)
    return pa.StructArray.from_arrays([lists, pa.array(kept, pa.binary()).cast(pa.string())], fields=list(_FOUND))


def _runs_of(texts: pa.Array, turns: pa.Array) -> pa.Array:
    parts, turns, at = [], turns.to_pylist(), 0
    for some in text_slices(texts):
        parts.append(_found(some, turns[at : at + len(some)]))
        at += len(some)
    return pa.concat_arrays(parts) if parts else pa.array([], _FOUND)


def with_runs(docs: DataFrame, text: str = "text", turn: Column | None = None) -> DataFrame:
    """Adds ``runs`` (array of start, length, period in words, by start and period) and ``collapsed`` to whole documents.

    Words are what white space parts. ``collapsed`` is the text's words, one space between them, without those that stand in any
    run behind its first period. ``turn``, a number or null, plants a repetition first (:func:`wrapped`): for tests of a corpus.
    A null, empty or blank text has no runs and an empty ``collapsed``. Every row stays, repeated rows too; input columns
    called like the results give way. An empty table gives an empty one. A text is held whole by one task: its bytes, 4 bytes a word, its
    distinct words, and lists of the two halves of the part in hand; time grows as n log n whatever it repeats.
    """
    turn = F.lit(None).cast("bigint") if turn is None else turn.cast("bigint")
    both = F.arrow_udf(_runs_of, "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>")(F.col(f"`{text}`").cast("string"), turn)
    return with_results(docs, {"runs": both["runs"], "collapsed": both["collapsed"]})


def planted_turn(doc_id: Column) -> Column:
    """The turn of every tenth document, by a checksum of its id; a null id has none."""
    h = F.crc32(doc_id.cast("string"))
    return F.when(h % 10 == 0, F.floor(h / 10))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text."""
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_max(order).alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
