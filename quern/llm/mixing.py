"""Mixing sources to target weights by fitting subset sums to word budgets.

Documents are counted by source and exact length. For each source the budget left after whole passes is
filled from these counts: an even share of every length first, then, largest length first, down to a
window that a bounded-knapsack programme fills. If no sum of the lengths left over fills it, some of the even share is given
back and a window of twice the size is tried, until one is filled, the programme has had the whole budget, or the window is as large as memory
allows; then the programme runs over residues of one length, whose documents make up for what the others leave. The
numbers taken of each length then select documents by a seeded hash of their id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, packed, source_key, unpacked, with_results, written

#: Weights of the sources in the order of their names, repeating; shares of all sizes; the most of a source's size.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Words that the knapsack programme fills at first (5 bytes each). Parts in which documents of one length are ranked: at least, and rows of all sources for each.
WINDOW, SALTS, ROWS_A_SALT, SEED = 1 << 17, 64, 1 << 16, 7
#: The largest window; where none fills the budget, residues of one length are asked (5 bytes a word of it).
LARGEST_WINDOW = 1 << 21
WORD = r"[^\x20\x09-\x0D]+"

_KEY, _SIZE, _HASH, _TIE, _SALT = f"{OWN}source", "size", f"{OWN}hash", f"{OWN}tie", f"{OWN}salt"


def words_of(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds ``target`` to (key, source, source_size), one row for each source.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A
    target stops at ``most`` times its source's size and the rest share its excess by weight: the level at
    which they end is the largest that any prefix of the sources, by cap for each weight, would leave. One task sorts
    all sources, some 100 bytes each: a million take 0.1 GB, and more spill to its disk.
    """
    everything = Window.partitionBy(F.lit(0))  # a row for each source
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - F.lit(1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % F.lit(len(weights)))
    rows = sources.select("*", weight.alias("w"), (F.lit(most) * F.col("source_size")).alias("cap"))
    by_cap = everything.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(everything) - before) / after
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return rows.select(*sources.columns, F.least("cap", F.col("level") * F.col("w")).alias("target"))


def subset_sum(sizes: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size (at most ``left``) sum to ``budget``, or to the largest sum below it."""
    take = np.zeros(len(sizes), np.int64)
    if budget <= 0:
        return take
    first = np.full(budget + 1, -1, np.int32)  # the item that first reaches a sum; items before it reach the rest
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    items: list[tuple[int, int]] = []
    for k in np.argsort(-sizes, kind="stable"):
        size, n, part = int(sizes[k]), int(min(left[k], budget // sizes[k])), 1
        while n > 0 and not reach[budget]:
            part = min(part, n)
            step = size * part
            if step <= budget:
                new = np.flatnonzero(reach[: budget + 1 - step] & ~reach[step:]) + step
                first[new] = len(items)
                reach[new] = True
                items.append((int(k), part))
            n, part = n - part, part * 2
        if reach[budget]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at:
        k, part = items[first[at]]
        take[k] += part
        at -= int(sizes[k]) * part
    return take


def by_residues(s: np.ndarray, n: np.ndarray, done: np.ndarray, left: int) -> np.ndarray:
    """A choice of sizes (at most n each) whose sum is as near below ``left`` beyond that of ``done`` as a pivot allows.

    One size is the pivot; the programme asks which others, taken more or fewer times, change the sum by which
    residue of it, and the pivot makes up for the rest. It needs memory in that size alone. A residue never needs more steps than the pivot
    is large, so a pivot with spare documents on both sides for them gives the nearest sum there is; the smallest of these is taken, or else that with the most.
    """
    spare = np.minimum(done, n - done)
    enough = np.flatnonzero(spare > int(s.max()) + left)
    at = int(enough[np.argmin(s[enough])]) if len(enough) else int(np.argmax(spare * (s <= LARGEST_WINDOW)))
    m = int(s[at])
    first = np.full(m, -1, np.int32)
    reach = np.zeros(m, bool)
    reach[0] = True
    items: list[tuple[int, int]] = []  # a size and how often more, or fewer
    room = {(k, sign): int(min(x[k], m - 1)) for k in range(len(s)) if k != at for sign, x in ((1, n - done), (-1, done))}
    goal, part = left % m, 1
    while room and not reach[goal]:
        for (k, sign), spared in list(room.items()):  # single steps of all sizes before double ones
            if reach[goal]:
                break
            by = min(part, spared)
            if by:
                new = np.roll(reach, sign * by * int(s[k]) % m) & ~reach
                first[new] = len(items)
                reach |= new
                items.append((k, sign * by))
            room[k, sign] = spared - by
        room = {x: spared for x, spared in room.items() if spared}
        part *= 2
    for short in np.sort((goal - np.flatnonzero(reach)) % m).tolist():  # the sum stays that far below
        if short >= left:
            break
        change, r = np.zeros(len(s), np.int64), (goal - short) % m
        while r:
            k, by = items[first[r]]
            change[k] += by
            r = (r - by * int(s[k])) % m
        change[at] = (left - short - int((change * s).sum())) // m
        if (0 <= done[at] + change[at] <= n[at]).all():
            return done + change
    return done


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take, at most ``counts``, so that their words come to ``budget``."""
    take = np.zeros(len(sizes), np.int64)
    real = np.flatnonzero((sizes > 0) & (counts > 0))
    if budget <= 0 or not len(real):
        return take
    s, n = sizes[real].astype(np.int64), counts[real].astype(np.int64)
    total = int((s * n).sum())
    if budget >= total:
        take[real] = n
        return take
    t = (n.astype(object) * budget // total).astype(np.int64)  # exact, however large the counts
    rest = budget - int((t * s).sum())
    for k in np.argsort(-s, kind="stable"):
        if rest <= WINDOW:
            break
        more = min(int(n[k] - t[k]), (rest - WINDOW) // int(s[k]))
        t[k] += more
        rest -= more * int(s[k])
    unit = int(np.gcd.reduce(s))
    best = budget - budget % unit  # no sum of the lengths is nearer
    window, least = WINDOW, None
    while True:
        fits = np.flatnonzero((n > t) & (s <= rest))
        more = subset_sum(s[fits], (n - t)[fits], rest)
        left = rest - int((more * s[fits]).sum())
        done = t.copy()
        done[fits] += more
        if least is None:
            # steps from here to a best choice can be ordered so that their sums stay within the largest length, and steps between equal
            # sums can be left out: a best choice is at most twice that length steps away, so no more of a length need be given back
            least = np.maximum(done - 2 * int(s.max()), 0)
        if budget - left >= best or (t <= least).all():
            break
        if 2 * window > LARGEST_WINDOW:
            done = by_residues(s // unit, n, done, left // unit)
            break
        window, free = 2 * window, np.maximum(t - least, 0)
        back = np.minimum(free, -(-(free.astype(object) * max(window - rest, 1)) // int((free * s).sum())).astype(np.int64))
        t = t - back
        rest += int((back * s).sum())
    take[real] = done
    return take


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one source's lengths: a row for each with the number to take once more than ``passes``."""
    size, budget = int(rows.source_size.iloc[0]), int(np.floor(rows.target.iloc[0] + 0.5))
    passes = min(int(MOST), budget // size) if size else 0
    more = fit(rows["size"].to_numpy(), rows.n.to_numpy(), budget - passes * size if passes < int(MOST) else 0)
    return pd.DataFrame({_KEY: rows[_KEY], _SIZE: rows["size"], "passes": passes, "more": more})


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """Adds size, source_size, target, copies and taken to documents, which can leave their texts behind once counted.

    size is the number of words of the whole text (null: 0); copies how often the mix takes the document, 0 to
    2, and taken its words, repeats counted. Every row stays. A null source is a source, the last. Which
    documents of a length are taken depends on the seed, the id and the text, and of rows that agree in these on the
    other columns but maps; rows that agree in all are interchangeable. Documents without words take part with no words. Input columns called like the
    results give way. An empty table gives an empty one. Texts of any length are counted whole. A source's lengths, at most the root of twice its words, are fitted by one
    task, with 10 MB for the window and 5 bytes for each word of one length.
    """
    row_hash = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string"))
    others = [F.col(f"`{c}`") for c, kind in docs.dtypes if c not in (doc_id, text) and "map<" not in kind and kind not in ("variant", "void")]
    sized = with_results(docs, {_SIZE: words_of(F.col(f"`{text}`")), _HASH: row_hash, _TIE: F.xxhash64(F.lit(seed), *others)})
    return mixed(sized if keep_text else sized.drop(text), source)


def mixed(sized: DataFrame, source: str = "source") -> DataFrame:
    """:func:`mix` from its first step on: rows with their size and hash."""
    keyed = written(with_results(sized, {_KEY: source_key(F.col(f"`{source}`"))}), "sized")
    salts = max(SALTS, keyed.count() // ROWS_A_SALT)
    keyed = keyed.withColumn(_SALT, F.pmod(_HASH, F.lit(salts)))
    plain = keyed.select(_KEY, F.col(f"`{source}`").cast("string").alias("source"), _SIZE, _SALT)
    by_salt = written(plain.groupBy(_KEY, "source", _SIZE, _SALT).agg(F.count(F.lit(1)).alias("n")), "lengths", narrow=True)
    lengths = by_salt.groupBy(_KEY, _SIZE).agg(F.sum("n").alias("n"))
    sums = by_salt.groupBy(_KEY).agg(F.first("source").alias("source"), F.sum(F.col(_SIZE) * F.col("n")).alias("source_size"))
    goals = written(targets(sums), "targets")
    # a source has at most as many lengths as the root of twice its words
    plan = lengths.join(goals, _KEY).groupBy(_KEY).applyInPandas(_fit_source, f"`{_KEY}` string, size long, passes int, more long")
    before = Window.partitionBy(_KEY, _SIZE).orderBy(_SALT).rowsBetween(Window.unboundedPreceding, -1)  # at most a row for each salt
    parts = by_salt.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(plan, [_KEY, _SIZE])
    parts = parts.join(goals.select(_KEY, "source_size", "target"), _KEY)
    quota = F.greatest(F.lit(0), F.least(F.col("n"), F.col("more") - F.col("before")))
    parts = parts.select(_KEY, _SIZE, _SALT, *[c.alias(f"{OWN}{n}") for n, c in (("quota", quota), ("passes", F.col("passes")), ("source_size", F.col("source_size")), ("target", F.col("target")))])
    rank = F.row_number().over(Window.partitionBy(_KEY, _SIZE, _SALT).orderBy(_HASH, _TIE))
    chosen = keyed.withColumn(f"{OWN}rank", rank).join(parts, [_KEY, _SIZE, _SALT])
    copies = F.col(f"{OWN}passes") + (F.col(f"{OWN}rank") <= F.col(f"{OWN}quota")).cast("int")
    out = with_results(
        chosen,
        {
            "source_size": F.col(f"{OWN}source_size"),
            "target": F.col(f"{OWN}target"),
            "copies": copies,
            "taken": (copies * F.col(_SIZE)).cast("long"),
        },
    )
    return out.drop(_KEY, _HASH, _TIE, _SALT, *[f"{OWN}{n}" for n in ("rank", "quota", "passes", "source_size", "target")])


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: each document of :func:`mix` as often as it is taken, with its own columns, whatever these are called.

    Documents without words, null texts too, are taken like any others of their length. An empty table gives an empty one.
    """
    rows = mix(packed(docs, doc_id, text, source), doc_id, text, source, seed, keep_text=False).where("copies > 0")
    return unpacked(rows.withColumn(f"{OWN}copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))), docs)


def digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "size", "source_size", "target", "taken")
