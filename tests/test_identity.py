"""Records to be kept apart, and clusters kept up by batches, against brute force."""

import random

import pytest

from quern.operators import identity
from quern.sources import clusters


def brute_force(ids, links, apart):
    """The rule of kept_apart in plain loops, one component at a time."""

    def closure(nodes, pairs):
        of = {n: n for n in nodes}
        for a, b in pairs:
            x, y = sorted((of[a], of[b]))
            of = {n: x if c == y else c for n, c in of.items()}
        return of

    plain, out = closure(ids, [(a, b) for a, b, _ in links]), {}
    for c in set(plain.values()):
        nodes = [n for n in ids if plain[n] == c]
        pairs = {frozenset(p) for p in apart if p[0] != p[1] and p[0] in nodes and p[1] in nodes}
        if not pairs:
            out |= {n: min(nodes) for n in nodes}
            continue
        seeds = set().union(*pairs)
        group, fixed = {n: n for n in nodes}, {n: n in seeds for n in nodes}  # the name of each one's whole, and whether it has a seed
        best = {}
        for a, b, s in links:
            if a in nodes and a != b:
                best[frozenset((a, b))] = max(s, best.get(frozenset((a, b)), 0))
        for strength in sorted(set(best.values()), reverse=True):
            edges = {frozenset((group[a], group[b])) for (a, b), s in ((tuple(e), s) for e, s in best.items() if s == strength) if group[a] != group[b]}
            held = {group[n] for n in nodes if fixed[n]}
            tie = {w: w for w in held}
            while True:
                new = {}
                for e in edges:
                    for x, y in (tuple(e), tuple(e)[::-1]):
                        if x not in tie and y in tie:
                            new[x] = min(new.get(x, tie[y]), tie[y])
                if not new:
                    break
                tie |= new
            free = [tuple(e) for e in edges if not set(e) & set(tie)]
            rest = closure({w for e in free for w in e}, free)
            between = sorted({tuple(sorted((tie[x], tie[y]))) for x, y in map(tuple, edges) if x in tie and y in tie and tie[x] != tie[y]})
            into = {w: w for w in held}
            holds = {w: {n for n in nodes if fixed[n] and group[n] == w} for w in held}
            while True:
                step = [tuple(sorted((into[x], into[y]))) for x, y in between if into[x] != into[y]]
                step = [(x, y) for x, y in step if not any(frozenset((a, b)) in pairs for a in holds[x] for b in holds[y])]
                if not step:
                    break
                x, y = step[0]
                into = {w: x if v == y else v for w, v in into.items()}
                holds[x] |= holds[y]
            for n in nodes:
                if group[n] in tie:
                    group[n], fixed[n] = into[tie[group[n]]], True
                else:
                    group[n] = rest.get(group[n], group[n])
        for w in set(group.values()):
            own = [n for n in nodes if group[n] == w]
            out |= {n: min(own) for n in own}
    return out


@pytest.mark.parametrize("seed", range(2))
def test_pairs_are_kept_apart_whatever_leads_from_one_to_the_other(spark, seed):
    rng = random.Random(seed)
    ids = list(range(80))
    links = [(rng.randrange(80), rng.randrange(80), rng.choice([1, 1, 2, 3])) for _ in range(75)]
    apart = [(a, b) for a, b, _ in rng.sample(links, 6)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(12)]
    expected = brute_force(ids, links, apart)
    assert all(expected[a] != expected[b] for a, b in apart if a != b)
    nodes = spark.createDataFrame([(n,) for n in ids], "id int")
    if seed:  # the rule doesn't know of any order
        links, apart = [(b, a, s) for a, b, s in rng.sample(links, len(links))], [(b, a) for a, b in reversed(apart)]
    found = identity.kept_apart(nodes, spark.createDataFrame(links, "a int, b int, strength int"), spark.createDataFrame(apart, "a int, b int"))
    assert {r.id: r.cluster for r in found.collect()} == expected


def test_third_records_keep_their_links(spark):
    """9 has the title of 7 and 8 its address; 10 is given as the same as both; 11 is one of many of their title."""
    rows = [(7, "T", "u/1"), (8, "X", "u/1"), (9, "t", "u/9"), (10, "Y", "u/10"), (11, "The T", "u/11"), (12, "x", None)]
    records = spark.createDataFrame(rows, "id int, original_title string, url string")
    same, apart = spark.createDataFrame([(7, 10), (8, 10)], "a int, b int"), spark.createDataFrame([(8, 7)], "a int, b int")
    found = {r.id: r.cluster for r in identity.kept_apart(records, identity.match_links(records, same), apart).collect()}
    assert found == {7: 7, 9: 7, 10: 7, 11: 7, 8: 8, 12: 8}
    none = spark.createDataFrame([], "a int, b int")
    assert {r.cluster for r in identity.kept_apart(records, identity.match_links(records, same), none).collect()} == {7}
    assert identity.kept_apart(records.limit(0), identity.match_links(records.limit(0)), apart).count() == 0


def test_upkeep_by_batches_equals_closure_from_scratch(spark, tmp_path):
    rng, at = random.Random(11), str(tmp_path / "clusters")
    ids = rng.sample(range(1000), 240)
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(170)]
    seen, given = [], []
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    for k in range(4):
        new = ids[k * 60 : (k + 1) * 60]
        seen += new
        links = [e for e in edges if set(e) <= set(seen) and e not in given]
        given += links
        version = clusters.refresh(spark, at, frame([(i,) for i in new] + [(new[0],), (None,)], "id int"), frame([*links, (5000, new[0])], "a int, b int"), k)
        found = {r.id: r.cluster for r in clusters.labels(spark, at).collect()}
        expected = brute_force(seen, [(a, b, 1) for a, b in given], [])
        assert found == expected and version["wrote"][0] == 60
    assert clusters.refresh(spark, at, frame([(1,)], "id int"), frame([(1, 2)], "a int, b int"), 3) == version
    # one link between two large clusters writes no label, and forwards only
    big, other = [min(c for c in expected.values()), next(c for c in sorted(expected.values(), reverse=True))]
    version = clusters.refresh(spark, at, frame([], "id int"), frame([(other, big)], "a int, b int"), 4)
    assert version["wrote"][0] == 0 and 1 <= version["wrote"][1] <= 60
    merged = {i: big if c == other else c for i, c in expected.items()}
    assert {r.id: r.cluster for r in clusters.labels(spark, at).collect()} == merged
    assert clusters.compact(spark, at)["forwards"] == 0 and {r.id: r.cluster for r in clusters.labels(spark, at).collect()} == merged


def test_a_chain_takes_no_more_room_than_it_has(spark, monkeypatch):
    """No step of a long chain in any order of ids has more edges than there were (F7)."""
    ids, sizes, kept = list(range(100)), [], identity.written

    def counted(df, what="step"):
        out = kept(df, what)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(identity, "written", counted)
    shuffled = random.Random(5).sample(ids, 100)
    for chain in (ids, shuffled):
        edges = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)) + [(1000, 1001), (1002, 1002)], "a long, b long")
        nodes = spark.createDataFrame([(k,) for k in [*ids, 1000, 1001, 1002, 1003]], "id long")
        found = dict(map(tuple, identity.components(nodes, edges).collect()))
        assert found == dict.fromkeys(ids, 0) | {1000: 1000, 1001: 1000, 1002: 1002, 1003: 1003}
    assert max(sizes) <= 104
