"""Career relations against plain-Python brute force on random small tables with nulls."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stintwise.operators import careers
from stintwise.schemas import APPEARANCES

ROW = st.tuples(st.one_of(st.none(), st.integers(2000, 2006)), st.sampled_from(["e1", "e2"]),
                st.sampled_from(["A", "B", "C", None]), st.sampled_from(["d1", "d2", "d3", None]),
                st.sampled_from([True, True, False, None]), st.booleans())
TABLES = st.lists(ROW, min_size=1, max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def spans_bf(rows):
    out = {}
    for y, _, c, d, took, _ in rows:
        if took is True and y is not None:
            f, l_ = out.get((d, c), (y, y))
            out[(d, c)] = (min(f, y), max(l_, y))
    return [(d, c, f, l_) for (d, c), (f, l_) in out.items()]


def transfers_bf(rows, midseason):
    sp = spans_bf(rows)
    out = Counter()
    for d1, c1, f1, l1 in sp:
        for d2, c2, f2, l2 in sp:
            if d1 is None or d1 != d2:
                continue
            if midseason:
                ok = c1 is not None and c2 is not None and c1 != c2 and f2 in (l1, l1 + 1)
            else:
                ok = f2 == l1 + 1
            if ok:
                out[(d1, c1, l1, c2, f2)] += 1
    return out


def gaps_bf(rows, explained_by=None):
    sp = spans_bf(rows)
    arrivals = set()
    if explained_by is not None:
        arrivals = {(d, ci, ti) for (d, _, _, ci, ti) in transfers_bf(rows, explained_by)
                    if ci is not None}
    out = Counter()
    for d1, c1, f1, l1 in sp:
        for d2, c2, f2, l2 in sp:
            if d1 is not None and d1 == d2 and f2 - l1 >= 2 and (d2, c2, f2) not in arrivals:
                out[(d1, c1, l1, c2, f2, f2 - l1)] += 1
    return out


def debuts_bf(rows):
    first = {}
    for y, _, _, d, took, _ in rows:
        if took is True and y is not None:
            first[d] = min(first.get(d, y), y)
    return Counter((d, c, y) for y, _, c, d, _, _ in rows
                   if d is not None and y is not None and first.get(d) == y)


def announced_bf(rows):
    years = [y for y, *_ in rows if y is not None]
    if not years:
        return Counter()
    mx = max(years)
    before = [y for y in years if y < mx]
    second = max(before) if before else None
    act = [r for r in rows if r[4] is True and r[0] is not None and r[0] < mx]
    last = {}
    for y, _, _, d, _, _ in act:
        last[d] = max(last.get(d, y), y)
    listed = [d for y, _, _, d, took, _ in rows if y == mx and took is False]

    def not_in(d):
        if not listed:
            return True
        if d is None or d in listed or None in listed:
            return False
        return True

    return Counter((d, c, y) for y, _, c, d, _, _ in act
                   if d is not None and last.get(d) == y
                   and ((second is not None and y < second) or not_in(d)))


def got(df):
    return Counter(tuple(r) for r in df.collect())


@SETTINGS
@given(TABLES)
def test_transfers_and_gaps(spark, rows):
    a = spark.createDataFrame(rows, APPEARANCES)
    s = careers.spans(a)
    assert got(careers.transfers_consecutive(a, s)) == transfers_bf(rows, False)
    assert got(careers.transfers_with_midseason(a, s)) == transfers_bf(rows, True)
    assert got(careers.gap_pairs(a, s)) == gaps_bf(rows)
    assert got(careers.gaps_unexplained(a, False, s)) == gaps_bf(rows, False)
    assert got(careers.gaps_unexplained(a, True, s)) == gaps_bf(rows, True)


@SETTINGS
@given(TABLES)
def test_debuts_and_announced_retirements(spark, rows):
    a = spark.createDataFrame(rows, APPEARANCES)
    assert got(careers.debuts(a)) == debuts_bf(rows)
    assert got(careers.retirements_announced(a)) == announced_bf(rows)


DRIVER = st.fixed_dictionaries({"driverId": st.sampled_from(["d1", "d2", None]),
                                "rounds": st.sampled_from(["1", "1-3", None]),
                                "testDriver": st.sampled_from([True, False, None])})
LEVEL2 = st.one_of(
    DRIVER,
    st.fixed_dictionaries({"drivers": st.lists(DRIVER, max_size=3)}),
)
CONSTRUCTOR = st.builds(lambda cid, body: {"constructorId": cid, **body},
                        st.sampled_from(["c1", "c2"]), LEVEL2)
ENTRY = st.one_of(
    st.builds(lambda e, c: {"entrantId": e, **c}, st.sampled_from(["e1", "e2"]), CONSTRUCTOR),
    st.builds(lambda e, cs: {"entrantId": e, "constructors": cs},
              st.sampled_from(["e1", "e2"]), st.lists(CONSTRUCTOR, max_size=3)),
)


def flatten_bf(year, entry):
    level1 = ([entry] if entry.get("constructorId") is not None or entry.get("constructors") is None
              else entry["constructors"])
    out = []
    for c in level1:
        level2 = ([c] if c.get("driverId") is not None or c.get("drivers") is None
                  else c["drivers"])
        for d in level2:
            out.append((year, entry["entrantId"], c.get("constructorId"), d.get("driverId"),
                        d.get("rounds") is not None, bool(d.get("testDriver") or False)))
    return out


@SETTINGS
@given(st.lists(st.tuples(st.integers(1990, 1995), ENTRY), min_size=1, max_size=8))
def test_flatten_entries(spark, entries):
    from pyspark.sql import types as T

    from stintwise.operators.normalise import flatten_entries
    from stintwise.schemas import SEASON_ENTRY
    df = spark.createDataFrame(entries, T.StructType([T.StructField("year", T.IntegerType()),
                                                      T.StructField("entry", SEASON_ENTRY)]))
    want = Counter(r for y, e in entries for r in flatten_bf(y, e))
    assert got(flatten_entries(df)) == want


KEYS = ["id", "name", "code", "year", "note"]


@SETTINGS
@given(st.lists(st.permutations(KEYS).flatmap(
    lambda ks: st.integers(1, len(ks)).map(lambda n: ks[:n])), min_size=1, max_size=8))
def test_key_discovery(spark, docs):
    import json

    from pyspark.sql import functions as F

    from stintwise.operators import schema
    rows = [(i, json.dumps({k: str(j) for j, k in enumerate(keys)})) for i, keys in enumerate(docs)]
    df = spark.createDataFrame(rows, "_doc int, j string").select(
        "_doc", F.from_json("j", "map<string,string>").alias("doc"))
    first_seen = list(dict.fromkeys(k for keys in docs for k in keys))
    assert schema.key_list(schema.discover_keys(df, ["_doc"])) == first_seen
    widest = max(range(len(docs)), key=lambda i: (len(docs[i]), i))
    assert schema.key_list(schema.widest_keys(df, ["_doc"])) == docs[widest]


CHAIN = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1990, 1999),
                           st.one_of(st.none(), st.integers(1990, 1999))), min_size=1, max_size=4)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), CHAIN)), min_size=1, max_size=10))
def test_chain_dedupe_and_edges(spark, owned):
    from stintwise.operators.normalise import chain_edges, dedupe_chains
    item = "array<struct<constructorId:string,yearFrom:int,yearTo:int>>"
    df = spark.createDataFrame(owned, f"owner int, chain {item}")
    uniq = dedupe_chains(df, "owner", "chain")
    want_ids = {}
    for owner, chain in owned:
        if chain is not None:
            key = tuple(chain)
            want_ids[key] = min(want_ids.get(key, owner), owner)
    got_ids = {tuple(tuple(x) for x in r["chain"]): r["chain_id"] for r in uniq.collect()}
    assert got_ids == want_ids
    edges = chain_edges(uniq, "chain", "constructorId", ["yearFrom", "yearTo"],
                        from_col="f", to_col="t", keep=["chain_id"])
    want_edges = Counter((cid, chain[i - 1][0] if i else None, c, yf, yt, i)
                         for chain, cid in want_ids.items()
                         for i, (c, yf, yt) in enumerate(chain))
    assert got(edges.select("chain_id", "f", "t", "yearFrom", "yearTo", "_pos")) == want_edges


@SETTINGS
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3),
                          st.one_of(st.none(), st.lists(st.sampled_from(["x", "y", "z"]), max_size=4))),
                min_size=1, max_size=10, unique_by=lambda t: t[0]))
def test_explode_child_ids(spark, parents):
    from stintwise.operators.normalise import explode_child
    df = spark.createDataFrame(parents, "id string, names array<string>")
    rows = sorted(tuple(r) for r in explode_child(df, "id", "names", "pid", item="name").collect())
    items = [(p, i, n) for p, names in parents for i, n in enumerate(names or [])]
    want = [(k, p, n) for k, (p, _, n) in enumerate(sorted(items, key=lambda t: (t[0], t[1])))]
    assert rows == want
