"""Operators that look at the corpus as a whole, against brute force."""

import collections
import glob
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stintwise.llm import ann, components, decontaminate, hmm, neardup, queries, sharding
from stintwise.llm.common import table, text_bytes
from tests.conftest import SF001
from tests.llm.conftest import prose


# --- decontamination

def _spoil(rnd, text, edits):
    for _ in range(edits):
        at = rnd.randrange(len(text))
        text = rnd.choice([text[:at] + text[at + 1:], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1:]])
    return text


def test_decontamination_finds_edited_passages(spark):
    rnd = random.Random(4)
    items = [(i, prose(rnd, rnd.randint(15, 60))) for i in range(12)]
    docs, want = [], set()
    for i in range(150):
        body = prose(rnd, rnd.randint(0, 200))
        if i % 3 == 0:
            j = rnd.randrange(12)
            k = decontaminate.budget(len(items[j][1].encode()))
            passage = _spoil(rnd, items[j][1], rnd.randint(0, k - 1))
            if i % 2:
                passage = passage.upper().replace(" ", "\n \t", 3)
            body = f"{body} {passage} {prose(rnd, rnd.randint(0, 50))}"
            want.add((i, j))
        docs.append((i, body, 9))
    docs += [(1000, None, 1), (1001, "", 1), (None, items[0][1], 1), (1002, items[1][1] + " gap " * 60 + items[1][1], 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, start int")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "short")], "item_id bigint, text string")
    got = decontaminate.matches(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 0), (1002, 1)}
    assert sum(1 for r in got if r.doc_id == 1002) == 2
    text = {d: t for d, t, _ in docs}
    item = dict(items)
    squash = lambda b: b" ".join(b.lower().split())
    for r in got:
        part = squash(text[r.doc_id].encode()[r.start:r.end])
        assert abs(len(part) - len(item[r.item_id])) <= r.edits
        assert r.edits or part == item[r.item_id].encode()
    in_passes = decontaminate.matches(df, bench, block_bytes=300).collect()
    assert sorted(map(str, in_passes)) == sorted(map(str, got))
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    hit = {d for d, _ in want} | {None, 1002}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _ in docs if d not in hit)
    assert decontaminate.matches(df.limit(0), bench).count() == 0
    assert decontaminate.matches(df, bench.limit(0)).count() == 0
    assert decontaminate.clean(df, bench.limit(0)).count() == len(docs)


def test_banded_alignment_equals_plain_edit_distance():
    rnd = random.Random(6)
    for _ in range(60):
        item = "".join(rnd.choice("abc") for _ in range(rnd.randint(12, 30)))
        part = _spoil(rnd, item, rnd.randint(0, 4))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9))) + part + "bb"
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j in range(1, len(text) + 1):
                new.append(min(row[j - 1] + (text[j - 1] != c), row[j] + 1, new[-1] + 1))
            row = new
        got = decontaminate.banded_alignment(np.frombuffer(item.encode(), np.uint8), np.frombuffer(text.encode(), np.uint8),
                                             -len(item), len(text), 30)
        assert got[0] == min(row)


# --- near duplicates

def _shingles(text):
    w = (text or "").encode().lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def _similarity(x, y):
    return sum(1 / sum(max(x[d] / x[k], y[d] / y[k]) for d in x.keys() | y.keys()) for k in x.keys() & y.keys())


def _classes(docs):
    """Class id of every row by comparing all different texts."""
    texts = sorted({t or "" for _, t in docs})
    sets, up = [_shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        return x if up[x] == x else find(up[x])

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i].keys() & sets[j].keys() and _similarity(sets[i], sets[j]) >= 0.8:
            up[find(i)] = find(j)
    least = {}
    for d, t in docs:
        root = find(texts.index(t or ""))
        if d is not None:
            least[root] = min(d, least.get(root, d))
    return collections.Counter((d, least.get(find(texts.index(t or "")))) for d, t in docs)


def _family(rnd, n, words, changes):
    base = prose(rnd, words).split()
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, changes)):
            own[rnd.randrange(len(own))] = prose(rnd, 1)
        yield " ".join(own)


def test_probability_jaccard_and_its_estimate():
    rnd = random.Random(8)
    texts = [*_family(rnd, 6, 120, 6), "a b", "a b c d e a b c d e a b c d e f", ""]
    row, ids, weight = neardup.shingles(*text_bytes(pa.array(texts)))
    sig = neardup.signatures(row, ids, weight, len(texts), registers=4096)
    for i, j in itertools.combinations(range(len(texts) - 1), 2):
        exact = _similarity(_shingles(texts[i]), _shingles(texts[j]))
        assert neardup.probability_jaccard(ids[row == i], weight[row == i], ids[row == j], weight[row == j]) == pytest.approx(exact)
        assert (sig[i] == sig[j]).mean() == pytest.approx(exact, abs=0.05)


def test_similarity_bound_holds_and_is_tight_for_equal_weights():
    rng = np.random.default_rng(2)
    for heavy in (1, 4):
        sets = []
        for _ in range(40):
            ids = np.sort(rng.choice(30, rng.integers(1, 25), replace=False)).astype(np.uint64)
            sets.append((ids, rng.integers(1, heavy + 1, len(ids))))
        weights = np.zeros(30)
        weights[sets[0][0].astype(int)] = sets[0][1]
        rest = sets[1:]
        owner = np.repeat(np.arange(len(rest)), [len(i) for i, _ in rest])
        ids, y = (np.concatenate(c) for c in zip(*rest))
        got = neardup._most_similar(weights[ids.astype(int)], y.astype(float), owner, weights.sum(),
                                    np.bincount(owner, y, minlength=len(rest)))
        true = np.array([neardup.probability_jaccard(*sets[0], *s) for s in rest])
        assert (got >= true - 1e-12).all()
        assert heavy > 1 or np.allclose(got, true)


@pytest.mark.parametrize("limits", [{}, {"bucket_block": 3, "group_rows": 4}])
def test_near_duplicate_classes_equal_brute_force(spark, limits):
    rnd = random.Random(9)
    docs = []
    for n, words, changes in ((40, 100, 4), (25, 60, 6), (12, 200, 12), (6, 30, 1), (4, 5, 1)):
        docs += [(None, t) for t in _family(rnd, n, words, changes)]
    docs += [(None, prose(rnd, rnd.randint(1, 150))) for _ in range(40)]
    docs += [(None, t) for _, t in rnd.sample(docs, 30)]
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    docs += [(500, None), (501, ""), (502, "  "), (503, "  "), (None, "alone without id"), (None, docs[0][1]), (504, docs[0][1].upper())]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], "doc_id bigint, text string, key string, class_id string")
    keyed = neardup.near_duplicates(df, **limits, with_keys=True)
    got = keyed.select("doc_id", "class_id")
    want = _classes(docs)
    assert collections.Counter(map(tuple, got.collect())) == want
    kept = neardup.keep_one(df, keyed).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for _, c in want if c is not None})
    assert [r.text for r in kept if r.doc_id is None] == ["alone without id"]


def test_keep_one_with_null_and_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(None, a)] * 50 + [(7, b), (7, a), (7, b), (9, b), (None, "no id"), (None, "no id"), (8, None), (3, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, text_key string")
    kept = neardup.keep_one(df, neardup.near_duplicates(df, with_keys=True))
    assert kept.columns == df.columns
    # one id with two texts leads both classes; empty and null texts are one class
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("7", a), ("7", b), ("None", "no id"), ("3", "")])


def test_near_duplicates_of_nothing(no_docs):
    assert neardup.near_duplicates(no_docs).count() == 0


def test_components_equal_union_find(spark):
    rnd = random.Random(10)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {x: x for e in links for x in e}

    def find(x):
        return x if up[x] == x else find(up[x])

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {(r.a, r.b) for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(x, find(x)) for x in up if find(x) != x}


# --- nearest neighbours

def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(3000, 24)) + 2 * rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)]
    v[1000:2000] = v[0]                                # a third of all rows are equal
    rows = [(i, x.tolist(), "c") for i, x in enumerate(v)]
    rows += [(5000, None, "c"), (5020, [], "c"), (5040, [0.0] * 24, "c"), (5060, [1.0] * 3, "c"),
             (5080, [float("nan")] * 24, "c"), (5100, [None] * 24, "c"), (5120, [float("inf")] * 24, "c"), (None, [1.0] * 24, "c")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 20 == 0, k=20, sample_rows=1500, block_rows=256, query_rows=64).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    found = []
    for q, best in got.items():
        s = (v * v[q]).sum(axis=1)
        assert [r for r, _, _ in sorted(best)] == list(range(1, 21))
        assert all(abs(x - s[i]) < 1e-9 and i != q for _, i, x in best)
        order = [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:20]
        found.append(len({i for _, i, _ in best} & set(order)) / 20)
    assert np.mean(found) >= 0.9


def test_nearest_with_few_rows_is_exact(spark):
    v = np.random.default_rng(4).normal(size=(15, 6)).round(1)
    v[7] = v[3]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = [(r.rank, r.vec_id) for r in ann.nearest(df, F.col("id") == 3).orderBy("rank").collect()]
    s = (v * v[3]).sum(axis=1)
    assert got == list(enumerate([i for i in np.lexsort((np.arange(15), -s)) if i != 3], 1))
    assert ann.nearest(df.limit(0), F.col("id") == 3).count() == 0
    assert ann.nearest(df.limit(1), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("n", [300, 5000])
def test_recall_and_lists_at_small_and_larger_sizes(spark, n):
    """Probes are fitted and lists grow with the root of n at any size; no table is searched in full."""
    rng = np.random.default_rng(12)
    v = rng.normal(size=(n, 16)) + 3 * rng.normal(size=(10, 16))[rng.integers(0, 10, n)]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(set)
    for r in ann.nearest(df, F.col("id") % 20 == 0, sample_rows=256, rows_per_list=16).collect():
        got[r.query_id].add(r.vec_id)
    assert set(got) == set(range(0, n, 20))
    s = v[::20] @ v.T
    s[np.arange(len(s)), np.arange(0, n, 20)] = -np.inf
    true = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([len(got[20 * i] & set(t.tolist())) / 20 for i, t in enumerate(true)]) >= 0.9


def test_nearest_finds_k_when_near_lists_hold_few(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3000, 8))
    v[:30] = 40 * rng.normal(size=(30, 8))             # far out: lists of one or two vectors
    v[30:2500] = v[30]                                 # one list holds most rows
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += rows[:60]                                  # repeated rows
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 20 == 0, k=20, target=0.05, block_rows=512).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    for q, best in got.items():
        best = sorted(best)
        assert [r for r, _, _ in best] == list(range(1, 21))
        seen = collections.Counter(i for _, i, _ in best)
        assert q not in seen and all(c <= 1 + (i < 60) for i, c in seen.items())
        assert [(-s, i) for _, i, s in best] == sorted((-s, i) for _, i, s in best)


@settings(max_examples=20, deadline=None, derandomize=True)
@given(st.integers(0, 10_000), st.integers(1, 25), st.booleans())
def test_scan_without_abandoning_is_exact(seed, k, ties):
    rng = np.random.default_rng(seed)
    x, q = rng.normal(size=(300, 20)), rng.normal(size=(7, 20))
    if ties:
        x, q = x.round(0), q.round(0)
    own = rng.random((7, 300)) < 0.01
    far = ((q[:, None] - x) ** 2).sum(axis=2)
    far[own] = np.inf
    kept = [set() for _ in q]
    bars = np.where(rng.random(7) < 0.5, np.inf, np.sort(far, axis=1)[:, 40])
    for who, which in ann.scan(q, bars, ann.Columns(x, 6), k, 1e6, own, chunk=64):
        for a, b in zip(who, which):
            kept[a].add(int(b))
    for i in range(7):
        bar = np.sort(far[i])[k - 1]
        assert {int(j) for j in np.flatnonzero(far[i] <= bar)} <= kept[i]
        assert not kept[i] & set(np.flatnonzero(own[i]))


# --- language model

def test_forward_recursion_equals_enumeration():
    rng = np.random.default_rng(5)
    m = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(4), 3).T)
    seqs = [rng.integers(0, 4, n) for n in (1, 5, 3)]
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s, got in zip(seqs, hmm.Runs(seqs).log10(m)):
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = np.array([m.start[q[0]] * math.prod(m.move[a, b] for a, b in zip(q, q[1:]))
                      * math.prod(m.emit[x, k] for x, k in zip(s, q)) for q in paths])
        assert got == pytest.approx(math.log10(p.sum()))
        for q, w in zip(paths, p / p.sum()):
            starts[q[0]] += w
            for a, b in zip(q, q[1:]):
                moves[a, b] += w
            for x, k in zip(s, q):
                emits[x, k] += w
    for got, want in zip(hmm.Runs(seqs).expected(m), (starts, moves, emits)):
        assert np.allclose(got, want, atol=1e-5)


@pytest.mark.parametrize("run", [1, 2, 7, 64])
def test_counts_do_not_depend_on_the_runs(run):
    rng = np.random.default_rng(6)
    m = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(9), 3).T)
    texts = [rng.integers(0, 9, n) for n in (1, 40, 7, 300, 8, 1, 14)]
    got = hmm.expected_counts(texts, m, run)
    for a, b in zip(got, hmm.Runs(texts).expected(m)):
        assert np.allclose(a, b, rtol=1e-4, atol=1e-4)
    assert got[0].sum() == pytest.approx(len(texts), rel=1e-5)          # every text starts once
    assert got[1].sum() == pytest.approx(sum(len(t) - 1 for t in texts), rel=1e-5)


def test_long_words_and_words_of_held_out_texts_are_frequent(spark):
    line, strange = "=" * 100, "only-held-out"
    rows = [(i, f"{line} {strange if i % 7 == 2 else 'common'} w{i}") for i in range(700)] + [(9, line + "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = hmm.word_counts(docs.withColumn("held", F.col("doc_id") % 7 == 2), "text", "held")
    key, = hmm.tokens(line)
    assert len(key) == 19 and key != hmm.tokens(line + "x")[0]
    assert hmm._most_frequent(counts.where("n > 0"), 2) == [(key, 600), (b"common", 600)]
    assert hmm._most_frequent(counts.where("n = 0"), 50, by="other") == [(strange.encode(), 100)]
    held = F.col("doc_id") % 7 == 2
    some, all_ = (hmm.score_texts(docs, held, frequent_words=n, own_words=2, buckets=16, iterations=2) for n in (2, 1 << 17))
    # of held-out texts the line and the end are known; 9 % 7 == 2, so row 9's second text has a new word and the end
    want = {i: [2] if i % 7 == 2 else [4] for i, _ in rows}
    want[9] = [1, 2]
    for got in (some, all_):
        found = collections.defaultdict(list)
        for r in got.collect():
            found[r.doc_id].append(r.n_known)
        assert {i: sorted(v) for i, v in found.items()} == {i: sorted(v) for i, v in want.items()}


def test_scores_of_odd_rows(odd_docs, no_docs):
    held = F.col("doc_id") % 7 == 2
    # no word is frequent enough for the first tier, then all are
    tables = [hmm.score_texts(odd_docs, held, frequent_words=n, own_words=5, buckets=16, iterations=2) for n in (1, 1 << 17)]
    rows = odd_docs.collect()
    split = [(r.doc_id, [*(r.text or "").encode().lower().split(), None]) for r in rows]
    counts = collections.Counter(w for d, ws in split for w in ws if d is None or d % 7 != 2)
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for d, ws in split:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        want[(d, d is not None and d % 7 == 2, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6))] += 1
    for got in tables:
        got = got.collect()
        assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                                   for r in got) == want
        assert all(r.score < 0 for r in got)
    assert hmm.score_texts(no_docs, held).count() == 0
    untrained = hmm.score_texts(odd_docs, F.lit(True)).collect()
    assert {r.base_score for r in untrained} == {0.0} and {r.n_known for r in untrained} == {0}


def test_model_is_a_distribution_and_beats_the_base(spark):
    got = queries.QUERIES["op9_hmm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    # shares of a shared symbol's words, with one for all unseen words, add up to 1
    words = [f"w{i}".encode() for i in range(200)]
    c = np.random.default_rng(1).integers(1, 50, 200)
    s = hmm.Symbols(0, 8)
    for symbol in range(1, s.size):
        inside = [n for w, n in zip(words, c) if s.shared(w) == symbol]
        total = sum(inside) + len(inside) + 1
        assert sum((n + 1) / total for n in inside) + 1 / total == pytest.approx(1)


# --- sharding

def test_shards_are_exact_and_rows_whole(odd_docs, no_docs):
    got = sharding.shuffle_to_shards(sharding.size_and_crc(odd_docs), shards=7, cell_rows=3).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect())
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(7)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shuffle_to_shards(no_docs.select("doc_id"), shards=7).count() == 0
    again = sharding.shuffle_to_shards(odd_docs, shards=7)      # has a column "shard" of its own
    assert again.columns == [c for c in odd_docs.columns if c != "shard"] + ["shard", "slot"]
    assert again.count() == len(got)


def test_written_shards_hold_the_texts(spark, monkeypatch):
    written = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, path: (written.append(path), write(df, path)))
    got = queries.op10_sharding(spark, SF001).collect()
    assert len(written) == 1
    seen, texts = set(), []
    for s in range(8):
        files = sorted(glob.glob(f"{written[0]}/shard={s}/*.parquet"))
        rows = [r for f in files for r in pq.ParquetFile(f).read().to_pylist()]
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        texts += [(r["doc_id"], r["text"]) for r in rows]
        seen |= {(r["doc_id"], zlib.crc32(r["text"].encode()), s, r["slot"]) for r in rows}
    docs = table(spark, SF001, "documents").collect()
    assert sorted(texts) == sorted((r.doc_id, r.text) for r in docs)
    assert {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in got} == seen and len(got) == len(docs)


def test_cells_are_bounded_by_bytes_and_shards_read_back(odd_docs, no_docs, tmp_path):
    placed = sharding.shuffle_to_shards(odd_docs, shards=2, cell_bytes=20_000)
    assert placed.rdd.getNumPartitions() > 2
    sharding.write_shards(placed, f"{tmp_path}/some")
    back = sharding.read_shards(placed, f"{tmp_path}/some")
    assert back.columns == placed.columns
    rows = back.collect()
    assert collections.Counter((r.doc_id, r.text, r.lang, r.score, r._text) for r in rows) == collections.Counter(
        (r.doc_id, r.text, r.lang, r.score, r._text) for r in odd_docs.collect())
    for s in range(2):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(len(rows) // 2))
    empty = sharding.shuffle_to_shards(no_docs, shards=2)
    sharding.write_shards(empty, f"{tmp_path}/none")
    assert sharding.read_shards(empty, f"{tmp_path}/none").collect() == []


def test_matrix_rows_add_up_and_are_uniform():
    sums = np.array([0, 5, 5, 30, 31, 64])
    cells = np.array([20, 20, 24])
    rows = np.stack([sharding.matrix_row(sums, cells, p, 3) for p in range(5)])
    assert rows.sum(axis=0).tolist() == cells.tolist()
    assert rows.sum(axis=1).tolist() == np.diff(sums).tolist()
    mean = np.mean([sharding.matrix_row(sums, cells, 2, s) for s in range(3000)], axis=0)
    assert np.allclose(mean, 25 * cells / 64, atol=0.15)
    rng = np.random.default_rng(2)
    big = [sharding._hypergeometric(rng, 3 * 10 ** 9, 7 * 10 ** 9, 1000) for _ in range(3000)]
    assert np.mean(big) == pytest.approx(300, abs=1.5) and np.std(big) == pytest.approx(14.49, abs=0.8)


# --- pipeline

def test_stages_against_brute_force(spark):
    docs = table(spark, SF001, "documents")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF001).cache()
        if name != "pack":
            assert kept.schema == docs.schema
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id for r in kept.collect()}
        if name == "quality":
            bad = {r.doc_id for r in queries.QUERIES["op2_line_crf_quality"](spark, SF001).where("predicted = 0").collect()}
            assert after == before.keys() - bad and bad
        elif name == "near_dedup":
            assert after == {c for _, c in _classes(list(before.items()))}
        elif name == "decontaminate":
            items = [" ".join(r.text.lower().split()) for r in table(spark, SF001, "benchmark").collect()]
            hit = {d for d, t in before.items() if any(i in " ".join(t.lower().split()) for i in items)}
            assert after == before.keys() - hit
        else:
            assert after == before.keys()
        docs = kept


def test_pipeline_is_registered_and_runs_on_nothing(spark, no_docs):
    assert entry.queries()["pipeline"] is queries.pipeline and corpus_pipeline.ORACLE_SQL is None
    docs = table(spark, SF001, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0
