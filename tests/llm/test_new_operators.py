"""The prefix trie, the Jaccard join and the cross-tokenizer alignment, against brute force."""

import base64
import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stintwise.llm import jaccardjoin, prefixtrie, queries, tokenalign
from tests.conftest import SF001
from tests.llm.conftest import DOCS, prose

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# --- prefix trie

def brute_trie(convs):
    """``convs``: id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        own = (len(who) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    return sorted((min(who), len(p), min(members[p[:-1]]) if p else -1, len(who), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, who in members.items())


def trie_rows(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.select(*TRIE).collect())


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}


@pytest.mark.parametrize("longest", [1, 4, 21])
def test_trie_equals_brute_force(spark, longest):
    rnd = random.Random(longest)
    rows = []
    for c in range(60):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bé", "", None])))
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    assert trie_rows(prefixtrie.prefix_trie(df)) == brute_trie(ordered(rows))


def test_trie_of_odd_rows(spark):
    schema = "conv_id bigint, turn int, role string, text string, d int, name string, up int, key int"
    rows = [(None, 0, "user", "x"), (1, None, "user", "first"), (1, 0, None, None), (2, None, "user", "first"),
            (2, 0, "", ""), (3, 5, "user", "u"), (-4, 1, "us", "eru")]
    df = spark.createDataFrame([(*r, 1, "n", 2, 3) for r in rows], schema)
    assert trie_rows(prefixtrie.prefix_trie(df)) == brute_trie(ordered(rows))
    again = [(1, 0, "a", "b"), (1, 0, "a", "b")]        # a repeated row is a turn of its own
    df = spark.createDataFrame([(*r, 1, "n", 2, 3) for r in again], schema)
    assert trie_rows(prefixtrie.prefix_trie(df)) == brute_trie(ordered(again))
    assert prefixtrie.prefix_trie(spark.createDataFrame([], schema)).count() == 0


def test_trie_of_one_long_conversation_and_many_equal_ones(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(70)]
    rows += [(c, t, "user", f"t{t}") for c in range(1, 300) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    assert trie_rows(prefixtrie.prefix_trie(df)) == brute_trie(ordered(rows))


def test_end_lists_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK_IDS", 7)
    ends = spark.range(100).select(F.lit(b"x").alias("name"), F.col("id").alias("conv"))
    want = hashlib.sha256(",".join(map(str, range(100))).encode()).hexdigest()
    assert [r.ends_sha256 for r in prefixtrie._end_digests(ends).collect()] == [want]


def test_op13_rebuilds_conversations(spark):
    table = pq.read_table(f"{SF001}/conversations.parquet").to_pydict()
    convs = ordered(zip(table["conv_id"], table["turn"], table["role"], table["text"]))
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    assert trie_rows(queries.op13_prefix_trie(spark, SF001)) == brute_trie(built)


# --- Jaccard join

def word_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(ws[i:i + 4]) for i in range(max(len(ws) - 3, 1))} if ws else set()


def brute_components(rows):
    """(id, set size, component) of every row, sorted."""
    sets = [(i, frozenset(word_set(t))) for i, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b) if a and b else 0
            if both and 100 * both >= 85 * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(s), least.get(find(i))) for i, (doc, s) in enumerate(sets)), key=repr)


def found_components(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        ws = base.split()
        for _ in range(rnd.randint(0, edits)):
            ws[rnd.randrange(len(ws))] = rnd.choice(["zzz", "yyy", "xxx"]) + str(rnd.randrange(50))
        out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("most", [1, 6])
def test_jaccard_components_equal_brute_force(spark, most):
    rnd = random.Random(most)
    texts = []
    for size, edits in ((8, 1), (40, 2), (40, 3), (120, 6), (120, 12), (400, 16)):
        for _ in range(3):
            texts += copies(rnd, prose(rnd, size), rnd.randint(2, 12), edits)
    shared = prose(rnd, 60)
    texts += [f"{prose(rnd, rnd.randint(0, 30))} {shared} {prose(rnd, rnd.randint(0, 20))}" for _ in range(30)]
    texts += [prose(rnd, rnd.randint(1, 6)) for _ in range(40)]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found_components(jaccardjoin.jaccard_components(df, most=most)) == brute_components(rows)


def test_jaccard_components_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found_components(jaccardjoin.jaccard_components(odd_docs)) == brute_components(rows)
    assert jaccardjoin.jaccard_components(no_docs).count() == 0


def test_ten_thousand_equal_rows_and_a_large_loose_group(spark):
    rnd = random.Random(9)
    base = prose(rnd, 30)
    rows = [(None, base)] * 10_000 + [(7, base), (8, base + " and more")]
    rows += [(100 + i, t) for i, t in enumerate(copies(rnd, prose(rnd, 25), 120, 2))]
    got = Counter(found_components(jaccardjoin.jaccard_components(spark.createDataFrame(rows, DOCS.split(", lang")[0]))))
    small = brute_components([r for r in rows if r[0] is not None])
    assert got.pop((None, len(word_set(base)), 7)) == 10_000
    assert sorted(got.elements(), key=repr) == small


def test_digests_differ_in_no_more_bits_than_sets():
    rnd = np.random.default_rng(5)
    for n in (1, 3, 40, 300, 600, 3000):
        for gone in (0, 1, n // 9, n // 2, n):
            a = rnd.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[gone:], rnd.integers(0, 1 << 63, gone // 2).astype(np.uint64)])
            x, y = jaccardjoin.digest(a), jaccardjoin.digest(b)
            apart = len(np.setxor1d(a, b))
            assert jaccardjoin.differing(x, y) == jaccardjoin.differing(y, x) <= apart
            size = jaccardjoin.NARROW // 8
            assert jaccardjoin.differing(jaccardjoin.folded(x, size), jaccardjoin.folded(y, size)) <= apart


def test_unlinked_documents_with_a_rare_passage_are_seldom_compared(spark, monkeypatch):
    rnd = random.Random(4)
    lines = [" ".join(f"often{j}x{i}" for i in range(36)) for j in range(10)]
    texts = copies(rnd, prose(rnd, 60), 5, 1)
    for g in range(20):
        passage = " ".join(f"rare{g}x{i}" for i in range(14))
        texts += [f"{passage} {line}" for line in lines]
    rows, compared, linked = list(enumerate(texts)), [], jaccardjoin._linked

    def counted(pairs, sets, least):
        compared.append(pairs.count())
        return linked(pairs, sets, least)

    monkeypatch.setattr(jaccardjoin, "_linked", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found_components(jaccardjoin.jaccard_components(df)) == brute_components(rows)
    assert sum(compared) < 100      # the passages make 900 pairs


def test_frequency_cells_count_every_document(spark):
    docs = spark.createDataFrame([("a b c d",)] * 50 + [("e f g h i",)] * 3 + [(None,)], "_text string").repartition(7)
    cells = jaccardjoin.frequency_cells(docs)
    assert sorted(cells[cells > 0].tolist()) == [3, 3, 50]


def test_op12_equals_brute_force(spark):
    table = pq.read_table(f"{SF001}/documents.parquet").to_pydict()
    assert (found_components(queries.op12_jaccard_join(spark, SF001))
            == brute_components(list(zip(table["doc_id"], table["text"]))))


# --- cross-tokenizer alignment

ALIGN = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    with open(queries.tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        table = {int(n): base64.b64decode(t) for t, n in map(bytes.split, f)}
    return a, table, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute_groups(text):
    """Groups of a text as (A ids, B ids), or none."""
    a, table, b = libraries()
    if not text:
        return []
    xa = a.encode(" " + text, add_special_tokens=False).ids
    xb = b.encode(text)
    bytes_b = []
    for i in xb:
        p = b.id_to_piece(i)
        bytes_b.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode())
    if b"".join(table[i] for i in xa) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    out, ga, gb, ea, eb = [], [], [], 0, 0
    ia, ib = iter(xa), iter(zip(xb, bytes_b))
    while True:
        if ea <= eb:
            i = next(ia, None)
            if i is None:
                return out
            ga.append(i)
            ea += len(table[i])
        else:
            i, raw = next(ib)
            gb.append(i)
            eb += len(raw)
        if ea == eb:
            out.append((ga, gb))
            ga, gb = [], []


def brute_align(texts):
    per = [brute_groups(t) for t in texts]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in per]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g, c in zip(per, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        rows.append((sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(c.values()),
                     sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                     hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows


def aligned_rows(df):
    return sorted(((r.doc_id, *(r[c] for c in ALIGN)) for r in df.collect()), key=repr)


def hostile(rnd, n):
    parts = ["word", "Word's", " ", "  ", "\n", "\t", "é", "漢字", "🙂", "12345", "...", "<|endoftext|>", "</s>", "<0x41>", "aaaaaaa", "I'll", "\u00a0", "=====", "\x1c"]
    return "".join(rnd.choice(parts) + rnd.choice(["", " ", " "]) for _ in range(n))


@pytest.mark.parametrize("span, piece, fan, frequent", [(32 << 10, 8 << 10, 16, 1 << 18), (64, 40, 2, 20), (7, 30, 3, 0)])
def test_alignment_equals_brute_force(spark, span, piece, fan, frequent):
    rnd = random.Random(span)
    texts = [None, "", "x", "a\u2581b", " lead", "trail ", "a" * 301, "b" * 64 + " " + "-" * 333, " " * 50, "\n" * 33, "same", "same"]
    texts += [hostile(rnd, rnd.randint(1, 60)) for _ in range(60)] + [prose(rnd, rnd.randint(1, 80)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id bigint, text string, n_a int, row int")
    got = aligned_rows(tokenalign.align(df, *PATHS, span=span, piece_chars=piece, fan=fan, frequent=frequent))
    assert got == sorted(((i, *r) for i, r in enumerate(brute_align(texts))), key=repr)


def test_alignment_of_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *b) for r, b in zip(rows, brute_align([r.text for r in rows]))), key=repr)
    assert aligned_rows(tokenalign.align(odd_docs, *PATHS)) == want
    assert tokenalign.align(no_docs, *PATHS).count() == 0


def test_fragments_compose_in_any_order():
    rnd = random.Random(2)
    pair = tokenalign.Pair(*PATHS)
    for _ in range(40):
        text = hostile(rnd, 40)
        (a,), (b,), (same,) = pair.encode([text])
        assert same
        parts = [f for _, f, _ in tokenalign.fragments_of(a, b, 0, pair, rnd.randint(1, 40))]
        left = functools.reduce(tokenalign.compose, parts, tokenalign.Fragment())
        while len(parts) > 1:
            i = rnd.randrange(len(parts) - 1)
            parts[i:i + 2] = [tokenalign.compose(*parts[i:i + 2])]
        assert parts[0] == left
        links = Counter((x << 16) | y for ga, gb in brute_groups(text)[1:] for x in ga for y in gb)
        assert left.links == links and not left.suffix[0] and not left.suffix[1]


def test_op11_equals_brute_force(spark):
    table = pq.read_table(f"{SF001}/documents.parquet").to_pydict()
    want = sorted(((i, *r) for i, r in zip(table["doc_id"], brute_align(table["text"]))), key=repr)
    assert aligned_rows(queries.op11_token_alignment(spark, SF001)) == want
