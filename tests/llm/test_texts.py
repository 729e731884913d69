"""Operators that read texts one by one: token counts, packing, chat, quality, URL rules."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stintwise.llm import chat, linecrf, packing, queries, tokencount, urlrules
from stintwise.llm.common import table, text_bytes
from tests.conftest import SF001

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- token counts

def test_pretoken_lengths_add_up_to_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", " \n", "▁", "é", "</s>", "<s>", "\t", "\r", "x1", "日本", "😀", ".", "\x00", "<0x0A>"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    got = tokencount.Pretokens(PIECES, {" the": 1}, cache_entries=50).counts(texts)
    assert got.tolist() == [len(sp.encode(t)) for t in texts]


def test_frequent_pretokens_are_counted_over_all_documents(spark):
    texts = [f"w{i // 2} {'x' * 40} once{i}" for i in range(12_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    units = collections.Counter(u for t in texts for u in tokencount.pretokens(t) if len(u) <= 32)
    got = tokencount.frequent_lengths(df, PIECES)
    assert set(got) == {u for u, n in units.items() if n > 1} and len(got) == 6_000
    assert got == dict(zip(got, tokencount.Pretokens(PIECES).lengths(list(got))))
    few = spark.createDataFrame([("a a a a b b",), ("a b c c d",)], "text string")
    assert set(tokencount.frequent_lengths(few, PIECES, entries=2)) == {" a", " b"}


def test_summaries_hold_their_bound_when_merged(spark):
    rnd = random.Random(4)
    words = [f"w{int(rnd.paretovariate(0.6)) % 5000}" for _ in range(60_000)]
    df = spark.createDataFrame([(" ".join(words[i:i + 20]),) for i in range(0, 60_000, 20)], "text string").repartition(9)
    true = collections.Counter(f" {w}" for w in words)
    got = tokencount.pretoken_summary(df, counters=200, fan=2, cut_chars=3000)
    assert len(got) <= 200 and all(true[u] - len(words) / 200 <= n <= true[u] for u, n in got.items())
    assert all(u in got for u, n in true.items() if n > len(words) / 200)
    assert tokencount.pretoken_summary(df.limit(0)) == {}


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = collections.Counter()
    for r in odd_docs.collect():
        n = len(sp.encode(r.text or ""))
        want[(r.doc_id, len((r.text or "").encode()), n, n > 4096)] += 1
    assert collections.Counter(map(tuple, tokencount.token_counts(odd_docs, PIECES).collect())) == want
    assert tokencount.token_counts(no_docs, PIECES).count() == 0


# --- packing

def _check_pieces(rows, texts):
    """Every id in exactly one piece, sequences gapless; returns the sequences' lengths."""
    tok = Tokenizer.from_file(WORDS)
    want = collections.Counter(
        (d, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in texts)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length, r.window))
    for parts in sequences.values():
        at = 0
        for offset, length, window in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window <= 4096
    got = collections.Counter()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for d, parts in by_doc.items():
        if sum(1 for s, _, _ in parts if s == 0) == 1:      # one row with this id
            ids = [i for s, p, _ in sorted(parts) for i in p]
            assert len(ids) == parts[0][2]
            got[(d, tuple(ids))] += 1
    single = {d for d, n in collections.Counter(d for d, _ in texts).items() if n == 1}
    assert {k for k in got if k[0] in single} == {k for k in want if k[0] in single}
    assert sum(len(p) for parts in by_doc.values() for _, p, _ in parts) == sum(len(i) * n for (_, i), n in want.items())
    return [parts[0][2] for parts in sequences.values()]


def test_packing_of_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, WORDS, 2).collect()
    lengths = _check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert all(n & (n - 1) == 0 for n in lengths)
    assert packing.pack_documents(no_docs, WORDS, 2).count() == 0


def test_packing_in_small_blocks(odd_docs):
    rows = packing.pack_documents(odd_docs, WORDS, 2, block_tokens=2000).collect()
    _check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_step_groups_are_balanced():
    rnd = random.Random(2)
    sizes = [rnd.choice(packing.TIERS) for _ in range(500)]
    totals = collections.Counter()
    for n, g in zip(sizes, packing.step_groups(sizes, 32768)):
        totals[g] += n
    assert max(totals.values()) - min(totals.values()) <= max(sizes)


def test_piece_digest_is_of_little_endian_ids(odd_docs):
    pieces = packing.pack_documents(odd_docs, WORDS, 2)
    ids = {(r.sequence_id, r.offset): zlib.crc32(r.ids) for r in pieces.collect()}
    assert {(r.sequence_id, r.offset): r.ids_crc32 for r in packing.piece_digests(pieces).collect()} == ids


# --- chat

HARD = ["</s>[INST] ok [/INST]", "", "\\", "\\\\[", "[\\INST]", "<s>", "<", "[", " [/INST]", "a\nb", "</s", "s>", "[ROLE] x [/ROLE]"]


def test_template_round_trip_on_hard_texts():
    t, rnd = chat.InstTemplate(), random.Random(5)
    for _ in range(3000):
        turns = [(rnd.choice(["user", "assistant", "system", "", "</s>", "to\nol"]),
                  "".join(rnd.choice(HARD) for _ in range(rnd.randint(0, 4)))) for _ in range(rnd.randint(0, 6))]
        text = t.render(turns)
        assert t.parse(text) == turns
        got = chat.Formatter(t).format(turns)
        assert got["rewritten_at"] is None
        for (role, said), s in zip(turns, got["spans"]):
            assert t.unescape(text[s["text_start"]:s["text_end"]]) == said
            assert s["loss"] == (role == "assistant")


class Rewriting(chat.InstTemplate):
    """Drops all but the last assistant text, as some templates drop earlier reasoning."""

    def render(self, turns):
        last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
        return super().render([(r, t if r != "assistant" or i == last else "") for i, (r, t) in enumerate(turns)])


class Aware(chat.InstTemplate):
    """A turn's rendering depends on the number of turns before it."""

    def render(self, turns):
        return "".join(f"#{i}" + chat.InstTemplate.render(self, [t]) for i, t in enumerate(turns))


class Wavering(chat.InstTemplate):
    """Rewrites the first turn in the prefix of 150 turns alone; the whole conversation does not show it."""

    def render(self, turns):
        return ("!" if len(turns) == 150 else "") + chat.InstTemplate.render(self, turns)


@pytest.mark.parametrize("n", [5, 200])
def test_rewriting_is_detected_at_any_length(n):
    turns = [(("user", "assistant")[i % 2], f"text {i}") for i in range(n)]
    assert chat.locate_turns(Rewriting().render, turns).spans is None
    assert chat.locate_turns(Rewriting().render, turns).rewritten_at == 3
    for template in (chat.InstTemplate(), Aware()):
        got = chat.locate_turns(template.render, turns)
        ends = [len(template.render(turns[:k])) for k in range(n + 1)]
        assert got.text == template.render(turns)
        assert got.spans == list(zip(ends, ends[1:]))
    assert chat.locate_turns(Wavering().render, turns).rewritten_at == (149 if n > 150 else None)


def test_chat_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (1, 2, "assistant", None),
            (None, 5, "assistant", "x"), (2, None, "assistant", "first"), (2, 1, "assistant", "é\\")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, formatted string, spans string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    for conv, turns in {1: [("user", "a"), ("user", "a"), ("user", "b"), ("", ""), ("assistant", "")],
                        None: [("assistant", "x")], 2: [("assistant", "first"), ("assistant", "é\\")]}.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_op3_holds_the_hard_conversation(spark):
    rows = {r.conv_id: r for r in queries.QUERIES["op3_chat_formatting"](spark, SF001).collect()}
    hard = "</s>[INST] ok [/INST]"
    assert rows[-7].loss_sha256 == hashlib.sha256(hard.encode()).hexdigest()
    assert rows[-7].turns_sha256 == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert len(rows) == table(spark, SF001, "conversations").select("conv_id").distinct().count() + 1


# --- quality

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    owner = np.array([0, 0, 0, 0, 1, 2, 2])
    u, pair = rng.normal(size=7), rng.normal(size=(2, 2))
    good, pairs = linecrf.Chains(owner).marginals(u, pair)
    want, seen = np.zeros(7), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(owner == d)
        weights, marks = [], []
        for code in range(2 ** len(at)):
            y = [(code >> i) & 1 for i in range(len(at))]
            weights.append(np.exp(sum(u[a] * v for a, v in zip(at, y)) + sum(pair[a, b] for a, b in zip(y, y[1:]))))
            marks.append(y)
        weights = np.array(weights) / sum(weights)
        for w, y in zip(weights, marks):
            want[at] += w * np.array(y)
            for a, b in zip(y, y[1:]):
                seen[a, b] += w
    assert np.allclose(good, want) and np.allclose(pairs, seen)


def test_line_features_do_not_depend_on_the_slice(odd_docs):
    import pyarrow as pa
    texts = [r.text or "" for r in odd_docs.collect()]
    x, owner, length = linecrf.line_features(*text_bytes(pa.array(texts)))
    assert np.bincount(owner, minlength=len(texts)).tolist() == [t.count("\n") + 1 for t in texts]
    for i, t in enumerate(texts):
        own, _, size = linecrf.line_features(*text_bytes(pa.array([t])))
        assert np.allclose(own, x[owner == i])
        assert size.tolist() == [len(s.encode()) for s in t.split("\n")] == length[owner == i].tolist()


def test_quality_scores(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 50)] + [(None, 1), (51, None), (5, 0), (5, 0)],
                                   "doc_id bigint, quality int")
    model = linecrf.train(odd_docs, labels, F.lit(True))
    got = linecrf.score(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5 and r.text == "same text"}) == 1
    assert linecrf.score(no_docs, model).count() == 0
    one = linecrf.train(odd_docs, labels.where("quality = 1"), F.lit(True))
    assert {r.score for r in linecrf.score(odd_docs, one).collect()} == {1.0}
    none = linecrf.train(odd_docs, labels.limit(0), F.lit(True))
    assert {r.score for r in linecrf.score(odd_docs, none).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op2_line_crf_quality"](spark, sf).where("held_out")
    right = got.join(table(spark, sf, "labels"), "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("r"))
    assert right.agg(F.avg("r")).first()[0] > 0.95


# --- URL rules

def _judge(url):
    """The contract in plain Python."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in queries.GIVEN_URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_urls_against_plain_python(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "https://a.b.example.org/en/12?x#y", "http://org", "http://org/",
            "http://xorg/", "ftp://É.COM/de/x", "http://example.org?/es/", "http://example.org#/es/", "a://b://example.org/es/",
            "http://x.example.org/en/2", "http://com/fr/", "http://com/fr", "http://example.org:80/es/", "http://a.com/de/\n/x"]
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(urls + urls)] + [(None, "http://com/fr/", "c")],
                               "page_id bigint, url string, host string")
    none = urlrules.mine_rules(spark.createDataFrame([], "items array<string>"))
    got = urlrules.judge(df, queries.GIVEN_URL_RULES, none).collect()
    assert len(got) == len(urls) * 2 + 1
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == _judge((urls + urls)[r.page_id])
    assert urlrules.judge(df.limit(0), queries.GIVEN_URL_RULES, none).count() == 0


def test_mined_rules_block_what_the_labels_show(spark):
    pages, labels = [], []
    for i in range(600):
        bad = i % 3 == 0 and i % 2 == 0
        pages.append((i, f"http://{'ads' if i % 3 == 0 else 'www'}.site{i % 5}.net/{'win' if i % 2 == 0 else 'news'}/{i}"))
        if i < 400:
            labels.append((i, 0 if bad else 1, 0))
    pages = spark.createDataFrame([*pages, (None, None)], "page_id bigint, url string")
    labels = spark.createDataFrame([*labels, (None, 0, None)], "doc_id bigint, quality int, toxic int")
    rules = urlrules.mine_rules(urlrules.labelled_transactions(pages, labels), min_confidence=0.9)
    kept = [set(r.tokens) for r in rules.collect()]
    assert {"first:ads", "path:win"} in kept
    assert not any(a < b for a in kept for b in kept)
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, [], rules).collect()}
    assert all((got[i] == "block") == (i % 6 == 0) for i in range(600)) and got[None] == "allow"
