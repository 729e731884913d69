"""Cross-tokenizer alignment: groups of tokens of two tokenizers, by an associative fragment monoid.

Tokenizer A (byte-level BPE, run by tiktoken from the file's own vocabulary) encodes a space
and the text, tokenizer B (sentencepiece) the text, before which it puts a space itself, so
both spell the same bytes.  Byte offsets at
which a token of A and a token of B end cut the text into groups.

* Texts are cut into pieces at places that both tokenizers are known to keep: a single
  space between two characters that are no white space.  Pieces are encoded on their own.
* The tokens of a piece are dealt to byte ranges of the document by their ends.  A range
  gives a fragment: an open prefix (tokens up to the first common end), closed groups
  (their number, links and texts) and an open suffix (tokens after the last common end).
* Fragments compose: a suffix and the next prefix make one group.  Composition is
  associative, so those of a long document are reduced as a tree, ``FAN`` neighbours at a
  time, by as many tasks as there are; a fragment's size is bounded by its different
  links, not by its length.  Only the digest of the groups, which is sequential, streams
  through the fragments in order, holding one at a time.
* A document of one range is its only fragment and is finished where it lies.

Linked id pairs are counted by documents, corpus-wide.  Pairs at least as frequent as a
bound that at most ``FREQUENT`` pairs reach are broadcast, as is each A id's highest count
(one number per id of the vocabulary).  What is rarer joins by id pair.

Defined cases: null and empty texts, and texts whose joined token bytes differ from the
space and the text under A or B (a text with U+2581, say), have no tokens: zeros and an
empty digest; special tokens' strings are plain text; repeated rows and ids count as
documents of their own; a run without a space is one piece, whatever its length; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from stintwise.llm.common import slices
from stintwise.session import materialize

RANGE_BYTES = 32 << 10      # byte range of a fragment
PIECE_CHARS = 8 << 10       # a piece of a longer text goes on to the next safe cut after this
FAN = 16                    # fragments that are composed in one step
FREQUENT = 1 << 18          # id pairs that may be broadcast
COUNTED = 4 << 20           # links a worker gathers before it hands on partial counts
MARK = "▁"
# Fixed value: how a byte-level tokenizer file with ``use_regex`` splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAFE = re.compile(r"(?<=[^\s▁]) (?=\S)")


class Pair:
    """The two tokenizers, with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, vocab = spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        if (spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex") or any(vocab[m] != 256 + i for i, m in enumerate(merges))):
            raise ValueError(f"{a_path}: not a byte-level BPE whose merges are in the order of their ids")
        proto = model_pb2.ModelProto()
        with open(b_path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if (not norm.add_dummy_prefix or norm.remove_extra_whitespaces or norm.precompiled_charsmap
                or proto.trainer_spec.treat_whitespace_as_suffix
                or any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)):
            raise ValueError(f"{b_path}: pieces of a text do not encode on their own under this model")
        byte_of = _byte_level()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
        # the same merges in the same order; special tokens are plain text
        self.a = tiktoken.Encoding(a_path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = sorted(ranks, key=ranks.get)
        kind = model_pb2.ModelProto.SentencePiece.BYTE
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == kind else p.piece.replace(MARK, " ").encode()
                        for p in proto.pieces]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])

    def encode(self, pieces: list[str]) -> tuple[list, list, list[bool]]:
        """Ids of A (of a space and each piece), ids of B, and whether both spell the piece's bytes."""
        a = [self.a.encode_ordinary(" " + p) for p in pieces]
        b = self.b.encode(pieces, num_threads=1)
        same = []
        for p, x, y in zip(pieces, a, b):
            want = b" " + p.encode()
            same.append(b"".join(map(self.a_bytes.__getitem__, x)) == want and b"".join(map(self.b_bytes.__getitem__, y)) == want)
        return a, b, same


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for.

    Printable bytes stand for themselves, the others follow from U+0100 on in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces_of(text: str, most: int = PIECE_CHARS) -> list[str]:
    """``text`` in pieces, without the space at each cut."""
    out, start = [], 0
    while len(text) - start > most:
        cut = _SAFE.search(text, start + most)
        if cut is None:
            break
        out.append(text[start:cut.start()])
        start = cut.end()
    return [*out, text[start:]]


# ----------------------------------------------------------------- the monoid
@dataclass
class Fragment:
    """The alignment of a byte range; ``cut`` tells whether both tokenizers end a token anywhere in it.

    Without a cut all tokens are in the prefix.  ``links`` counts the closed groups' links by
    id pair (A id << 16 | B id).
    """

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    cut: bool = False
    prefix: tuple[list, list] = field(default_factory=lambda: ([], []))
    suffix: tuple[list, list] = field(default_factory=lambda: ([], []))
    groups: int = 0
    links: dict[int, int] = field(default_factory=dict)


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges; associative, with ``Fragment()`` as neutral element."""
    out = Fragment(x.ok and y.ok, x.n_a + y.n_a, x.n_b + y.n_b, x.cut or y.cut)
    out.groups, out.links = x.groups + y.groups, _merged(x.links, y.links)
    if not x.cut:
        out.prefix = _both(x.prefix, y.prefix)
        out.suffix = y.suffix
    elif not y.cut:
        out.prefix, out.suffix = x.prefix, _both(x.suffix, y.prefix)
    else:
        out.prefix, out.suffix = x.prefix, y.suffix
        out.groups += 1
        out.links = _merged(out.links, group_links(*_both(x.suffix, y.prefix)))
    return out


def _both(x, y):
    return (x[0] + y[0], x[1] + y[1])


def _merged(x: dict[int, int], y: dict[int, int]) -> dict[int, int]:
    if len(x) < len(y):
        x, y = y, x
    out = dict(x)
    for k, v in y.items():
        out[k] = out.get(k, 0) + v
    return out


def group_links(a: list[int], b: list[int]) -> dict[int, int]:
    """Links of one group: every occurrence of an A id with every occurrence of a B id."""
    ia, ca = np.unique(np.array(a, np.int64), return_counts=True)
    ib, cb = np.unique(np.array(b, np.int64), return_counts=True)
    pairs = ((ia[:, None] << 16) | ib[None, :]).ravel()
    return dict(zip(pairs.tolist(), (ca[:, None] * cb[None, :]).ravel().tolist()))


def group_text(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


# ----------------------------------------------------------------- one slice of texts
_ID_TEXT: np.ndarray | None = None


def _id_text() -> np.ndarray:
    """Bytes of every id below 65,536 with each of the three signs that may follow, as 8-byte numbers."""
    global _ID_TEXT
    if _ID_TEXT is None:
        made = [[f"{i}{sign}".encode().ljust(8, b"\0") for i in range(1 << 16)] for sign in ",|;"]
        _ID_TEXT = np.stack([np.frombuffer(b"".join(m), np.uint64) for m in made])
    return _ID_TEXT


def _links_by_unit(ga, ia, gb, ib, unit_of_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, id pair and number of links of every different (unit, pair); groups are numbered from 0."""
    ka, ca = np.unique((ga << 16) | ia, return_counts=True)
    kb, cb = np.unique((gb << 16) | ib, return_counts=True)
    groups = len(unit_of_group)
    na, nb = np.bincount(ka >> 16, minlength=groups), np.bincount(kb >> 16, minlength=groups)
    at_b = np.cumsum(nb) - nb
    width = nb[ka >> 16]
    i = np.repeat(np.arange(len(ka)), width)
    j = at_b[ka[i] >> 16] + np.arange(len(i)) - np.repeat(np.cumsum(width) - width, width)
    unit = unit_of_group[ka[i] >> 16]
    code = (unit << 32) | ((ka[i] & 0xFFFF) << 16) | (kb[j] & 0xFFFF)
    order = np.argsort(code, kind="stable")
    code, n = code[order], (ca[i] * cb[j])[order]
    start = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
    return code[start] >> 32, code[start] & 0xFFFFFFFF, np.add.reduceat(n, start) if len(start) else n


def align_slice(tokens: list[tuple[list, list]], pair: Pair):
    """Alignment of whole units (token ids of A and B that spell the same bytes) side by side.

    Returns per unit: number of groups, group text, id pairs and their link counts.
    """
    size_a, size_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
    ia = np.array([i for t in tokens for i in t[0]], np.int64)
    ib = np.array([i for t in tokens for i in t[1]], np.int64)
    end_a, end_b = np.cumsum(pair.a_size[ia]), np.cumsum(pair.b_size[ib])     # units follow each other
    common = end_a[np.isin(end_a, end_b, assume_unique=True)]
    ga, gb = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    units = len(tokens)
    unit_a = np.repeat(np.arange(units), size_a)
    last_a = np.searchsorted(end_a, common)
    unit_of_group = unit_a[last_a]
    unit, ids, n = _links_by_unit(ga, ia, gb, ib, unit_of_group)

    # group texts: A ids, then B ids, each with the sign that follows it
    na, nb = np.bincount(ga, minlength=len(common)), np.bincount(gb, minlength=len(common))
    base = np.cumsum(na + nb) - (na + nb)
    place_a = base[ga] + np.arange(len(ga)) - (np.cumsum(na) - na)[ga]
    place_b = base[gb] + na[gb] + np.arange(len(gb)) - (np.cumsum(nb) - nb)[gb]
    sign_a, sign_b = np.zeros(len(ga), np.int64), np.zeros(len(gb), np.int64)
    sign_a[np.cumsum(na) - 1] = 1
    sign_b[np.cumsum(nb) - 1] = 2
    table = _id_text()
    wide = np.empty(len(ga) + len(gb), np.uint64)
    wide[place_a], wide[place_b] = table[sign_a, ia], table[sign_b, ib]
    raw = wide.view(np.uint8)
    used = raw != 0
    text = raw[used].tobytes()
    ends = np.concatenate([[0], np.cumsum(size_a + size_b)])
    at = np.concatenate([[0], np.cumsum(used.reshape(-1, 8).sum(axis=1))])[ends]
    edge = np.searchsorted(unit, np.arange(units + 1))
    groups = np.bincount(unit_of_group, minlength=units)
    return [(int(groups[u]), text[at[u]:max(at[u + 1] - 1, at[u])], ids[edge[u]:edge[u + 1]], n[edge[u]:edge[u + 1]])
            for u in range(units)]


def fragments_of(a: list[int], b: list[int], start: int, pair: Pair, span: int = RANGE_BYTES) -> Iterator[tuple[int, Fragment, str]]:
    """Fragments of the tokens of one piece that begins at byte ``start`` of its document, with their groups' text.

    A token belongs to the byte range in which it ends; ranges begin at multiples of ``span``.
    """
    ia, ib = np.array(a, np.int64), np.array(b, np.int64)
    end_a, end_b = start + np.cumsum(pair.a_size[ia]), start + np.cumsum(pair.b_size[ib])
    for r in np.unique(np.concatenate([(end_a - 1) // span, (end_b - 1) // span])).tolist():
        in_a, in_b = ((np.searchsorted(e, [r * span + 1, (r + 1) * span + 1])) for e in (end_a, end_b))
        xa, xb = a[in_a[0]:in_a[1]], b[in_b[0]:in_b[1]]
        ea, eb = end_a[in_a[0]:in_a[1]], end_b[in_b[0]:in_b[1]]
        common = np.intersect1d(ea, eb, assume_unique=True)
        out = Fragment(True, len(xa), len(xb), len(common) > 0)
        if not len(common):
            out.prefix = (xa, xb)
            yield r, out, ""
            continue
        first_a, first_b = (int(np.searchsorted(e, common[0])) + 1 for e in (ea, eb))
        last_a, last_b = (int(np.searchsorted(e, common[-1])) + 1 for e in (ea, eb))
        out.prefix, out.suffix = (xa[:first_a], xb[:first_b]), (xa[last_a:], xb[last_b:])
        text = ""
        if len(common) > 1:
            groups, raw, ids, n = align_slice([(xa[first_a:last_a], xb[first_b:last_b])], pair)[0]
            out.groups, out.links, text = groups, dict(zip(ids.tolist(), n.tolist())), raw.decode()
        yield r, out, text


# ----------------------------------------------------------------- Spark
_loaded: dict[tuple[str, str], Pair] = {}


def _pair(a_path: str, b_path: str) -> Pair:
    """One ``Pair`` per worker process."""
    if (a_path, b_path) not in _loaded:
        _loaded[(a_path, b_path)] = Pair(a_path, b_path)
    return _loaded[(a_path, b_path)]


_COLUMNS = "n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs binary, links binary"
_FRAGMENT = ("ok boolean, n_a bigint, n_b bigint, cut boolean, prefix_a binary, prefix_b binary, suffix_a binary, "
             "suffix_b binary, groups bigint, pairs binary, links binary")
_NONE = (0, 0, 0, "", b"", b"")


def _packed(links: dict[int, int]) -> tuple[bytes, bytes]:
    keys = sorted(links)
    return np.array(keys, np.uint32).tobytes(), np.array([links[k] for k in keys], np.int64).tobytes()


def _ids(x: list[int]) -> bytes:
    return np.array(x, np.uint16).tobytes()


def _list(raw: bytes) -> list[int]:
    return np.frombuffer(raw, np.uint16).tolist()


def _record(f: Fragment) -> tuple:
    return (f.ok, f.n_a, f.n_b, f.cut, *map(_ids, f.prefix), *map(_ids, f.suffix), f.groups, *_packed(f.links))


def _fragment(r) -> Fragment:
    links = dict(zip(np.frombuffer(r[9], np.uint32).tolist(), np.frombuffer(r[10], np.int64).tolist()))
    return Fragment(r[0], r[1], r[2], r[3], (_list(r[4]), _list(r[5])), (_list(r[6]), _list(r[7])), r[8], links)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema.names)


def _schema(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema(list(fields))


_FRAGMENT_FIELDS = [("ok", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("cut", pa.bool_()),
                    *[(c, pa.binary()) for c in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")],
                    ("groups", pa.int64()), ("pairs", pa.binary()), ("links", pa.binary())]


def _short(docs: DataFrame, paths: tuple[str, str], kind: str) -> DataFrame:
    """Documents of one byte range, finished where they lie."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        for batch in slices(batches, "_text", 1 << 20):
            texts = batch.column("_text").to_pylist()
            out = [_NONE] * len(texts)
            full = [i for i, t in enumerate(texts) if t]
            a, b, same = pair.encode([texts[i] for i in full])
            good = [k for k, s in enumerate(same) if s]
            if good:
                for k, (groups, text, ids, n) in zip(good, align_slice([(a[k], b[k]) for k in good], pair)):
                    out[full[k]] = (len(a[k]), len(b[k]), groups, hashlib.sha256(text).hexdigest(),
                                    ids.astype(np.uint32).tobytes(), n.astype(np.int64).tobytes())
            cols = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "links"])

    return docs.mapInArrow(align, f"doc_id {kind}, {_COLUMNS}")


def _long(docs: DataFrame, paths: tuple[str, str], kind: str, span: int, piece_chars: int, fan: int) -> DataFrame:
    """Longer documents: pieces to many tasks, fragments by byte range, a tree of compositions."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("_text").to_pylist()):
                pieces = pieces_of(text, piece_chars)
                starts = np.concatenate([[0], np.cumsum([1 + len(p.encode()) for p in pieces[:-1]])]).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"row": pa.array([row] * len(pieces), pa.int64()), "start": pa.array(starts),
                                                  "piece": pa.array(pieces, pa.string())})

    fields = _schema(("row", pa.int64()), ("seq", pa.int64()), ("part", pa.int64()), *_FRAGMENT_FIELDS, ("text", pa.string()))

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        for batch in slices(batches, "piece"):
            pieces = batch.column("piece").to_pylist()
            a, b, same = pair.encode(pieces)
            out = []
            for row, start, x, y, ok in zip(batch.column("row").to_pylist(), batch.column("start").to_pylist(), a, b, same):
                if not ok:
                    out.append((row, start // span, start, *_record(Fragment(ok=False)), ""))
                else:
                    out += [(row, r, start, *_record(f), text) for r, f, text in fragments_of(x, y, start, pair, span)]
            yield _table(out, fields)

    numbered = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "align-long")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = numbered.select("row", "_text").mapInArrow(cut, "row bigint, start bigint, piece string")
    parts = materialize(pieces.repartition(n, "row", "start").mapInArrow(
        fragments, f"row bigint, seq bigint, part bigint, {_FRAGMENT}, text string"), "align-fragments")

    # a range may have fragments of several pieces: (seq, part) is their order
    shape = _schema(("row", pa.int64()), ("seq", pa.int64()), ("part", pa.int64()), *_FRAGMENT_FIELDS)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbours with the same row and parent range, sorted, as one fragment."""
        now, held, out = None, None, []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("row", "up", *shape.names[3:])]):
                if r[:2] != now:
                    if now is not None:
                        out.append((*now, 0, *_record(held)))
                    now, held = r[:2], _fragment(r[2:])
                else:
                    held = compose(held, _fragment(r[2:]))
            if len(out) >= 256:
                yield _table(out, shape)
                out = []
        if now is not None:
            out.append((*now, 0, *_record(held)))
        yield _table(out, shape)

    level = parts.drop("text")
    widest = parts.agg(F.max("seq")).first()[0] or 0
    while True:
        grouped = level.withColumn("up", F.expr(f"seq div {fan}"))
        grouped = grouped.repartition("row", "up").sortWithinPartitions("row", "up", "seq", "part")
        level = materialize(grouped.mapInArrow(composed, f"row bigint, seq bigint, part bigint, {_FRAGMENT}"), "align-level")
        if widest < fan:
            break
        widest //= fan

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The digest of each document's groups, fragment by fragment."""
        row, state, first, tail, out = None, None, True, ([], []), []

        def add(text: str):
            nonlocal first
            state.update((text if first else ";" + text).encode())
            first = False

        names = ("row", "cut", "prefix_a", "prefix_b", "suffix_a", "suffix_b", "text")
        for batch in batches:
            for r, cut_, pa_, pb_, sa_, sb_, text in zip(*[batch.column(c).to_pylist() for c in names]):
                if r != row:
                    if row is not None:
                        out.append((row, state.hexdigest()))
                    row, state, first, tail = r, hashlib.sha256(), True, ([], [])
                tail = _both(tail, (_list(pa_), _list(pb_)))
                if cut_:
                    add(group_text(*tail))
                    if text:
                        add(text)
                    tail = (_list(sa_), _list(sb_))
        if row is not None:
            out.append((row, state.hexdigest()))
        yield _table(out, _schema(("row", pa.int64()), ("groups_sha256", pa.string())))

    digests = (parts.select("row", "seq", "part", "cut", "prefix_a", "prefix_b", "suffix_a", "suffix_b", "text")
               .repartition("row").sortWithinPartitions("row", "seq", "part").mapInArrow(digested, "row bigint, groups_sha256 string"))

    done = _schema(("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("whole", pa.bool_()), ("pairs", pa.binary()), ("links", pa.binary()))

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The one fragment of a document: its prefix is its first group, and nothing is left open."""
        for batch in batches:
            out = []
            for r in zip(*[batch.column(c).to_pylist() for c in ("row", *shape.names[3:])]):
                f = _fragment(r[1:])
                if f.ok and f.cut and not f.suffix[0] and not f.suffix[1]:
                    out.append((r[0], f.n_a, f.n_b, f.groups + 1, True,
                                *_packed(_merged(f.links, group_links(*f.prefix)))))
                else:
                    out.append((r[0], 0, 0, 0, False, b"", b""))
            yield _table(out, done)

    whole = level.mapInArrow(closed, "row bigint, n_a bigint, n_b bigint, n_groups bigint, whole boolean, pairs binary, links binary")
    return (numbered.select("row", F.col("_id").alias("doc_id")).join(whole, "row").join(digests, "row")
            .select("doc_id", "n_a", "n_b", "n_groups", F.when(F.col("whole"), F.col("groups_sha256")).otherwise("").alias("groups_sha256"),
                    "pairs", "links"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n``: in how many documents an id pair is linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            ids, n = np.unique(np.frombuffer(b"".join(held), np.uint32), return_counts=True)
            return pa.RecordBatch.from_pydict({"pair": pa.array(ids.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

        for batch in batches:
            for p in batch.column("pairs").to_pylist():
                held.append(p)
                size += len(p) // 4
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        yield out()

    return aligned.select("pairs").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", span: int = RANGE_BYTES,
          piece_chars: int = PIECE_CHARS, fan: int = FAN, frequent: int = FREQUENT) -> DataFrame:
    """One row per document; see the module's text.

    ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is the
    most frequent of its A id), ``count_sum`` (their pairs' counts) and ``groups_sha256``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kind = docs.schema["_id"].dataType.simpleString()
    paths, size = (a_path, b_path), F.octet_length("_text") + 1
    aligned = _short(docs.where(size <= span), paths, kind).unionByName(
        _long(docs.where(size > span), paths, kind, span, piece_chars, fan))
    aligned = materialize(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned", "zstd")

    counts = materialize(pair_counts(aligned), "pair-counts")
    best = np.zeros(1 << 16, np.int64)          # one number per A id
    for r in counts.groupBy(F.expr("shiftright(pair, 16)").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r.a] = r.n
    # the least power of two that at most ``frequent`` pairs reach; at most 63 rows
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("c")).collect()
    bound, met = 64, 0
    for r in sorted(by_size, key=lambda r: -r.e):
        met += r.c
        if met > frequent:
            break
        bound = r.e
    often = F.floor(F.log2("n")) >= bound
    known = counts.where(often).orderBy("pair").toArrow() if bound < 64 else None
    known_ids = known.column("pair").to_numpy() if known is not None else np.zeros(0, np.int64)
    known_n = known.column("n").to_numpy() if known is not None else np.zeros(0, np.int64)
    tier = spark.sparkContext.broadcast((known_ids, known_n, best))

    def lookup(batch: pa.RecordBatch):
        ids, n, top = tier.value
        pairs, links = batch.column("pairs").to_pylist(), batch.column("links").to_pylist()
        size_ = np.array([len(p) // 4 for p in pairs], np.int64)
        own = np.repeat(np.arange(len(pairs)), size_)
        pair, times = np.frombuffer(b"".join(pairs), np.uint32).astype(np.int64), np.frombuffer(b"".join(links), np.int64)
        at = np.searchsorted(ids, pair)
        at[at == len(ids)] = 0
        hit = ids[at] == pair if len(ids) else np.zeros(len(pair), bool)
        return own, pair, times, hit, np.where(hit, n[at] if len(ids) else 0, 0), top

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "pairs"):
                own, pair, times, hit, n, top = lookup(batch)
                rows = batch.num_rows
                total = lambda v: pa.array(np.bincount(own, v, minlength=rows).round().astype(np.int64))
                many = np.zeros(rows, np.int64)
                np.add.at(many, own, times * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), total(times), total(times * (hit & (n == top[pair >> 16]))), pa.array(many)],
                    ["row", "n_links", "known_best", "known_sum"])

    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "pairs"):
                own, pair, times, hit, _, top = lookup(batch)
                rare = np.flatnonzero(~hit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(own[rare])), pa.array(pair[rare]), pa.array(times[rare]),
                     pa.array(top[pair[rare] >> 16])], ["row", "pair", "times", "best"])

    packed = aligned.select("row", "pairs", "links")
    seen = packed.mapInArrow(sums, "row bigint, n_links bigint, known_best bigint, known_sum bigint")
    rare = (packed.mapInArrow(misses, "row bigint, pair bigint, times bigint, best bigint").join(counts.where(~often), "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
                                F.sum(F.col("times") * F.col("n")).alias("rare_sum")))
    return (aligned.drop("pairs", "links").join(seen, "row").join(rare, "row", "left")
            .select(F.col("doc_id").alias(key), "n_a", "n_b", "n_groups", "n_links",
                    (F.col("known_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
                    (F.col("known_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))
