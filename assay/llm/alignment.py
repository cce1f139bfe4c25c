"""Cross-tokenizer alignment: a byte-level BPE (A) against a piece BPE (B).

Both token sequences cover the same bytes. Byte places where a token of each
ends cut them into groups; the two tokens that end there are a link.

A byte range of a text gives a fragment: the tokens up to its first common end
(open prefix), the closed groups, and the tokens after its last common end (open
suffix). Fragments of neighbouring ranges compose, and the composition is
associative, so the ranges of a very long text are encoded by different tasks
and their fragments reduced as a tree, eight at a time. A text of up to
``CHUNK`` bytes is one range; many of them are handled side by side.

Two tokens that end together have one's bytes as a suffix of the other's. The
pairs that can ever be linked are therefore listed from the vocabularies alone,
at most the number of bytes in all their tokens. Corpus-wide counts are one
number for each listed pair: this bounds what is broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.bpe import PIECES, byte_letters
from assay.llm.common import ready, written

CHUNK = 1 << 16         # bytes of a range
FAN = 8                 # fragments composed at a time
TOGETHER = 1 << 19      # bytes of short texts handled side by side


class Pair:
    """Both tokenizers, their tokens' bytes and the pairs that can be linked."""

    def __init__(self, bpe_definition: str, piece_model: bytes):
        model = json.loads(bpe_definition)["model"]
        byte_of = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        ranks = {b"".join(byte_of[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte_of for c in token)}
        order = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        made = [model["vocab"][t] for t in order]
        if made != sorted(made) or 256 + len(made) > len(ranks) + 1:
            raise ValueError("token ids of the byte-level BPE must follow the order of its merges")
        # special tokens are no ranks: their strings in a text are ordinary text
        if made:
            ranks = {b: i for b, i in ranks.items() if i <= made[-1]}
        self.a = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        names_b: dict[bytes, list[int]] = {}
        for i, token in enumerate(self.bytes_b):
            names_b.setdefault(token, []).append(i)
        linked = {(i, j) for token, i in ranks.items() for k in range(len(token)) for j in names_b.get(token[k:], ())}
        linked |= {(ranks[token[k:]], j) for j, token in enumerate(self.bytes_b) for k in range(len(token)) if token[k:] in ranks}
        #: names a * n_b + b of the pairs that can be linked, ascending
        self.pairs = np.array(sorted(i * self.n_b + j for i, j in linked), np.int64)
        # a code names a token and whether it ends its side of a group
        shown = [f"{i}{end}" for i in range(self.n_a) for end in ",|"] + [f"{i}{end}" for i in range(self.n_b) for end in ",;"]
        self.shown = np.array(shown, "S")
        self.shown_size = np.array(list(map(len, shown)), np.int64)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def show(self, codes: np.ndarray) -> bytes:
        """``a1,a2|b1;`` and so on, as bytes."""
        return self.shown[codes].tobytes().translate(None, b"\0")

    def codes_a(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (2 * ids + last).astype(np.int32)

    def codes_b(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (2 * (self.n_a + ids) + last).astype(np.int32)

    def encode(self, texts: list[str]):
        """Ids of both sides for every text: space+text by A, text by B."""
        return self.a.encode_ordinary_batch([" " + t for t in texts], num_threads=1), self.b.encode(texts, num_threads=1)

    def covers(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether both sides' bytes are those of space+text."""
        whole = b" " + text.encode()
        return (b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole and b"".join(map(self.bytes_b.__getitem__, ids_b)) == whole)


_PAIRS: dict[int, Pair] = {}


def pair_of(files: tuple[str, bytes]) -> Pair:
    """One pair of tokenizers per worker process and files."""
    key = hash(files)
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*files)
    return _PAIRS[key]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _common(ends_a: np.ndarray, ends_b: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in both token lists of the tokens that end together."""
    size = int(max(ends_a[-1] if len(ends_a) else base, ends_b[-1] if len(ends_b) else base)) - base + 1
    has_a, has_b = np.zeros(size, bool), np.zeros(size, bool)
    has_a[ends_a - base] = True
    has_b[ends_b - base] = True
    return np.flatnonzero(has_b[ends_a - base]), np.flatnonzero(has_a[ends_b - base])


def _groups(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of whole groups, A's tokens of a group and then B's, and for every
    group the place after its last code. The last token of either side ends a group."""
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[at_a] = True
    last_b[at_b] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    out = np.empty(len(ids_a) + len(ids_b), np.int32)
    before_b = np.concatenate([[0], at_b + 1])      # B's tokens in earlier groups
    out[np.arange(len(ids_a)) + before_b[group_a]] = pair.codes_a(ids_a, last_a)
    out[np.arange(len(ids_b)) + (at_a + 1)[group_b]] = pair.codes_b(ids_b, last_b)
    return out, at_a + at_b + 2


EMPTY = np.empty(0, np.int64)


class Fragment:
    """Of a byte range: its tokens in an open prefix, closed groups and an open
    suffix. Without a common end (``cut`` false) all tokens are in the prefix."""

    __slots__ = ("cut", "head_a", "head_b", "body", "groups", "tail_a", "tail_b", "links")

    def __init__(self, cut, head_a, head_b, body, groups, tail_a, tail_b, links):
        self.cut, self.head_a, self.head_b, self.body, self.groups = cut, head_a, head_b, body, groups
        self.tail_a, self.tail_b, self.links = tail_a, tail_b, links

    @classmethod
    def of(cls, pair: Pair, ids_a, ends_a, ids_b, ends_b, base: int) -> Fragment:
        at_a, at_b = _common(ends_a, ends_b, base)
        if not len(at_a):
            return cls(False, ids_a, ids_b, EMPTY.astype(np.int32), 0, EMPTY, EMPTY, EMPTY)
        i, j, p, q = at_a[0] + 1, at_b[0] + 1, at_a[-1] + 1, at_b[-1] + 1
        body = _groups(pair, ids_a[i:p], ids_b[j:q], at_a[1:] - i, at_b[1:] - j)[0]
        return cls(True, ids_a[:i], ids_b[:j], body, len(at_a) - 1, ids_a[p:], ids_b[q:],
                   ids_a[at_a] * pair.n_b + ids_b[at_b])

    def then(self, pair: Pair, other: Fragment) -> Fragment:
        """This range and the next one as one; associative."""
        links = np.concatenate([self.links, other.links])
        if not self.cut:
            return Fragment(other.cut, np.concatenate([self.head_a, other.head_a]), np.concatenate([self.head_b, other.head_b]),
                            other.body, other.groups, other.tail_a, other.tail_b, links)
        tail_a, tail_b = np.concatenate([self.tail_a, other.head_a]), np.concatenate([self.tail_b, other.head_b])
        if not other.cut:
            return Fragment(True, self.head_a, self.head_b, self.body, self.groups, tail_a, tail_b, links)
        return Fragment(True, self.head_a, self.head_b, np.concatenate([self.body, closed(pair, tail_a, tail_b), other.body]),
                        self.groups + other.groups + 1, other.tail_a, other.tail_b, links)

    def whole(self, pair: Pair) -> tuple[np.ndarray, int]:
        """Codes and number of all groups of a whole text, which begins and ends
        with both sides' tokens: its prefix is a group and its suffix empty."""
        if not self.cut:
            return EMPTY, 0
        return np.concatenate([closed(pair, self.head_a, self.head_b), self.body]), self.groups + 1

    FIELDS = ("head_a", "head_b", "body", "tail_a", "tail_b", "links")

    def packed(self) -> dict:
        return {"cut": self.cut, "groups": self.groups} | {f: getattr(self, f).tobytes() for f in self.FIELDS}

    @classmethod
    def unpacked(cls, row: dict) -> Fragment:
        got = {f: np.frombuffer(row[f], np.int32 if f == "body" else np.int64) for f in cls.FIELDS}
        return cls(cut=row["cut"], groups=row["groups"], **got)


def closed(pair: Pair, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    """Codes of one group."""
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[-1] = last_b[-1] = True
    return np.concatenate([pair.codes_a(ids_a, last_a), pair.codes_b(ids_b, last_b)])


def safe_cuts(text: str) -> Iterator[int]:
    """Places of spaces where a text may be cut without a change to either side's
    tokens: both tokenizers start anew at a space between a letter, a digit or
    other visible ASCII and something that is no white space. (A parts texts
    there; no piece of B holds its space mark behind another character.)"""
    at = text.find(" ", 1)
    while 0 <= at < len(text) - 1:
        if ("!" <= text[at - 1] <= "~" or text[at - 1].isalnum()) and not text[at + 1].isspace():
            yield at
        at = text.find(" ", at + 1)


def ranges(text: str, chunk: int) -> Iterator[tuple[int, int, int, str]]:
    """(first byte, byte after the last, byte at which the context begins,
    context) of the ranges of space+text. The context reaches from the last safe
    cut at or before the range to the first at or after its end, without the
    space it begins with; where a text has none, to the text's own ends."""
    cuts, size, at = [0], 0, 0          # bytes before each safe cut, in space+text
    chars = [0]
    for cut in safe_cuts(text):
        size += len(text[at:cut].encode())
        at = cut
        # several cuts within a small part of a range serve no purpose
        if 1 + size - cuts[-1] >= chunk // 64:
            cuts.append(1 + size)
            chars.append(cut + 1)
    total = 1 + size + len(text[at:].encode())
    cuts.append(total)
    chars.append(len(text) + 1)
    edges = np.array(cuts)
    for lo in range(0, total, chunk):
        hi = min(total, lo + chunk)
        i, j = int(np.searchsorted(edges, lo, "right")) - 1, int(np.searchsorted(edges, hi, "left"))
        # the character at a cut is the space that both sides are given anyway
        yield lo, hi, cuts[i], text[chars[i]:chars[j] - 1]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


class _Rows:
    """Result rows of a batch."""

    def __init__(self, pair: Pair, with_groups: bool):
        self.pair, self.with_groups = pair, with_groups
        self.columns: list[list] = [[] for _ in range(9)]

    def add(self, doc_id, n_a=0, n_b=0, n_groups=0, text=None, names=None, times=None):
        digest = hashlib.sha256(text).hexdigest() if text is not None else ""
        none = np.empty(0, np.int32)
        values = (doc_id, n_a, n_b, n_groups, n_groups, digest, none if names is None else names,
                  none if times is None else times, (text or b"").decode())
        for column, value in zip(self.columns, values):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        c = self.columns

        def lists(rows):
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int32)))
        arrays = [*(pa.array(c[i], pa.int64()) for i in range(5)), pa.array(c[5], pa.string()), lists(c[6]), lists(c[7])]
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        if self.with_groups:
            arrays.append(pa.array(c[8], pa.string()))
            names.append("groups")
        return pa.RecordBatch.from_arrays(arrays, names=names)


def _side_by_side(pair: Pair, rows: _Rows, ids: list, texts: list[str]) -> None:
    """Short texts: their ends are common ends, so all groups are found at once."""
    made_a, made_b = pair.encode(texts)
    fine = [i for i, t in enumerate(texts) if t and pair.covers(t, made_a[i], made_b[i])]
    made_a, made_b = [made_a[i] for i in fine], [made_b[i] for i in fine]
    ids_a, ids_b = _flat(made_a), _flat(made_b)
    at_a, at_b = _common(np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b]), 0)
    codes, after = _groups(pair, ids_a, ids_b, at_a, at_b)
    shown = pair.show(codes)
    ends = np.cumsum(pair.shown_size[codes])
    # groups up to each text's end
    upto = np.searchsorted(at_a, np.cumsum(list(map(len, made_a))) - 1, "left") + 1 if fine else EMPTY
    links = ids_a[at_a] * pair.n_b + ids_b[at_b]
    owner = np.repeat(np.arange(len(fine)), np.diff(upto, prepend=0))
    base = pair.n_a * pair.n_b
    named, times = np.unique(owner * base + links, return_counts=True)
    names = np.searchsorted(pair.pairs, named % base).astype(np.int32)
    starts = np.searchsorted(named, np.arange(len(fine) + 1) * base)
    times = times.astype(np.int32)
    done, g0, s0 = dict(zip(fine, range(len(fine)))), 0, 0
    for i, doc_id in enumerate(ids):
        k = done.get(i)
        if k is None:
            rows.add(doc_id)
            continue
        g1 = int(upto[k])
        s1 = int(ends[after[g1 - 1] - 1])
        rows.add(doc_id, len(made_a[k]), len(made_b[k]), g1 - g0, shown[s0:s1 - 1], names[starts[k]:starts[k + 1]], times[starts[k]:starts[k + 1]])
        g0, s0 = g1, s1


FRAGMENT = ("cut boolean, groups long, head_a binary, head_b binary, body binary, tail_a binary, tail_b binary, links binary, "
            "fine boolean, n_a long, n_b long")
SHUFFLED = [f.split()[0] for f in FRAGMENT.split(", ")]


def _as_batch(rows: list[dict], keys: list[str]) -> pa.RecordBatch:
    kinds = {"cut": pa.bool_(), "fine": pa.bool_(), **dict.fromkeys(("groups", "n_a", "n_b", *keys), pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in [*keys, *SHUFFLED]],
                                      names=[*keys, *SHUFFLED])


def _long_fragments(longs: DataFrame, files, chunk: int, fan: int) -> DataFrame:
    """(row, doc_id, the whole text's fragment) of long texts: ranges dealt out to
    tasks, encoded there, and composed level by level."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                for seq, (lo, hi, begins, context) in enumerate(ranges(text.as_py(), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row.as_py()]), pa.array([doc_id.as_py()], pa.int64()), pa.array([seq], pa.int64()), pa.array([lo], pa.int64()),
                         pa.array([hi], pa.int64()), pa.array([begins], pa.int64()), pa.array([context], pa.string())],
                        names=["row", "doc_id", "seq", "lo", "hi", "begins", "context"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(files.value)
        for batch in batches:
            for r in batch.to_pylist():
                (ids_a,), (ids_b,) = pair.encode([r["context"]])
                fine = pair.covers(r["context"], ids_a, ids_b)
                sides = []
                for ids, sizes in ((ids_a, pair.size_a), (ids_b, pair.size_b)):
                    ids = np.array(ids if fine else [], np.int64)
                    ends = r["begins"] + np.cumsum(sizes[ids])
                    own = (ends > r["lo"]) & (ends <= r["hi"])
                    sides += [ids[own], ends[own]]
                got = Fragment.of(pair, *sides, r["lo"])
                yield _as_batch([got.packed() | {"fine": fine, "n_a": len(sides[0]), "n_b": len(sides[2])} | {k: r[k] for k in ("row", "doc_id", "seq")}],
                                ["row", "doc_id", "seq"])

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(files.value)
        for batch in batches:
            for r in batch.to_pylist():
                total, out = None, {"fine": True, "n_a": 0, "n_b": 0}
                for part in r["parts"]:
                    own = Fragment.unpacked(part)
                    total = own if total is None else total.then(pair, own)
                    out = {"fine": out["fine"] and part["fine"], "n_a": out["n_a"] + part["n_a"], "n_b": out["n_b"] + part["n_b"]}
                yield _as_batch([total.packed() | out | {k: r[k] for k in ("row", "doc_id", "seq")}], ["row", "doc_id", "seq"])

    keys = "row long, doc_id long, seq long, "
    cutted = written(longs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
                     .mapInArrow(cut, keys + "lo long, hi long, begins long, context string"), "align-ranges")
    count = (cutted.agg(F.max("seq")).first()[0] or 0) + 1
    level = cutted.repartition("row", "seq").mapInArrow(encode, keys + FRAGMENT)
    while count > 1:
        level = (level.groupBy("row", F.expr(f"seq div {fan}").alias("seq"))
                 .agg(F.min("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("seq", *SHUFFLED))).alias("parts"))
                 .mapInArrow(compose, keys + FRAGMENT))
        count = -(-count // fan)
    return level


def aligned(docs: DataFrame, files, chunk: int, fan: int, with_groups: bool) -> DataFrame:
    """Counts and digest of every text, and how often each listed pair is linked in it."""
    schema = ALIGNED + ", groups string" * with_groups

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(files.value)
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= TOGETHER:
                    rows = _Rows(pair, with_groups)
                    _side_by_side(pair, rows, ids, texts)
                    yield rows.batch()
                    ids, texts, held = [], [], 0
            if ids:
                rows = _Rows(pair, with_groups)
                _side_by_side(pair, rows, ids, texts)
                yield rows.batch()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(files.value)
        for batch in batches:
            for r in batch.to_pylist():
                rows = _Rows(pair, with_groups)
                if r["fine"]:
                    got = Fragment.unpacked(r)
                    codes, groups = got.whole(pair)
                    named, times = np.unique(got.links, return_counts=True)
                    rows.add(r["doc_id"], r["n_a"], r["n_b"], groups, pair.show(codes)[:-1],
                             np.searchsorted(pair.pairs, named).astype(np.int32), times.astype(np.int32))
                else:
                    rows.add(r["doc_id"])
                yield rows.batch()

    is_long = F.coalesce(F.octet_length("text") >= chunk, F.lit(False))
    brief = docs.where(~is_long).mapInArrow(short, schema)
    return brief.unionByName(_long_fragments(docs.where(is_long), files, chunk, fan).mapInArrow(finish, schema))


def align_tokenizers(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk: int = CHUNK, fan: int = FAN, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and
    the groups themselves, ``a1,a2|b1;a3|b2,b3``, if asked for) for every row of
    ``docs``.

    A encodes space+text with the byte-level BPE file, B the text with the piece
    model, which adds the space; special tokens' strings are ordinary text. A link
    joins the two tokens that end at a common end. An id pair's count is how many
    links of the corpus hold it; ``n_best`` counts a text's links whose pair has
    its B id's highest count (ties included), ``count_sum`` adds up the counts.

    Null or empty text, or a text that one side does not give back byte by byte:
    zeros and an empty digest. Repeated rows come back each and count each; a null
    id stays null. Empty table: no rows. Extra columns are not read. Ranges whose
    surroundings hold no safe cut (texts without spaces) are encoded with all the
    text around them. The tokenizer files (fixed in size) are read on the driver
    and broadcast.
    """
    spark = docs.sparkSession
    ready(spark)
    with open(bpe_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        files = spark.sparkContext.broadcast((f.read(), g.read()))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = written(aligned(plain, files, chunk, fan, with_groups), "aligned")
    pair = pair_of(files.value)
    size = len(pair.pairs)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        met = np.flatnonzero(total)
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["pair", "n"])

    # at most ``size`` rows, a number fixed by the vocabularies
    counted = found.select("pairs", "times").mapInArrow(add_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    most = np.zeros(pair.n_b, np.int64)
    np.maximum.at(most, pair.pairs % pair.n_b, counts)
    looked_up = spark.sparkContext.broadcast((counts, (counts == most[pair.pairs % pair.n_b]).astype(np.int64)))
    carried = ["groups"] * with_groups

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = looked_up.value
        for batch in batches:
            names, times = (batch.column(c) for c in ("pairs", "times"))
            flat, times = names.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), names.value_lengths().to_numpy(zero_copy_only=False))
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, owner, times * best[flat])
            np.add.at(count_sum, owner, times * counts[flat])
            kept = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(count_sum), *(batch.column(c) for c in ("groups_sha256", *carried))],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *carried])

    return found.mapInArrow(look_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                     "groups_sha256 string" + ", groups string" * with_groups)
