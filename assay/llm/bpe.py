"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a piece has exactly one last token in its BPE encoding. It is
the token that ends there, found by an automaton over all tokens, and that is
compatible with the last token of the prefix it leaves; following these tokens
backwards gives the ids. Spark hands out the texts; each task encodes its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assay.llm.common import ready

#: Fixed value: the split of a byte-level BPE text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces remembered per task; others are encoded anew, with the same result.
REMEMBERED = 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the
    others from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for b in range(256):
        if b in shown:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file's text."""

    def __init__(self, definition: str):
        data = json.loads(definition)
        model = data["model"]
        self.id_of: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.letters = letters
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.bytes_of = {i: b"".join(byte_of[c] for c in token) for token, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}        # pair -> order of its merge
        self.made: dict[int, tuple[int, int, int]] = {}   # token -> (order, left, right)
        self.result: dict[tuple[int, int], int] = {}
        for order, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = self.id_of[left], self.id_of[right], self.id_of[left + right]
            self.rank[a, b], self.result[a, b] = order, c
            self.made.setdefault(c, (order, a, b))
        self.automaton = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether the text of two adjacent tokens encodes to just these two.

        Runs the merges that built both tokens backwards in time. At any moment
        the two parts that touch the border are known; had they a merge of their
        own that came before the next step of either side, BPE would have taken
        it. Equal steps go left to right.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            known = self._fits[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        never = len(self.rank) + 1
        # merge order at which the part is used up; a right part's own step loses ties
        left_used, right_used = never, never
        while True:
            cross = self.rank.get((left, right))
            if cross is not None and cross < left_used and cross <= right_used:
                return False
            left_made, right_made = self.made.get(left), self.made.get(right)
            if left_made is None and right_made is None:
                return True
            if right_made is None or (left_made is not None and left_made[0] > right_made[0]):
                left_used, left = left_made[0], left_made[2]
            else:
                right_used, right = right_made[0], right_made[1]

    def whole(self, token: int) -> bool:
        """Whether a token's own text encodes to that token alone."""
        known = self._whole.get(token)
        if known is None:
            made = self.made.get(token)
            known = made is None or (self.whole(made[1]) and self.whole(made[2])
                                     and self.result.get((made[1], made[2])) == token
                                     and self._joined(made[1], made[2]))
            self._whole[token] = known
        return known

    def _joined(self, left: int, right: int) -> bool:
        """The merge of the two is the first that crosses their border."""
        order = self.rank[left, right]
        left_used = right_used = order
        a, b = left, right
        while True:
            a_made, b_made = self.made.get(a), self.made.get(b)
            if a_made is None and b_made is None:
                return True
            if b_made is None or (a_made is not None and a_made[0] > b_made[0]):
                left_used, a = a_made[0], a_made[2]
            else:
                right_used, b = b_made[0], b_made[1]
            cross = self.rank.get((a, b))
            if cross is not None and cross < left_used and cross <= right_used:
                return False

    def encode_piece(self, piece: str) -> list[int]:
        letters = self.letters
        text = "".join([letters[b] for b in piece.encode()])
        last: list[int] = [-1] * len(text)
        size: list[int] = [0] * len(text)
        fits, whole = self.fits, self.whole
        for end, (n, token) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            before = end - n
            if whole(token) if before < 0 else (last[before] >= 0 and fits(last[before], token)):
                last[end], size[end] = token, n
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids


class Codec:
    """Encodes and decodes whole texts, remembering pieces already seen."""

    def __init__(self, definition: str):
        self.vocabulary = Vocabulary(definition)
        self.pieces = regex.compile(PIECES)
        named = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(regex.escape(s) for s in named)) if named else None
        self.seen: dict[str, list[int]] = {}

    def _plain(self, text: str, ids: list[int]) -> None:
        seen, encode = self.seen, self.vocabulary.encode_piece
        for piece in self.pieces.findall(text):
            got = seen.get(piece)
            if got is None:
                got = encode(piece)
                if len(seen) >= REMEMBERED:
                    seen.clear()
                if len(piece) <= 64:
                    seen[piece] = got
            ids.extend(got)

    def encode(self, text: str) -> list[int]:
        """Token ids; the text of a special token is that token."""
        ids: list[int] = []
        at = 0
        for found in (self.special.finditer(text) if self.special else ()):
            self._plain(text[at:found.start()], ids)
            ids.append(self.vocabulary.special[found.group()])
            at = found.end()
        self._plain(text[at:] if at else text, ids)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that form no character become U+FFFD."""
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def codec_of(definition: str) -> Codec:
    """One codec per worker process and definition."""
    key = hash(definition)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


DIGEST = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                       T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def _read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded): the token ids of every whole text and
    the text they decode to. Null text is the empty text: no ids. Repeated rows
    come back each; a null id stays null; extra columns are not read. The
    tokenizer file (a vocabulary, its size fixed) is read on the driver and
    broadcast."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_read_definition(tokenizer_path))
    ready(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(
        encode, "doc_id long, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for):
    ``bpe_encode`` with ids and decoded text hashed where they are made, so that
    the decoded text never leaves the task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_read_definition(tokenizer_path))
    ready(spark)
    schema = T.StructType([*DIGEST, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        name = [str(i) for i in range(max(codec.vocabulary.bytes_of) + 1)].__getitem__
        for batch in batches:
            counts, hashes, texts, kept = [], [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids))
                hashes.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                texts.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                if with_ids:
                    kept.append(pa.array(ids, pa.int32()))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(texts, pa.string())]
            if with_ids:
                ends = np.cumsum([0, *counts]).astype(np.int32)
                flat = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(digest, schema)
