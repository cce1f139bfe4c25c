"""Substring dedup, tokenizer alignment and the conversation trie against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import alignment, conversation_trie, count_min, queries, substring_dedup
from assay.llm.common import table

SMALL, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
FILES = (queries.tokenizer_file(), queries.tokenizer_file("piece_bpe_32k.model"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- substring dedup

def brute_substrings(rows):
    """(doc_id, n_words, n_removed, sha) of every row, sorted; null ids come first."""
    order = lambda i: (i is not None, i)
    listed = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in listed:
        for p in range(len(w) - 49):
            key = tuple(w[p:p + 50])
            least[key] = min(least.get(key, order(i)), order(i))
    out = []
    for i, w in listed:
        gone = {q for p in range(len(w) - 49) if least[tuple(w[p:p + 50])] < order(i) for q in range(p, p + 50)}
        kept = [x for q, x in enumerate(w) if q not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def substrings(d, **more):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(d, **more).collect()), key=str)


def test_substrings_equal_brute_force(spark):
    rnd = random.Random(7)
    fresh = lambda n: [f"{rnd.choice('abcde')}{rnd.randrange(3000)}" for _ in range(n)]
    passages = [fresh(rnd.choice((49, 50, 51, 60, 130, 400))) for _ in range(12)]
    rows = []
    for i in range(160):
        text = fresh(rnd.randrange(90))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            cut = rnd.randrange(len(p) // 3 + 1)
            text += p[cut:] if rnd.random() < 0.5 else p[:len(p) - cut]
            text += fresh(rnd.randrange(40))
        rows.append((i, rnd.choice((" ", "\n", "\t ")).join(text)))
    rows += [(200 + i, rows[5 * i][1]) for i in range(20)]                       # copies
    rows += [(300 + i, "same " * n) for i, n in enumerate((10, 49, 50, 51, 200))]    # ties within a text
    rows += [(400, None), (401, ""), (402, " \n"), (None, rows[3][1]), (None, None), (403, rows[3][1]), (403, rows[3][1]),
             (404, " ".join(passages[4]) + " " + " ".join(passages[4])), (404, " ".join(passages[5])), (405, "a b " * 30)]
    rnd.shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("mark", F.lit("clash")).withColumn("d", F.lit(1))
    want = brute_substrings(rows)
    assert sum(r[2] for r in want) > 3000
    assert substrings(d) == want
    assert substrings(d.limit(0)) == []
    texts = {(r.doc_id, r.kept_sha256): r.text for r in substring_dedup.substring_dedup(d, with_text=True).collect()}
    assert all(sha(t) == h for (_, h), t in texts.items())


def test_substrings_of_a_long_text(spark, monkeypatch):
    """A text handled in parts, beside a copy of its middle; and a saturated sketch."""
    long = [f"w{i}" for i in range(30_000)]
    rows = [(1, " ".join(long)), (2, "x " + " ".join(long[9_000:21_000]) + " y"), (3, " ".join(f"v{i}" for i in range(400)))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, 30_000, 0, sha(rows[0][1])), (2, 12_002, 12_000, sha("x y")), (3, 400, 0, sha(rows[2][1]))]
    assert substrings(d) == want
    pieces = list(substring_dedup._pieces(spark.createDataFrame(rows, "doc_id long, text string").toArrow().to_batches()[0]))
    assert len(pieces) >= 1
    monkeypatch.setattr(count_min, "cells_for", lambda n: 4)
    assert substrings(d) == want


def test_parts_of_a_long_text_hold_each_window_once(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(substring_dedup, "PIECE", 120)
    words = [f"w{i}" for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words), " ".join(words[:60]), "few"])], names=["text"])
    at = collections.Counter()
    for hashes, rows, places in substring_dedup._pieces(batch):
        marks, first, lengths, window = substring_dedup._runs(hashes, rows, places)
        for f, n in zip(first, lengths):
            at.update((int(rows[f]), int(places[f]) + k) for k in range(n))
    assert at == collections.Counter({**{(0, p): 1 for p in range(951)}, **{(1, p): 1 for p in range(11)}})


def test_sketch_never_underestimates(spark):
    rnd = np.random.default_rng(1)
    keys = rnd.integers(0, 400, 1500)
    d = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(4)
    width = 256
    cells = d.select(*[count_min.cell(r, width, "key").alias(f"c{r}") for r in range(count_min.DEPTH)])
    bits = count_min.repeated_cells(cells.select(F.explode(F.array("c0", "c1")).alias("cell")), width)
    both = np.array(d.select("key", *[count_min.cell(r, width, "key") for r in range(count_min.DEPTH)]).collect())
    found = count_min.is_set(bits, both[:, 1]) & count_min.is_set(bits, both[:, 2])
    seen = collections.Counter(both[:, 0].tolist())
    assert all(f for k, f in zip(both[:, 0].tolist(), found) if seen[k] > 1)
    assert not found.all() or len(seen) > 200


# ---------------------------------------------------------------- tokenizer alignment

def brute_alignment(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from assay.llm.bpe import byte_letters
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=FILES[1])
    byte = {c: i for i, c in enumerate(byte_letters())}
    seen, out = collections.Counter(), []
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        parts = [[bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]],
                 [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
        if not text or any(b"".join(p) != whole for p in parts):
            out.append((doc_id, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        groups, held = [], ([], [])
        common = set(ends[0]) & set(ends[1])
        for end in sorted(common):
            groups.append(tuple([i for i, e in zip(ids[s], ends[s]) if e <= end and e > (groups[-1][2] if groups else 0)] for s in (0, 1)) + (end,))
        seen.update((g[0][-1], g[1][-1]) for g in groups)
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc_id, len(ids[0]), len(ids[1]), [(g[0][-1], g[1][-1]) for g in groups], shown))
    most = collections.Counter()
    for (_, y), n in seen.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, len(links), len(links), sum(seen[x] == most[x[1]] for x in links), sum(seen[x] for x in links), sha(s) if s else "", s)
                   for i, na, nb, links, s in out), key=str)


ODD_TEXTS = ["", " ", "  ", "a", " a", "a ", "a  ", "\n", "\n\n x", "x\r\ny\t z", "<s>", "</s><unk> <|endoftext|>", "▁", "a▁b", "文字化け の テキスト 🙂",
             "it's we'll 12 345", "  many   spaces    here ", "\x00\x01\x7f", "é́ ü", "ａｂ", "  x   y", "﻿bom", "😀😃 👩‍👩‍👧", "a" * 300, "the the the"]


def alignments(d, **more):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups)
                   for r in alignment.align_tokenizers(d, *FILES, with_groups=True, **more).collect()), key=str)


@pytest.mark.parametrize("chunk, fan", [(1 << 16, 8), (40, 3), (7, 2)])
def test_alignment_equals_brute_force(spark, chunk, fan):
    """The same result whether texts are handled whole or in byte ranges of any size."""
    rnd = random.Random(11)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100, None), (None, "no id"), (5, "twice the same id"), (5, "twice the same id")]
    for i in range(60):
        rows.append((200 + i, "".join(rnd.choice(ODD_TEXTS + [" word", " in", "ung", ".", " 7"]) for _ in range(rnd.randrange(12))).replace("▁", "_")))
    rows += [(r.doc_id + 1000, r.text) for r in table(spark, SMALL, "documents").limit(25 if chunk > 1000 else 4).collect()]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("seq", F.lit("clash")).withColumn("pairs", F.lit(1))
    assert alignments(d, chunk=chunk, fan=fan) == brute_alignment(rows)
    assert alignments(d.limit(0), chunk=chunk, fan=fan) == []


def test_fragments_compose_associatively():
    pair = alignment.Pair(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())
    text = "Ungewöhnliche Zeichenfolgen wie naïve façades, 12345 and antidisestablishmentarianism"
    (a,), (b,) = pair.encode([text])
    a, b = np.array(a), np.array(b)
    ea, eb = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    def part(lo, hi):
        x, y = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
        return alignment.Fragment.of(pair, a[x], ea[x], b[y], eb[y], lo)
    parts = [part(lo, lo + 3) for lo in range(0, int(ea[-1]), 3)]
    def fold(way):
        left = parts[:]
        while len(left) > 1:
            k = way(len(left))
            left[k:k + 2] = [left[k].then(pair, left[k + 1])]
        codes, groups = left[0].whole(pair)
        return pair.show(codes), groups, sorted(left[0].links.tolist())
    rnd = random.Random(1)
    ways = [lambda n: 0, lambda n: n - 2, lambda n: rnd.randrange(n - 1)]
    whole = part(0, int(ea[-1]))
    codes, groups = whole.whole(pair)
    assert all(fold(w) == (pair.show(codes), groups, sorted(whole.links.tolist())) for w in ways)
    # what is broadcast is bounded by the vocabularies
    assert len(pair.pairs) <= sum(pair.size_a) + sum(pair.size_b) * 2


# ---------------------------------------------------------------- conversation trie

def brute_trie(rows):
    """Nodes of the rebuilt conversations, from their definition."""
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    original = {c: [x[1:] for x in sorted(t)] for c, t in turns.items()}
    made = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        made[c] = tuple(original.get(base, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   sha(",".join(map(str, sorted(c for c in m if made[c] == p))))) for p, m in members.items())


def trie(d):
    return sorted(tuple(r) for r in conversation_trie.conversation_trie(d).select(*conversation_trie.NODE).collect())


@pytest.mark.parametrize("cells", [None, 16])
def test_trie_equals_brute_force(spark, monkeypatch, cells):
    """Also with a sketch so small that it screens nothing."""
    if cells:
        monkeypatch.setattr(count_min, "cells_for", lambda n: cells)
    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 130), *range(300, 330), -205, -200, 777, 1_000_003]:
        own = rnd.choice((0, 1, 2, 5, 6, 7, 9))
        stem = rnd.choice("pqr")
        for turn in range(max(1, own)):
            rows.append((c, turn, rnd.choice(("user", "assistant", None)) if rnd.random() < .2 else ("user", "assistant")[turn % 2],
                         f"{stem}{turn}é" if rnd.random() < .85 else rnd.choice((None, "", "other", "🙂"))))
    long = [(c, t, "user", f"turn {t}") for c in (401, 402, 455) for t in range(70 + c % 3)]
    rows += long + [(500, None, "user", "x"), (500, None, None, None), (500, 3, "user", "x"), (500, 3, "user", "x"), (500, 3, "bot", "y"), (None, 1, "user", "lost")]
    rnd.shuffle(rows)
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).withColumn("depth", F.lit("clash")).withColumn("chunk", F.lit(1))
    assert trie(d) == brute_trie(rows)
    assert trie(d.limit(0)) == []


def test_trie_of_one_long_conversation(spark):
    """A conversation over many partitions, and an exact copy of it."""
    rows = [(c, t, "user", f"turn {t}") for c in (9_901, 9_902) for t in range(3_000)] + [(c, 0, "user", "turn 0") for c in range(9_903, 9_950)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie(d)
    want = brute_trie([r for r in rows if r[1] < 40])
    assert [r for r in got if r[1] <= 20 and r[0] != 9_901] == [r for r in want if r[1] <= 20 and r[0] != 9_901]
    assert len(got) >= 3_001 and max(r[1] for r in got) >= 2_995
