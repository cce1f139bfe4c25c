"""Operators against brute force on a small table, and on awkward rows."""

import collections
import hashlib
import heapq
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm import (bpe, embedding_dedup, jaccard_join, language_id, line_dedup, lm_scoring, mixing, quality_qda,
                       quality_rules, queries, sharding)
from assay.llm.common import table

SMALL, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Names that operators use inside.
CLASHING = ["row", "n", "node", "th", "lines", "block", "size", "grp", "w", "hashes", "_chunk", "key", "x"]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, a very long text, ties, a repeated row and clashing columns."""
    three = "one two three\nfour five six\nseven eight nine\n"
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, three + "alpha beta gamma delta", "en", "a"),
            (5, three + "other end of it", "en", "a"), (5, three + "other end of it", "en", "a"), (None, "no id here at all", "de", "b"),
            (7, long, "en", "b"), (8, long + " tail", None, None), (9, "日本語 の テキスト 🙂", "ja", "b"), (10, "1 2 3", "en", "a")]
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.length("text").cast("long"))
    for c in CLASHING:
        out = out.withColumn(c, F.lit("clash"))
    return out.cache()


@pytest.fixture(scope="module")
def marks(spark):
    return table(spark, SMALL, "labels").cache()


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text):
    return (text or "").encode().lower().split()


OPERATORS = {
    "line_dedup": lambda d, m: line_dedup.line_dedup(d),
    "mixing": lambda d, m: mixing.mix_sources(d),
    "bpe": lambda d, m: bpe.bpe_encode(d, queries.tokenizer_file()),
    "digests": lambda d, m: bpe.bpe_digests(d, queries.tokenizer_file()),
    "quality_rules": quality_rules.quality_rules,
    "jaccard": lambda d, m: jaccard_join.jaccard_components(d),
    "sharding": lambda d, m: sharding.shard_groups(d),
    "lm": lambda d, m: lm_scoring.lm_scores(d, steps=2),
    "qda": quality_qda.quality_scores,
    "language": lambda d, m: language_id.identify(d, language_id.train(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_empty_tables(spark, odd, marks, name):
    got = OPERATORS[name](odd, marks)
    n = len(got.collect())
    # mixing draws by budget and takes a repeated row once
    assert n > 0 if name == "mixing" else n == odd.count()
    assert OPERATORS[name](odd.limit(0), marks.limit(0)).collect() == []


def test_line_dedup_keeps_the_first_occurrence(odd):
    got = {(r.doc_id, r.text): r.n_removed for r in line_dedup.line_dedup(odd).collect()}
    assert (4, "one two three\nfour five six\nseven eight nine\nalpha beta gamma delta") in got
    assert got[(5, "other end of it")] == 3
    assert got[(1, None)] == 0


def test_line_dedup_merges_overlapping_windows(spark):
    text = "\n".join("abcde")
    d = spark.createDataFrame([(1, text), (2, "x\n" + text + "\ny"), (3, "\n".join("zzzzz"))], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.line_dedup(d).collect()}
    assert got[1] == (text, 0) and got[2] == ("x\ny", 5) and got[3] == ("z", 4)


def test_mixing_fills_each_part(spark):
    d = table(spark, SF01, "documents")
    got = mixing.mix_sources(d, max_repeats=3.0).toPandas()
    sizes = {r.doc_id: max(len(words(r.text)), 1) for r in d.collect()}
    total = sum(sizes.values())
    for _, g in got.groupby("source"):
        part = math.floor(g["weight"].iloc[0] * total)
        assert g.start.max() < part <= (g.start + g.n_tokens).max()
    assert abs(got.groupby("source")["weight"].first().sum() - 1) < 1e-9
    for _, g in got.groupby("block"):
        assert sorted(g.slot) == list(range(len(g)))


def test_mixing_flattens_skewed_shares(spark):
    rows = [(i, "t " * 10, "big" if i < 900 else f"s{i % 5}") for i in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    w = {r.source: r.weight for r in mixing.mix_sources(d).collect()}
    assert w["big"] < 0.9 and w["s1"] > 0.02 and w["s1"] * 10_000 <= 4 * 200 + 1


def test_bpe_equals_the_tokenizers_library(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_file())
    codec = bpe.Codec(open(queries.tokenizer_file(), encoding="utf-8").read())
    rnd = random.Random(3)
    parts = ["a", "the", "  ", "\n", "é", "文", "🙂", "'s", " 12", "!!!", "aaaa", "ing", "<|endoftext|>", "%%%", "\r\n", "\x85", "ouou", " x"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        ids = tok.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids and codec.decode(ids) == tok.decode(ids, skip_special_tokens=False)
    long = "abc" * 20_000 + "a" * 9_000
    assert codec.encode(long) == tok.encode(long, add_special_tokens=False).ids
    for r in bpe.bpe_digests(docs, queries.tokenizer_file()).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_quality_base_counts(docs, odd, marks):
    both = docs.select("doc_id", "text").union(odd.select("doc_id", "text").where("doc_id is not null and doc_id <> 5")
                                               .withColumn("doc_id", F.col("doc_id") + 10_000))
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in quality_rules.quality_rules(both, marks).collect():
        text, w = texts[r.doc_id] or "", words(texts[r.doc_id])
        runs = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r.base_failed and r.kept)


def test_quality_ratio_counts_every_trusted_text(spark):
    """All texts trusted: both sides are alike, however many ids there are."""
    d = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.sha1(F.col("id").cast("string")), F.lit("and so on")).alias("text"))
    m = d.select("doc_id", F.lit(1).alias("quality"))
    top = lambda x: x.agg(F.max(F.abs("llr"))).first()[0]
    assert top(quality_rules.quality_rules(d, m)) < 1e-12


def test_quality_ratio_separates_labels(spark):
    d, m = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 2
    got = quality_rules.quality_rules(d, m.where(fold == 0)).join(m.where(fold == 1), "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.2


def test_filtered_results_grow_with_the_text(spark):
    """A filter on the result must not split a text once per word or line."""
    def took(n, run):
        text = "\n".join(f"w{i} x{i} y{i}" for i in range(n)) + "\n" + "\n".join(f"w{i} x{i} y{i}" for i in range(9))
        d = spark.createDataFrame([(1, text), (2, text + " tail")], "doc_id long, text string")
        t = time.time()
        assert run(d).collect() is not None
        return time.time() - t
    m = table(spark, SMALL, "labels")
    for run in (lambda d: quality_rules.quality_rules(d, m).where("kept").select("doc_id"),
                lambda d: line_dedup.line_dedup(d).where("text <> ''").select("doc_id")):
        took(500, run)
        short, long = took(2_000, run), took(20_000, run)
        assert long < 10 * short + 10, (short, long)


def test_language_rejection_is_calibrated(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train(docs, accept=0.9)
    wide = language_id.train(docs, accept=1.0)
    assert (model.slack <= wide.slack).all() and (model.slack < wide.slack).any()
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "qxzj vkqw zzxq jqkv wqxz kjvq " * 20)], "doc_id long, text string"))
    got = {r.doc_id: r.rejected for r in language_id.identify(d, wide).collect()}
    assert got.pop(-1) and sum(got.values()) <= 0.02 * len(got)


def test_fine_sketches_tell_long_sets_apart():
    rng = np.random.default_rng(5)
    for n in (700, 3000, 9000):
        a, b = (np.unique(rng.integers(0, 2 ** 64 - 1, n, np.uint64)) for _ in range(2))
        near = np.concatenate([a[n // 20:], b[:n // 20]])
        fine = [jaccard_join.fine_sketch(x).view(np.uint64) for x in (a, b, near)]
        assert len(fine[0]) * 64 >= n
        for x, f in zip((a, b, near), fine):
            cut = jaccard_join.folded(f[None, :], jaccard_join.BITS // 64)[0]
            assert (cut == jaccard_join.sketch(x).view(np.uint64)).all()
        apart, close = (int(np.bitwise_count(fine[0] ^ f).sum()) for f in fine[1:])
        assert close <= len(np.setxor1d(a, near)) and apart * 180 > 2 * n * 20
    # beyond the most bits a sketch only says less
    assert len(jaccard_join.fine_sketch(np.arange(50_000, dtype=np.uint64))) * 64 == jaccard_join.FINE


def test_jaccard_two_texts_with_one_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail")]
    for order in (rows, rows[::-1]):
        d = spark.createDataFrame(order, "doc_id long, text string")
        assert {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(d).collect()} == {(1, 1), (2, 1), (3, 1)}


def brute_components(rows, width=4, percent=85):
    sets = {}
    for i, text in rows:
        w = lower(text)
        sets[i] = (frozenset(tuple(w[a:a + width]) for a in range(len(w) - width + 1)) if len(w) >= width
                   else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                c = len(a & b)
                if 100 * c >= percent * (len(a) + len(b) - c):
                    x, y = find(i), find(j)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_groups_equal_brute_force(spark, docs, width, percent):
    rnd = random.Random(5)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    for k in range(150):      # near copies at, above and below the threshold, in chains
        copy = base[:]
        for _ in range(rnd.randrange(6)):
            copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(50)}"
        rows.append((1000 + k, " ".join(copy)))
    for k in range(60):       # small sets
        rows.append((2000 + k, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 12)))))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = jaccard_join.jaccard_components(d, width=width, percent=percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_components(rows, width, percent)


def test_parts_of_partenum_lose_no_similar_pair():
    rnd = np.random.default_rng(2)
    for size in (1, 2, 6, 7, 12, 40, 130, 400, 900):
        for _ in range(20):
            a = rnd.integers(0, 2 ** 63, size).astype(np.uint64)
            # as different as the threshold allows
            out = size * 15 // 185 if size > 6 else 0
            b = np.unique(np.concatenate([a[out:], rnd.integers(0, 2 ** 63, out).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert np.intersect1d(jaccard_join.signatures(a), jaccard_join.signatures(b)).size


def test_unlike_sets_share_no_signatures_by_the_dozen():
    """Subsets of cells without a feature are alike in all sets: buckets of them grew
    with the table, and the pairs in them with its square."""
    rnd = np.random.default_rng(4)
    sets = [rnd.integers(0, 2 ** 63, size).astype(np.uint64) for size in rnd.integers(60, 1200, 800)]
    shared = collections.Counter(x for grams in sets for x in set(jaccard_join.signatures(grams, 80).tolist()))
    assert max(shared.values()) < 12, shared.most_common(5)
    # thin sets too agree with their like: each has lost and won as much as 80 % allows
    for size in range(60, 1200, 7):
        a = np.unique(rnd.integers(0, 2 ** 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 9:], rnd.integers(0, 2 ** 63, size // 9).astype(np.uint64)]))
        assert 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        assert np.intersect1d(jaccard_join.signatures(a, 80), jaccard_join.signatures(b, 80)).size


def test_sharding_is_longest_first(spark):
    d = table(spark, SF01, "documents")
    got = sharding.shard_groups(d).join(d, "doc_id").toPandas()
    groups = collections.Counter()
    for r in got.itertuples():
        assert r.size == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        groups[r.text] += r.size
    loads = [0] * 8
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(loads, loads[0] + size)
    assert sorted(got.groupby("shard")["size"].sum()) == sorted(loads)
    assert (got.groupby("text").shard.nunique() == 1).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_lm_base_and_model(spark):
    d = table(spark, SF01, "documents")
    texts = {r.doc_id: lower(r.text) + [None] for r in d.collect()}
    seen = collections.Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(seen.values()), len(seen)
    gain = 0.0
    for r in lm_scoring.lm_scores(d).collect():
        t = texts[r.doc_id]
        base = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(seen[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0


def test_lm_classes_sum_to_one():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(lm_scoring.SLOTS + 1, lm_scoring.CLASSES)).astype(np.float32)
    p = np.exp(lm_scoring.log_softmax(w, np.arange(500)))
    assert np.allclose(p.sum(1), 1, atol=1e-5)


def test_quality_classifier_on_held_out_labels(spark):
    m = table(spark, SF01, "labels")
    got = quality_qda.quality_scores(table(spark, SF01, "documents"), m).join(m, "doc_id").where("held_out").toPandas()
    assert ((got.score >= 0) & (got.score <= 1)).all()
    assert (got.predicted == got.quality).mean() > 0.95


def test_language_on_held_out_rows(spark):
    d = table(spark, SF01, "documents")
    got = queries.op10_language_id(spark, SF01).join(d.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97


def test_language_without_letters_is_und(odd):
    got = {r.doc_id: r for r in language_id.identify(odd, language_id.train(odd)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 10))
    assert got[9].lang_pred == "ja"


def test_kneser_ney_is_a_distribution():
    code = language_id.codes("the cat sat on the mat that the rat had")
    g, n = np.unique(language_id.grams(code), return_counts=True)
    kn = language_id.KneserNey(["en"], np.zeros(len(g), np.int64), g, n)
    history = int(g[0]) >> 16
    every = np.array([(history << 16) | c for c in range(65536)], np.uint64)
    assert np.exp(kn.log_probs(every).astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_language_tables_equal_the_model_in_arrays(spark, docs):
    marked = [(r.lang, r.text) for r in docs.collect() if r.text and r.lang]
    langs = sorted({x for x, _ in marked})
    seen = collections.Counter((langs.index(x), g) for x, t in marked for g in language_id.grams(language_id.codes(t)).tolist())
    pairs = sorted(seen)
    kn = language_id.KneserNey(langs, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs], np.uint64),
                               np.array([seen[p] for p in pairs]))
    got = language_id.train(docs).local()
    assert got.langs == langs
    for o in range(1, language_id.ORDER + 1):
        assert (got.keys[o] == kn.keys[o]).all() and abs(got.logp[o] - kn.logp[o]).max() <= 1
        assert (got.left[o - 1] == kn.left[o - 1]).all() and abs(got.rest[o - 1] - kn.rest[o - 1]).max() <= 1


def test_language_joined_equals_broadcast(spark, odd, docs):
    d = docs.select("doc_id", "text", "lang")
    d = d.union(odd.select("doc_id", "text", "lang")).union(d.limit(5))
    model = language_id.train(d)
    held, joined = (sorted(language_id.identify(d, model, broadcast=b).collect(), key=str) for b in (1 << 40, 0))
    assert held == joined


def test_language_small_beside_a_large_one(spark):
    """More than two million frequent sequences of one language leave the other's in."""
    rng = np.random.default_rng(5)
    big = ["".join(map(chr, rng.integers(0x4E00, 0x9FA0, 100_000))) for _ in range(21)]
    rows = [(i, t, "zh") for i, t in enumerate(big * 2)] + [(100, "quick brown foxes jump over lazy dogs", "zz")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = language_id.train(d)
    assert model.langs == ["zh", "zz"] and model.keys[language_id.ORDER].count() > 2_000_000
    got = {r.doc_id: r for r in language_id.identify(d, model).collect()}
    assert got[100].lang_pred == "zz" and got[0].lang_pred == "zh"


def test_embedding_links_equal_brute_force(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(40, 16))
    rows = []
    for k in range(600):
        v = base[k % 40] + rnd.normal(size=16) * (0.12 if k % 3 else 0.3)
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(k % 2)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]                     # equal vectors
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[0][1], None),
           (2004, [1.0, None] * 8, 0), (None, rows[0][1], 0), (2005, [1.0], 0), (2006, [float("inf")] * 16, 1)]
    d = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("clash"))
    got = {r.vec_id: r for r in embedding_dedup.embedding_neighbours(d).collect()}
    assert len(got) == len(rows) + len(odd)
    u = np.array([r[1] for r in rows], np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    lab = np.array([r[2] for r in rows])
    links = ((u @ u.T >= 0.93) & (lab[:, None] == lab)).sum(1) - 1
    mine = np.array([got[r[0]].n_links for r in rows])
    assert (mine <= links).all() and mine.sum() >= 0.9 * links.sum()
    for o in odd:
        assert got[o[0]].n_links == 0 and got[o[0]].component_id == o[0] and got[o[0]].kept
    assert got[1000].component_id == got[0].component_id
    assert embedding_dedup.embedding_neighbours(d.limit(0)).collect() == []


def test_embedding_of_every_length_and_precision(spark):
    """Vectors of a rarer length are linked; doubles keep their precision."""
    rnd = np.random.default_rng(9)
    rows = [(i, rnd.normal(size=16).tolist(), 0) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0 + i], 0) for i in range(2)] + [(1010, [1.0], 0), (1011, [2.0], 0), (1012, [-1.0], 0)]
    # cosine with the first axis just below and just above the threshold
    edge = lambda c: [c, math.sqrt(1 - c * c), 0.0]
    rows += [(1020, [1.0, 0.0, 0.0], 0), (1021, edge(0.93 + 1e-12), 0), (1022, edge(0.93 - 1e-12)[:1] + [-edge(0.93 - 1e-12)[1], 0.0], 0)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_neighbours(d).collect()}
    assert got[1000] == (1, 1000) and got[1001] == (1, 1000)
    assert got[1010] == (1, 1010) and got[1011] == (1, 1010) and got[1012] == (0, 1012)
    assert got[1020] == (1, 1020) and got[1021] == (1, 1020) and got[1022] == (0, 1022)


def test_embedding_recall_where_links_are_rare(spark):
    """No probe has a neighbour, yet the few links at the least cosine are found."""
    rnd = np.random.default_rng(12)
    base = rnd.normal(size=(6000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rnd.normal(size=(120, 32))
    noise -= (noise * base[:120]).sum(1)[:, None] * base[:120]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    near = 0.932 * base[:120] + math.sqrt(1 - 0.932 ** 2) * noise
    rows = [(i, x.tolist(), 0) for i, x in enumerate(np.concatenate([base, near]))]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.embedding_neighbours(d).where("n_links > 0").count()
    assert got >= 0.9 * 240


def test_mixing_of_a_huge_budget(spark):
    """The block of a place is exact where place times blocks passes 64 bits."""
    d = spark.createDataFrame([(i, f"text {i}", "s") for i in range(20)], "doc_id long, text string, source string")
    got = mixing.mix_sources(d, budget_tokens=39, block_tokens=1).collect()
    assert sorted(r.block for r in got) == sorted(r.start * 39 // 39 for r in got)
    big, blocks, part = 4 * 10 ** 18, 10 ** 14, 5 * 10 ** 18
    exact = spark.createDataFrame([(big, part)], "start long, part long").select(mixing.block_of(blocks).alias("b"))
    assert exact.first().b == big * blocks // part


def test_pipeline_stages(spark, odd):
    cols = odd.columns
    got = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, SMALL).cache()
        assert got.columns == cols
    assert "ids" in corpus_pipeline.STAGES[-1][1](spark, got, SMALL).columns
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.collect() == []


def test_pipeline_equals_brute_force(spark, docs):
    """The first three stages, replayed in plain Python on what the stage before kept."""
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    judged = {r.doc_id: r.kept for r in queries.op4_quality_rules(spark, SMALL).collect()}
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    assert [i for i, _ in rows] == sorted(i for i, k in judged.items() if k)
    seen, cleaned = set(), []
    for i, text in rows:
        part, gone = text.split("\n"), set()
        for a in range(len(part) - 2):
            if tuple(part[a:a + 3]) in seen:
                gone |= {a, a + 1, a + 2}
            seen.add(tuple(part[a:a + 3]))
        left = "\n".join(x for a, x in enumerate(part) if a not in gone)
        if left or not gone:
            cleaned.append((i, left))
    plain = corpus_pipeline.lines(spark, kept, SMALL)
    assert sorted((r.doc_id, r.text) for r in plain.collect()) == cleaned
    assert plain.where("n_chars <> char_length(text)").count() == 0
    unique = corpus_pipeline.near_duplicates(spark, plain, SMALL)
    comp = brute_components(cleaned, 5, 80)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, (_, c) in comp.items() if i == c)
    mixed = corpus_pipeline.mix(spark, unique, SMALL)
    assert mixed.columns == docs.columns and mixed.count() > 0
