"""Language identification by interpolated Kneser-Ney character models.

One model per language over the letters of the training texts, all of them in
shared tables of character sequences with a row of log probabilities per
language. Counts, discounts and probabilities are Spark jobs over every sequence
seen. Tables of up to BROADCAST bytes are sorted arrays in the tasks that score;
larger ones are joined with the sequences of each text. Log probabilities are
whole numbers of 1/SCALE, so that both ways add up to the same sums.

Every language has discounts of its own. What a text may cost before it is
rejected is calibrated on training texts that a trial model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import ready, written

ORDER = 4
#: Codes scored at once; longer texts are cut with ORDER-1 codes of overlap.
SEGMENT = 1 << 20
UNKNOWN = "und"
SCALE = 1 << 20
#: Log probability of a letter that no model has seen, before its weight.
FLOOR = round(float(np.log(1.0 / 65536)) * SCALE)
#: Bytes of model tables that the driver and each worker hold at most.
BROADCAST = 96 << 20
#: One training text in so many is kept from the trial model that calibrates rejection.
FOLDS = 5
#: Share of a language's unseen training texts that is not to be rejected.
ACCEPT = 0.999
#: Standard errors of a text's mean loss that are allowed on top of the slack.
TOLERANCE = 2.0
#: Slack, in nats a letter, of a language without an unseen training text.
SLACK = 0.5
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def codes(text: str) -> np.ndarray:
    """16-bit codes of a text: lower-cased letters, one space for every other
    run, spaces at both ends; empty without a letter. Letters beyond the basic
    plane share the private-use codes."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[points]
    if not is_letter.any():
        return np.empty(0, np.uint64)
    plain = np.where(is_letter, np.where(points < 0x10000, points, 0xE000 + points % 6400), 32).astype(np.uint64)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]          # the first of a run of other characters
    body = plain[keep]
    body = body[1:] if body[0] == 32 else body
    tail = [] if body[-1] == 32 else [32]
    return np.concatenate([np.full(ORDER - 1, 32, np.uint64), body, np.array(tail, np.uint64)])


def grams(code: np.ndarray) -> np.ndarray:
    """Every run of ORDER codes, packed into 64 bits, first code highest."""
    n = len(code) - ORDER + 1
    packed = np.zeros(max(n, 0), np.uint64)
    for k in range(ORDER if n > 0 else 0):
        packed = (packed << np.uint64(16)) | code[k:k + n]
    return packed


def segments(code: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, len(code) - ORDER + 1, SEGMENT):
        yield code[start:start + SEGMENT + ORDER - 1]


COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()),
                       T.StructField("n", T.LongType())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=COUNTS.names)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in segments(codes(text.as_py())):
                held.setdefault(lang, []).append(grams(part))
                size += len(part)
                if size > 2 * SEGMENT:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()


def discount_of(ones: int, twos: int, otherwise: float = 0.5) -> float:
    """Discount of a model by the numbers of sequences seen once and twice;
    ``otherwise`` where one of them is 0."""
    return ones / (ones + 2 * twos) if ones and twos else otherwise


class KneserNey:
    """Interpolated models of several languages with a discount per language and
    order (that of all languages together where a language has no sequence seen
    once or none seen twice).

    ``keys[n]`` are the sorted n-code sequences seen in any language and
    ``logp[n]`` their log probabilities per language; ``left[n]`` are the sorted
    histories of n codes with the log weight ``rest[n]`` that a language gives
    to the next shorter model after them. Logs are in units of 1/SCALE.
    """

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        width = len(langs)
        u = np.uint64
        self.keys, self.logp, self.left, self.rest = {}, {}, {}, {}
        # order ORDER has counts; lower orders count the distinct sequences they end
        order_rows = {ORDER: (lang, gram, n.astype(np.float64))}
        for o in range(ORDER - 1, 0, -1):
            l, g, _ = order_rows[o + 1]
            short = g & u((1 << (16 * o)) - 1)
            pair = np.unique(np.stack([l.astype(u), short]), axis=1, return_counts=True)
            order_rows[o] = (pair[0][0].astype(np.int64), pair[0][1], pair[1].astype(np.float64))
        total = np.zeros(width)
        lower_keys = np.empty(0, u)
        lower = np.empty((0, width))
        for o in range(1, ORDER + 1):
            l, g, c = order_rows[o]
            ones, twos = (np.bincount(l[c == k], minlength=width) for k in (1, 2))
            pooled = discount_of(ones.sum(), twos.sum())
            discount = np.array([discount_of(a, b, pooled) for a, b in zip(ones, twos)])
            hist = g >> u(16)
            hkeys, hpos = np.unique(hist, return_inverse=True)
            mass, kinds = np.zeros((len(hkeys), width)), np.zeros((len(hkeys), width))
            np.add.at(mass, (hpos, l), c)
            np.add.at(kinds, (hpos, l), 1.0)
            rest = np.where(mass > 0, discount * kinds / np.maximum(mass, 1e-300), 1.0)
            keys, pos = np.unique(g, return_inverse=True)
            counts = np.zeros((len(keys), width))
            counts[pos, l] = c
            at = np.searchsorted(hkeys, keys >> u(16))
            if o == 1:
                base = np.full((len(keys), width), 1.0 / 65536)
            else:
                base = lower[np.searchsorted(lower_keys, keys & u((1 << (16 * (o - 1))) - 1))]
            own = np.maximum(counts - discount, 0.0) / np.maximum(mass[at], 1e-300)
            prob = np.where(mass[at] > 0, own, 0.0) + rest[at] * base
            lower_keys, lower = keys, prob
            self.keys[o], self.logp[o] = keys, np.rint(np.log(prob) * SCALE).astype(np.int32)
            self.left[o - 1], self.rest[o - 1] = hkeys, np.rint(np.log(rest) * SCALE).astype(np.int32)

    @classmethod
    def of(cls, langs: list[str], keys: dict, logp: dict, left: dict, rest: dict) -> KneserNey:
        """A model of given tables."""
        self = cls.__new__(cls)
        self.langs, self.keys, self.logp, self.left, self.rest = langs, keys, logp, left, rest
        return self

    def log_probs(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each sequence's last code after the others, per language."""
        return self.units(packed, order) / np.float32(SCALE)

    def units(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        """``log_probs`` in units of 1/SCALE."""
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, packed), len(keys) - 1)
        out = self.logp[order][at]
        miss = np.flatnonzero(keys[at] != packed)
        if len(miss):
            rare = packed[miss]
            hist = rare >> np.uint64(16)
            left = self.left[order - 1]
            h = np.minimum(np.searchsorted(left, hist), len(left) - 1)
            rest = np.where((left[h] == hist)[:, None], self.rest[order - 1][h], np.int32(0))
            if order == 1:
                out[miss] = rest + np.int32(FLOOR)
            else:
                out[miss] = rest + self.units(rare & np.uint64((1 << (16 * (order - 1))) - 1), order - 1)
        return out

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities (text x language) in units of 1/SCALE and numbers of codes."""
        sums = np.zeros((len(texts), len(self.langs)), np.int64)
        sizes = np.zeros(len(texts), np.int64)
        parts, owners, held = [], [], 0

        def flush():
            logp = self.units(np.concatenate(parts))
            starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
            np.add.at(sums, owners, np.add.reduceat(logp, starts, axis=0, dtype=np.int64))
        for i, text in enumerate(texts):
            for part in segments(codes(text or "")):
                packed = grams(part)
                sizes[i] += len(packed)
                parts.append(packed)
                owners.append(i)
                held += len(packed)
                if held >= SEGMENT // 4:
                    flush()
                    parts, owners, held = [], [], 0
        if parts:
            flush()
        return sums, sizes


class Tables:
    """Trained models: ``keys[n]`` (gram, logp) and ``left[n]`` (gram, rest) as
    written tables with one number per language, mean and deviation of the log
    loss of each language's training text, and the slack that its texts are
    allowed. ``bytes`` is what ``local`` holds."""

    def __init__(self, langs: list[str], keys: dict[int, DataFrame], left: dict[int, DataFrame],
                 mean: np.ndarray, sd: np.ndarray, rows: int):
        self.langs, self.keys, self.left, self.mean, self.sd = langs, keys, left, mean, sd
        self.slack = np.full(len(langs), SLACK)
        self.bytes = rows * (8 + 4 * len(langs))

    def excess(self, lang: np.ndarray, sums: np.ndarray, sizes: np.ndarray, tolerance: float) -> np.ndarray:
        """Nats a letter by which texts of total log probability ``sums`` lie above
        the training loss of a language and ``tolerance`` standard errors."""
        sizes = np.maximum(sizes, 1)
        return -sums / SCALE / sizes - self.mean[lang] - tolerance * self.sd[lang] / np.sqrt(sizes)

    def local(self) -> KneserNey:
        def arrays(tables: dict[int, DataFrame]) -> tuple[dict, dict]:
            grams_of, values_of = {}, {}
            for o, table in tables.items():
                got = table.toArrow()
                gram = got.column(0).to_numpy().view(np.uint64)
                order = np.argsort(gram)
                values = np.concatenate([c.flatten().to_numpy() for c in got.column(1).chunks]).reshape(-1, len(self.langs))
                grams_of[o], values_of[o] = gram[order], values[order]
            return grams_of, values_of
        return KneserNey.of(self.langs, *arrays(self.keys), *arrays(self.left))


def _suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND(F.lit((1 << (16 * order)) - 1))


def _units(p: Column) -> Column:
    return F.transform(p, lambda x: F.rint(F.log(x) * SCALE).cast("int"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = FOLDS, accept: float = ACCEPT, tolerance: float = TOLERANCE,
          broadcast: int = BROADCAST) -> Tables | None:
    """Models of the languages in ``docs``; None without a labelled letter.

    Every text and every sequence counts, by the formulas of ``KneserNey``. A
    trial model of all texts but one in ``folds`` (by the text's hash, so copies
    stay together) meets the texts left out; the slack of a language is the
    ``accept`` quantile of what they cost above the trial's own training loss.
    Without such a text, or with ``folds`` 0, the slack is SLACK. The driver holds
    the names of the languages, one discount per language and order and three
    numbers per language.
    """
    ready(docs.sparkSession)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    model = _estimate(labelled)
    if model is None or not folds:
        return model
    unseen = F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(folds)) == 0
    trial = _estimate(labelled.where(~unseen))
    if trial is not None:
        slack = _slack(labelled.where(unseen), trial, accept, tolerance, broadcast)
        model.slack = np.array([slack.get(lang, SLACK) for lang in model.langs])
    return model


def _slack(texts: DataFrame, trial: Tables, accept: float, tolerance: float, broadcast: int) -> dict[str, float]:
    """The ``accept`` quantile per language of the excess of ``texts`` (lang, text)
    under their own language's model."""
    names = F.array(*[F.lit(x) for x in trial.langs])
    placed = texts.select((F.array_position(names, F.col("lang")) - 1).cast("long").alias("doc_id"), "text").where("doc_id >= 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_numpy()
            sums = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(trial_langs))
            sizes = batch.column(2).to_numpy()
            over = judge.excess(lang, sums[np.arange(len(lang)), lang], sizes, tolerance)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(over)], names=["l", "excess"]).filter(pa.array(sizes > 0))
    # the numbers alone: tables do not travel to the tasks
    trial_langs, judge = trial.langs, Tables(trial.langs, {}, {}, trial.mean, trial.sd, 0)
    rows = _sums(placed, trial, broadcast).mapInArrow(run, "l long, excess double")
    found = rows.groupBy("l").agg(F.percentile_approx("excess", accept, 10000).alias("slack")).collect()
    return {trial.langs[r["l"]]: r["slack"] for r in found}


SUMS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType())),
                     T.StructField("size", T.LongType())])


def _sums(texts: DataFrame, model: Tables, broadcast: int) -> DataFrame:
    """(doc_id, sums, size) of (doc_id, text): total log probability per language,
    and the number of codes."""
    if model.bytes > broadcast:
        return _joined(texts, model)
    shared = texts.sparkSession.sparkContext.broadcast(model.local())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = shared.value
        for batch in batches:
            sums, sizes = kn.totals(batch.column(1).to_pylist())
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(kn.langs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(sums.ravel())), pa.array(sizes)], names=SUMS.names)
    return texts.mapInArrow(run, SUMS)


def _estimate(labelled: DataFrame) -> Tables | None:
    """Models of (lang, text)."""
    counted = written(labelled.mapInArrow(_count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not langs:
        return None
    every = F.sequence(F.lit(0), F.lit(len(langs) - 1))
    place = (F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1).cast("int")
    # order ORDER has counts; lower orders count the distinct sequences they end
    per_order = [counted.select(F.lit(ORDER).alias("o"), place.alias("l"), "gram", "n")]
    for o in range(ORDER - 1, 0, -1):
        per_order.append(per_order[-1].groupBy("l", _suffix(F.col("gram"), o).alias("gram")).agg(F.count("*").alias("n"))
                         .select(F.lit(o).alias("o"), "l", "gram", "n"))
    rows = per_order[0]
    for more in per_order[1:]:
        rows = rows.unionByName(more)
    rows = written(rows, "lang-orders")
    seen_often = {(r["o"], r["l"]): (r["ones"], r["twos"]) for r in rows.groupBy("o", "l").agg(
        F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
    discounts: dict[int, list[float]] = {}
    for o in range(1, ORDER + 1):
        own = [seen_often[o, l] for l in range(len(langs))]
        pooled = discount_of(*map(sum, zip(*own)))
        discounts[o] = [discount_of(*x, pooled) for x in own]

    def per_language(values: list[float]) -> Column:
        return F.array(*[F.lit(x) for x in values])
    discount = F.get(F.element_at(F.create_map(*[x for o in discounts for x in (F.lit(o), per_language(discounts[o]))]), F.col("o")), F.col("l"))
    hists = written(
        rows.groupBy("o", F.shiftrightunsigned("gram", 16).alias("gram"), "l").agg(F.sum("n").alias("mass"), F.count("*").alias("kinds"))
        .withColumn("rest", discount * F.col("kinds") / F.col("mass"))
        .groupBy("o", "gram").agg(F.map_from_entries(F.collect_list(F.struct("l", F.struct("mass", "rest")))).alias("m"))
        .select("o", "gram", F.transform(every, lambda l: F.coalesce(F.element_at("m", l)["mass"], F.lit(0)).cast("double")).alias("mass"),
                F.transform(every, lambda l: F.coalesce(F.element_at("m", l)["rest"], F.lit(1.0))).alias("rest")), "lang-histories")
    keys: dict[int, DataFrame] = {}
    for o in range(1, ORDER + 1):
        seen = (rows.where(F.col("o") == o).groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("l", "n"))).alias("m"))
                .select("gram", F.transform(every, lambda l: F.coalesce(F.element_at("m", l), F.lit(0))).alias("n")))
        hist = hists.where(F.col("o") == o).select(F.col("gram").alias("hist"), "mass", "rest")
        seen = seen.join(hist, F.shiftrightunsigned(seen["gram"], 16) == F.col("hist"))
        if o == 1:
            seen = seen.withColumn("base", F.array_repeat(F.lit(1.0 / 65536), len(langs)))
        else:
            lower = keys[o - 1].select(F.col("gram").alias("short"), F.col("p").alias("base"))
            seen = seen.join(lower, _suffix(seen["gram"], o - 1) == F.col("short"))
        p = F.transform(every, lambda l: F.when(
            F.get("mass", l) > 0, F.greatest(F.get("n", l) - F.get(per_language(discounts[o]), l), F.lit(0.0)) / F.get("mass", l)).otherwise(F.lit(0.0))
            + F.get("rest", l) * F.get("base", l))
        keys[o] = written(seen.select("gram", "n", p.alias("p")).select("gram", _units(F.col("p")).alias("logp"), "p", "n"), f"lang-model-{o}")
    # log loss of the training text per language, from its counts
    n, top = F.col("x")["n"].cast("decimal(19,0)"), F.col("x")["logp"].cast("decimal(10,0)")
    loss = {r["l"]: [float(r[k]) for k in ("n", "one", "two")] for r in
            keys[ORDER].select(F.posexplode(F.arrays_zip("n", "logp")).alias("l", "x")).where("x.n > 0").groupBy("l").agg(
                F.sum(n).alias("n"), F.sum(n * top).alias("one"), F.sum(n * top * top).alias("two")).collect()}
    weight, one, two = np.array([loss[l] for l in range(len(langs))]).T
    mean = -one / weight / SCALE
    sd = np.sqrt(np.maximum(two / weight / SCALE ** 2 - mean ** 2, 1e-9))
    held = hists.count() + sum(keys[o].count() for o in keys)
    return Tables(langs, {o: keys[o].select("gram", "logp") for o in keys},
                  {o - 1: hists.where(F.col("o") == o).select("gram", _units(F.col("rest")).alias("rest")) for o in keys}, mean, sd, held)


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()),
                       T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()),
                       T.StructField("rejected", T.BooleanType())])
FOUND = T.StructType([T.StructField("text_key", T.BinaryType()), T.StructField("gram", T.LongType()),
                      T.StructField("n", T.LongType())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, gram, n) of every text; one row without a gram for the text itself."""
    for batch in batches:
        keys, grams_, ns, size = [], [], [], 0

        def flush():
            gram = np.concatenate(grams_)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(keys, object), [len(g) for g in grams_]), pa.binary()),
                 pa.array(gram.view(np.int64), mask=np.concatenate([n == 0 for n in ns])),
                 pa.array(np.maximum(np.concatenate(ns), 1))], names=FOUND.names)
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            parts = [(np.zeros(1, np.uint64), np.zeros(1, np.int64))]
            parts += [np.unique(grams(part), return_counts=True) for part in segments(codes(text.as_py()))]
            for gram, n in parts:
                keys.append(key)
                grams_.append(gram)
                ns.append(n)
                size += len(gram)
            if size > SEGMENT // 4:
                yield flush()
                keys, grams_, ns, size = [], [], [], 0
        if keys:
            yield flush()


def _joined(texts: DataFrame, model: Tables) -> DataFrame:
    """(doc_id, sums, size) of (doc_id, text): each distinct sequence of the texts
    is looked up once, then joined with the sequences counted per text. Rows of
    one text are summed together and share the sums, which divide evenly."""
    width = len(model.langs)
    keyed = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.unhex(F.md5("text")))
    found = written(keyed.select("text_key", "text").mapInArrow(_found, FOUND), "text-grams")
    looked = found.where("gram is not null").select("gram").distinct()
    rest = model.left[0].first()["rest"]
    score = F.array(*[F.lit(x + FLOOR) for x in rest])
    for o in range(1, ORDER + 1):
        key, value = f"_gram{o}", f"_logp{o}"
        looked = looked.join(model.keys[o].select(F.col("gram").alias(key), F.col("logp").alias(value)),
                             _suffix(looked["gram"], o) == F.col(key), "left")
        if o > 1:
            left, weight = f"_left{o}", f"_rest{o}"
            looked = looked.join(model.left[o - 1].select(F.col("gram").alias(left), F.col("rest").alias(weight)),
                                 F.shiftrightunsigned(_suffix(looked["gram"], o), 16) == F.col(left), "left")
            score = F.when(F.col(weight).isNull(), score).otherwise(F.zip_with(weight, score, lambda a, b: a + b))
        score = F.coalesce(F.col(value), score)
    looked = written(looked.select("gram", score.alias("units")), "gram-scores")
    grams_ = found.where("gram is not null").join(looked, "gram").select("text_key", "n", "units", F.lit(0).cast("long").alias("copies"))
    marks = found.where("gram is null").select("text_key", F.lit(0).cast("long").alias("n"), F.lit(None).cast("array<int>").alias("units"),
                                               F.col("n").alias("copies"))
    summed = grams_.unionByName(marks).groupBy("text_key").agg(
        F.sum("copies").alias("copies"), F.sum("n").alias("size"),
        *[F.coalesce(F.sum(F.col("n") * F.get("units", F.lit(l))), F.lit(0)).alias(f"_sum{l}") for l in range(width)])
    per_text = summed.select("text_key", F.expr("size div copies").alias("size"),
                             F.array(*[F.expr(f"_sum{l} div copies") for l in range(width)]).alias("sums"))
    return keyed.select("doc_id", "text_key").join(per_text, "text_key", "left").select("doc_id", "sums", "size")


def identify(docs: DataFrame, model: Tables | None, id_col: str = "doc_id", text_col: str = "text",
             tolerance: float = TOLERANCE, broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) for every row.

    The language with the lowest cross-entropy per letter over the whole text;
    ties go to the first name. ``score`` weighs the others at the evidence of
    the square root of the length. ``rejected``: the cross-entropy lies more
    than the language's slack (see ``train``, which takes the same tolerance) plus
    ``tolerance`` standard errors above that of the language's own training
    text. A model of more than ``broadcast`` bytes is
    joined instead of held, with the same result.

    Null text or no letter: ``und``, score 0, no cross-entropy, rejected; so for
    every row without a model. Repeated rows come back each; null ids stay;
    extra columns are not read.
    """
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    langs = model.langs if model else []
    judge = Tables(langs, {}, {}, model.mean, model.sd, 0) if model else None     # the numbers alone travel to the tasks
    slack = model.slack if model else None

    def judged(ids: pa.Array, sums: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        rows = len(sizes)
        pred, conf = [UNKNOWN] * rows, np.zeros(rows)
        entropy: list[float | None] = [None] * rows
        rejected = np.ones(rows, bool)
        if langs and rows:
            best = sums.argmax(1)
            top = sums[np.arange(rows), best]
            root = np.sqrt(np.maximum(sizes, 1))
            conf = np.where(sizes > 0, 1.0 / np.exp((sums - top[:, None]) / SCALE / root[:, None]).sum(1), 0.0)
            ce = -top / SCALE / np.maximum(sizes, 1)
            rejected = (sizes == 0) | (judge.excess(best, top, sizes, tolerance) > slack[best])
            for i in np.flatnonzero(sizes):
                pred[i], entropy[i] = langs[best[i]], float(ce[i])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(pred, pa.string()), pa.array(conf, pa.float64()),
             pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())], names=RESULT.names)

    if model and model.bytes > broadcast:
        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield judged(batch.column(0), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(langs)),
                             batch.column(2).to_numpy())

        return _joined(texts, model).mapInArrow(weigh, RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(model.local() if model else None)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn = shared.value
        for batch in batches:
            rows = batch.num_rows
            sums, sizes = kn.totals(batch.column(1).to_pylist()) if kn is not None and rows else (np.zeros((rows, 0)), np.zeros(rows, np.int64))
            yield judged(batch.column(0), sums, sizes)

    return texts.mapInArrow(score, RESULT)
