"""Toxicity by weak supervision.

1. Voters. Terms (words and word beginnings) that labelled toxic documents
   hold far more often than clean ones are mined and dealt to lexicon voters;
   pattern voters look at the density and spread of hits, a general insult
   list, direct address, disguised spelling, shouting and exclamation marks.
2. Label model. A generative model of the votes: a class prior, each voter's
   rate of firing in both classes (its accuracy), and the covariance of the
   voters within the classes (their correlations). It starts from the training
   labels and is refined by expectation maximisation over the votes of the
   whole corpus, counted by vote pattern (2^voters patterns at most).
3. Classifier. A linear model of the voters' strengths is trained on the label
   model's posterior labels and scaled so that the training labels fit.

Labels are used from training rows only. Terms are counted over all labelled
training texts; rates, correlations and scores come from all texts. Bounded by
parameters are the size of the lexicons (``most`` terms) and the classifier's
sample (``sample`` labelled rows); the vote patterns are bounded by the voters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from furrow.llm.common import Scratch, batches, window_hashes, word_hashes, words

# A short general insult list, and letters that digits and signs stand for.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile stupid dumb loser losers scum trash garbage worthless pathetic disgusting filthy vermin clown coward freak creep jerk bastard".split()
)
SPELLING = str.maketrans("013457@$!", "oieastasi")
LEXICONS = 6
PATTERNS = ("doubtful pair", "doubtful crowd", "two", "dense", "general", "address", "disguised", "shouting", "exclaiming")
VOTERS = LEXICONS + len(PATTERNS)
LETTERS = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"\b[^\W_]*[^\W\d_][013457@$!]+[^\W\d_]+\b")
ADDRESS = re.compile(r"\byou(?:'re| are|r)?(?: \w+){0,2}? (\w+)")
#: Lengths of the word beginnings that count as terms.
CUTS = (8, 7, 6, 5, 4, 3)
#: The lexicon of terms that clean documents use too; several of them together tell.
DOUBTFUL = LEXICONS


def parts_of(word: str) -> set[str]:
    """The terms that a word holds: itself and its beginnings."""
    return {word, *(word[:n] for n in CUTS if len(word) > n)}


@dataclass
class Model:
    """Terms by lexicon, the label model and the classifier; small enough to travel with a task."""

    terms: dict[str, int] = field(default_factory=dict)
    prior: float = 0.05
    rates: tuple = ()
    correlations: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0

    def strengths(self, text: str | None) -> list[float]:
        """Per voter, how strongly it fires (0: not at all)."""
        if not text:
            return [0.0] * VOTERS
        lower = text.lower()
        found = Counter(LETTERS.findall(lower))
        lexicon = [0.0] * LEXICONS
        hits = distinct = general = doubtful = 0
        get = self.terms.get
        for word, n in found.items():
            at = get(word)
            if at is None or at == DOUBTFUL:
                for cut in CUTS:
                    if len(word) > cut and (other := get(word[:cut])) is not None:
                        at = other
                        if at != DOUBTFUL:
                            break
            if at == DOUBTFUL:
                doubtful += 1
            elif at is not None:
                lexicon[at] += n
                hits, distinct = hits + n, distinct + 1
            if word in INSULTS:
                general += n
        if doubtful >= 3:
            hits, distinct = hits + doubtful, distinct + doubtful
        total = sum(found.values())
        disguised = sum(1 for w in DISGUISED.findall(lower) if self.knows(w.translate(SPELLING))) if any(c in lower for c in "013457@$!") else 0
        address = sum(1 for w in ADDRESS.findall(lower) if self.knows(w)) if "you" in lower else 0
        capitals = sum(1 for c in text if c.isupper()) if text.upper() == text else 0
        density = 1000.0 * hits / max(total, 50)
        out = [math.log1p(x) for x in lexicon]
        out += [math.log1p(doubtful) if doubtful > 1 else 0.0, math.log1p(doubtful) if doubtful > 2 else 0.0]
        out += [math.log1p(distinct) if distinct > 1 else 0.0, math.log1p(density) if density >= 3 else 0.0, math.log1p(general), math.log1p(address), math.log1p(disguised)]
        return out + [float(capitals > 20), float(text.count("!") > max(3, 0.05 * total))]

    def knows(self, word: str) -> bool:
        return word in INSULTS or any(self.terms.get(p, DOUBTFUL) != DOUBTFUL for p in parts_of(word))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def in_training(doc_id: Column) -> Column:
    """Rows whose crc32 of the doc_id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 != 1, F.lit(False))


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labelled training rows; a doc_id with several labels is toxic if one of them is."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")).where("toxic IS NOT NULL")
    return marked.where(in_training(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def mining_rows(docs: DataFrame, known: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic`` of the labelled training texts, one of each group of copies, and how many there are of each label.

    Texts that share their smallest hash of five-word runs (copies, most near
    copies) and their label count once. Which one stays (smallest text hash,
    then doc_id) is found on narrow rows; then training texts are shuffled once,
    rows that repeat whole merged before.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("least", pa.int64())])

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            least = []
            for t in part.column(2).to_pylist():
                h = word_hashes(words(t))
                runs = window_hashes(h, min(5, len(h))) if len(h) else h
                least.append(int(runs.min()) >> 1 if len(runs) else 0)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(least, pa.int64())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text").where(in_training(F.col("doc_id")))
    narrow = texts.mapInArrow(mark, "doc_id long, h long, least long").join(known, "doc_id")
    once = narrow.groupBy("least", "toxic").agg(F.min(F.struct("h", "doc_id")).alias("first"))
    once = scratch.write(once.select("first.doc_id", "first.h", "toxic"), "once")
    whole = texts.groupBy("doc_id", "h").agg(F.min("text").alias("text")).join(once, ["doc_id", "h"])
    return whole.select("text", "toxic"), dict(once.groupBy("toxic").count().collect())


def mine_terms(train: DataFrame, total: dict[int, int], most: int = 50_000, precision: float = 0.8, lift: float = 3.0, doubt: float = 1e-7) -> dict[str, int]:
    """Significant terms of toxic rows, and the lexicon of each.

    ``train(text, toxic)``, ``total`` rows by label: see ``mining_rows``. A term is kept if as many toxic
    rows would, at the base rate, come about with a probability below
    ``doubt``. Terms of at least ``precision`` are dealt to the lexicons; those
    that are at least ``lift`` times as toxic as the base rate are doubtful. Of
    a word and its beginnings the most general with the same support stays.
    ``most`` bounds the size of the model: beyond it the terms of the fewest
    toxic rows are left out.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.string()), ("k", pa.int64()), ("m", pa.int64())])
        terms_of = lru_cache(1 << 16)(parts_of)
        seen: tuple[Counter, Counter] = (Counter(), Counter())  # clean, toxic

        def counted() -> Iterator[pa.RecordBatch]:
            yield from batches(((t, seen[1][t], seen[0][t]) for t in seen[0].keys() | seen[1].keys()), schema)
            seen[0].clear()
            seen[1].clear()

        for part in parts:
            for text, toxic in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                seen[toxic].update(set().union(*map(terms_of, set(LETTERS.findall((text.as_py() or "").lower())))))
                if len(seen[0]) + len(seen[1]) > 200_000:  # what a task holds is bounded; Spark adds the parts up
                    yield from counted()
        yield from counted()

    if not total.get(1) or not total.get(0):
        return {}
    base = total[1] / (total[0] + total[1])
    counts = train.mapInArrow(count, "term string, k long, m long").groupBy("term").agg(F.sum("k").alias("k"), F.sum("m").alias("m"))
    p = F.col("k") / (F.col("k") + F.col("m"))
    q = F.greatest(1 - p, F.lit(1e-12))
    evidence = (F.col("k") + F.col("m")) * (p * F.log(p / F.lit(base)) + q * F.log(q / F.lit(1 - base)))
    kept = counts.where((F.col("k") > 0) & (p >= min(precision, lift * base)) & (evidence >= -math.log(doubt))).orderBy(F.desc("k"), "term").limit(most).collect()
    support = {r.term: r.k for r in kept}
    longer_than: dict[str, list[str]] = {}
    for t in support:
        for cut in CUTS:
            if len(t) > cut:
                longer_than.setdefault(t[:cut], []).append(t)
    sure = {r.term for r in kept if r.k >= max(precision, base) * (r.k + r.m)}
    dropped: set[str] = set()
    for term in sorted(support, key=lambda t: (len(t), t)):
        if term in dropped:
            continue
        longer = longer_than.get(term, [])
        if any(support[t] >= (0.95 if term in sure else 0.75) * support[term] for t in longer):
            dropped.add(term)
        else:  # what a sure beginning covers, and doubtful words that a doubtful one covers, say nothing more
            dropped.update(t for t in longer if term in sure or t not in sure)
    found = sorted(support.keys() - dropped, key=lambda t: (-support[t], t))
    dealt = {t: i % LEXICONS for i, t in enumerate(t for t in found if t in sure)}
    return dealt | {t: DOUBTFUL for t in found if t not in sure}


def vote_features(docs: DataFrame, model: Model) -> DataFrame:
    """``row, x``: every row, whole, and the strengths of the voters on its ``text``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = pa.array([model.strengths(t.as_py()) for t in part.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), x], names=["row", "x"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("x", ArrayType(DoubleType()))]))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, anchor: float, rounds: int = 10) -> tuple:
    """``(prior, rates of both classes, covariance, posterior of each pattern)``.

    ``patterns``: 0/1 by voter; ``start``: first guess of each pattern's share of
    toxic rows; ``anchor``: how many rows that guess counts for in each round.
    Within the classes votes are taken as normal with one covariance, so that
    voters that fire together share their weight.
    """
    n = counts.sum()
    post = start.copy()
    for _ in range(rounds):
        blend = (counts * post + anchor * counts / n * start) / (counts + anchor * counts / n)
        w1, w0 = counts * blend, counts * (1 - blend)
        prior = float(np.clip((w1.sum() + 0.5) / (n + 1), 1e-6, 1 - 1e-6))
        rate1 = (w1 @ patterns + 0.5) / (w1.sum() + 1)
        rate0 = (w0 @ patterns + 0.05) / (w0.sum() + 1)
        d1, d0 = patterns - rate1, patterns - rate0
        cov = ((d1 * w1[:, None]).T @ d1 + (d0 * w0[:, None]).T @ d0) / n
        cov += np.diag(np.full(VOTERS, 1e-3))
        weight = np.linalg.solve(cov, rate1 - rate0)
        bias = math.log(prior / (1 - prior)) - 0.5 * float(weight @ (rate1 + rate0))
        post = _sigmoid(patterns @ weight + bias)
    return prior, (rate0, rate1), cov, post


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps, ridge on all but the bias."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(rounds):
        p = _sigmoid(z @ w)
        slope = z.T @ (p - y) + penalty * w
        curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, scratch: Scratch | None = None, carry: list[str] | None = None) -> tuple[Model, DataFrame]:
    """The fitted model, and ``row, x`` of every row of ``docs`` (written to scratch).

    ``docs(doc_id, text)``, ``labels(doc_id, toxic)``: labels of rows outside
    the training part are never read into the model. Without labels of both
    classes no terms are mined and the general voters carry the score alone.
    ``row`` has the columns ``carry`` (``doc_id`` alone by default).
    """
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    known = scratch.write(known_labels(labels), "known")
    model = Model(terms=mine_terms(*mining_rows(docs, known, scratch)))
    features = vote_features(docs, model).select(F.struct(*[F.col("row")[c].alias(c) for c in carry or ["doc_id"]]).alias("row"), "x")
    features = scratch.write(features, "features")
    bits = sum((F.when(F.col("x")[i] > 0, 1 << i).otherwise(0) for i in range(1, VOTERS)), F.when(F.col("x")[0] > 0, 1).otherwise(0))
    rows = features.groupBy(bits.alias("v")).count().collect()  # 2^VOTERS at most
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # two numbers a row, ``sample`` rows at most
    taught = features.select(F.col("row.doc_id").cast("long").alias("doc_id"), "x").join(F.broadcast(some), "doc_id")
    taught = taught.groupBy("doc_id").agg(F.min(F.struct("x", "toxic")).alias("one"))  # a doc_id that repeats counts once
    known = taught.select("one.x", "one.toxic").toPandas()  # ``sample`` rows at most
    x = np.array(known["x"].tolist(), "f8").reshape(-1, VOTERS)
    y = (known["toxic"].to_numpy() > 0).astype("f8")
    codes = np.array([r["v"] for r in rows], "i8")
    counts = np.array([r["count"] for r in rows], "f8")
    patterns = (codes[:, None] >> np.arange(VOTERS) & 1).astype("f8")
    mine = ((x > 0) << np.arange(VOTERS)).sum(1)
    base = (y.sum() + 0.5) / (len(y) + 10)
    hits, toxic = Counter(mine.tolist()), Counter(mine[y > 0].tolist())
    general = base + (1 - base) * np.minimum(1.0, 0.3 * patterns[:, : VOTERS - 2].sum(1)) if len(counts) else counts
    start = np.array([(toxic[c] + 2 * g) / (hits[c] + 2) for c, g in zip(codes.tolist(), general, strict=True)]) if len(counts) else counts
    if len(counts):
        model.prior, model.rates, cov, post = fit_label_model(patterns, counts, start, anchor=float(max(len(y), 100)))
        sd = np.sqrt(np.diag(cov))
        model.correlations = cov / np.outer(sd, sd)
        # the sample's rows, and each pattern of the corpus once, so that patterns which no labelled row has are learnt too
        target = dict(zip(codes.tolist(), post, strict=True))
        soft = np.array([target.get(c, base) for c in mine.tolist()])
        x_all = np.concatenate([x, patterns * math.log(2)])
        model.weights, model.bias = _logistic(x_all, np.concatenate([soft, post]))
    else:
        model.weights, model.bias = np.zeros(VOTERS), -4.0
    if 0 < y.sum() < len(y):  # scale: the training labels decide what a margin is worth
        slope, shift = _logistic((x @ model.weights + model.bias)[:, None], y, ridge=1e-2)
        if slope[0] > 0:
            model.weights, model.bias = model.weights * slope[0], model.bias * float(slope[0]) + shift
    scratch.drop("once", "known")
    return model, features


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 20_000) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``held_out``: the row's label was not to be learnt (false for a null
    doc_id, whose label is not learnt either). Null and empty texts get the
    score of a text on which no voter fires. Rows that repeat are scored each;
    a doc_id with several labels is toxic if one of them is. Other columns are
    not read. No rows in, no rows out.
    """
    model, features = fit(docs.select("doc_id", "text"), labels, sample)
    scored = features.select(F.col("row.doc_id").cast("long").alias("doc_id"), _score(model).alias("score"))
    scored = scored.withColumn("held_out", F.col("doc_id").isNotNull() & ~in_training(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _score(model: Model) -> Column:
    margin = sum((F.col("x")[i] * F.lit(float(w)) for i, w in enumerate(model.weights)), F.lit(float(model.bias)))
    return 1.0 / (1.0 + F.exp(-F.least(F.greatest(margin, F.lit(-35.0)), F.lit(35.0))))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; each is scored once and written with its votes."""
    model, features = fit(docs, labels, sample, carry=docs.columns)
    return features.where(_score(model) < threshold).select("row.*")
