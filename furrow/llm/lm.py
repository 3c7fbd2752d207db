"""Language-model scoring by cross-entropy difference.

Two bigram models, of the target documents and of the whole corpus, share one
vocabulary and one smoothing. A document's score is its loss per token under the
target model minus that under the background model: the lower, the more it is
like the target.

Words and pairs of words are counted over all texts, each n-gram for itself:
nothing is capped and no counter is shared, so what is gathered grows with the
corpus. N-grams are told apart by 64-bit hashes (of 2 billion different ones,
0.1 pairs of them are expected to have equal hashes).

1. Texts are read once, in blocks of about ``BLOCK`` tokens. A block sends its
   different n-grams, each with its two counts, to buckets of the hash. A frequent
   n-gram is one entry a block, however often it occurs, so no bucket is hot.
2. A bucket adds the counts up and answers every block with what the others have of
   the n-grams it sent, in the same order: nothing, for one that no other block has.
3. A block scores its documents from its tokens, its own counts and the answers.

Each step ends in a table, and the one before it and its shuffle files are removed then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import _MIX, Scratch, batches, mix, word_hashes, words
from furrow.llm.substring import buckets_for

#: Tokens that are counted and scored together.
BLOCK = 1 << 20
#: Stand for the end of a text (and what comes before its first word), and for all unknown words.
END, UNKNOWN = np.uint64(0x8F14E45FCEEA167A), np.uint64(0xC9F0F895FB98AB91)


def token_hashes(text: str | None) -> np.ndarray:
    return word_hashes(words(text.lower() if text else text))


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(h, n)``: how often each word (by hash) occurs in all texts."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            seen, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(seen.view("i8")), pa.array(n, pa.int64())], schema=schema)

        for part in parts:
            for text in part.column(0):
                held.append(token_hashes(text.as_py()))
                size += len(held[-1])
                if size >= 1 << 22:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def fit_vocabulary(docs: DataFrame, size: int, scratch: Scratch, text_col: str = "text") -> np.ndarray:
    """The sorted hashes of the most frequent words, ``size`` at most.

    Words are taken by whole frequency classes (eighths of a doubling), the most
    frequent first, as long as they fit: the driver reads a count for each class
    and the chosen words, never more, however many tasks there are.
    """
    counts = scratch.write(count_words(docs, text_col).withColumn("class", F.floor(8 * F.log2("n")).cast("int")), "words")
    room, least = size, None
    for of, n in sorted(counts.groupBy("class").count().collect(), reverse=True):  # 512 classes at most
        if n > room:
            break
        room, least = room - n, of
    top = counts.where(F.col("class") >= least).select("h").toPandas()["h"].to_numpy("i8") if least is not None else np.empty(0, "i8")
    scratch.drop("words")
    return np.sort(top.view("u8"))


def known_or_unknown(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, hashes)
    known = at < len(vocabulary)
    known[known] = vocabulary[at[known]] == hashes[known]
    return np.where(known, hashes, UNKNOWN)


def ngrams(different: np.ndarray, own: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens ``own`` (places in ``different``, the sorted words) of texts of ``lengths`` tokens, ends included.

    The token before each one, the sorted keys of all different words and pairs,
    the place among the keys of each of ``different``, and that of each token's pair.
    Keys of words are odd, those of pairs are even.
    """
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.cumsum(lengths) - lengths] = np.searchsorted(different, END)
    single = mix(different + _MIX[1]) | np.uint64(1)
    pair = mix(mix(different)[before] * _MIX[0] + different[own]) & ~np.uint64(1)
    keys, at = np.unique(np.concatenate([single, pair]), return_inverse=True)
    return before, keys, at[: len(different)], at[len(different) :]


def squeeze(x: np.ndarray) -> bytes:
    """Numbers, their first bytes first, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view("u1").reshape(len(x), x.itemsize).T.tobytes())


def expand(raw: bytes, kind: str) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "u1")
    return flat.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def cut_blocks(docs: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """``block, ids, words, tokens, lengths``: a row for each block of ``docs(doc_id, text)``.

    ``words``: the different words; ``tokens``: places among them; ``lengths``: tokens of each text.
    """
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary()), ("lengths", pa.binary())])
    shared = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)

    def block(number: int, ids: list, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        different, own = np.unique(np.concatenate(held), return_inverse=True)
        lengths = np.array([len(h) for h in held], "i8")
        yield from batches([(number, ids, squeeze(_steps(different)), squeeze(own.astype("u4")), squeeze(lengths))], schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, held, size = [], [], 0
        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                hashes = token_hashes(text.as_py())
                held.append(np.append(hashes if shared is None else known_or_unknown(hashes, shared.value), END))
                ids.append(doc_id)
                size += len(held[-1])
                if size >= BLOCK:
                    yield from block(number, ids, held)
                    ids, held, size, number = [], [], 0, number + 1
        if held:
            yield from block(number, ids, held)

    return docs.select("doc_id", "text").mapInArrow(run, "block long, ids array<long>, words binary, tokens binary, lengths binary")


def _read(words: bytes, tokens: bytes, lengths: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words, the tokens, and the number of tokens of each text."""
    return np.cumsum(expand(words, "u8")), expand(tokens, "u4"), expand(lengths, "i8")


def mark(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """``block, ids, words, tokens, lengths, target``: with the places of the texts whose doc_id is one of ``ids(doc_id)``, or null."""
    found = blocks.select("block", F.posexplode("ids").alias("place", "doc_id")).join(ids.hint("merge"), "doc_id")
    # the targets grow with the corpus: the same join at every size, no broadcast
    target = found.groupBy("block").agg(F.collect_list("place").alias("target"))
    return blocks.join(target.hint("merge"), "block", "left")


def own_counts(target: list[int] | None, own: np.ndarray, lengths: np.ndarray, word_at: np.ndarray, pair_at: np.ndarray, n: int) -> list[np.ndarray]:
    """How often a block has each of its ``n`` keys, in all its texts and in those at the places ``target``."""
    inside = np.zeros(len(lengths), bool)
    inside[target or []] = True
    return [np.bincount(np.concatenate([word_at[own[w]], pair_at[w]]), minlength=n).astype("u4") for w in (slice(None), np.repeat(inside, lengths))]


def count_blocks(marked: DataFrame, buckets: int) -> DataFrame:
    """``block, bucket, x, y, z``: what blocks send to buckets: keys, counts in all texts, counts in the target."""
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])

    def send(number: int, target: list[int] | None, different: np.ndarray, own: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
        _, keys, word_at, pair_at = ngrams(different, own, lengths)
        counts = own_counts(target, own, lengths, word_at, pair_at, len(keys))
        edges = np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype="u8"))
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if a < b:
                yield number, k, squeeze(_steps(keys[a:b])), squeeze(counts[0][a:b]), squeeze(counts[1][a:b])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number, target, *raw in zip(*part.columns, strict=True):
                yield from batches(send(number.as_py(), target.as_py(), *_read(*(x.as_py() for x in raw))), schema, 64)

    return marked.select("block", "target", "words", "tokens", "lengths").mapInArrow(run, "block long, bucket int, x binary, y binary, z binary")


def _by(key: str, parts: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each value of ``key``, from rows sorted by it."""
    held: list[dict] = []
    for part in parts:
        for at in range(part.num_rows):
            row = {n: part.column(n)[at].as_py() for n in part.schema.names}
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def add_up(sent: DataFrame) -> DataFrame:
    """``block, bucket, x, y, words, background, target``: each bucket's answers to the blocks, from rows of ``count_blocks``.

    ``x, y``: totals of the other blocks, in all texts and in the target, of the keys that the block
    sent. A bucket's row without a block has its number of different words and
    the tokens of both models that these are.
    """
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("words", pa.int64()), ("background", pa.int64()), ("target", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by("bucket", parts):
            keys = [np.cumsum(expand(r["x"], "u8")) for r in rows]
            ends = np.cumsum([len(k) for k in keys])[:-1]
            found, at = np.unique(np.concatenate(keys), return_inverse=True)
            totals, others = [], []
            for column in "yz":
                total, sent = np.zeros(len(found), "u8"), np.concatenate([expand(r[column], "u4") for r in rows]).astype("u8")
                np.add.at(total, at, sent)
                totals.append(total)
                others.append(np.split(total[at] - sent, ends))
            of_words = (found & np.uint64(1)).astype(bool)
            out = [(None, rows[0]["bucket"], None, None, int(of_words.sum()), *(int(t[of_words].sum()) for t in totals))]
            out += [(r["block"], r["bucket"], squeeze(a), squeeze(b), None, None, None) for r, a, b in zip(rows, *others, strict=True)]
            yield from batches(out, schema, 64)

    placed = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return placed.mapInArrow(run, "block long, bucket int, x binary, y binary, words long, background long, target long")


def log_probability(word: np.ndarray, context: np.ndarray, pair: np.ndarray, tokens: int, size: int, mixed: float) -> np.ndarray:
    """log of ``mixed`` x pair frequency + (1 - ``mixed``) x word frequency (one added to each word), from counts."""
    own = (word + 1.0) / (tokens + size)
    return np.log(np.where(context > 0, mixed * (pair / np.maximum(context, 1)) + (1 - mixed) * own, own))


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None, bits: int | None = None, mixed: float = 0.7, bucket_bytes: int = 24 << 20
) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: ``doc_id, n_tokens, loss_target, loss_background, score``.

    ``target_ids(doc_id)``: the documents of the target; repeats and ids that
    ``docs`` lacks do not matter. Tokens are lower-cased words and the end of the
    text, so a null or empty text has one token. Losses are in nats a token.
    Repeated rows count and are scored each; a null doc_id is never target.
    Without a target document the target model knows no word. Other columns are
    not read. No rows in, no rows out.

    All words are known, unless ``vocabulary`` limits them to the most frequent;
    the others are then one unknown word. ``bits`` has no effect: it was the size of
    shared counters, and pairs are now counted each for itself.
    """
    scratch = Scratch(docs.sparkSession, "lm", tidy=True)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocab = None if vocabulary is None else fit_vocabulary(base, vocabulary, scratch)
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    blocks = scratch.write(mark(scratch.write(cut_blocks(base, vocab), "cut"), ids), "blocks")
    scratch.drop("cut")
    totals = scratch.write(add_up(count_blocks(blocks, buckets_for(base, bucket_bytes, least=64))), "totals")
    stats = totals.where("block IS NULL").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "target", "background"))).first()
    # all words but the end; then unknown, begin and end
    size = (stats[0] - 1 if vocab is None else len(vocab)) + 3
    tokens = stats[1:]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("loss_target", pa.float64()), ("loss_background", pa.float64()), ("score", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, *answers in _by("block", parts):
            different, own, lengths = _read(block["x"], block["y"], block["z"])
            before, keys, word_at, pair_at = ngrams(different, own, lengths)
            starts = np.cumsum(lengths) - lengths
            losses = []
            all_texts, in_target = own_counts(block["target"], own, lengths, word_at, pair_at, len(keys))
            for column, mine, of in zip("yx", (in_target, all_texts), tokens, strict=True):
                count = np.concatenate([expand(r[column], "u8") for r in answers])
                assert len(count) == len(keys)
                count += mine
                single = count[word_at]
                losses.append(-np.add.reduceat(log_probability(single[own], single[before], count[pair_at], of, size, mixed), starts) / lengths)
            a, b = losses
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((block["ids"], lengths, a, b, a - b), schema, strict=True)], schema=schema)

    own = blocks.select("block", F.lit(-1).alias("bucket"), "ids", "target", F.col("words").alias("x"), F.col("tokens").alias("y"), F.col("lengths").alias("z"))
    back = totals.where("block IS NOT NULL").select("block", "bucket", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<int>").alias("target"), "x", "y", F.lit(None).cast("binary").alias("z"))
    together = own.unionByName(back).repartition("block").sortWithinPartitions("block", "bucket")
    return together.mapInArrow(run, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")
