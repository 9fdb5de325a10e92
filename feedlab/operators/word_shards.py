"""Word2Vec trained on shards of the texts, without a vocabulary on the driver.

Skip-gram with negative sampling.  One task learns from the first ``COMMON`` words or so,
then every shard goes on from there, once over its texts, and gives the vectors of the
words it met; a word's vector is the mean over the shards, weighted by its updates.
Shards, windows (each word's drawn anew up to the full size), sentences of at most
``SENTENCE`` words and first vectors near zero are MLlib's.  Unlike MLlib's trainer the
vocabulary is a table, the contexts are learnt against drawn words instead of along the
paths of a Huffman tree, a vector's step shrinks with its own past gradients instead of
with the share done, and shards have a common beginning: means of vectors that were
learnt apart from the start say little.

Words travel as 64-bit hashes, so words of the same hash, which are not expected below
billions of words, would share a vector.  A shard's task holds the hashes and counts of
the vocabulary, the vectors of the words it met and one batch of texts; the driver holds
nothing.  A shard learns in batches of neighbouring words, so the work is array
arithmetic on whole batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.operators.word_blocks import NEGATIVES, RATE, WINDOW, vocabulary
from feedlab.session import arrow_batches, input_bytes, map_arrow, materialize

# Words that are learnt from by one task before the shards part.
COMMON = 2_000_000
# Words of a text beyond which a new sentence begins, as in MLlib.
SENTENCE = 1_000

# Words of a batch: few at first, when every step changes the next one.
_LEAST_BATCH = 32
_BATCH = 4_096
_SHARED = 64
# Words of texts that are looked up at once.
_RUN = 1 << 17
# Stands between the words of a text that is dealt to a shard.
_SEP = "\0"
# Weight of the first vector of a word that no shard moved: next to any update it is nothing.
_UNMOVED = 1e-9
# Words in a row of the vocabulary as it is sent to shards.
_PACK = 4_096
_COUNTS, _VECTORS, _TEXT = 0, 1, 2
_LEARNT = "hash long, weight double, vec array<float>, rest array<float>"


def _first(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """First vectors, of the word's hash and the seed only: the same in every shard."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64)[:, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, size + 1, dtype=np.uint64)
        z ^= np.uint64(seed % (1 << 64)) * np.uint64(0xD6E8FEB86659FD93)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (((z >> np.uint64(11)) * 2.0 ** -53 - 0.5) / size).astype(np.float32)


def _sigmoid(x):
    x = np.clip(-x, -30, 30)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums(rows: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(rows[order], starts, axis=0)


class _Words:
    """Vocabulary and vectors of a shard.  Words get places as they are met, so the
    vectors take memory for these only (pages that were never touched take none)."""

    def __init__(self, hashes, counts, size, seed):
        order = np.argsort(hashes)
        self.hashes, counts = hashes[order], counts[order]
        begins = np.flatnonzero(np.append(True, self.hashes[1:] != self.hashes[:-1]))
        if len(begins) < len(order):
            self.hashes, counts = self.hashes[begins], np.add.reduceat(counts, begins)
        del order, begins
        self.size, self.seed, self.seen = size, seed, 0
        n = len(self.hashes)
        self.place = np.full(n, -1, dtype=np.int32)
        self.met = np.zeros(n, dtype=np.int32)
        self.n_met = 0
        self.inputs, self.outputs = (np.zeros((n, size), dtype=np.float32) for _ in range(2))
        self.in_step, self.out_step = np.zeros(n, dtype=np.float32), np.zeros(n, dtype=np.float32)
        self.updates = np.zeros(n, dtype=np.float32)
        self.share = np.cumsum(np.power(counts, 0.75, out=counts), out=counts)

    def begin(self, hashes, vectors, rest) -> None:
        """Goes on from vectors learnt before, with their outputs and steps in ``rest``."""
        at = self.places(np.searchsorted(self.hashes, hashes))
        self.inputs[at], self.outputs[at] = vectors, rest[:, :-2]
        self.in_step[at], self.out_step[at] = rest[:, -2], rest[:, -1]

    def rest(self, at) -> np.ndarray:
        return np.hstack([self.outputs[at], self.in_step[at, None], self.out_step[at, None]])

    def places(self, ids: np.ndarray) -> np.ndarray:
        new = np.unique(ids[self.place[ids] < 0])
        if len(new):
            at = np.arange(self.n_met, self.n_met + len(new))
            self.place[new], self.met[at] = at, new
            self.inputs[at] = _first(self.hashes[new], self.size, self.seed)
            self.n_met += len(new)
        return self.place[ids]

    def drawn(self, rng) -> np.ndarray:
        ids = np.searchsorted(self.share, rng.random(_SHARED) * self.share[-1], side="right")
        return self.places(np.minimum(ids, len(self.share) - 1))


def _move(vectors, step, rows, gradient, rate):
    step[rows] += (gradient * gradient).mean(axis=1)
    vectors[rows] += rate * gradient / np.sqrt(step[rows] + 1e-12)[:, None]


def _learn(w: _Words, at: np.ndarray, sentence: np.ndarray, reach: np.ndarray, n: int, window: int, negatives: int,
           rate: float, rng) -> None:
    """One step over ``n`` words, by place, followed by up to ``window`` words of the
    next batch: a pair belongs to the batch of its left word.  A word is predicted from
    those up to its ``reach`` apart; the batch shares one draw of ``_SHARED`` words, which
    count as ``negatives`` for each pair."""
    # a row a dimension: the operations run along the words
    u, v = np.ascontiguousarray(w.inputs[at].T), np.ascontiguousarray(w.outputs[at].T)
    du, dv, space = np.zeros_like(u), np.zeros_like(v), np.empty_like(u)
    pairs = np.zeros(len(at), dtype=np.float32)
    for d in range(1, window + 1):
        k = min(n, len(at) - d)
        if k <= 0:
            break
        same = sentence[:k] == sentence[d:d + k]
        left, right, product = slice(0, k), slice(d, d + k), space[:, :k]
        for given, wanted in ((right, left), (left, right)):
            used = (same & (reach[wanted] >= d)).astype(np.float32)
            miss = np.multiply(u[:, given], v[:, wanted], out=product).sum(axis=0)
            miss = (1 - _sigmoid(miss)) * used
            du[:, given] += np.multiply(miss, v[:, wanted], out=product)
            dv[:, wanted] += np.multiply(miss, u[:, given], out=product)
            pairs[given] += used
    other = w.drawn(rng)
    far = w.outputs[other]
    # a drawn word that is the given one says nothing
    away = _sigmoid(far @ u)
    away *= pairs * np.float32(negatives / _SHARED)
    away *= other[:, None] != at[None, :]
    du -= far.T @ away
    order = np.argsort(at, kind="stable")
    ends = at[order]
    starts = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    rows = ends[starts]
    w.updates[rows] += np.add.reduceat(pairs[order], starts)
    _move(w.inputs, w.in_step, rows, _sums(du.T, order, starts), rate)
    _move(w.outputs, w.out_step, rows, _sums(dv.T, order, starts), rate)
    order = np.argsort(other, kind="stable")
    ends = other[order]
    starts = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    _move(w.outputs, w.out_step, ends[starts], _sums(-(away @ u.T), order, starts), rate)


def _numbers(lists: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every hash in the lists its place in the sorted ``hashes``, -1 if it has none, and its list's."""
    ends = lists.offsets.to_numpy()
    values, at = np.unique(lists.values.to_numpy()[ends[0]:ends[-1]], return_inverse=True)
    number = np.searchsorted(hashes, values)
    number[number == len(hashes)] = 0
    number[hashes[number] != values] = -1
    return number[at], np.repeat(np.arange(len(lists)), np.diff(ends))


def _runs(lists: pa.Array):
    """The lists in runs of about ``_RUN`` values."""
    ends = lists.offsets.to_numpy()
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _RUN, side="right")) - 1)
        yield lo, lists.slice(lo, hi - lo)
        lo = hi


def _lists(rows: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))


def _vectors(hashes, weight, vectors, rest=None) -> pa.RecordBatch:
    rest = pa.nulls(len(hashes), pa.list_(pa.float32())) if rest is None else _lists(rest)
    return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(weight.astype(np.float64)), _lists(vectors), rest],
                                      names=["hash", "weight", "vec", "rest"])


def _train(size: int, seed: int, window: int, negatives: int, rate: float):
    """Rows of a shard in the order of ``ord``: its vocabulary, then its texts.  Shard -1 is
    the common beginning."""
    def learn_from(w, lists, rng):
        ids, text = _numbers(lists, w.hashes)
        known = ids >= 0
        ids, text = ids[known], text[known]
        if not len(ids):
            return
        begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        place_in_text = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
        sentence = text * (1 << 32) + place_in_text // SENTENCE
        at, reach = w.places(ids), rng.integers(1, window + 1, len(ids))
        lo = 0
        while lo < len(at):
            n = min(_BATCH, max(_LEAST_BATCH, w.seen // 8), len(at) - lo)
            part = slice(lo, lo + n + window)
            _learn(w, at[part], sentence[part], reach[part], n, window, negatives, rate, rng)
            w.seen += n
            lo += n

    def rows(w, shard):
        # a word's weight in the mean; unmoved ones come once, with the vector they have
        for lo in range(0, w.n_met, 10_000):
            at = np.arange(lo, min(lo + 10_000, w.n_met))
            if shard > 0:
                at = at[w.updates[at] > 0]
            yield _vectors(w.hashes[w.met[at]], np.maximum(w.updates[at], _UNMOVED), w.inputs[at],
                           w.rest(at) if shard < 0 else None)
        if shard == 0:
            still = w.hashes[w.place < 0]
            for lo in range(0, len(still), 10_000):
                part = still[lo:lo + 10_000]
                yield _vectors(part, np.full(len(part), _UNMOVED), _first(part, size, seed))

    def run(batches):
        known, begun, w, shard, rng = [], [], None, None, None

        def ready():
            hashes, counts = (np.concatenate(x) for x in zip(*known))
            known.clear()
            w = _Words(hashes, counts, size, seed)
            del hashes, counts
            for hashes, rows in begun:
                w.begin(hashes, rows[:, :size], rows[:, size:])
            begun.clear()
            return w

        for b in batches:
            if not b.num_rows:
                continue
            if shard is None:
                shard = b.column(0)[0].as_py()
                rng = np.random.default_rng([seed % (1 << 32), shard + 1])
            kind = b.column(1).to_numpy()
            for i in np.flatnonzero(kind != _TEXT).tolist():
                hashes, numbers = (b.column(c)[i].values.to_numpy() for c in (2, 3))
                if kind[i] == _COUNTS:
                    known.append((hashes.copy(), numbers.astype(float)))
                else:
                    begun.append((hashes, numbers.reshape(len(hashes), -1)))
            cut = int((kind != _TEXT).sum())
            if cut < b.num_rows:
                w = w or ready()
                for _, lists in _runs(b.column(2).slice(cut)):
                    learn_from(w, lists, rng)
        if shard is not None:
            yield from rows(w or ready(), shard)
        w = None
        pa.default_memory_pool().release_unused()
    return run


def _dealt(tokens) -> list:
    """A row's words as columns ``_text`` and ``_tokens``: one text, which takes less room than
    an array, or the array where the text would not give back the words."""
    tokens = F.col(tokens)
    text = F.array_join(tokens, _SEP)
    odd = (text == "") | F.exists(tokens, lambda x: x.isNull() | x.contains(_SEP))
    return [F.when(~odd, text).alias("_text"),
            F.when(odd | tokens.isNull(), tokens).otherwise(F.array().cast("array<string>")).alias("_tokens")]


def _words():
    return F.when(F.col("_text").isNull(), F.col("_tokens")).otherwise(F.split("_text", _SEP, -1))


def _hashes():
    """Hashes of the words dealt, and none of a row without words."""
    return F.coalesce(F.transform(_words(), lambda x: F.xxhash64(x)), F.array().cast("array<long>"))


def _packed(df: DataFrame, kind: int, numbers, shards) -> DataFrame:
    """``(_shard, _kind, _hashes, _numbers)``: for each shard the ``hash`` and ``numbers`` of all
    rows, a few thousand to a row.  (Spark's Arrow writer takes the square of a batch's rows
    where lists are null, so there are few such rows and no null lists.)"""
    packs = max(1, -(-df.count() // _PACK))
    rows = (df.groupBy(F.pmod("hash", F.lit(packs)).alias("_pack"))
            .agg(F.collect_list(F.struct("hash", numbers.cast("array<float>").alias("x"))).alias("p")))
    return rows.select(F.explode(F.array(*map(F.lit, shards))).alias("_shard"), F.lit(kind).alias("_kind"),
                       F.col("p.hash").alias("_hashes"), F.flatten("p.x").alias("_numbers"))


def fit_word_shards(docs: DataFrame, tokens: str, size: int, min_count: int, seed: int, partitions: int,
                    window: int = WINDOW, negatives: int = NEGATIVES, rate: float = RATE) -> DataFrame:
    """``(word, hash, vec)`` of every word that occurs ``min_count`` times or more, as a stored
    table.  Rare words are left out before windows are formed; a word without neighbours
    keeps its first vector.  One shard repeats exactly whatever the partitioning of ``docs``."""
    words = materialize(vocabulary(docs, tokens, min_count).withColumn("hash", F.xxhash64("word")), "words")
    if words.isEmpty():
        raise ValueError("The vocabulary size should be > 0. You may need to check the setting of minCount, "
                         "which could be large enough to remove all your words in sentences.")
    total = words.agg(F.sum("n")).first()[0]
    common = 1.0 if partitions == 1 else min(1.0, COMMON / total)
    row = F.monotonically_increasing_id()
    texts = docs.where(F.size(tokens) > 1).select(
        F.when(F.pmod(F.xxhash64(row), F.lit(1 << 30)) < int(common * (1 << 30)), -1)
        .otherwise(F.pmod(row, F.lit(partitions))).cast("int").alias("_shard"), F.lit(_TEXT).alias("_kind"),
        F.xxhash64(tokens).bitwiseAND(F.lit((1 << 62) - 1)).alias("_ord"), *_dealt(tokens),
        *[F.array().cast(t).alias(c) for c, t in (("_hashes", "array<long>"), ("_numbers", "array<float>"))])

    def learnt(known: DataFrame, texts: DataFrame, tasks: int) -> DataFrame:
        known = known.withColumns({"_ord": F.lit(-1).cast("long"), "_text": F.lit(None).cast("string"),
                                   "_tokens": F.array().cast("array<string>")})
        hashes = F.when(F.col("_kind") == _TEXT, _hashes()).otherwise(F.col("_hashes"))
        dealt = (known.unionByName(texts).repartitionById(tasks, F.greatest("_shard", F.lit(0)))
                 .sortWithinPartitions("_ord").select("_shard", "_kind", hashes.alias("_hashes"), "_numbers"))
        return map_arrow(dealt, _train(size, seed, window, negatives, rate), _LEARNT)

    counts = F.array("n")
    with arrow_batches(docs.sparkSession):
        first = materialize(learnt(_packed(words, _COUNTS, counts, [-1]), texts.where("_shard < 0"), 1), "common_vectors")
    # where no texts are left one shard gives the words not met their first vectors
    shards = list(range(partitions if common < 1 else 1))
    known = _packed(words, _COUNTS, counts, shards).unionByName(
        _packed(first, _VECTORS, F.concat("vec", "rest"), shards))
    rows = learnt(known, texts.where("_shard >= 0"), len(shards))
    weight = F.sum("weight")
    mean = F.array(*[(F.sum(F.col("vec")[i] * F.col("weight")) / weight).cast("float") for i in range(size)])
    # dealt first: a word has one row a shard, sums before the shuffle would only be larger
    vectors = rows.repartition("hash").groupBy("hash").agg(mean.alias("vec"))
    with arrow_batches(docs.sparkSession):
        return materialize(words.select("word", "hash").join(vectors, "hash").select("word", "hash", "vec"), "word_vectors")


def _means(size: int, words: int):
    """Vectors of words, then texts as lists of hashes, which get the mean of their words' vectors."""
    def run(batches):
        pa.default_memory_pool().release_unused()
        # the last row is of words without a vector
        table, known, n, order = np.zeros((words + 1, size), dtype=np.float32), np.empty(words, dtype=np.int64), 0, None
        for b in batches:
            kind = b.column(0).to_numpy()
            for i in np.flatnonzero(kind != _TEXT).tolist():
                hashes = b.column(2)[i].values.to_numpy()
                known[n:n + len(hashes)] = hashes
                table[n:n + len(hashes)] = b.column(3)[i].values.to_numpy().reshape(-1, size)
                n += len(hashes)
            cut = int((kind != _TEXT).sum())
            if cut == b.num_rows:
                continue
            if order is None:
                order = np.append(np.argsort(known), words).astype(np.int32)
                known = known[order[:-1]]
            for lo, lists in _runs(b.column(2).slice(cut)):
                ids, text = _numbers(lists, known)
                sums = np.zeros((len(lists), size))
                if len(ids):
                    begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
                    sums[text[begins]] = np.add.reduceat(table[order[ids]], begins, axis=0, dtype=np.float64)
                mean = sums / np.maximum(np.diff(lists.offsets.to_numpy()), 1)[:, None]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(cut + lo, len(lists)), _lists(mean)],
                                                 names=["_id", "_mean"])
    return run


class WordVectors:
    """A fitted model: the methods of MLlib's ``Word2VecModel`` that the library uses,
    over a stored table ``(word, hash, vec)``."""

    def __init__(self, vectors: DataFrame, size: int, col: str, out: str):
        self.vectors, self.size, self.col, self.out = vectors, size, col, out

    def getVectors(self) -> DataFrame:  # noqa: N802
        return self.vectors.select("word", array_to_vector(F.col("vec").cast("array<double>")).alias("vector"))

    def findSynonyms(self, word: str, num: int) -> DataFrame:  # noqa: N802
        """The ``num`` words most similar to ``word``, itself left out, and the cosines."""
        own = self.vectors.where(F.col("word") == word).select("vec").first()
        if own is None:
            raise ValueError(f"{word} not in vocabulary")
        q = np.asarray(own["vec"], dtype=float)
        q /= np.linalg.norm(q) or 1.0
        other = F.array(*[F.lit(float(x)) for x in q])
        dot = F.aggregate(F.zip_with("vec", other, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
        norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        found = self.vectors.where(F.col("word") != word).select(
            "word", F.coalesce(F.try_divide(dot, norm), F.lit(0.0)).alias("similarity"))
        return found.orderBy(F.col("similarity").desc(), F.col("word")).limit(num)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean vector of each row's words: unknown ones add nothing but
        count; a row without words has zeros.

        The means of distinct texts, known by a 64-bit hash, are written first.  Texts meet
        the vectors in as many tasks as the stored rows take the vectors' room, so copies of
        the vectors take no more room than the rows; a task holds all vectors."""
        tasks = max(2, -(-input_bytes(df) // max(1, input_bytes(self.vectors))))
        texts = df.where(F.size(self.col) > 0).select(
            F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int").alias("_shard"), F.lit(_TEXT).alias("_kind"),
            F.xxhash64(self.col).alias("_id"), F.array().cast("array<long>").alias("_hashes"),
            F.array().cast("array<float>").alias("_numbers"), *_dealt(self.col))
        vectors = _packed(self.vectors, _VECTORS, F.col("vec"), range(tasks)).select(
            "*", F.lit(0).cast("long").alias("_id"), F.lit(None).cast("string").alias("_text"),
            F.array().cast("array<string>").alias("_tokens"))
        hashes = F.when(F.col("_kind") == _TEXT, _hashes()).otherwise(F.col("_hashes"))
        met = (vectors.unionByName(texts).repartitionById(tasks, "_shard").sortWithinPartitions("_kind")
               .select("_kind", "_id", hashes.alias("_hashes"), "_numbers"))
        with arrow_batches(df.sparkSession):
            means = materialize(map_arrow(met, _means(self.size, self.vectors.count()), "_id long, _mean array<double>"), "means")
        # one mean of a text that occurs more than once
        means = means.groupBy("_id").agg(F.any_value("_mean").alias("_mean")).hint("shuffle_hash")
        mean = F.coalesce("_mean", F.array_repeat(F.lit(0.0), self.size))
        rows = df.withColumn("_id", F.when(F.size(self.col) > 0, F.xxhash64(self.col)))
        return rows.join(means, "_id", "left").select(*df.columns, array_to_vector(mean).alias(self.out))
