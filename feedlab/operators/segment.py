"""Segmentation of scripts without spaces, from the corpus itself.

A run is a stretch of text without a word boundary (a run of Han characters).
``lexicon`` finds the corpus' words by aggregates alone: a character n-gram is a
word if it is frequent, holds together (pointwise mutual information of its
weakest split) and stands free (entropy of the characters beside it).
``segment`` cuts every run along the path of largest word probability.  No
dictionary file.

Scale: equal runs are counted first; only the longest n-gram at each character
is exploded and counted, the shorter ones are prefixes of the counted ones;
the splits and the neighbours join or group on the n-gram, of which there are
far fewer than characters.  A lexicon of up to ``TABLE_WORDS`` words goes to the
tasks as a table and a run is cut where it lies, without a shuffle.  A larger one
meets the runs' candidate pieces in an equi-join on the piece; these return
grouped by run.  Both ways give the same cuts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlab.functions.strings import col_of
from feedlab.session import map_arrow, materialize

HAN_RUN = r"\p{IsHan}+"
MAX_WORD = 4
MIN_COUNT = 5
MIN_PMI = 1.0
MIN_ENTROPY = 0.5
DIGITS = 6
BLOCK_CHARS = 256
# Largest lexicon that travels as a table, its largest alphabet (codes of words fit
# 63 bits) and the number of codes up to which a length is looked up by position.
TABLE_WORDS = 1_000_000
TABLE_CHARS = 50_000
_DENSE = 1 << 21
# Characters of the runs cut at once.
_CUT_CHARS = 1 << 20


def unspaced_runs(c, pattern: str = HAN_RUN) -> Column:
    """Text -> its runs in order; null text -> ``[]``."""
    runs = F.regexp_extract_all(F.lower(col_of(c)), F.lit(pattern), 0)
    return F.coalesce(runs, F.array().cast("array<string>"))


def run_counts(df: DataFrame, runs: str = "runs") -> DataFrame:
    """Distinct runs with their number: ``(run, n)``."""
    return (df.select(F.explode(runs).alias("run")).filter(F.col("run") != "")
            .groupBy("run").agg(F.count(F.lit(1)).alias("n")))


def _starts(counted: DataFrame, longest: int, *carry: str) -> DataFrame:
    """Every character of the runs: ``(carry.., _at, _s, _part)``, the one at ``_s`` of the
    text ``_part``, which holds the ``longest`` - 1 characters after it too, if there are any.
    A long run is cut into overlapping blocks first: finding a character takes
    time linear in the text it is looked up in."""
    b = F.col("_b") * BLOCK_CHARS
    blocks = counted.select("run", *carry, F.explode(F.sequence(
        F.lit(0), F.floor((F.length("run") - 1) / BLOCK_CHARS).cast("int"))).alias("_b"))
    blocks = blocks.select(*carry, b.alias("_at"), F.least(F.lit(BLOCK_CHARS), F.length("run") - b).alias("_own"),
                           F.substring(F.col("run"), b + 1, F.lit(BLOCK_CHARS + longest - 1)).alias("_part"))
    return blocks.select("_part", "_at", *carry, F.explode(F.sequence(F.lit(1), F.col("_own"))).alias("_s"))


def _pieces(counted: DataFrame, longest: int, *carry: str) -> DataFrame:
    """Every piece of up to ``longest`` characters: ``(carry.., start, gram)``, start from 1."""
    sizes = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("_part") - F.col("_s") + 1))
    return _starts(counted, longest, *carry).select(*carry, (F.col("_at") + F.col("_s")).alias("start"), F.explode(
        F.transform(sizes, lambda k: F.substring(F.col("_part"), F.col("_s"), k))).alias("gram"))


def ngrams(counted: DataFrame, longest: int) -> DataFrame:
    """Occurrences of every n-gram: ``(gram, count)``.  The n-grams that start at a
    character are the prefixes of the longest one, so only that one is counted there."""
    heads = (_starts(counted, longest, "n").select(F.substring(F.col("_part"), F.col("_s"), F.lit(longest)).alias("head"), "n")
             .groupBy("head").agg(F.sum("n").alias("n")))
    prefixes = F.transform(F.sequence(F.lit(1), F.length("head")), lambda k: F.substring(F.col("head"), F.lit(1), k))
    return heads.select("n", F.explode(prefixes).alias("gram")).groupBy("gram").agg(F.sum("n").alias("count"))


def _entropy(grams: DataFrame, part: Column, out: str) -> DataFrame:
    """Entropy of the one character by which longer n-grams extend ``part``."""
    x = F.col("count").cast("double")
    return (grams.filter(F.length("gram") > 1).groupBy(part.alias("gram"))
            .agg(F.sum(x).alias("_s"), F.sum(x * F.log(x)).alias("_t"))
            .select("gram", F.round(F.log("_s") - F.col("_t") / F.col("_s"), DIGITS).alias(out)))


def lexicon(counted: DataFrame, longest: int = MAX_WORD, min_count: int = MIN_COUNT, min_pmi: float = MIN_PMI,
            min_entropy: float = MIN_ENTROPY) -> DataFrame:
    """``(term, count, pmi, entropy, logp)`` of the corpus' words.

    Words of two or more characters occur ``min_count`` times at least, have a
    pointwise mutual information of ``min_pmi`` at their weakest split, and an
    entropy of ``min_entropy`` on the side that varies less.  Single characters
    are always words, so every run has a path; their pmi and entropy are null.
    ``logp`` is the share of a word's count in all words' counts, as a logarithm.
    """
    grams = materialize(ngrams(counted, longest + 1), "ngrams")
    n = F.length("gram")
    total = grams.filter(n == 1).agg(F.sum("count").cast("double")).scalar()
    frequent = grams.filter((n >= 2) & (n <= longest) & (F.col("count") >= min_count))
    splits = frequent.withColumn("_total", total).select(
        "gram", "count", "_total", F.explode(F.sequence(F.lit(1), n - 1)).alias("_k")).select(
        "gram", "count", "_total", F.substring(F.col("gram"), F.lit(1), F.col("_k")).alias("left"),
        F.expr("substring(gram, _k + 1)").alias("right"))
    left, right = (grams.select(F.col("gram").alias(s), F.col("count").alias(f"_{s}")) for s in ("left", "right"))
    pmi = F.log(F.col("count") * F.col("_total") / (F.col("_left").cast("double") * F.col("_right")))
    weakest = (splits.join(left, "left").join(right, "right").groupBy("gram", "count")
               .agg(F.round(F.min(pmi), DIGITS).alias("pmi")).filter(F.col("pmi") >= min_pmi))
    after = _entropy(grams, F.expr("left(gram, length(gram) - 1)"), "_after")
    before = _entropy(grams, F.expr("substring(gram, 2)"), "_before")
    # a neighbour that never varies, or is never there, has entropy 0
    free = F.least(F.coalesce("_after", F.lit(0.0)), F.coalesce("_before", F.lit(0.0)))
    words = (weakest.join(after, "gram", "left").join(before, "gram", "left").withColumn("entropy", free)
             .filter(F.col("entropy") >= min_entropy).select("gram", "count", "pmi", "entropy"))
    none = F.lit(None).cast("double")
    single = grams.filter(n == 1).select("gram", "count", none.alias("pmi"), none.alias("entropy"))
    found = materialize(words.unionByName(single), "lexicon")
    mass = found.agg(F.sum("count").cast("double")).scalar()
    return found.withColumn("_mass", mass).select(
        F.col("gram").alias("term"), "count", "pmi", "entropy",
        F.round(F.log(F.col("count") / F.col("_mass")), DIGITS).alias("logp"))


class _Words:
    """A lexicon as tables: ``logp`` by length and by the code of a word's characters;
    -inf where there is no such word."""

    def __init__(self, terms: list[str], logp: np.ndarray, longest: int):
        points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in terms]
        used = np.unique(np.concatenate(points)) if points else np.zeros(0, dtype=np.uint32)
        self.base = len(used) + 1
        # characters of no word share the last number
        self.number = np.full(0x110000, len(used), dtype=np.int32)
        self.number[used] = np.arange(len(used))
        size = np.array([len(x) for x in points], dtype=np.int64)
        self.longest, self.tables = longest, []
        for n in range(1, longest + 1):
            at = np.flatnonzero(size == n)
            code = self._codes([self.number[np.array([points[i][k] for i in at], dtype=np.int64)] for k in range(n)])
            order = np.argsort(code)
            code, values = code[order], logp[at][order]
            if self.base ** n <= _DENSE:
                dense = np.full(self.base ** n, -np.inf)
                dense[code] = values
                code, values = None, dense
            self.tables.append((code, values))

    def _codes(self, numbers) -> np.ndarray:
        code = np.zeros(len(numbers[0]), dtype=np.int64)
        for x in numbers:
            code = code * self.base + x
        return code

    def starting(self, chars: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """By length: ``logp`` of the word that starts at each character; none crosses
        the end of its run (``ends``: the position after it, by character)."""
        number = self.number[chars].astype(np.int64)
        code, out = np.zeros(len(chars), dtype=np.int64), []
        for n, (known, values) in enumerate(self.tables, 1):
            code = code[:len(chars) - n + 1] * self.base + number[n - 1:] if len(chars) >= n else code[:0]
            if known is None:
                found = values[code]
            elif len(known):
                at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                found = np.where(known[at] == code, values[at], -np.inf)
            else:
                found = np.full(len(code), -np.inf)
            logp = np.full(len(chars), -np.inf)
            logp[:len(code)] = np.where(np.arange(n, n + len(code)) <= ends[:len(code)], found, -np.inf)
            out.append(logp)
        return out


def _word_ends(words: _Words, chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the last characters of the words, for runs of ``sizes`` characters
    laid end to end.  All parts (see ``segment``) advance together, a character a step."""
    total = len(chars)
    if not total:
        return np.zeros(0, dtype=np.int64)
    logp = words.starting(chars, np.repeat(np.cumsum(sizes), sizes))
    joined = np.zeros(total + 1, dtype=bool)  # a word spans the cut before this character
    for n, p in enumerate(logp, 1):
        at = np.flatnonzero(p > -np.inf)
        for k in range(1, n):
            joined[at + k] = True
    first = np.flatnonzero(~joined[:total])
    length = np.diff(np.append(first, total))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    # how many parts have more than t characters
    more = np.searchsorted(-length, -np.arange(length[0]), side="left")
    best, back = np.zeros(total), np.ones(total, dtype=np.int32)
    for t, parts in enumerate(more.tolist()):
        at = first[:parts] + t
        top, size = np.full(parts, -np.inf), np.ones(parts, dtype=np.int32)
        for n in range(min(words.longest, t + 1), 0, -1):
            sums = logp[n - 1][at - n + 1] + (best[at - n] if n <= t else 0.0)
            better = sums > top
            top[better], size[better] = sums[better], n
        best[at], back[at] = top, size
    is_end = np.zeros(total, dtype=bool)
    at = first + length - 1
    while len(at):
        is_end[at] = True
        at = at - back[at]
        on = at >= first
        at, first = at[on], first[on]
    return np.flatnonzero(is_end)


def _cut(lexicon):
    """Runs -> ``(run, terms)`` by the lexicon's tables."""
    def batches_of(runs: pa.StringArray):
        sizes = np.cumsum(pc.utf8_length(runs).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(runs):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _CUT_CHARS, side="right")))
            yield runs.slice(at, to - at)
            at = to

    def run(batches):
        words = lexicon.value
        for b in batches:
            for runs in batches_of(b.column(0)):
                sizes = pc.utf8_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
                text = "".join(runs.to_pylist())
                chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
                ends = _word_ends(words, chars, sizes)
                width = 1 + (chars > 0x7F).astype(np.int32) + (chars > 0x7FF) + (chars > 0xFFFF)
                offsets = np.concatenate([[0], np.cumsum(width)[ends]]).astype(np.int32)
                terms = pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(text.encode()))
                lists = np.concatenate([[0], np.searchsorted(ends, np.cumsum(sizes))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([runs, pa.ListArray.from_arrays(pa.array(lists), terms)], ["run", "terms"])
    return run


def segment(counted: DataFrame, words: DataFrame, longest: int = MAX_WORD) -> DataFrame:
    """``(run, terms)``: each distinct run along its path of largest summed
    ``logp``; of equal paths the one with the longer last word, at every cut.

    Every character must be a word (``lexicon``).  A boundary that no candidate word
    spans lies on every path, so a run is cut there and the parts, a few characters
    long, are searched on their own.
    """
    size = F.length("term")
    words = words.where(size.between(1, longest)).select("term", "logp")
    chars = words.where(size == 1)
    if words.limit(TABLE_WORDS + 1).count() > TABLE_WORDS or chars.limit(TABLE_CHARS + 1).count() > TABLE_CHARS:
        return _segment_joined(counted, words, longest)
    table = words.toArrow()
    lexicon = counted.sparkSession.sparkContext.broadcast(
        _Words(table["term"].to_pylist(), table["logp"].to_numpy(), longest))
    return map_arrow(counted.select("run").where(F.col("run").isNotNull()), _cut(lexicon), "run string, terms array<string>")


def _segment_joined(counted: DataFrame, words: DataFrame, longest: int = MAX_WORD) -> DataFrame:
    """``segment`` for a lexicon of any size."""
    # a run travels as a number: its text would repeat with every piece
    numbered = materialize(counted.select("run").withColumn("_run", F.monotonically_increasing_id()), "numbered_runs")
    lex = words.select(F.col("term").alias("gram"), "logp")
    found = _pieces(numbered, longest, "_run").join(lex, "gram").withColumn("end", F.col("start") + F.length("gram") - 1)
    by_start = Window.partitionBy("_run").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("_new", F.when(F.col("start") > F.coalesce(reach, F.lit(0)), 1).otherwise(0))
    found = found.withColumn("_part", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    # candidate words by their last character, the longest first
    word = F.struct("end", (-F.length("gram")).alias("back"), "logp", "gram")
    parts = found.groupBy("_run", "_part").agg(F.min("start").alias("_first"),
                                               F.array_sort(F.collect_list(word)).alias("_words"))
    start = F.struct(F.array(F.lit(0.0)).alias("best"), F.array().cast("array<struct<back:int,gram:string>>").alias("steps"))

    def step(state, w):
        # best: the largest sums up to each of the last characters, the nearest
        # last; steps: the last word on the way there, one per character
        best, steps = state["best"], state["steps"]
        fresh = w["end"] - F.col("_first") + 1 > F.size(steps)
        total = F.element_at(best, F.when(fresh, w["back"]).otherwise(w["back"] - 1)) + w["logp"]
        taken = F.array(F.struct(w["back"].alias("back"), w["gram"].alias("gram")))
        push = F.struct(F.slice(F.concat(best, F.array(total)), F.greatest(F.lit(1), F.size(best) + 1 - longest),
                                longest + 1).alias("best"), F.concat(steps, taken).alias("steps"))
        swap = F.struct(F.concat(F.slice(best, F.lit(1), F.size(best) - 1), F.array(total)).alias("best"),
                        F.concat(F.slice(steps, F.lit(1), F.size(steps) - 1), taken).alias("steps"))
        return F.when(fresh, push).when(total > F.element_at(best, -1), swap).otherwise(state)

    parts = parts.select("_run", "_part", F.aggregate("_words", start, step)["steps"].alias("_steps"))
    # from the end back: only the positions where a word of the path ends
    walk = F.aggregate(F.reverse(F.sequence(F.lit(1), F.size("_steps"))),
                       F.struct(F.size("_steps").alias("at"), F.array().cast("array<string>").alias("terms")),
                       lambda s, i: F.when(i == s["at"], F.struct(
                           (i + F.element_at("_steps", i)["back"]).alias("at"),
                           F.concat(s["terms"], F.array(F.element_at("_steps", i)["gram"])).alias("terms"))).otherwise(s))
    cut = parts.select("_run", F.struct("_part", F.reverse(walk["terms"]).alias("terms")).alias("_x"))
    whole = cut.groupBy("_run").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
    return whole.join(numbered, "_run").select("run", F.flatten(F.transform("_xs", lambda x: x["terms"])).alias("terms"))


def tokenize_runs(df: DataFrame, key: str, runs: str, segmented: DataFrame) -> DataFrame:
    """``(key, position, term)``: the words of each row's runs, in order."""
    rows = df.select(key, F.posexplode(runs).alias("_r", "run")).filter(F.col("run") != "")
    out = rows.join(segmented, "run").select(key, "_r", F.posexplode("terms").alias("_w", "term"))
    return out.select(key, F.struct(F.col("_r").alias("run"), F.col("_w").alias("word")).alias("position"), "term")
