"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document and leaves one bit; the measurements
behind the rules stay beside it.  A policy is a named, versioned mask over the
ledger, so applying another policy, or asking what one rule changes (an
ablation), is bit arithmetic and aggregation over the stored ledger: no text
is read again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from feedlab.llm.common import SPACES, map_arrow, text_bytes, without_spaces

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 3


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; ``bit`` never changes its meaning."""
    bit: int
    name: str
    failed: str


# Integer arithmetic only, so every engine decides the same.
RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "100 * n_symbols > 8 * word_chars"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "long_words", "word_chars > 40 * n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
    Rule(6, "some_symbols", "100 * n_symbols > 3 * word_chars"),
    Rule(7, "some_duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(8, "some_repetition", "100 * n_repeat_words > 20 * n_words"),
    Rule(9, "no_words", "n_words = 0"),
)
BITS = {r.name: r.bit for r in RULES}


def mask(*names: str) -> int:
    return sum(1 << BITS[n] for n in names)


BASE_MASK = mask("too_few_words", "repeated_windows")
# Versions are only ever added.  A policy drops a document when it fails a rule
# of its mask.
POLICIES: Mapping[str, int] = {
    "base-1": BASE_MASK,
    "main-1": BASE_MASK | mask("symbol_heavy", "duplicate_lines", "long_words", "short_words", "no_words"),
    "strict-1": BASE_MASK | mask("symbol_heavy", "duplicate_lines", "long_words", "short_words", "no_words",
                                 "some_symbols", "some_duplicate_lines", "some_repetition"),
}
DEFAULT_POLICY = "main-1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_window_words(words: list, k: int = WINDOW_WORDS) -> int:
    """Words covered by a k-word window that occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(k))))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + k - max(i, upto)
            upto = i + k
    return covered


# Texts measured, and rows handed on, at a time.
_RUN = 500


def _measure(text: str, drop: bool):
    """The measurements of the column ``text``, which stays beside them unless ``drop``."""
    def run(batches):
        for whole in batches:
            for b in (whole.slice(at, _RUN) for at in range(0, whole.num_rows, _RUN)):
                cols: list[list[int]] = [[], [], [], []]
                for value in b.column(text).cast(pa.binary()):
                    t = value.as_py() or b""
                    words = t.split()
                    lines = [x for x in t.split(b"\n") if x.split()] if b"\n" in t else [t] if words else []
                    for out, v in zip(cols, (len(words), len(lines), len(lines) - len(set(lines)),
                                             repeated_window_words(words))):
                        out.append(v)
                keep = [i for i, n in enumerate(b.schema.names) if n != text or not drop]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in keep] + [pa.array(c, pa.int64()) for c in cols],
                    names=[b.schema.names[i] for i in keep] + ["n_words", "n_lines", "n_dup_lines", "n_repeat_words"])
    return run


def failure_bits(rules=RULES) -> Column:
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0)))
    return bits


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=RULES,
           carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the measurements, ``failures`` (a bit per failed rule) and the
    columns ``carry``, one row per row.

    A null text has no words.  Words are runs of characters outside
    U+0009-U+000D and space; lines are what stands between \\n.  Null and
    repeated ids pass through, an empty table stays empty, other columns are
    ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    # a carried text goes to the workers once: it is measured where it stands
    own_text = text not in carry or docs.schema[text].dataType != StringType()
    measured_text = "__text" if own_text else f"__carry{carry.index(text)}"
    src = docs.select(F.col(doc_id).alias("doc_id"),
                      F.length(without_spaces(whole)).cast("long").alias("word_chars"),
                      (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                      *([text_bytes(text).alias("__text")] if own_text else []),
                      *[F.col(c).alias(f"__carry{i}") for i, c in enumerate(carry)])
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "__text")
    measured = map_arrow(src, _measure(measured_text, own_text),
                         ddl + ", n_words long, n_lines long, n_dup_lines long, n_repeat_words long")
    own = ["doc_id", *MEASURES]
    return measured.select(*[F.col(c) for c in own if c not in carry], failure_bits(rules).alias("failures"),
                           *[F.col(f"__carry{i}").alias(c) for i, c in enumerate(carry)])


def passes(policy: str | int, failures: str = "failures") -> Column:
    """True where a ledger row passes the policy (a name of POLICIES or a mask)."""
    m = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failures).bitwiseAND(F.lit(m)) == 0


def ablation(led: DataFrame, policy: str | int = DEFAULT_POLICY, rules=RULES, by: tuple[str, ...] = ()) -> DataFrame:
    """Per rule of the policy: documents that fail it, documents that fail it
    alone (they would return without it), and documents kept without it."""
    m = POLICIES[policy] if isinstance(policy, str) else policy
    inside = F.col("failures").bitwiseAND(F.lit(m))
    used = [r for r in rules if m >> r.bit & 1]
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(inside == 0).alias("kept")]
    for r in used:
        aggs += [F.count_if(inside.bitwiseAND(F.lit(1 << r.bit)) != 0).alias(f"f{r.bit}"),
                 F.count_if(inside == (1 << r.bit)).alias(f"a{r.bit}")]
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.col(f"f{r.bit}").alias("failing"), F.col(f"a{r.bit}").alias("only_this"),
                 (F.col("kept") + F.col(f"a{r.bit}")).alias("kept_without")) for r in used]))
    total = led.groupBy(*by).agg(*aggs) if by else led.agg(*aggs)
    return total.select(*by, "n", "kept", rows.alias("r")).select(*by, "r.rule", "n", "kept", "r.failing",
                                                                  "r.only_this", "r.kept_without")
