"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
integer whose bits say which rules failed; policies are named masks over those bits, so
a new version of a policy, or the effect of leaving a rule out, needs no text.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemirror.llm.texts import counts_by_text, flat, hash_runs, hash_windows, is_space, mix, runs, slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]


@dataclass(frozen=True)
class Rule:
    """A rule that fails where ``fails`` is true; ``bit`` never changes its meaning."""

    name: str
    bit: int
    fails: str


# Shares are compared as whole numbers, so both sides of a limit are exact.
RULES = [
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("upper_case", 4, "100 * n_upper > 40 * n_letters"),
    Rule("word_length", 5, "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
]
BITS = {rule.name: rule.bit for rule in RULES}


def mask(*names: str) -> int:
    return sum(1 << BITS[name] for name in names)


# Versions of the policy: a document is kept when no bit of the mask is set.
POLICIES = {
    "base": mask("few_words", "repeated_words"),
    "v1": mask("few_words", "repeated_words", "symbols", "repeated_lines", "upper_case"),
    "v2": mask(*BITS),
}


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind, in array order."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later, shared = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    return shared, later


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = flat(column)
    n = len(offsets) - 1
    space = is_space(data)
    starts, ends = runs(~space, offsets)
    bounds = counts_by_text(starts, offsets)
    text_of = np.repeat(np.arange(n), np.diff(bounds))
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))
    code_point = (data & 0xC0) != 0x80
    windows = hash_windows(hash_runs(data, starts, ends), WINDOW)
    own = text_of[: len(windows)] == text_of[WINDOW - 1 :] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(own)
    shared, _ = _again(windows[at] ^ salt[text_of[at]])
    opened = np.bincount(at[shared], minlength=len(starts) + 1)
    closed = np.bincount(at[shared] + WINDOW, minlength=len(starts) + 1)
    covered = np.cumsum(opened - closed)[: len(starts)] > 0
    line_starts, line_ends = runs(data != 10, offsets)
    solid = np.concatenate([[0], np.cumsum(~space)])
    worded = solid[line_ends] > solid[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_bounds = counts_by_text(line_starts, offsets)
    line_text = np.repeat(np.arange(n), np.diff(line_bounds))
    _, later = _again(hash_runs(data, line_starts, line_ends) ^ salt[line_text])
    upper = (data - np.uint8(65)) < 26
    lower = (data - np.uint8(97)) < 26
    return {
        "n_words": np.diff(bounds),
        "word_chars": _per_text(code_point & ~space, offsets),
        "n_symbols": _per_text(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), offsets),
        "n_dup_lines": _per_text(later, line_bounds),
        "n_repeat_words": _per_text(covered, bounds),
        "n_lines": np.diff(line_bounds),
        "n_upper": _per_text(upper, offsets),
        "n_letters": _per_text(upper | lower, offsets),
    }


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: its id, all measurements, and ``failed`` with the bits of the failed rules.

    A null or empty text has no words, so it fails ``few_words``. Null ids and repeated
    rows are passed on, an empty table gives an empty ledger, other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = with_fields(docs.drop("text").schema, **dict.fromkeys(MEASURES, "bigint"))

    def run(batches):
        for batch in slices(batches, "text"):
            found = measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], ["doc_id", *MEASURES]
            )

    bits = " | ".join(f"(CASE WHEN {r.fails} THEN {1 << r.bit}L ELSE 0L END)" for r in rules)
    return docs.mapInArrow(run, schema).withColumn("failed", F.expr(bits))


def passes(policy: int) -> Column:
    """Whether a row of the ledger meets a policy."""
    return F.col("failed").bitwiseAND(F.lit(policy)) == 0


def ablations(rows: DataFrame, policy: int, rules: list[Rule] = RULES) -> DataFrame:
    """What each rule of a policy does: documents it fails, and those only it fails.

    The ledger is first counted by its masked bits, at most two to the number of rules.
    """
    by_bits = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy)).alias("bits")).agg(F.count("*").alias("n"))
    used = [r for r in rules if policy >> r.bit & 1]
    totals = by_bits.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))), F.lit(0)).alias("fails"),
                    F.coalesce(F.sum(F.when(F.col("bits") == 1 << r.bit, F.col("n"))), F.lit(0)).alias("fails_alone"),
                )
                for r in used
            ]
        ).alias("all"),
    )
    return totals.select("documents", F.inline("all"))
