"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps its measurements and one bit for each rule that
fails.  A policy is a version with the set of rules that reject: applying one is ``failures & mask``, and changing
one needs no second look at the texts.  Ablations group the ledger by its failure bits (at most 2 ** rules groups)
and combine the groups with the masks.

Words are runs of anything but space, tab and line breaks; all texts are looked at whole.

Defined results: null and empty texts have no words and fail ``few_words``; a rule whose measure needs words passes
where there are none; repeated rows are judged each for itself; an empty table gives an empty ledger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_name

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bangs", "n_same_next")
MEASURE_TYPE = "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of 8 found twice or more.  Windows are numbered exactly, by doubling: 2, 4, 8 words."""
    n = len(ids)
    if n <= window:
        return 0
    code, width = ids, 1
    while width < window:
        code = code[:-width] * (int(code.max()) + 1) + code[width:]
        kinds, code = np.unique(code, return_inverse=True)
        if len(kinds) == len(code):
            return 0
        width *= 2
    again = np.bincount(code)[code] > 1
    step = np.zeros(n + 1, np.int64)
    step[:-window] += again
    step[window:] -= again
    return int((np.cumsum(step[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            if line in seen:
                dups += 1
            seen.add(line)
    raw = np.frombuffer(text.encode(), np.uint8)
    each = np.bincount(raw, minlength=256)
    return (
        len(words),
        sum(map(len, words)),
        int(sum(each[ord(c)] for c in SYMBOLS)),
        dups,
        repeated_words(ids),
        lines,
        int(each[65:91].sum()),
        int(each[97:123].sum()),
        int(each[33]),
        int((ids[1:] == ids[:-1]).sum()),
    )


@dataclass(frozen=True)
class Rule:
    """fails: SQL over the measures."""

    name: str
    fails: str


#: The place in this list is the bit.  New rules go to the end, so that stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    Rule("upper_case", "100 * n_upper > 50 * (n_upper + n_lower)"),
    Rule("exclamations", "100 * n_bangs > 30 * n_words"),
    Rule("stuttering", "100 * n_same_next > 30 * n_words"),
)
#: Versions of policies: names of the rules that reject.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "strict-1": tuple(r.name for r in RULES),
}


def mask(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    unknown = set(POLICIES[policy]) - {r.name for r in rules}
    if unknown:
        raise ValueError(f"policy {policy} names unknown rules: {sorted(unknown)}")
    return sum(1 << i for i, r in enumerate(rules) if r.name in POLICIES[policy])


def measures(text: Column) -> Column:
    """A struct of all measures."""

    @F.pandas_udf(MEASURE_TYPE)
    def run(texts):
        import pandas as pd

        return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")

    return run(text)


def failure_bits(of: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Failure bits from the struct column ``of``."""

    def one(rule: Rule) -> Column:
        sql = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", lambda m: f"`{of}`.{m[1]}", rule.fails)
        return F.expr(f"CASE WHEN {sql} THEN 1L ELSE 0L END")

    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(one(r), i) for i, r in enumerate(rules)])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measures, failures (long): one row for each row of docs."""
    base = bounded_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), measures(F.col(f"`{text_col}`")).alias("m"))
    return base.select("doc_id", "m.*", failure_bits("m").alias("failures"))


def apply_policy(kept_ledger: DataFrame, policy: str) -> DataFrame:
    return kept_ledger.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0)


def ablations(kept_ledger: DataFrame, policy: str) -> DataFrame:
    """For each rule of the policy: documents rejected by it at all, by it alone, and kept without it.

    One shuffle of at most 2 ** rules rows; counts are combined with the masks by bitwise operations.
    """
    full = mask(policy)
    hist = kept_ledger.groupBy(F.col("failures").bitwiseAND(F.lit(full)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(RULES) if full >> i & 1])
    rest = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return (
        hist.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(count(hit).alias("rejected"), count(hit & (rest == 0)).alias("rejected_alone"), count(rest == 0).alias("kept_without"))
    )


def filter_documents(docs: DataFrame, policy: str, text_col: str = "text") -> DataFrame:
    """The rows that the policy keeps, with their own columns."""
    m, f = free_name(docs, "measures"), free_name(docs, "failures")
    judged = bounded_batches(docs).withColumn(m, measures(F.col(f"`{text_col}`"))).withColumn(f, failure_bits(m))
    return judged.where(F.col(f).bitwiseAND(F.lit(mask(policy))) == 0).drop(m, f)
