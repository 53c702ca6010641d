"""Quality rules with risk-controlled thresholds.

Every rule compares a ratio of a text's counts with a cutoff.  Labelled good
documents select the cutoffs: a cutoff is allowed in a stratum only if an exact
binomial test shows, at error level ``delta``, that it rejects at most a given
share of good documents there.  The share ``alpha`` is split over the rules, so
that all rules together reject at most ``alpha``; ``delta`` is split over rules
and strata (Bonferroni).  A rule's cutoffs are tested from the most lenient
down and the first that fails ends the rule, so testing many costs nothing
(fixed sequence).  With too few labels no cutoff passes and the rule is off.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import BROADCAST_ROWS, fresh, map_rows, stored, text_key

_SYMBOLS = "#*$%&|<>"
_BLANKS = re.compile("[\x20\x09-\x0d]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_same_words")


class Rule(NamedTuple):
    """Rejects texts with numerator / denominator over (sign 1) or under (sign -1) a cutoff; most lenient first."""

    name: str
    numerator: str
    denominator: str
    sign: int
    cutoffs: tuple[float, ...]


_SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)
RULES = (
    Rule("symbols", "n_symbols", "n_words", 1, (4.0, 3.0, 2.0, 1.5, 1.0, *_SHARES)),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1, _SHARES),
    Rule("repeat_words", "n_repeat_words", "n_words", 1, _SHARES),
    Rule("same_words", "n_same_words", "n_words", 1, _SHARES),
    Rule("capitals", "n_upper", "word_chars", 1, _SHARES),
    Rule("long_words", "word_chars", "n_words", 1, (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0)),
    Rule("short_words", "word_chars", "n_words", -1, (1.2, 1.5, 2.0, 2.5, 3.0, 3.25, 3.5, 3.75, 4.0)),
)


def repeated_positions(words: list[bytes], window: int = _WINDOW) -> int:
    """Words inside a window of ``window`` (a power of two) words that occurs twice or more in the text."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    width = 1
    while width < window:  # ids of twice as wide windows from pairs of ids: exact, no hash
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        width *= 2
    often = (np.bincount(ids) > 1)[ids]
    if not often.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(ids)] += often
    edge[window:] -= often
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one text; a null text has none of anything."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # of bytes: exactly the blanks 0x20 and 0x09-0x0D
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    blanks = sum(raw.count(b) for b in b" \t\n\x0b\x0c\r")
    return (len(words), len(text) - blanks, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            repeated_positions(words), len(lines), len(_UPPER.findall(text)),
            sum(a == b for a, b in zip(words, words[1:])))


def measure(documents: DataFrame, stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, text_key, counts..., base_failed) for every row; a stratum column that is missing counts as null."""
    own = F.col(stratum).cast("string") if stratum in documents.columns else F.lit(None).cast("string")

    def make():
        def work(rows):
            counts = list(zip(*map(count_text, rows["text"]))) or [()] * len(COUNTS)
            return {k: rows[k] for k in ("doc_id", "stratum", "text_key")} | dict(zip(COUNTS, map(list, counts)))
        return work

    counted = map_rows(documents.select("doc_id", own.alias("stratum"), text_key(F.col("text")).alias("text_key"), "text"),
                       "doc_id long, stratum string, text_key long, " + ", ".join(f"{c} long" for c in COUNTS), make)
    return counted.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def rejects(rule: Rule, cutoff: Column | float) -> Column:
    """True where the rule rejects at this cutoff; a zero denominator or a null cutoff never rejects."""
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(float(cutoff))
    ratio = F.col(rule.numerator) / F.nullif(F.col(rule.denominator), F.lit(0))
    return F.coalesce(ratio > cutoff if rule.sign > 0 else ratio < cutoff, F.lit(False))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in logarithms."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(np.log((n - i + 1) / i) + math.log(p / (1 - p)))])
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def select_cutoffs(tallies: dict[str | None, tuple[int, dict[str, list[int]]]], alpha: float = 0.05,
                   delta: float = 0.05) -> dict[str | None, dict[str, float | None]]:
    """The strictest allowed cutoff of each rule by stratum.

    ``tallies``: by stratum, the number of good documents and for each rule how
    many of them each of its cutoffs rejects.
    """
    share, level = alpha / len(RULES), delta / max(1, len(RULES) * len(tallies))
    out: dict = {}
    for stratum, (n, rejected) in tallies.items():
        out[stratum] = {}
        for rule in RULES:
            best = None
            for cutoff, k in zip(rule.cutoffs, rejected[rule.name]):
                if binomial_tail(k, n, share) > level:
                    break
                best = cutoff
            out[stratum][rule.name] = best
    return out


def calibrate(measured: DataFrame, labels: DataFrame, label: str = "quality", alpha: float = 0.05,
              delta: float = 0.05) -> dict:
    """Cutoffs from all labelled good documents that pass the base rules; copies of a text count once.

    Only one row a stratum reaches the driver.
    """
    good = labels.where(F.col(label) == 1).select("doc_id").where("doc_id IS NOT NULL").distinct()
    sample = (measured.where("NOT base_failed").join(good, "doc_id").drop("doc_id").dropDuplicates(["stratum", "text_key"]))
    sums = [F.sum(rejects(r, c).cast("long")).alias(f"{r.name}_{i}") for r in RULES for i, c in enumerate(r.cutoffs)]
    rows = sample.groupBy("stratum").agg(F.count("*").alias("n"), *sums).collect()
    return select_cutoffs({r["stratum"]: (r["n"], {rule.name: [r[f"{rule.name}_{i}"] for i in range(len(rule.cutoffs))]
                                                   for rule in RULES}) for r in rows}, alpha, delta)


def apply_cutoffs(measured: DataFrame, cutoffs: dict) -> DataFrame:
    """``measured`` plus kept: false if a base rule or a calibrated rule of the row's stratum rejects it."""
    spark = measured.sparkSession
    names = [f"cut_{r.name}" for r in RULES]
    rows = [(s, *[c[r.name] for r in RULES]) for s, c in cutoffs.items()]
    table = spark.createDataFrame(rows, "of_stratum string, " + ", ".join(f"{n} double" for n in names))
    verdict = ~F.col("base_failed")
    for rule, name in zip(RULES, names):
        verdict = verdict & ~rejects(rule, F.col(name))
    if len(rows) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return (measured.join(table, F.col("stratum").eqNullSafe(F.col("of_stratum")), "left")
            .withColumn("kept", verdict).drop("of_stratum", *names))


def risk_controlled(documents: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.05,
                    delta: float = 0.05) -> DataFrame:
    """Counts, base verdict and kept for every row of ``documents``.

    Null and blank texts have zero counts and fail the base rules.  Rows of a
    stratum without labels (or null) meet the base rules only.  Repeated rows
    are judged alike; a null doc_id is never a labelled one.
    """
    measured = stored(measure(documents, stratum), "measured")  # one pass over the texts serves both uses
    return apply_cutoffs(measured, calibrate(measured, labels, "quality", alpha, delta))


def keep_good(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``documents`` without rejected rows."""
    id_, key = fresh(documents.columns, "_id", "_key")
    bad = (risk_controlled(documents, labels, **options).where("NOT kept")
           .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct())
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (text_key(F.col("text")) == F.col(key)), "left_anti")
