"""Quality rules with host verdicts, in DataFrame functions only.

Every text is measured by itself. Failures of each rule, base rules and soft ones, are then counted by host (the
``source`` column). A host's failure rate is shrunk towards the mean rate with a beta prior, so a host with few
documents says little. The prior's mean and variance are those of the hosts' rates, less the variance that chance alone
gives to rates of so few documents; where nothing is left, all hosts have the mean rate. A host whose shrunken rate of
any rule is above ``host_rate`` is rejected with all its documents. Above ``binding_rate`` a soft rule binds: the host's
documents that fail it go; elsewhere a lone soft failure is let pass.

Rows are carried as one struct, so columns of any name are safe. A null source is a host like others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdw.llm.common import BLANK_RUN, BLANKS
from salesdw.staging import Staging

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WINDOW = 8


@dataclass(frozen=True)
class HostPolicy:
    """Soft rules and the shrunken failure rate above which a host's documents must meet them."""

    symbols_a_word: float = 0.1
    dup_lines_a_word: float = 0.02
    shortest_mean_word: float = 2.5
    longest_mean_word: float = 12.0
    binding_rate: float = 0.25
    host_rate: float = 0.5

    def base_rules(self) -> dict[str, Column]:
        return {"short": F.col("n_words") < 20, "repeats": 100 * F.col("n_repeat_words") > 30 * F.col("n_words")}

    def soft_rules(self) -> dict[str, Column]:
        words = F.greatest(F.col("n_words"), F.lit(1))
        mean = F.col("word_chars") / words
        return {
            "symbols": F.col("n_symbols") > self.symbols_a_word * words,
            "lines": F.col("n_dup_lines") > self.dup_lines_a_word * words,
            "length": (mean < self.shortest_mean_word) | (mean > self.longest_mean_word),
        }


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns), host (the source), the measures of the whole ``text`` and
    ``base_failed``; a null text has no words.

    Equal 8-word windows are found by 64-bit hashes inside one text.
    """
    kept = ["row", "host"]
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0
    words = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in carry]).alias("row"),
        F.col("source").alias("host"),
        F.split(F.btrim(text, F.lit(BLANKS)), BLANK_RUN).alias("_words"),
        F.filter(F.split(text, "\n"), has_word).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    counted = words.select(
        *kept,
        "n_symbols",
        F.when(F.col("_words") == F.array(F.lit("")), 0).otherwise(F.size("_words")).cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    # A window's hash and its first word's place, for every text of eight words or more.
    window = lambda start: F.xxhash64(F.slice(F.col("_hashes"), start, WINDOW))
    starts = F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1))
    windows = counted.select(
        *kept,
        *MEASURES[:4],
        F.when(F.size("_hashes") >= WINDOW, F.transform(starts, window)).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = windows.select(
        *kept,
        *MEASURES[:4],
        F.when(
            repeats,
            F.sort_array(F.transform("_windows", lambda hashed, at: F.struct(hashed.alias("hash"), at.alias("at")))),
        ).alias("_ordered"),
    )
    same = lambda one, place: F.coalesce(F.get("_ordered", place)["hash"] == one["hash"], F.lit(False))
    twice = F.filter("_ordered", lambda one, at: same(one, at - 1) | same(one, at + 1))
    places = ordered.select(
        *kept, *MEASURES[:4], F.sort_array(F.transform(twice, lambda one: one["at"])).alias("_places")
    )
    # A word is counted once although several windows hold it: each window adds what reaches beyond the one before.
    gap = lambda at, n: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", n + 1) - at, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("_places", gap), F.lit(0), lambda total, one: total + one)
    measured = places.select(*kept, *MEASURES[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    rules = HostPolicy().base_rules()
    return measured.withColumn("base_failed", rules["short"] | rules["repeats"])


def host_verdicts(measured: DataFrame, policy: HostPolicy) -> DataFrame:
    """One row per host: ``_host``, ``_rejected`` and, for each soft rule, ``_binds_<rule>``."""
    soft = policy.soft_rules()
    rules = policy.base_rules() | soft
    counts = [F.sum(failed.cast("long")).alias(f"_failed_{name}") for name, failed in rules.items()]
    hosts = measured.groupBy(F.col("host").alias("_host")).agg(F.count("*").alias("_docs"), *counts)
    rates = {name: F.col(f"_failed_{name}") / F.col("_docs") for name in rules}
    moments = [f(rate).alias(f"{kind}_{name}") for name, rate in rates.items() for kind, f in (("mean", F.avg), ("var", F.var_pop))]
    found = hosts.agg(F.avg(1 / F.col("_docs")).alias("chance"), *moments).first()
    shrunken = {}
    for name in rules:
        mean, variance = found[f"mean_{name}"] or 0.0, found[f"var_{name}"] or 0.0
        real = variance - mean * (1 - mean) * (found["chance"] or 0.0)
        if real <= 0:  # the hosts do not differ by more than chance
            shrunken[name] = F.lit(mean)
        else:  # a beta distribution of this mean and variance has a + b = mean (1 - mean) / variance - 1
            weight = mean * (1 - mean) / real - 1
            shrunken[name] = (F.col(f"_failed_{name}") + mean * weight) / (F.col("_docs") + weight)
    rejected = F.greatest(*shrunken.values()) > policy.host_rate
    binds = [(shrunken[name] > policy.binding_rate).alias(f"_binds_{name}") for name in soft]
    return hosts.select("_host", rejected.alias("_rejected"), *binds)


def judge(docs: DataFrame, staging: Staging, policy: HostPolicy = HostPolicy(), carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns of ``docs``, all by default), the measures, ``base_failed`` and ``kept``.

    The measured rows are written once; hosts are counted from them and joined back, the verdicts broadcast only
    where Spark's own threshold allows it. An empty table gives an empty result.
    """
    measured = staging.put(measure(docs, docs.columns if carry is None else carry), "measured")
    verdicts = host_verdicts(measured, policy)
    bound = [F.col(f"_binds_{name}") & failed for name, failed in policy.soft_rules().items()]
    gone = reduce(lambda one, other: one | other, bound, F.col("_rejected"))
    joined = measured.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce(gone, F.lit(False))
    return joined.select("row", *MEASURES, "base_failed", kept.alias("kept"))
