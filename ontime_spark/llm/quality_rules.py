"""Quality rules: a decision list learned by sequential covering (operator 7), in DataFrame
operations only.

Documents become statistics. On the labelled ones rules for low quality are learned one after
another: a rule grows by the threshold condition with the highest information gain on two thirds
of the rows that no earlier rule covers, is pruned back to the prefix that does best on the other
third, and is kept while it is right more often than not there. The ordered rules are emitted as
one conditional Spark expression.

Each learning step is an aggregation of the labelled statistics to (statistic, bin) counts; what
comes to the driver is the number of statistics times the number of bins, whatever the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common
from ontime_spark.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
#: Thresholds tried for each statistic (approximate quantiles of the labelled rows).
BINS = 48
#: The learner stops at so many rules and conditions of a rule, or when a rule fails.
MAX_RULES, MAX_CONDITIONS = 12, 4
#: Documents always rejected: fewer words, or a larger percentage of repeated words.
MIN_WORDS, MAX_REPEATED = 50, 50

#: Derived statistics that conditions are about: name -> expression over the counted ones.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "ends": "n_ends / greatest(n_words, 1)",
}


def _removed(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are in ``letters``."""
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_lines
    (with a word), n_upper (A-Z), n_distinct (words), n_ends (words that end in . ! or ?).

    Null texts have no words. A window of three words that occurs twice or more marks all its
    words, of the first occurrence, too."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias(id_col), text.alias("text")).withColumn(
        "words", F.filter(F.split("text", SPACES), lambda w: w != "")).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    at = lambda i: F.get("words", i)
    windows = F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, at(i + 1), at(i + 2)))
    base = base.withColumn("windows", windows)
    counted = base.select(
        id_col, F.size("words").cast("long").alias("n_words"),
        _removed(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        (F.length("text") - _removed(F.col("text"), " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _removed(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.filter("words", lambda w: F.substring(w, -1, 1).isin(".", "!", "?"))).cast("long").alias("n_ends"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
            F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    # Sorted windows: those equal to a neighbour repeat; their words are counted once each.
    h = lambda j: F.get("s", j)["h"]
    marked = counted.withColumn("p", F.sort_array(F.transform(
        F.filter("s", lambda x, j: (x["h"] == F.coalesce(h(j + 1), x["h"] + 1)) | (x["h"] == F.when(j > 0, h(j - 1)).otherwise(x["h"] + 1))),
        lambda x: x["i"])))
    covered = F.aggregate(F.transform("p", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("p", j + 1) - i, F.lit(3)))),
                          F.lit(0), lambda s, x: s + x)
    return marked.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("s", "p")


def base_failed() -> Column:
    """The fixed rule over the counted statistics."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


@dataclass
class Rule:
    """A conjunction of (statistic, above, threshold)."""

    conditions: list[tuple[str, bool, float]] = field(default_factory=list)

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, cut in self.conditions:
            value = F.expr(FEATURES[name])
            out = out & ((value > cut) if above else (value <= cut))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if a else '<='} {c:.6g}" for n, a, c in self.conditions)


def verdict(rules: list[Rule]) -> Column:
    """Whether a document is kept: false at the first rule that holds, true if none does."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(False)) if out is None else out.when(r.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _bin(name: str, cuts: list[float]) -> Column:
    """How many thresholds are below the statistic."""
    value = F.expr(FEATURES[name])
    below = [F.lit(float(c)) for c in cuts]
    return F.size(F.filter(F.array(*below), lambda c: c < value)) if below else F.lit(0)


def _bin_counts(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """(low, high quality) rows by statistic and bin."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"bins.{n}").alias("bin")) for n in FEATURES])
    counts = (rows.select("low", F.inline(pairs)).groupBy("name", "bin")
              .agg(F.sum("low").alias("p"), F.sum(1 - F.col("low")).alias("q")).collect())
    out: dict[str, dict[int, tuple[int, int]]] = {n: {} for n in FEATURES}
    for r in counts:
        out[r["name"]][r["bin"]] = (r["p"], r["q"])
    return out


def _best_condition(counts, cuts) -> tuple[float, str, bool, int] | None:
    """The condition (gain, statistic, above, cut number) with the highest FOIL gain."""
    best = None
    for name, bins in counts.items():
        total_p, total_q = (sum(x[i] for x in bins.values()) for i in (0, 1))
        if not total_p:
            return None
        base = math.log2(total_p / (total_p + total_q))
        p = q = 0
        for b in range(len(cuts[name])):
            dp, dq = bins.get(b, (0, 0))
            p, q = p + dp, q + dq
            for above, cp, cq in ((False, p, q), (True, total_p - p, total_q - q)):
                if cp and cq < total_q:
                    gain = cp * (math.log2(cp / (cp + cq)) - base)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, name, above, b)
    return best if best and best[0] > 1e-9 else None


def learn(labelled: DataFrame, max_rules: int = MAX_RULES) -> list[Rule]:
    """Rules for low quality from rows with the counted statistics, ``key`` (divides growing and
    pruning rows) and ``quality`` (0 low, else high; null rows are ignored). No rows or only one
    class: no rules."""
    rows = labelled.where(F.col("quality").isNotNull())
    values = [F.expr(FEATURES[n]).alias(n) for n in FEATURES]
    points = [i / BINS for i in range(1, BINS)]
    quantiles = rows.select(*values).agg(*[F.percentile_approx(n, points, 1000).alias(n) for n in FEATURES]).first()
    cuts = {n: sorted(set(quantiles[n] or [])) for n in FEATURES}
    if not any(cuts.values()):
        return []
    bins = [_bin(n, cuts[n]).alias(n) for n in FEATURES]
    left = materialize(rows.select((F.col("quality") == 0).cast("int").alias("low"), F.struct(*bins).alias("bins"),
                                   (F.pmod(F.xxhash64(F.col("key"), F.lit("prune")), F.lit(3)) == 0).alias("prune")), "labelled")

    def holds(conditions) -> Column:
        out = F.lit(True)
        for name, above, b in conditions:
            out = out & ((F.col(f"bins.{name}") > b) if above else (F.col(f"bins.{name}") <= b))
        return out

    rules: list[Rule] = []
    while len(rules) < max_rules:
        grown: list[tuple[str, bool, int]] = []
        while len(grown) < MAX_CONDITIONS:
            best = _best_condition(_bin_counts(left.where(~F.col("prune") & holds(grown))), cuts)
            if best is None:
                break
            grown.append(best[1:])
        if not grown:
            break
        prefixes = [F.sum(F.when(holds(grown[:i + 1]), 1).otherwise(0)).alias(f"n{i}") for i in range(len(grown))]
        prefixes += [F.sum(F.when(holds(grown[:i + 1]), F.col("low")).otherwise(0)).alias(f"p{i}") for i in range(len(grown))]
        seen = left.where("prune").agg(*prefixes).first()
        worth = [((2 * seen[f"p{i}"] - seen[f"n{i}"]) / seen[f"n{i}"] if seen[f"n{i}"] else -1.0, -i) for i in range(len(grown))]
        value, at = max(worth)
        if value <= 0:
            break
        kept = grown[:1 - at]
        rules.append(Rule([(n, above, float(cuts[n][b])) for n, above, b in kept]))
        left = left.where(~holds(kept))
    return rules


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[Rule]]:
    """(statistics with base_failed and kept of every document, the rules). Labels of one id are
    one label, the lowest; labels without a document and null labels teach nothing."""
    stats = materialize(statistics(docs, id_col, text_col), "statistics")
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = (stats.where(~base_failed()).join(known.withColumnRenamed("doc_id", "_key"), F.col(id_col) == F.col("_key"))
                .withColumn("key", F.col("_key")))
    rules = learn(labelled)
    out = stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))
    return out, rules


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document with its statistics, the fixed rule and the learned verdict."""
    out, _ = judged(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
