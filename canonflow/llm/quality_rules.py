"""Quality rules: base statistics of whole texts and a learned decision list, all built-in.

The statistics are array and string expressions on one row; nothing is exploded or shuffled. The
list is learned by sequential covering: a rule is grown on one part of the labelled statistics by
adding the threshold that raises its precision most, pruned on the other part by dropping
thresholds that don't pay there, and accepted if it is precise on both; rows it covers leave, and
the next rule is grown. The rules become one ordered conditional expression.

The learner sees at most `SAMPLE` labelled rows, those whose hashed doc_id is lowest; only their
statistics (a dozen numbers a row) reach the driver.

Defined cases: a null or empty text has no words, every count is 0 and base_failed is true; with
no usable labels the list is empty and the base checks decide; documents labelled more than once
count once, with the lowest label; repeated rows are judged each, and equal ones alike; ties among
thresholds go to the first feature in order; other columns, whatever their names, pass through
`apply_rules`; an empty table gives no rows. 3-word windows are compared by 64-bit hashes. A very
long text is held by one task with its words, hashes and, if windows repeat, one sorted array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_SQL, WORD_SQL, free, table, text_or_empty

#: Fixed values of the base checks.
SYMBOLS = "#*$%&|<>"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Bounds of the learner.
SAMPLE = 6000
MAX_RULES = 8
MAX_CONDITIONS = 3
PRECISION = 0.98
LEAST_COVER = 8
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct_words", "n_digits"]
FEATURES = ["words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "distinct_share", "digit_share"]


def _without(col: Column, chars: str) -> Column:
    return F.length(F.translate(col, chars, ""))


def with_statistics(docs: DataFrame, at: str = "__q") -> DataFrame:
    """`docs` and one struct column `at` of STATS; no column's name may begin with `at`.

    Each step reads only columns of the step before, so that no lambda holds an array's expression
    in place of the array. Windows are sorted only in texts where one occurs twice.
    """
    if free(docs.columns, at) != at:
        raise ValueError(f"a column's name begins with {at!r}")
    t, w, x, m, h, s, p = (f"{at}_{k}" for k in ("text", "words", "lines", "marks", "hashes", "sorted", "places"))
    one = docs.withColumn(t, text_or_empty())
    two = one.withColumns({
        w: F.array_remove(F.split(F.col(t), SPACE_SQL), ""),
        x: F.filter(F.split(F.col(t), "\n"), lambda line: line.rlike(WORD_SQL)),
        m: F.translate(F.col(t), f"{LETTERS} ", ""),  # the little that is counted by kind
    })
    window = lambda word, i: F.xxhash64(word, F.get(w, i + 1), F.get(w, i + 2))
    three = two.withColumn(h, F.when(F.size(w) >= 3, F.slice(F.transform(w, window), F.lit(1), F.size(w) - 2)))
    numbered = F.arrays_zip(F.col(h).alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("i")).cast("array<struct<h:bigint,i:int>>")
    four = three.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(numbered)))
    twin = lambda e, k: (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"])
    five = four.withColumn(p, F.sort_array(F.transform(F.filter(s, twin), lambda e: e["i"])))
    # A window covers its three words; one that starts within the last covers only the rest.
    covers = F.transform(p, lambda i, k: F.least(F.lit(3), i - F.coalesce(F.get(p, k - 1), F.lit(-3))))
    stats = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(m) - _without(F.col(m), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covers, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(x).cast("long").alias("n_lines"),
        (F.length(m) - _without(F.col(m), LETTERS.upper())).cast("long").alias("n_upper"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
        (F.length(m) - _without(F.col(m), "0123456789")).cast("long").alias("n_digits"),
    )
    return five.withColumn(at, stats).drop(t, w, x, m, h, s, p)


def base_failed(at: Column) -> Column:
    few = at["n_words"] < MIN_WORDS
    return few | (100 * at["n_repeat_words"] > MAX_REPEAT_PERCENT * at["n_words"])


def feature_values(r: dict) -> dict[str, float]:
    """The learner's view of one labelled row's statistics."""
    n, c, lines = max(1, r["n_words"]), max(1, r["word_chars"]), max(1, r["n_lines"])
    return {
        "words": float(r["n_words"]), "word_length": c / n, "symbol_share": r["n_symbols"] / c, "dup_line_share": r["n_dup_lines"] / lines,
        "repeat_share": r["n_repeat_words"] / n, "upper_share": r["n_upper"] / c, "distinct_share": r["n_distinct_words"] / n, "digit_share": r["n_digits"] / c,
    }


def feature_columns(at: Column) -> dict[str, Column]:
    """The same as expressions."""
    least = lambda k: F.greatest(at[k], F.lit(1)).cast("double")
    n, c, lines = least("n_words"), least("word_chars"), least("n_lines")
    return {
        "words": at["n_words"].cast("double"), "word_length": c / n, "symbol_share": at["n_symbols"] / c, "dup_line_share": at["n_dup_lines"] / lines,
        "repeat_share": at["n_repeat_words"] / n, "upper_share": at["n_upper"] / c, "distinct_share": at["n_distinct_words"] / n, "digit_share": at["n_digits"] / c,
    }


Condition = tuple[str, str, float]  # feature, ">=" or "<=", threshold
Example = tuple[dict, int]  # features, 1 for bad


def _holds(rule: list[Condition], f: dict) -> bool:
    return all(f[k] >= v if op == ">=" else f[k] <= v for k, op, v in rule)


def _counts(rule: list[Condition], rows: list[Example]) -> tuple[int, int]:
    bad = good = 0
    for f, y in rows:
        if _holds(rule, f):
            bad += y
            good += 1 - y
    return bad, good


def _best_condition(rows: list[Example]) -> tuple[float, Condition] | None:
    """The threshold with the largest information gain of covered bad rows, found by one sweep
    over each feature's sorted values from either end."""
    bad_all = sum(y for _, y in rows)
    if not bad_all or bad_all == len(rows):
        return None
    prior, best = math.log2(bad_all / len(rows)), None
    for k in FEATURES:
        for op, sign in ((">=", -1), ("<=", 1)):
            ordered = sorted(rows, key=lambda r: sign * r[0][k])
            bad = 0
            for n, (f, y) in enumerate(ordered, 1):
                bad += y
                last = n == len(ordered)
                if last or not bad or ordered[n][0][k] == f[k]:
                    continue
                gain = bad * (math.log2(bad / n) - prior)
                if best is None or gain > best[0]:
                    # halfway to the next value, so a shift of a hair doesn't change the verdict
                    best = (gain, (k, op, (f[k] + ordered[n][0][k]) / 2))
    return best


def learn(examples: list[Example]) -> list[list[Condition]]:
    """Sequential covering; every third example is for pruning."""
    grow = [e for i, e in enumerate(examples) if i % 3]
    prune = [e for i, e in enumerate(examples) if not i % 3]
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES:
        rule: list[Condition] = []
        covered = grow
        while len(rule) < MAX_CONDITIONS and (found := _best_condition(covered)) and found[0] > 0:
            rule.append(found[1])
            covered = [e for e in covered if _holds(rule, e[0])]
        if not rule:
            break

        def worth(r: list[Condition]) -> float:
            bad, good = _counts(r, prune)
            return (bad - 4 * good) / max(1, bad + good)

        while len(rule) > 1:
            shorter = max(([c for c in rule if c is not out] for out in rule), key=worth)
            if worth(shorter) < worth(rule):
                break
            rule = shorter
        parts = [_counts(rule, grow), _counts(rule, prune)]
        if any(bad < PRECISION * (bad + good) for bad, good in parts) or sum(bad for bad, _ in parts) < LEAST_COVER:
            break
        rules.append(rule)
        grow = [e for e in grow if not _holds(rule, e[0])]
        prune = [e for e in prune if not _holds(rule, e[0])]
    return rules


def labelled_examples(docs: DataFrame, labels: DataFrame) -> list[Example]:
    """At most SAMPLE labelled rows that pass the base checks, lowest hash first."""
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # SAMPLE rows of two numbers: the broadcast is bounded by that parameter.
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")).select("doc_id", "quality", "__q")
    # The base checks are applied here: as a filter they would be pushed below the statistics.
    taken = [(r["__q"].asDict(), r["quality"]) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()]
    passed = [(s, q) for s, q in taken if s["n_words"] >= MIN_WORDS and 100 * s["n_repeat_words"] <= MAX_REPEAT_PERCENT * s["n_words"]]
    return [(feature_values(s), 1 - q) for s, q in passed]


def verdict(rules: list[list[Condition]], at: Column) -> Column:
    """The number of the first rule that fires, from 1, else 0: an ordered conditional."""
    f, out = feature_columns(at), None
    for n, rule in enumerate(rules, 1):
        test = F.lit(True)
        for k, op, v in rule:
            test = test & (f[k] >= v if op == ">=" else f[k] <= v)
        out = F.when(test, F.lit(n)) if out is None else out.when(test, F.lit(n))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judged(docs: DataFrame, rules: list[list[Condition]], at: str = "__q") -> DataFrame:
    """`docs` with statistics `at` and, named after it, _base_failed, _rule and _kept."""
    d = with_statistics(docs, at)
    d = d.withColumns({f"{at}_base_failed": base_failed(F.col(at)), f"{at}_rule": verdict(rules, F.col(at))})
    return d.withColumn(f"{at}_kept", ~F.col(f"{at}_base_failed") & (F.col(f"{at}_rule") == 0))


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep. A generator drops the others: a filter would be
    pushed below the statistics and have them computed twice."""
    at = free(docs.columns, "__q")
    d = judged(docs, learn(labelled_examples(docs, labels)), at)
    stays = F.when(F.col(f"{at}_kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(stays).alias(f"{at}_stays")).drop(f"{at}_stays")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    d = judged(docs.select("doc_id", "text"), learn(labelled_examples(docs, labels)))
    base = [F.col("__q")[k].alias(k) for k in STATS[:5]]
    return d.select(
        "doc_id", *base, F.col("__q_base_failed").alias("base_failed"), F.col("__q_kept").alias("kept"), F.col("__q_rule").alias("rule")
    )
