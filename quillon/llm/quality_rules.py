"""Quality rules as weak supervision.

Rules look at statistics of a text and vote good, bad or abstain. No rule alone
decides: expectation-maximisation over the counts of vote patterns estimates how
each rule votes on good and on bad texts, and a text's posterior probability of
being good replaces the demand that it pass every rule.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.text import SPACE, count_chars, let, words
from quillon.session import materialise

GOOD, BAD, ABSTAIN = 1, 0, 2
WINDOW = 5


def _repeat_positions(w: Column, n: Column) -> Column:
    """How many words stand in a 5-word window that occurs twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts that have an equal pair
    pay for finding where; there, hashes are sorted with their places.
    """
    at = F.sequence(F.lit(0), n - WINDOW)
    return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))


def _covered(windows: Column) -> Column:
    """From the hashes of windows in order: the words that lie in repeated ones."""

    def starts(placed: Column) -> Column:
        def twin(x: Column, k: Column, by: int) -> Column:
            return F.coalesce(F.get(placed, k + by)["h"] == x["h"], F.lit(False))

        # An equal window stands next to its equals once they are sorted.
        return F.sort_array(F.transform(F.filter(placed, lambda x, k: twin(x, k, -1) | twin(x, k, 1)), lambda x: x["i"]))

    def total(begin: Column) -> Column:
        steps = F.transform(begin, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(begin, k + 1), s + WINDOW) - s))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(placed, starts), total)


def statistics(docs: DataFrame, carry: str = "doc_id") -> DataFrame:
    """The statistics of the texts of docs beside the column carry: a row for a row.

    Null counts as the empty text. Words are `[^\\x20\\x09-\\x0D]+`.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(carry, text.alias("_t")).select(carry, "_t", words(F.col("_t")).alias("_w"))
    base = base.withColumn("n_words", F.size("_w"))
    base = base.withColumn("_h", F.when(F.col("n_words") > WINDOW, _repeat_positions(F.col("_w"), F.col("n_words"))))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return base.select(
        carry,
        F.col("n_words").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"),
        count_chars(F.col("_t"), "#*$%&|<>").alias("n_symbols"),
        count_chars(F.col("_t"), "!").alias("n_bangs"),
        count_chars(F.col("_t"), "|").alias("n_bars"),
        ((F.length("_t") - F.length(F.regexp_replace("_t", r"([#*$%&|<>=~_-])\1\1", ""))) / 3).cast("long").alias("n_symbol_runs"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.when(F.contains("_t", F.lit("\n")), F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long").alias("n_dup_lines"),
        F.when(F.contains("_t", F.lit("\n")), F.size(lines)).otherwise((F.col("n_words") > 0).cast("int")).cast("long").alias("n_lines"),
        F.when(F.col("_h").isNull() | (F.size(F.array_distinct("_h")) == F.size("_h")), F.lit(0)).otherwise(_covered(F.col("_h"))).cast("long").alias("n_repeat_words"),
    )


def votes() -> dict[str, Column]:
    """The rules: each a column of GOOD, BAD or ABSTAIN over the statistics."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))

    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)

    mean = F.col("word_chars") / n
    return {
        "length": rule(n < 10, n >= 30),
        "word_length": rule((mean < 2.5) | (mean > 12), (mean >= 3.5) & (mean <= 9)),
        "symbols": rule(F.col("n_symbols") > 0.3 * n, F.col("n_symbols") <= 0.05 * n),
        "symbol_runs": rule(F.col("n_symbol_runs") > 0.1 * n, F.col("n_symbol_runs") <= 0.01 * n),
        "bars": rule(F.col("n_bars") > 0.1 * n, F.col("n_bars") == 0),
        "bangs": rule(F.col("n_bangs") > 0.3 * n, F.col("n_bangs") <= 0.05 * n),
        "capitals": rule(F.col("n_upper") > 0.4 * F.col("word_chars"), F.col("n_upper") <= 0.1 * F.col("word_chars")),
        "repeated_lines": rule(F.col("n_dup_lines") > 0.5 * lines, F.col("n_dup_lines") <= 0.05 * lines),
        "repeated_words": rule(F.col("n_repeat_words") > 0.2 * n, F.col("n_repeat_words") <= 0.02 * n),
    }


def fit_em(patterns: Mapping[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list[list[list[float]]]]:
    """Prior of good, and for each rule the probabilities [class][vote], from counts of vote patterns.

    There are 3 ** rules patterns at most, however many texts. Junk of one kind
    trips one or two rules and passes the others, so it starts from the number
    of bad votes, not from a majority. Smoothing keeps every probability off 0
    and 1, and a rule that comes out worse than chance is held at chance, so
    that the classes cannot change places.
    """
    rules = len(next(iter(patterns), ()))
    post = {p: (0.95, 0.25, 0.05)[min(2, sum(v == BAD for v in p))] for p in patterns}
    prior, table = 0.8, [[[1 / 3] * 3 for _ in range(2)] for _ in range(rules)]
    for _ in range(rounds if patterns else 0):
        mass = [sum(c * (1 - post[p]) for p, c in patterns.items()), sum(c * post[p] for p, c in patterns.items())]
        prior = min(0.98, max(0.02, (mass[1] + 2) / (mass[0] + mass[1] + 3)))
        for r in range(rules):
            for y in (BAD, GOOD):
                seen = [1.0, 1.0, 1.0]
                for p, c in patterns.items():
                    seen[p[r]] += c * (post[p] if y == GOOD else 1 - post[p])
                table[r][y] = [x / sum(seen) for x in seen]
            for v, own in ((GOOD, GOOD), (BAD, BAD)):
                if table[r][own][v] < table[r][1 - own][v]:
                    table[r][own][v] = table[r][1 - own][v] = (table[r][own][v] + table[r][1 - own][v]) / 2
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[r][GOOD][v] / table[r][BAD][v]) for r, v in enumerate(p) if v != ABSTAIN)
            post[p] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return prior, table


def label(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """For each row of docs: doc_id, the statistics, base_failed, posterior and kept.

    docs needs doc_id and text. base_failed is n_words < 10, or more than a
    fifth of the words in repeated windows; such texts are not kept whatever
    the posterior. A null or empty text fails. An empty table gives no rows,
    repeated rows get the same verdict, and other columns are ignored.
    """
    stats = materialise(statistics(docs))
    rules = votes()
    histogram = stats.select(*[c.alias(f"v{i}") for i, c in enumerate(rules.values())]).groupBy(*[f"v{i}" for i in range(len(rules))]).count()
    patterns = {tuple(r[:-1]): r[-1] for r in sorted(histogram.collect())}  # 3 ** len(rules) rows at most
    prior, table = fit_em(patterns)
    odds = F.lit(math.log(prior / (1 - prior)))
    for column, t in zip(rules.values(), table, strict=False):
        odds = odds + F.when(column == GOOD, math.log(t[GOOD][GOOD] / t[BAD][GOOD])).when(column == BAD, math.log(t[GOOD][BAD] / t[BAD][BAD])).otherwise(0.0)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    scored = stats.withColumns({"base_failed": failed, "posterior": 1 / (1 + F.exp(-odds))})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept"
    )
