"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, fresh, held, text_of

# Frequent function words of the corpus's languages (en, de, fr, es).
STOP_WORDS = list(dict.fromkeys((
    "the of and to in a is that it for on was with as be by this are from or an at have not"
    " der die das und ist von den mit zu ein eine nicht auf im dem des"
    " le la les de et un une est que en du pour dans qui sur pas"
    " el los las y que se por con para una del no su lo"
).split()))


@dataclass(frozen=True)
class Rule:
    """A metric's accepted range, from ``least`` to ``most`` where given."""

    metric: str
    least: float | None = None
    most: float | None = None

    def failed(self) -> Column:
        value = F.col(self.metric)
        out = F.lit(False)
        if self.least is not None:
            out = out | (value < self.least)
        if self.most is not None:
            out = out | (value > self.most)
        return F.coalesce(out, F.lit(False))

    @property
    def name(self) -> str:
        return f"{self.metric}[{self.least if self.least is not None else ''},{self.most if self.most is not None else ''}]"


# The production table. Ratios are per word unless the name says otherwise.
RULES = (
    Rule("n_words", least=20),
    Rule("repeat_word_ratio", most=0.30),
    Rule("mean_word_chars", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.30),
    Rule("upper_ratio", most=0.60),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.50),
)

WINDOW = 8


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{BLANKS}+"), "")


def _hashed_with_next(values: Column, step: int) -> Column:
    return F.transform(values, lambda x, i: F.xxhash64(x, F.get(values, i + step)))


def _repeated(starts: Column) -> Column:
    """Words covered by windows that begin at ``starts`` (ascending)."""
    steps = F.transform(
        starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)))
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)


def with_metrics(docs: DataFrame, text: str = "text", into: str = "metrics") -> DataFrame:
    """``docs`` with a struct of measures of each whole text, made by built-in functions only.

    Words are runs without ASCII blanks. word_chars: code points in words. n_symbols: characters
    of ``#*$%&|<>``. n_stop_words: words that are, as written, in STOP_WORDS. n_dup_lines: lines with a word that equal an earlier line. n_repeat_words:
    words in 8-word windows that the text has twice or more. Windows are told apart by a 64-bit
    hash of their words; only windows of one text are ever compared. Null or empty text: zeros,
    and null ratios, which break no rule.
    """
    words, lines, hashes, steps, body = fresh(docs, "q_words", "q_lines", "q_hashes", "q_starts", "q_text")
    w, h = F.col(words), F.col(hashes)
    out = docs.withColumn(body, text_of(text))
    out = out.withColumn(words, _words(F.col(body))).withColumn(
        lines, F.filter(F.split(F.col(body), "\n", -1), lambda x: x.rlike(f"[^{BLANKS[1:]}"))
    )
    # Hashes of 2, 4 and 8 words, each from two of the level before; the last 7 reach past the end.
    for source, span in ((w, 1), (h, 2), (h, 4)):
        out = out.withColumn(hashes, _hashed_with_next(source, span))
    out = out.withColumn(hashes, F.slice(h, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))))
    # Most texts repeat no window; only the others pay for the sort.
    order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn(
        steps, F.when(F.size(F.array_distinct(h)) < F.size(h), order)
    )
    s = F.col(steps)
    twice = F.filter(
        s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
    )
    out = out.withColumn(steps, F.array_sort(F.transform(twice, lambda x: x["i"])))
    n_words, n_lines = F.size(w).cast("long"), F.size(lines).cast("long")
    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(F.col(body), F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": n_lines - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(_repeated(F.col(steps)), F.lit(0).cast("long")),
        "n_lines": n_lines,
        "n_upper": F.regexp_count(F.col(body), F.lit("[A-Z]")).cast("long"),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long"),
    }
    (own,) = fresh(out, "q_counts")
    out = held(out, own, F.struct(*[c.alias(k) for k, c in counts.items()]))
    c = F.col(own)
    ratios = {
        "repeat_word_ratio": F.try_divide(c["n_repeat_words"], c["n_words"]),
        "mean_word_chars": F.try_divide(c["word_chars"], c["n_words"]),
        "symbol_ratio": F.try_divide(c["n_symbols"], c["n_words"]),
        "upper_ratio": F.try_divide(c["n_upper"], c["word_chars"]),
        "stop_word_ratio": F.try_divide(c["n_stop_words"], c["n_words"]),
        "dup_line_ratio": F.try_divide(c["n_dup_lines"], c["n_lines"]),
    }
    (name,) = fresh(docs, into)
    out = out.withColumn(name, F.struct(*[c[k].alias(k) for k in counts], *[r.alias(k) for k, r in ratios.items()]))
    return out.drop(words, lines, hashes, steps, body, own)


def failed_rules(metrics: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that the struct column ``metrics`` breaks, in the table's order."""
    checks = [F.when(F.lit(False), F.lit(""))]
    for rule in rules:
        checks.append(F.when(Rule(f"{metrics}.{rule.metric}", rule.least, rule.most).failed(), F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def base_failed(metrics: str) -> Column:
    m = F.col(metrics)
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with columns metrics (struct), base_failed, failed_rules and kept.

    kept is false for rows that base_failed, and else true where no rule of the table is broken.
    An empty or null text has too few words. Columns of these names in ``docs`` stay; the new
    ones then begin with an underscore.
    """
    metrics, failed, base, kept = fresh(docs, "metrics", "failed_rules", "base_failed", "kept")
    out = with_metrics(docs, text, metrics)
    out = out.withColumn(failed, failed_rules(metrics, rules)).withColumn(base, base_failed(metrics))
    return out.withColumn(kept, ~F.col(base) & (F.size(failed) == 0))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows that no rule rejects; same columns."""
    names = fresh(docs, "metrics", "failed_rules", "base_failed", "kept")
    return judged(docs, text, rules).where(F.col(names[3])).drop(*names)
