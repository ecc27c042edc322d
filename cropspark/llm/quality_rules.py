"""Quality rules: a table of thresholds compiled into one projection of text measures.

Everything is a built-in expression. Measures are bound by a generated one-row struct, so
each is computed once and later filters are not pushed below the computation.

Defined results: null text counts as empty; empty or blank text has no words, ratios over
nothing are null, and a null ratio breaks no rule; every input row gives one row, equal or
null ids included; no input columns are kept except the id, so clashing names don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropspark.llm.frames import BLANKS, bound, fresh, one_row, words_of

SYMBOLS = "#*$%&|<>"
# Common function words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for as with was on be at by this are from or an not "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur pas au plus "
    "el los las y se del por con no una su para al lo como más"
).split()
# Signs that begin the lines of lists.
BULLETS = "-*•‣·–"
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if the measure is below `low` or above `high`."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_length", "mean_word_chars", 1.5, 25.0),
    # Bars of menus ('word | word') count as words too, so such text never exceeds 0.5.
    Rule("symbol_ratio", "symbols_per_word", None, 0.1),
    Rule("stop_word_ratio", "stop_word_share", 0.01, None),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("duplicate_lines", "dup_line_share", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_share", None, 0.3),
    Rule("bullet_lines", "bullet_line_share", None, 0.9),
    Rule("letter_words", "letter_word_share", 0.5, None),
    Rule("length", "n_words", None, 100_000),
)


def _window_hashes(words: Column) -> Column:
    last = F.size(words) - F.lit(WINDOW)
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + F.lit(j)) for j in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))


def _repeat_words(hashes: Column) -> Column:
    """How many words lie in a window of `WINDOW` words that the text holds twice or more."""

    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + F.lit(1)) - p, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0), lambda x, y: x + y)

    def positions(ordered: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - F.lit(1)), F.get(ordered, i + F.lit(1))
            return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twice), lambda x: x["p"]))

    ordered = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, bound(bound(ordered, positions), covered)).otherwise(0).cast("bigint")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and a struct `_m` of counts and ratios of its whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    t, w, ln, h = (F.col(f"_m.{c}") for c in "twlh")
    parts = one_row(docs, [id_col], t=text, w=words_of(text), l=lines)
    hashed = one_row(parts, [id_col], t=t, w=w, l=ln, h=_window_hashes(w))
    n, n_lines = F.size(w).cast("bigint"), F.size(ln)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole)

    word_chars = F.length(F.array_join(w, ""))
    symbols = F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]+", ""))
    dup_lines = n_lines - F.size(F.array_distinct(ln))
    trimmed = F.transform(ln, lambda x: F.btrim(x, F.lit(BLANKS)))
    ellipses = F.size(F.filter(trimmed, lambda x: x.endswith("...") | x.endswith("…")))
    bullets = F.size(F.filter(trimmed, lambda x: F.substring(x, 1, 1).isin(*BULLETS)))
    # one pass over the text instead of a search in each word
    letters = F.regexp_count(t, F.lit(r"[^ \t\n\x0B\f\r\p{L}]*+\p{L}[^ \t\n\x0B\f\r]*+"))
    stops = F.size(F.filter(w, lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS))))
    counted = one_row(
        hashed,
        [id_col],
        n_words=n,
        n_lines=n_lines,
        word_chars=word_chars.cast("bigint"),
        n_symbols=symbols.cast("bigint"),
        n_dup_lines=dup_lines.cast("bigint"),
        n_repeat_words=_repeat_words(h),
        n_stop_words=stops.cast("bigint"),
        n_ellipsis_lines=ellipses.cast("bigint"),
        n_bullet_lines=bullets.cast("bigint"),
        n_letter_words=letters.cast("bigint"),
    )
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_ellipsis_lines", "n_bullet_lines", "n_letter_words")
    m = {c: F.col(f"_m.{c}") for c in counts}
    return one_row(
        counted,
        [id_col],
        **m,
        mean_word_chars=share(m["word_chars"], m["n_words"]),
        symbols_per_word=share(m["n_symbols"], m["n_words"]),
        stop_word_share=share(m["n_stop_words"], m["n_words"]),
        letter_word_share=share(m["n_letter_words"], m["n_words"]),
        dup_line_share=share(m["n_dup_lines"], F.col("_m.n_lines")),
        ellipsis_line_share=share(m["n_ellipsis_lines"], F.col("_m.n_lines")),
        bullet_line_share=share(m["n_bullet_lines"], F.col("_m.n_lines")),
    )


def _broken(rule: Rule) -> Column:
    value = F.col(f"_m.{rule.measure}")
    low = value < rule.low if rule.low is not None else F.lit(False)
    high = value > rule.high if rule.high is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


def _base_failed() -> Column:
    n = F.col("_m.n_words")
    return (n < MIN_WORDS) | (F.lit(100) * F.col("_m.n_repeat_words") > F.lit(REPEAT_PERCENT) * n)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its measures, `base_failed`, `kept`, and the names of the rules it breaks."""
    named = [F.when(_broken(r), F.lit(r.name)) for r in rules]
    broken = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return measure(docs, id_col, text_col).select(
        F.col(id_col),
        F.col("_m.*"),
        _base_failed().alias("base_failed"),
        (~_base_failed() & (F.size(broken) == 0)).alias("kept"),
        broken.alias("broken_rules"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that break neither the base rule nor a rule of the table, unchanged."""
    whole = fresh(docs, "_row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col(text_col).alias("_text"))
    ok = ~_base_failed()
    for rule in rules:
        ok = ok & ~_broken(rule)
    return measure(packed, whole, "_text").filter(ok).select(f"{whole}.*")
