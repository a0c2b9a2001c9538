"""Quality rules: a table of thresholds compiled into Spark projections, without user functions.

Every measure is an expression over one row, so the operator is a map over the
input: no shuffle, no state, any skew.  Arrays of one text's words are the
largest thing held.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.llm.text import WHITE, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of English, Spanish, French and German, as they stand in running text.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "you were their there been "
    "de la que el en y los se del las un por con no una su para es al lo como más pero sus le ya o este "
    "le les des et à du est dans qui pour pas sur ce avec ne plus par au il sont "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "sie nach wird bei"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a row while low * per <= measure * 1 <= high * per; rows of under ``at_least`` words are not asked."""

    name: str
    measure: str
    per: str
    low: float | None = None
    high: float | None = None
    at_least: int = 0
    base: bool = False


#: The threshold table.  Base rules come first; the others are the verdict beyond them.
RULES = (
    Rule("few_words", "n_words", "one", low=20, base=True),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=0.30, base=True),
    Rule("word_length", "word_chars", "n_words", low=2, high=15),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    Rule("exclamations", "n_exclamations", "n_words", high=0.25),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, at_least=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.50),
)


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _joined(hashes: str, step: int) -> Column:
    """Hash of each entry with the one ``step`` further; entries without one are left out."""
    n = F.size(hashes) - step
    later = F.slice(hashes, step + 1, F.greatest(n, F.lit(0)))
    return F.zip_with(F.slice(hashes, 1, F.greatest(n, F.lit(0))), later, lambda a, b: F.xxhash64(a, b))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the measures that rules refer to, all of them longs.

    Null texts count as empty: every measure is 0.  A column of the input with
    the name of a measure is replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: _without(x, WHITE) != "")
    df = df.withColumns({"__words": words(t), "__lines": lines})
    solid = F.array_join("__words", "")
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(solid).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "n_exclamations": (F.length(t) - F.length(_without(t, "!"))).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(STOP_WORDS))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__w": F.transform("__words", lambda w: F.xxhash64(w)),
    }).drop("__words", "__lines")
    step = 1
    while step < WINDOW:  # hashes of 2, 4 and 8 words, each from two of half the length
        df, step = df.withColumn("__w", _joined("__w", step)), step * 2
    # Only texts in which some window comes back are sorted: equal windows are then neighbours.
    df = df.withColumn(
        "__w",
        F.when(
            F.size(F.array_distinct("__w")) < F.size("__w"),
            F.sort_array(F.transform("__w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda x, k: F.coalesce(F.get("__w", k)["h"] == x["h"], F.lit(False))
    repeated = F.filter("__w", lambda x, k: same(x, k + 1) | same(x, k - 1))
    df = df.withColumn("__w", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    # A window covers its words up to the next repeated window's start.
    covered = F.transform("__w", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__w", k + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    # A filter on a measure would be moved below these steps, with a copy of all their expressions
    # wherever it refers to them; one on a column that asks for a row's number (always true) is not.
    here = F.monotonically_increasing_id() >= 0
    return df.withColumn("n_repeat_words", F.when(here, F.coalesce(total, F.lit(0)).cast("long"))).drop("__w")


def broken(rule: Rule) -> Column:
    """True where a row with measures breaks the rule."""
    value = F.col(rule.measure).cast("double") * 100
    per = F.lit(1.0) if rule.per == "one" else F.col(rule.per).cast("double")
    tests = []
    if rule.low is not None:
        tests.append(value < per * F.lit(float(round(rule.low * 100, 6))))
    if rule.high is not None:
        tests.append(value > per * F.lit(float(round(rule.high * 100, 6))))
    failed = reduce(Column.__or__, tests)
    return failed & (F.col("n_words") >= rule.at_least) if rule.at_least else failed


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with measures, ``base_failed``, ``failed_rules`` (names) and ``kept``.

    Null and empty texts have no words and fail the first rule.  Repeated rows
    are judged alike; other columns pass through, null or not.
    """
    judged = measures(df, text)
    base = reduce(Column.__or__, [broken(r) for r in rules if r.base], F.lit(False))
    names = F.filter(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return judged.withColumns({"base_failed": base, "failed_rules": names}).withColumn(
        "kept", F.size("failed_rules") == 0
    )


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that break no rule, with their own columns only."""
    verdict = judge(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(text)), text, rules)
    return verdict.filter("kept").select("__row.*")
