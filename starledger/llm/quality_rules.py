"""Quality rules: a table of thresholds compiled into one projection, with no user functions.

Every rule compares 100 x a count with a percentage of another count, in whole numbers,
so the same table compiles to Spark columns and to SQL with equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import WORD, words_of

# Symbols that count as noise, and frequent function words of the four languages.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to in that is for it as was with be by on not this are or from at which but have an had they you were "
    "der die das und ist in den von zu mit sich des auf für im dem nicht ein eine als auch es an er "
    "le la les de des et un une est que qui dans pour en du pas au sur par plus ce il ne se avec "
    "el los las y que del una por con no su para lo como más o pero sus al"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails when 100 * part < percent * whole (``below``) or > (otherwise)."""

    name: str
    part: str
    whole: str
    percent: int
    below: bool = False

    def failed(self) -> Column:
        part, limit = F.lit(100) * F.col(self.part), F.lit(self.percent) * F.col(self.whole)
        return part < limit if self.below else part > limit

    def failed_sql(self) -> str:
        return f"100 * {self.part} {'<' if self.below else '>'} {self.percent} * {self.whole}"


BASE_RULES = (
    Rule("too_short", "n_words", "one", 5000, below=True),
    Rule("repetitive", "n_repeat_words", "n_words", 50),
)
#: Production thresholds, set from the labelled training documents of all four languages.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 10),
    Rule("stop_words", "n_stop_words", "n_words", 3, below=True),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 50),
    Rule("short_words", "word_chars", "n_words", 200, below=True),
    Rule("long_words", "word_chars", "n_words", 1500),
    Rule("shouting", "n_shouts", "n_words", 15),
)


#: Up to so many repeated hashes are looked up one by one; beyond, every window is sorted.
FEW = 64


def _window(w: Column, i: Column) -> Column:
    return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


def _repeated(values: Column, same) -> Column:
    """Of a sorted array, what equals a neighbour by ``same``; null elsewhere."""
    return F.transform(
        values, lambda x, k: F.when(same(x, F.get(values, k - 1)) | same(x, F.get(values, k + 1)), x)
    )


def measures(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per document with its counts. Null text counts as empty.

    Repeats of 3-word windows are looked for only among windows whose hash occurs twice,
    which every repeat's does; those windows are then compared, so the count is exact.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(
        *keys,
        t.alias("_t"),
        words_of(t).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    w, h, s = F.col("_w"), F.col("_h"), F.col("_s")
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    df = df.select("*", F.slice(hashes, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))).alias("_h"))
    df = df.select("*", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(h)).alias("_hs"))
    again = F.array_distinct(F.array_compact(_repeated(F.col("_hs"), lambda a, b: a == b)))
    df = df.select("*", again.alias("_again"))
    near = F.filter(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))),
        lambda z: (F.size("_again") > FEW) | F.array_contains("_again", z.h),
    )
    windows = F.transform(near, lambda z: F.struct(_window(w, z.i).alias("w"), z.i.alias("i")))
    df = df.select("*", F.when(F.col("_again").isNotNull(), F.sort_array(windows)).alias("_s"))
    starts = F.transform(F.array_compact(_repeated(s, lambda a, b: a.w == b.w)), lambda x: x.i)
    covered = F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc.n + F.least(F.lit(3), p - acc.last)).alias("n"), p.alias("last")),
    )["n"]
    return df.select(
        *keys,
        F.lit(1).cast("long").alias("one"),
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        (F.octet_length("_t") - F.octet_length(F.replace("_t", F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
    )


def any_failed(rules) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | rule.failed()
    return out


def apply_rules(docs: DataFrame, keys: list[str], text: str = "text", rules=RULES) -> DataFrame:
    """Per document its counts, ``base_failed``, one ``failed_<rule>`` per rule, and ``kept``.

    ``keys`` are carried through; no other column of ``docs`` is read, so extra columns of
    any name do no harm. Repeated rows are judged each for itself; an empty table gives an
    empty result; a document without words fails by length.
    """
    base = any_failed(BASE_RULES)
    return measures(docs, keys, text).select(
        "*",
        base.alias("base_failed"),
        *[r.failed().alias(f"failed_{r.name}") for r in rules],
        (~base & ~any_failed(rules)).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns. All of them travel in one struct,
    so a column named like a count cannot clash."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text).alias("_text"))
    judged = apply_rules(packed, ["_doc"], "_text", rules)
    # A filter would be pushed below the counts and repeat them in itself; an array of one
    # or no document, exploded, is not.
    return judged.select(F.explode(F.when(F.col("kept"), F.array("_doc"))).alias("_doc")).select("_doc.*")
