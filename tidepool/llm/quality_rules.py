"""Quality rules as a short-circuit cascade, in native expressions only.

Each rule is a boolean SQL expression over a text's features that says whether
the rule rejects the text. The cascade measures on a sample what every rule
costs (seconds a row) and how many rows it rejects, orders the rules by
rejections per cost, and evaluates them in that order inside one CASE: a row
that a rule rejects never reaches the next one. The order changes the work,
never the verdict, which is "no rule rejects".

Defined results: a null or empty text has no words and fails the word-count
rule; repeated rows and ties get one verdict each; an empty table gives an
empty result; extra columns pass through ``quality_filter`` untouched, whatever
their names, because a row travels as one struct beside the features.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import SPACE_CLASS, query, read

#: Rows of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 1000

MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """``reject`` is a SQL expression over the columns that ``needs`` names."""
    name: str
    reject: str
    needs: tuple[str, ...]


#: Feature -> SQL expression over ``text`` and features that stand above it.
_SP = SPACE_CLASS.replace("\\", "\\\\")
FEATURES: dict[str, str] = {
    "words": f"filter(split(coalesce(text, ''), '{_SP}'), w -> w != '')",
    "lines": f"filter(split(coalesce(text, ''), '\\n'), l -> l rlike '{_SP.replace('[', '[^')}')",
    "n_words": "cast(size(words) as bigint)",
    "word_chars": "cast(length(array_join(words, '')) as bigint)",
    "n_symbols": "cast(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '')) as bigint)",
    "n_lines": "cast(size(lines) as bigint)",
    "n_dup_lines": "cast(size(lines) - size(array_distinct(lines)) as bigint)",
    "n_capitals": "cast(length(regexp_replace(coalesce(text, ''), '[^A-Z]+', '')) as bigint)",
    # Three-word windows by a 64-bit hash; only texts in which one comes back are sorted.
    "grams": "transform(if(size(words) < 3, array(), sequence(0, size(words) - 3)),"
             " i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))",
    "sorted_grams": "if(size(array_distinct(grams)) = size(grams), array(),"
                    " sort_array(transform(grams, (h, i) -> struct(h as h, i as i))))",
    "repeat_starts": "sort_array(transform(filter(sorted_grams, (g, j) ->"
                     " get(sorted_grams, j - 1).h <=> g.h or get(sorted_grams, j + 1).h <=> g.h), g -> g.i))",
    "n_repeat_words": "aggregate(transform(repeat_starts, (p, j) ->"
                      " cast(least(3, coalesce(get(repeat_starts, j + 1) - p, 3)) as bigint)),"
                      " 0L, (a, x) -> a + x)",
}

BASE_RULES = (
    Rule("too_few_words", f"n_words < {MIN_WORDS}", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
)

#: What the verdict asks beside the base rules.
EXTRA_RULES = (
    Rule("symbols", "5 * n_symbols > n_words", ("n_words", "n_symbols")),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines", ("n_lines", "n_dup_lines")),
    Rule("capitals", "2 * n_capitals > word_chars", ("word_chars", "n_capitals")),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words", ("n_words", "word_chars")),
)


def _closure(names: tuple[str, ...]) -> list[str]:
    """The features needed for ``names``, in the order in which they build on each other."""
    need: set[str] = set(names)
    for f in reversed(FEATURES):
        if f in need:
            need |= {g for g in FEATURES if g != f and _mentions(FEATURES[f], g)}
    return [f for f in FEATURES if f in need]


def _mentions(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", sql) is not None


def with_features(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` (with a ``text`` column) and the named features.

    One projection a feature: each is then computed once and read by those above it.
    """
    for f in _closure(names):
        df = _with_feature(df, f)
    return df


def _with_feature(df: DataFrame, name: str) -> DataFrame:
    df = df.withColumn(name, F.expr(FEATURES[name]))
    if name == "n_repeat_words":
        # A filter on this count must not be pushed below it: written out as one expression, the
        # sort would run again for every window. The optimizer pushes nothing past a row number.
        df = df.withColumn("_at", F.monotonically_increasing_id()).withColumn(name, F.expr(f"if(_at >= 0, {name}, 0L)"))
    return df


def _when(rules: list[Rule], guard: str | None = None) -> str:
    """The verdict as SQL: true if no rule rejects; stops at the first that does."""
    arms = "".join(f" when {r.reject} then false" for r in rules)
    guard = f" when {guard} then false" if guard else ""
    return f"case{guard}{arms} else true end" if guard or arms else "true"


def estimate(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS,
             text_col: str = "text") -> list[dict]:
    """Per rule: seconds a row and share of rows rejected, on a sample of about ``sample_rows``."""
    n = docs.count()
    if not n:
        return [{"rule": r, "cost": 1.0, "rejects": 0.0} for r in rules]
    sample = docs.select(F.col(text_col).alias("text"))
    if n > sample_rows:
        sample = sample.sample(fraction=sample_rows / n, seed=7)
    sample = sample.repartition(1).persist()
    try:
        rows = max(1, sample.count())
        out = []
        for r in rules:
            counted = with_features(sample, r.needs).agg(F.count_if(F.expr(r.reject)).alias("k"))
            began = time.perf_counter()
            rejected = counted.first()["k"]
            out.append({"rule": r, "cost": (time.perf_counter() - began) / rows, "rejects": rejected / rows})
        return out
    finally:
        sample.unpersist()


def ordered(estimates: list[dict]) -> list[Rule]:
    """Rules by rejections per cost, the best first; ties by name."""
    return [e["rule"] for e in sorted(estimates, key=lambda e: (-e["rejects"] / max(e["cost"], 1e-9), e["rule"].name))]


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = EXTRA_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, base verdict and final verdict of every row of ``docs`` (doc_id, text)."""
    order = ordered(estimate(docs, rules, sample_rows))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    needs = tuple(dict.fromkeys([*counts, *(c for r in rules for c in r.needs)]))
    base = " or ".join(f"({r.reject})" for r in BASE_RULES)
    return (with_features(docs.select("doc_id", "text"), needs)
            .withColumn("base_failed", F.expr(base))
            .select("doc_id", *counts, "base_failed", F.expr(_when(order, "base_failed")).alias("kept")))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + EXTRA_RULES,
                   text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    Stage by stage: a feature is computed after the filter of the rules before
    it, so rows rejected early never pay for the dear features.
    """
    order = ordered(estimate(docs, rules, sample_rows, text_col))
    out = docs.select(F.struct(F.col("*")).alias("_row"), F.col(text_col).alias("text"))
    have: set[str] = set()
    for r in order:
        for f in _closure(r.needs):
            if f not in have:
                out, have = _with_feature(out, f), have | {f}
        out = out.filter(f"not ({r.reject})")
    return out.select("_row.*")


_WORDS_SQL = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: The report of quality_report over a relation ``{docs}`` with a row number ``rid``.
REPORT_SQL = rf"""
with base as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text, {_WORDS_SQL} as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from {{docs}}),
grams as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from base)),
repeated as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from grams) where c > 1),
covered as (
  select rid, count(distinct p) as n
  from (select rid, unnest([i, i + 1, i + 2]) as p from repeated) group by rid),
counted as (
  select b.rid, doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_capitals,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from base b left join covered c using (rid)),
judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
"""
REPORT_ROWS_SQL = """
select rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 5 * n_symbols > n_words or 2 * n_dup_lines > n_lines
            or 2 * n_capitals > word_chars or word_chars < 2 * n_words or word_chars > 20 * n_words) as kept
from judged"""


@query("op2_quality_rules", oracle=REPORT_SQL.format(docs="documents")
       + f"select * exclude (rid) from ({REPORT_ROWS_SQL})")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_report(read(spark, sf_dir, "documents"))
