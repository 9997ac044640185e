"""Choosing one candidate, or none, by rules on the words of both names.

* The cultivar decides: words that are neither color, product type nor subtype
  must overlap strongly.  Without such words there is no match.
* Colors may differ, plural forms and word order do not matter.
* The product type must agree where both names state one.
* Subtype words must be in both names or in neither.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv


@dataclass(frozen=True)
class MatchRules:
    """Word lists and the required overlap; words are lower case, singular."""

    color_words: tuple[str, ...] = (
        "white", "cream", "ivory", "yellow", "gold", "orange", "peach", "coral", "pink",
        "red", "burgundy", "purple", "lavender", "blue", "green", "brown", "black",
        "bicolor", "assorted", "mixed", "light", "dark", "hot", "deep",
    )
    type_words: tuple[str, ...] = (
        "rose", "carnation", "chrysanthemum", "mum", "disbud", "lily", "tulip", "orchid",
        "hydrangea", "ranunculus", "gerbera", "daisy", "alstroemeria", "anemone", "aster",
        "foliage", "flower",
    )
    subtype_words: tuple[str, ...] = field(default=tuple(fv.SUBTYPE_WORDS))
    min_overlap: float = 0.5


def name_words(name: Column) -> Column:
    """Distinct lower-case words of a name in singular form."""
    words = F.split(F.lower(name), r"[^\p{L}0-9]+")
    return F.array_distinct(
        F.transform(
            F.filter(words, lambda w: w != ""),
            _singular,
        )
    )


def _singular(word: Column) -> Column:
    """`daisies`, `bushes`, `irises`, `roses` as `daisy`, `bush`, `iris`, `rose`."""
    word = F.regexp_replace(word, r"(..)ies$", "$1y")
    word = F.regexp_replace(word, r"(.(?:sh|ch|x|ss|is|us))es$", "$1")
    return F.regexp_replace(word, r"(..[^siu])s$", "$1")


def _constant(words: tuple[str, ...]) -> Column:
    """Array of the words; a constant that the optimizer splits once."""
    return F.split(F.lit(" ".join(words)), " ")


def _of(words: Column, listed: tuple[str, ...]) -> Column:
    return F.array_intersect(words, _constant(listed))


def judge(candidates: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """Adds `overlap` and `accepted` to (`query_name`, `candidate_name`) rows."""
    generic = tuple(dict.fromkeys(rules.color_words + rules.type_words + rules.subtype_words))
    generic_words = _constant(generic)
    words = candidates.withColumns(
        {
            "_q": name_words(F.col("query_name")),
            "_c": name_words(F.col("candidate_name")),
        }
    )
    parts = words.withColumns(
        {
            "_q_own": F.array_except("_q", generic_words),
            "_c_own": F.array_except("_c", generic_words),
            "_q_type": _of(F.col("_q"), rules.type_words),
            "_c_type": _of(F.col("_c"), rules.type_words),
        }
    )
    overlap = F.coalesce(
        F.try_divide(
            F.size(F.array_intersect("_q_own", "_c_own")).cast("double"),
            F.size(F.array_union("_q_own", "_c_own")).cast("double"),
        ),
        F.lit(0.0),
    )
    same_subtype = F.array_sort(_of(F.col("_q"), rules.subtype_words)) == F.array_sort(
        _of(F.col("_c"), rules.subtype_words)
    )
    type_agrees = (
        (F.size("_q_type") == 0)
        | (F.size("_c_type") == 0)
        | F.arrays_overlap("_q_type", "_c_type")
    )
    return (
        parts.withColumn("overlap", overlap)
        .withColumn(
            "accepted",
            (F.col("overlap") > 0)
            & (F.col("overlap") >= rules.min_overlap)
            & same_subtype
            & type_agrees,
        )
        .drop("_q", "_c", "_q_own", "_c_own", "_q_type", "_c_type")
    )


def adjudicate(candidates: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """One row per `query_name` with `matched_name`, `Null` when none is accepted.

    candidates: `query_name`, `candidate_name`, `score`, `rank`.  Among accepted
    candidates the largest overlap wins, then the better rank.  The choice is a
    partial aggregate, and equal names always get equal answers.
    """
    judged = judge(candidates, rules)
    best = F.max(
        F.when(
            F.col("accepted"),
            F.struct("overlap", (-F.col("rank")).alias("place"), "candidate_name"),
        )
    )
    return judged.groupBy("query_name").agg(best.alias("best")).select(
        "query_name", F.coalesce("best.candidate_name", F.lit(fv.NO_MATCH)).alias("matched_name")
    )
