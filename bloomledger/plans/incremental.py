"""Matching day by day: candidates and decisions of an earlier run, brought up to date.

Nearly all names are the same from one day to the next.  Candidates of a name change only if
the catalog gets new names, which then have to be compared with it, or loses one of its
candidates, in which case the name is compared with the whole catalog again.  A decision
changes only if the list of candidates does, or the rules.
"""

from __future__ import annotations

import hashlib
from dataclasses import astuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.operators.adjudication import MatchRules, adjudicate
from bloomledger.plans.matching import Decider, candidates

# --- candidates ---------------------------------------------------------------


def merge_candidates(parts: DataFrame, k: int = fv.CANDIDATES_PER_NAME) -> DataFrame:
    """The best `k` of candidate rows from several comparisons; each holds k rows a name at most."""
    best = Window.partitionBy("query_name").orderBy(F.desc("score"), F.asc("candidate_name"))
    ranked = parts.select("query_name", "candidate_name", "score", F.row_number().over(best).alias("rank"))
    return ranked.filter(F.col("rank") <= k)


def _without(rows: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    return rows.join(names.select(F.col("name").alias(column)), column, "left_anti")


def refresh_candidates(
    found: DataFrame,
    old_queries: DataFrame,
    old_catalog: DataFrame,
    queries: DataFrame,
    catalog: DataFrame,
    k: int = fv.CANDIDATES_PER_NAME,
) -> DataFrame:
    """Candidates of `queries` in `catalog`, from those of an earlier run.

    found: the earlier result of `candidates` for the same k and vectors, of all names in
    `old_queries` against all in `old_catalog` (column `name`).  queries, catalog: today's
    (`name`, `vector`) tables.  The result equals `candidates(queries, catalog, k)`: new names
    and names that lost a candidate meet the whole catalog, all others only its new names.
    All inputs are read several times, so they are best stored tables.
    """
    gone = _without(old_catalog.select("name"), catalog)
    fresh = _without(catalog, old_catalog)
    lost = found.join(gone.withColumnRenamed("name", "candidate_name"), "candidate_name", "left_semi")
    lost = lost.select(F.col("query_name").alias("name")).distinct()
    steady = _without(old_queries.select("name"), lost)  # whose candidates are all still there
    kept = queries.join(steady, "name", "left_semi")
    again = _without(queries, steady)
    stay = found.join(kept.select(F.col("name").alias("query_name")), "query_name", "left_semi")
    columns = ["query_name", "candidate_name", "score", "rank"]
    merged = merge_candidates(stay.select(columns).unionByName(candidates(kept, fresh, k).select(columns)), k)
    return merged.unionByName(candidates(again, catalog, k).select(columns))


# --- decisions ------------------------------------------------------------------


def rules_key(rules: MatchRules, tag: str = "") -> str:
    """A short text that differs if the rules do; `tag` names a decider of one's own."""
    return hashlib.sha256(repr((astuple(rules), tag)).encode()).hexdigest()[:16]


def question_digest(names: Column, rules: str) -> Column:
    """Digest of what a decision depends on: the name, its candidates in order, the rules."""
    parts = F.concat(F.array(F.lit(rules), F.col("query_name")), names)
    # Lengths in front keep texts apart that run together alike.
    return F.sha2(F.array_join(F.transform(parts, lambda p: F.concat(F.length(p).cast("string"), F.lit(":"), p)), ""), 256)


def questions(found: DataFrame, rules: str) -> DataFrame:
    """`query_name`, `digest` of each name; a name has k candidates at most."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "candidate_name")))
    names = F.transform(ordered, lambda c: c["candidate_name"])
    return found.groupBy("query_name").agg(names.alias("names")).select("query_name", question_digest(F.col("names"), rules).alias("digest"))


def undecided(found: DataFrame, asked: DataFrame, known: DataFrame) -> DataFrame:
    """Candidate rows of the names whose question (`questions`) has no known decision."""
    open_names = asked.join(known.select("digest"), "digest", "left_anti").select("query_name")
    return found.join(open_names, "query_name", "left_semi")


def decide_new(
    found: DataFrame,
    known: DataFrame,
    rules: MatchRules = MatchRules(),
    decide: Decider | None = None,
    tag: str = "",
) -> tuple[DataFrame, DataFrame]:
    """The questions of all names (`query_name`, `digest`), and the decisions that are new to `known`.

    known: `digest`, `matched_name` of earlier runs.  Only names whose candidates or rules changed are decided; the others keep what was decided
    when the same question came up, so a decider that is slow or not always of one mind is
    asked once.
    """
    asked = questions(found, rules_key(rules, tag))
    rows = undecided(found, asked, known)
    decided = adjudicate(rows, rules) if decide is None else decide(rows)
    new = decided.join(asked, "query_name").groupBy("digest").agg(F.min("matched_name").alias("matched_name"))
    return asked, new


def answered(asked: DataFrame, known: DataFrame) -> DataFrame:
    """`query_name`, `matched_name` of all questions from known decisions."""
    return asked.join(known.select("digest", "matched_name"), "digest").select("query_name", "matched_name")
