"""The matching run: a competitor's catalog file to stored and exported matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bloomledger import fixed_values as fv
from bloomledger.functions.vectors import trigram_vector
from bloomledger.operators.adjudication import MatchRules
from bloomledger.operators.analytics import unmapped_products
from bloomledger.plans.catalog import build_catalog
from bloomledger.plans.incremental import answered, decide_new, refresh_candidates
from bloomledger.plans.matching import Decider, Vectoriser, assemble, candidates, match_yield
from bloomledger.sinks.tables import write_csv
from bloomledger.sinks.vector_store import keep_decisions, known_decisions, publish, published, store_matches, vectors_of
from bloomledger.sources.files import read_competitor_catalog, read_mart


_STATE = ["found", "queries", "catalog"]


def todays_candidates(spark: SparkSession, queries: DataFrame, catalog: DataFrame, path: str, version: str, k: int) -> DataFrame:
    """Candidates of today's names (`name`, `vector`), from the stored ones of the last run if there are any.

    They are stored with the names they are about, for the next run.
    """
    tag = f"{version}:{k}"
    before = published(spark, path, tag, _STATE)
    if before is None:
        found = candidates(queries, catalog, k)
    else:
        found = refresh_candidates(before["found"], before["queries"], before["catalog"], queries, catalog, k)
    now = {"found": found, "queries": queries.select("name"), "catalog": catalog.select("name")}
    return publish(now, path, tag)["found"]


def run_matching(
    spark: SparkSession,
    competitor_csv: str,
    mart_root: str,
    root: str,
    as_of: str,
    rules: MatchRules = MatchRules(),
    k: int = fv.CANDIDATES_PER_NAME,
    vectoriser: Vectoriser = trigram_vector,
    decide: Decider | None = None,
    version: str = "trigram-256",
    mapping: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The stored matches, and one row with how many products found a variety.

    Reads the competitor's CSV and the four mart tables, builds the catalog once
    (`root/catalog`), matches, stores the result (`root/matches`) and exports it
    (`root/matches.csv`).  With a `mapping`, only products that it lacks are matched.

    What an earlier run found is used again: vectors by name (`root/vectors`), candidates by
    name and catalog (`root/candidates`), decisions by question (`root/decisions`).  `version`
    names the vectoriser and the decider; vectors and decisions of another one do not count.
    Every intermediate result is a table under `root`, so a lost executor or a repeated run
    costs no more than what is missing.
    """
    root = root.rstrip("/")
    products = read_competitor_catalog(spark, competitor_csv)
    if mapping is not None:
        products = products.join(unmapped_products(products, mapping), "competitor_product_id", "left_semi")
    products = store_matches(products, f"{root}/products/as_of={as_of}")
    mart = read_mart(spark, mart_root)
    catalog = store_matches(
        build_catalog(mart["cart_box_item"], mart["variety"], mart["product_group"], mart["color"]),
        f"{root}/catalog/as_of={as_of}",
    )
    queries = vectors_of(products, f"{root}/vectors/products", version, vectoriser=vectoriser)
    known = vectors_of(catalog, f"{root}/vectors/catalog", version, vectoriser=vectoriser)
    found = todays_candidates(spark, queries, known, f"{root}/candidates", version, k)
    decided = known_decisions(spark, f"{root}/decisions")
    asked, new = decide_new(found, decided, rules, decide, tag=version)
    decisions = answered(asked, keep_decisions(new, f"{root}/decisions"))
    matches = assemble(products, decisions, catalog)
    stored = store_matches(matches, f"{root}/matches/as_of={as_of}")
    write_csv(stored, f"{root}/matches.csv/as_of={as_of}")
    return stored, match_yield(stored)
