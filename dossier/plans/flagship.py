"""Flagship: golden party record (S-01 -> H-08 -> U-03 -> P-05 -> H-07 -> A-12 + A-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dossier.operators.identity import assign_identity, golden_aggs, survivor_aggs
from dossier.operators.relational import blank_to_null
from dossier.plans.common import PARTIES_SQL, T, blank_sql, crosswalk, parties
from dossier.plans.registry import register


def golden_party(spark, sf_dir):
    t = T(spark, sf_dir)
    p = blank_to_null(parties(t))
    p = assign_identity(p, crosswalk(t), "local_id", drop_local=False)
    return p.groupBy("party_id").agg(
        *survivor_aggs("source_rank", ["name", "nationkey", "acctbal"]),
        *golden_aggs(["mktsegment"]),
        F.count(F.lit(1)).alias("n_sources"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


GOLDEN_PARTY_SQL = f"""
WITH {PARTIES_SQL},
cleaned AS (
  SELECT local_id, source, source_rank, {blank_sql('name')} AS name, nationkey, acctbal,
         {blank_sql('mktsegment')} AS mktsegment FROM parties),
cw AS (SELECT local_id, MIN(party_id) AS party_id FROM crosswalk GROUP BY local_id),
j AS (SELECT c.*, cw.party_id FROM cleaned c LEFT JOIN cw USING (local_id))
SELECT party_id,
       arg_min(name, source_rank) FILTER (WHERE name IS NOT NULL) AS name,
       arg_min(nationkey, source_rank) FILTER (WHERE nationkey IS NOT NULL) AS nationkey,
       arg_min(acctbal, source_rank) FILTER (WHERE acctbal IS NOT NULL) AS acctbal,
       MAX(mktsegment) AS mktsegment,
       COUNT(*) AS n_sources,
       array_to_string(list_sort(list_distinct(list(source))), ',') AS sources
FROM j GROUP BY party_id
"""

register("golden_party", GOLDEN_PARTY_SQL)(golden_party)
