"""Hierarchies over party edges (H-11..H-15).

All traversals are iterative joins: one join per level up to the fixed
point (H-11: to its documented depth), a cycle guard, and ``checkpoint()``
(reliable, in the shared ``spark.checkpoint.dir``) so the plan does not grow
with the depth.  Each level is a shuffle join keyed by the current node;
AQE splits a skewed key (many children of one parent) on the frontier side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.operators.shape import unpivot

CHECKPOINT_EVERY = 4

# Structural relationship followed per party type, and the
# party types a parent may have (leading-entity rules).
STRUCTURAL_EDGE = {
    "Branch": "Branch of",
    "Foreign Branch": "Branch of",
    "Sub Account": "Main Account",
    "Organisation Unit": "Organisation Unit of",
    "Managed Fund": "Managed by",
    "Sub-fund": "Sub-fund of",
}
LEGAL_ENTITY = "Legal Entity"
BRANCH_TYPES = ("Branch", "Foreign Branch")
ACCOUNT_TYPES = ("Sub Account", "Organisation Unit", "Managed Fund", "Sub-fund")


def _maybe_checkpoint(df: DataFrame, level: int) -> DataFrame:
    if level % CHECKPOINT_EVERY == 0:
        return df.checkpoint(eager=True)
    return df


def leading_entity(nodes: DataFrame, edges: DataFrame, max_depth: int = 4,
                   node_id: str = "id", party_type: str = "party_type", child: str = "id",
                   rel_type: str = "rel_type", parent: str = "parent") -> DataFrame:
    """H-11: per node the leading legal entity.

    Walk from the node: if the current node is a Legal Entity, it leads;
    if it is not and has a 'Credit' edge, the credit counterparty leads
    (credit wins at each step); otherwise follow the structural edge of its
    type to a parent of an allowed type (branch -> legal entity; account,
    unit, fund -> legal entity or branch).  Without such a parent, or at the
    depth cap, the node reached leads.  Returns (id, leading_id, depth).
    """
    types = nodes.select(F.col(node_id).alias("__n"), F.col(party_type).alias("__t"))
    credit = (edges.where(F.col(rel_type) == "Credit")
              .groupBy(F.col(child).alias("__n")).agg(F.min(parent).alias("__credit")))
    rel_for_type = F.create_map(*[x for k, v in STRUCTURAL_EDGE.items() for x in (F.lit(k), F.lit(v))])
    struct_e = edges.where(F.col(rel_type) != "Credit").where(F.col(child) != F.col(parent)) \
        .select(F.col(child).alias("__n"), F.col(rel_type).alias("__rel"), F.col(parent).alias("__p"))
    # attributes of a node: its type, its credit counterparty (one row per node)
    attrs = types.join(credit, "__n", "left")
    # valid structural step: edge type matches the child's type, parent type allowed
    ptypes = types.select(F.col("__n").alias("__p"), F.col("__t").alias("__pt"))
    step = (struct_e.join(types, "__n").where(F.col("__rel") == rel_for_type[F.col("__t")])
            .join(ptypes, "__p")
            .where((F.col("__t").isin(*BRANCH_TYPES) & (F.col("__pt") == LEGAL_ENTITY))
                   | (F.col("__t").isin(*ACCOUNT_TYPES) & F.col("__pt").isin(LEGAL_ENTITY, *BRANCH_TYPES)))
            .groupBy("__n").agg(F.min("__p").alias("__next")))
    # only undecided nodes go on to the next level: each level's join shrinks
    state = nodes.select(F.col(node_id).alias("id"), F.col(node_id).alias("__cur"), F.lit(0).alias("depth"))
    decided = []
    for level in range(max_depth + 1):
        s_ = (state.join(attrs.withColumnRenamed("__n", "__cur"), "__cur", "left")
              .join(step.withColumnRenamed("__n", "__cur"), "__cur", "left"))
        decide = (F.when(F.col("__t") == LEGAL_ENTITY, F.col("__cur"))
                  .when(F.col("__credit").isNotNull(), F.col("__credit"))
                  .when(F.col("__next").isNull() | F.lit(level == max_depth), F.col("__cur")))
        s_ = s_.withColumn("leading_id", decide)
        decided.append(s_.where(F.col("leading_id").isNotNull()).select("id", "leading_id", "depth"))
        if level == max_depth:
            break
        state = s_.where(F.col("leading_id").isNull()).select(
            "id", F.col("__next").alias("__cur"), (F.col("depth") + 1).alias("depth"))
        state = _maybe_checkpoint(state, level + 1)
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def climb(starts: DataFrame, edges: DataFrame, start: str = "id", child: str = "child",
          parent: str = "parent") -> DataFrame:
    """All ancestors of each start: (start, node, depth), one row per path, up to the fixed point.

    Paths carry the visited nodes, so a cycle stops at the node that closes it and every chain
    ends; there is no depth cap.  Used by H-12 (deepest ancestor).
    """
    e = edges.select(F.col(child).alias("__c"), F.col(parent).alias("__p")) \
        .where(F.col("__c") != F.col("__p")).distinct()
    frontier = starts.select(F.col(start).alias("start"), F.col(start).alias("node"),
                             F.lit(0).alias("depth"), F.array(F.col(start)).alias("__path"))
    out = frontier.drop("__path").where(F.lit(False))
    level = 0
    while True:
        level += 1
        nxt = (frontier.join(e, F.col("node") == F.col("__c"))
               .where(~F.array_contains(F.col("__path"), F.col("__p")))
               .select("start", F.col("__p").alias("node"), F.lit(level).alias("depth"),
                       F.array_append(F.col("__path"), F.col("__p")).alias("__path")))
        nxt = nxt.checkpoint(eager=True)  # the emptiness test and the next level reuse it
        if nxt.isEmpty():
            return out
        out = out.unionByName(nxt.drop("__path"))
        frontier = nxt


def ultimate_parent(entities: DataFrame, edges: DataFrame, types: DataFrame, node_id: str = "id",
                    child: str = "id", rel_type: str = "rel_type", parent: str = "parent",
                    party_type: str = "party_type",
                    chains: Sequence[str] = ("Credit", "Operational Hierarchy"),
                    commercial: str = "Commercial",
                    commercial_types: Sequence[str] = ("Legal Entity", "Natural Person")) -> DataFrame:
    """H-12: per entity the deepest ancestor over all chains, and its commercial super-parent.

    Each chain is climbed by itself.  The deepest level over both wins; at equal depth the first
    chain (Credit) wins, then the smallest id.  An entity without an ancestor is its own ultimate
    parent.  The super-parent is the commercial counterparty of the ultimate parent, if both are of
    ``commercial_types`` (smallest id of several), else the ultimate parent itself.
    Returns (id, ultimate_parent, chain, depth, super_parent).
    """
    starts = entities.select(F.col(node_id).alias("id")).distinct()
    found = None
    for rank, chain in enumerate(chains):
        e = edges.where(F.col(rel_type) == chain).select(F.col(child).alias("child"),
                                                         F.col(parent).alias("parent"))
        anc = climb(starts, e, "id").withColumns({"rank": F.lit(rank), "chain": F.lit(chain)})
        found = anc if found is None else found.unionByName(anc)
    # ids are compared ascending, as they are: negated depth is the only arithmetic
    pick = found.groupBy(F.col("start").alias("id")).agg(
        F.min(F.struct((-F.col("depth")).alias("up"), "rank", "node", "chain")).alias("__b"))
    top = starts.join(pick, "id", "left").select(
        "id", F.coalesce(F.col("__b.node"), F.col("id")).alias("ultimate_parent"),
        F.coalesce(F.col("__b.chain"), F.lit("self")).alias("chain"),
        F.coalesce(-F.col("__b.up"), F.lit(0)).alias("depth"))
    allowed = types.where(F.col(party_type).isin(*commercial_types)).select(F.col(node_id).alias("__n")).distinct()
    com = (edges.where(F.col(rel_type) == commercial)
           .select(F.col(child).alias("ultimate_parent"), F.col(parent).alias("__p"))
           .join(allowed, F.col("ultimate_parent") == F.col("__n"), "left_semi")
           .join(allowed, F.col("__p") == F.col("__n"), "left_semi")
           .groupBy("ultimate_parent").agg(F.min("__p").alias("__com")))
    return top.join(com, "ultimate_parent", "left").select(
        "id", "ultimate_parent", "chain", "depth", F.coalesce("__com", "ultimate_parent").alias("super_parent"))


def translate_hierarchy_ids(df: DataFrame, key: str, levels: Sequence[str], keystore: DataFrame,
                            ks_from: str, ks_to: str, suffix: str = "_ks") -> DataFrame:
    """H-13: map every level column to another key store: one unpivot, one join, one pivot."""
    long = unpivot(df.select(key, *levels), [key], list(levels), "__level", "__id")
    ks = keystore.select(F.col(ks_from).alias("__id"), F.col(ks_to).alias("__to"))
    j = long.join(ks, "__id", "left")
    wide = j.groupBy(key).pivot("__level", list(levels)).agg(F.first("__to"))
    return wide.select(key, *[F.col(lv).alias(f"{lv}{suffix}") for lv in levels])


def related_parties(starts: DataFrame, edges: DataFrame, start: str = "id",
                    child: str = "child", parent: str = "parent") -> DataFrame:
    """H-14: per root every node reachable upward, with its first-reached depth.

    Breadth-first frontier: each level joins the frontier to the edges and
    removes (root, node) pairs already visited (anti join), so each pair is
    expanded once.  Stops at the fixed point (empty frontier); cycles end there
    too.  All roots advance together in one job per level.
    """
    e = edges.select(F.col(child).alias("__c"), F.col(parent).alias("__p")) \
        .where(F.col("__c") != F.col("__p")).distinct()
    roots = starts.select(F.col(start).alias("root")).distinct()
    visited = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))
    frontier = visited
    level = 0
    while True:
        level += 1
        nxt = (frontier.join(e, F.col("node") == F.col("__c"))
               .select("root", F.col("__p").alias("node")).distinct()
               .join(visited.select("root", "node"), ["root", "node"], "left_anti")
               .withColumn("depth", F.lit(level)))
        nxt = nxt.checkpoint(eager=True)  # materialise: the emptiness test and next level reuse it
        if nxt.isEmpty():
            break
        visited = visited.unionByName(nxt)
        if level % CHECKPOINT_EVERY == 0:
            visited = visited.checkpoint(eager=True)
        frontier = nxt
    return visited.where(F.col("depth") > 0)


def row_volume_guard(df: DataFrame, floor: int) -> DataFrame:
    """H-15: one-row frame with the row count; fails the job when below ``floor``."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.where(F.when(F.col("n_rows") < floor,
                          F.raise_error(F.concat(F.lit("too few rows: "), F.col("n_rows").cast("string"))))
                   .otherwise(F.lit(True)))
