"""Hierarchies, chains and small graphs held as edge tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import paths
from tidemark.session import cut_lineage, dealt, scratch


def _kept_by(df: DataFrame, *keys: str) -> DataFrame:
    """Cut from its lineage and dealt by ``keys``; joins and groupings by them need no exchange of it, in any round that follows."""
    return cut_lineage(df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys))


def resolve_chains(df: DataFrame, node: str, target: str) -> DataFrame:
    """End of the chain every node points along, and the number of steps to it.

    Pointer doubling: each round every open node jumps twice, to where its pointer points and on from there, so a chain of length n takes
    log4(n) rounds. A node that is finished is written once. Open nodes look up only the finished nodes they point to, which
    are dealt by id once and not exchanged again. Nodes that run into a missing node drop out, and those in a cycle stay open
    while none finishes any more: both have no end and are left out.
    """
    state = df.select(
        F.col(node).alias("id"), F.col(target).alias("up"),
        F.when(F.col(target).isNull(), F.col(node)).alias("root"),
        F.when(F.col(target).isNull(), 0).otherwise(1).cast("long").alias("steps"),
    )
    state = _kept_by(state, "id")
    finished, before = [], None
    while True:
        counts = state.agg(F.count_if(F.col("up").isNotNull()), F.count_if(F.col("up").isNull())).first()
        finished.append(state.where(F.col("up").isNull()))
        # as many open nodes as before and none that ended: what is left are cycles
        if not counts[0] or (before == counts[0] and not counts[1]):
            break
        before = counts[0]
        open_nodes = state.where(F.col("up").isNotNull())

        def jumped(rows: DataFrame) -> DataFrame:
            ends = [x.select(F.col("id").alias("up"), "root", "steps") for x in finished]
            ahead = open_nodes.select(F.col("id").alias("up"), F.lit(None).cast(open_nodes.schema["root"].dataType).alias("root"), "steps", F.col("up").alias("__up"))
            ahead = reduce(DataFrame.unionByName, [x.withColumn("__up", F.lit(None).cast(open_nodes.schema["up"].dataType)) for x in ends], ahead)
            ahead = ahead.select("up", F.col("__up"), F.col("root").alias("__root"), F.col("steps").alias("__s"))
            return rows.join(ahead, "up").select("id", F.col("__up").alias("up"), F.col("__root").alias("root"), (F.col("steps") + F.col("__s")).alias("steps"))

        once = jumped(open_nodes)
        state = _kept_by(once.where(F.col("up").isNull()).unionByName(jumped(once.where(F.col("up").isNotNull()))), "id")
    return reduce(DataFrame.unionByName, finished).select(F.col("id").alias(node), "root", "steps")


def resolve_redirects(df: DataFrame, node: str, target: str) -> DataFrame:
    """Terminal id of merge, move and duplicate chains."""
    out = resolve_chains(df, node, target)
    return out.select(node, F.col("root").alias("final_id"), (F.col("root") != F.col(node)).alias("is_redirected"), "steps")


def lineage_paths(edges: DataFrame, node: str, parent: str, starts: str) -> DataFrame:
    """Renewal chains: every node with its cohort root, its place in the chain, the chain's length and start.

    A child of several parents keeps the parent that starts earliest. The path is returned as rows (root, position),
    not as one array, so a long chain stays spread.
    """
    known = edges.select(F.col(node).alias("__id"), F.col(starts).alias("__ps")).distinct()
    single = edges.join(known, edges[parent] == known["__id"], "left").groupBy(node).agg(
        F.min_by(parent, F.struct("__ps", parent)).alias(parent), F.min(starts).alias(starts))
    chain = resolve_chains(single, node, parent)
    roots = chain.groupBy("root").agg((F.max("steps") + 1).alias("chain_length"))
    root_start = single.select(F.col(node).alias("root"), F.col(starts).alias("cohort_start"))
    return (chain.join(roots, "root").join(root_start, "root")
            .select(node, "root", (F.col("steps") + 1).alias("position"), "chain_length", "cohort_start"))


def flatten_hierarchy(tree: DataFrame, node: str, parent: str, name: str, levels: int = 10) -> DataFrame:
    """Level columns from the root down for every node that a root (a node without parent) leads to.

    From the roots downwards, one join per level of the deepest branch, so a node whose parent is missing or whose
    ancestors form a circle is left out. ``deeper`` lists id and name of the levels after the last column, however many.
    """
    t = cut_lineage(tree.select(node, name, parent))
    own = F.struct(F.col(node).alias("id"), F.col(name).alias("name"))
    front, reached = t.where(F.col(parent).isNull()).select(node, name, F.array(own).alias("__path")), []
    while True:
        front = cut_lineage(front)
        reached.append(front)
        if front.isEmpty():
            break
        up = front.select(F.col(node).alias(parent), "__path")
        front = t.join(up, parent).where(~F.exists("__path", lambda p: p["id"] == F.col(node))).select(
            node, name, F.array_append("__path", own).alias("__path"))
    step = lambda k, part: F.get("__path", F.lit(k))[part].alias(f"lvl_{k + 1}_{part}")
    return reduce(DataFrame.unionByName, reached).select(
        node, name, F.size("__path").alias("hierarchy_level"), *[step(k, "id") for k in range(levels)], *[step(k, "name") for k in range(levels)],
        F.slice("__path", levels + 1, F.greatest(F.size("__path"), F.lit(1))).alias("deeper"))


def temporal_lineage(scd_edges: DataFrame, node: str, parent: str, start: str, end: str) -> DataFrame:
    """Root paths of effective-dated edges, valid only where all intervals on the way overlap.

    Pointer doubling over pieces of paths. A piece leads from a node up to the node it still has to go to, with the interval in which all its edges
    hold; two pieces that meet make one whose interval is the intersection, and an empty one is dropped. Every round doubles the length of open
    pieces, so a chain of n steps takes log2(n) joins. A piece that comes back to one of its own nodes is a cycle and is dropped.
    """
    pieces = _kept_by(scd_edges.select(
        F.col(node).alias("__id"), F.col(parent).alias("__up"), F.col(start).alias("__a"), F.col(end).alias("__b"), F.array(node).alias("__path")), "__id")
    finished = []
    while True:
        ended, open_pieces = pieces.where(F.col("__up").isNull()), pieces.where(F.col("__up").isNotNull())
        finished.append(ended)
        if open_pieces.isEmpty():
            break
        above = reduce(DataFrame.unionByName, finished, open_pieces).select(
            F.col("__id").alias("__up"), F.col("__up").alias("__next"), F.col("__a").alias("__a2"), F.col("__b").alias("__b2"), F.col("__path").alias("__path2"))
        met = open_pieces.join(above, "__up").where(~F.arrays_overlap("__path", "__path2"))
        pieces = met.select(
            "__id", F.col("__next").alias("__up"), F.greatest("__a", "__a2").alias("__a"), F.least("__b", "__b2").alias("__b"),
            F.concat("__path2", "__path").alias("__path"),
        ).where("__a < __b")
        pieces = _kept_by(pieces, "__id")
    whole = reduce(DataFrame.unionByName, finished)
    return whole.select(
        F.col("__id").alias(node), F.get("__path", F.lit(0)).alias("root"), F.size("__path").alias("depth"), F.col("__path").alias("path"),
        F.col("__a").alias("valid_from"), F.col("__b").alias("valid_to"))


def expand_membership(group_members: DataFrame, project_members: DataFrame, projects: DataFrame, group_links: DataFrame,
                      project_links: DataFrame, lineage: DataFrame, owners: DataFrame) -> DataFrame:
    """Every way a user reaches a namespace: direct, through a project, through shares of a guest group or one of its
    ancestors, or as owner. Both access levels are kept; a guest is one with level 10 in either.

    ``lineage(namespace_id, upstream array)``; links carry ``link_id, group_id, guest_id, group_access``.
    """
    members = group_members.select(F.col("source_id").alias("via"), "user_id", "access_level")
    direct = group_members.select(F.col("source_id").alias("namespace_id"), F.lit("group_membership").alias("source_type"),
                                  F.col("source_id").alias("source_id"), "access_level", F.lit(None).cast("int").alias("group_access"), "user_id")
    by_project = project_members.join(projects, "project_id").select(
        F.col("group_id").alias("namespace_id"), F.lit("project_membership").alias("source_type"),
        F.col("project_id").alias("source_id"), "access_level", F.lit(None).cast("int").alias("group_access"), "user_id")

    def shared(links: DataFrame, label: str) -> DataFrame:
        guests = links.join(lineage, F.col("guest_id") == F.col("namespace_id")).select(
            "link_id", "group_id", "guest_id", "group_access", F.explode("upstream").alias("via"))
        kind = F.when(F.col("via") == F.col("guest_id"), label).otherwise(f"{label}_ancestor")
        return guests.join(members, "via").select(
            F.col("group_id").alias("namespace_id"), kind.alias("source_type"), F.col("link_id").alias("source_id"),
            "access_level", "group_access", "user_id")

    via_project = project_links.join(projects, "project_id").select("link_id", "group_id", "guest_id", "group_access")
    own = owners.select("namespace_id", F.lit("individual_namespace").alias("source_type"), F.col("namespace_id").alias("source_id"),
                        F.lit(50).alias("access_level"), F.lit(None).cast("int").alias("group_access"), "user_id")
    ways = [direct, by_project, shared(group_links, "group_group_link"), shared(via_project, "project_group_link"), own]
    whole = reduce(DataFrame.unionByName, ways).distinct()
    top = lineage.select("namespace_id", F.get("upstream", F.lit(0)).alias("ultimate_parent_id"))
    guest = F.coalesce(F.col("access_level") == 10, F.lit(False)) | F.coalesce(F.col("group_access") == 10, F.lit(False))
    return whole.join(top, "namespace_id").withColumn("is_guest", guest)


def flag_billable(members: DataFrame, state: str, kind: str, requested_at: str, plan: str, guest_free_plans: Sequence[str], bot: str = "Project Bot") -> DataFrame:
    """Active and billable flags: active are people in active state not awaiting access; guests are free on some plans.

    Wants ``is_guest`` of ``expand_membership``.
    """
    active = F.coalesce((F.col(state) == "active") & (F.col(kind).isNull() | (F.col(kind) != bot)) & F.col(requested_at).isNull(), F.lit(False))
    free = F.col(plan).isin(*guest_free_plans) & F.col("is_guest")
    return members.select("*", active.alias("is_active"), F.coalesce(active & ~free, F.lit(False)).alias("is_billable"))


def _path_by_rounds(n: DataFrame, edges: DataFrame) -> DataFrame:
    """:func:`critical_path` of runs of any size, whose nodes are spread: ``__run, length, p``.

    A node is settled when all its parents are, and then tells its children, so an edge is used once and there are as many rounds as levels in
    the deepest graph. A node's state is its length and the parent that gave it. The path is put together afterwards from the end of each
    run: step by step where graphs have up to eight levels, else pointers to parents are doubled, so n steps take log2(n) joins. Nodes left
    when none can be settled any more are on or behind a cycle, which fails.
    """
    at = ["__run", "__node"]
    n = n.groupBy(*at).agg(F.max("__cost").alias("__cost"))
    out = _kept_by(edges.join(n, at), *at)
    waits = out.groupBy("__run", F.col("__child").alias("__node")).agg(F.count("*").alias("__wait"))
    none = F.lit(None).cast(out.schema["__node"].dataType)
    state = n.join(waits, at, "full").select(
        *at, F.coalesce("__wait", F.lit(0).cast("long")).alias("__wait"),
        F.struct(F.when(F.col("__wait").isNull(), 0.0).alias("length"), none.alias("parent")).alias("__best"))
    settled = []
    while True:
        state = _kept_by(state, *at)
        ready = state.where("__wait = 0")
        left, open_nodes = state.agg(F.count_if(F.col("__wait") == 0), F.count_if(F.col("__wait") > 0)).first()
        settled.append(ready)
        if not open_nodes:
            break
        if not left:
            raise ValueError("a run's graph has a cycle")
        told = ready.join(out, at).select(
            "__run", F.col("__child").alias("__node"), F.lit(-1).cast("long").alias("__wait"),
            F.struct((F.col("__best.length") + F.col("__cost")).alias("length"), F.col("__node").alias("parent")).alias("__best"))
        state = state.where("__wait > 0").unionByName(told).groupBy(*at).agg(F.sum("__wait").alias("__wait"), F.max("__best").alias("__best"))
    best = reduce(DataFrame.unionByName, settled)
    ends = best.join(out.select(*at).distinct(), at, "left_anti")
    ends = ends.groupBy("__run").agg(F.max_by(F.struct("__node", F.col("__best.length").alias("length")), F.struct("__best.length", "__node")).alias("e"))
    ends = cut_lineage(ends.select("__run", "e.*"))
    on_path = [ends.select(*at, F.lit(0).cast("long").alias("__back"))]
    up = _kept_by(best.where(F.col("__best.parent").isNotNull()).select(*at, F.col("__best.parent").alias("__up")), *at)
    step, doubled = 1, len(settled) > 8  # on few levels, stepping back along one path per run costs less than pointers for all nodes
    while True:
        last = reduce(DataFrame.unionByName, on_path) if doubled else on_path[-1]
        more = _kept_by(last.join(up, at).select("__run", F.col("__up").alias("__node"), (F.col("__back") + step).alias("__back")), *at)
        if more.isEmpty():
            break
        on_path.append(more)
        if not doubled:
            continue
        step *= 2
        up = _kept_by(up.join(up.select("__run", F.col("__node").alias("__up"), F.col("__up").alias("__next")), ["__run", "__up"]).select(*at, F.col("__next").alias("__up")), *at)
    path = reduce(DataFrame.unionByName, on_path).groupBy("__run").agg(F.sort_array(F.collect_list(F.struct((-F.col("__back")).alias("o"), "__node"))).alias("p"))
    return ends.join(path, "__run").select("__run", "length", F.transform("p", lambda x: x["__node"]).alias("p"))


def critical_path(nodes: DataFrame, edges: DataFrame, run: str, node: str, cost: str, most: int = 300_000) -> DataFrame:
    """Costliest start-to-end path of every run; the last node's own cost is not counted.

    ``edges(run, parent, child)``. Runs of up to ``most`` nodes and edges are dealt whole and solved level by level in a task, many at
    once; larger ones are spread and take rounds of joins (:func:`_path_by_rounds`). An edge whose parent isn't listed is left out, a node
    listed twice counts with its highest cost, and a run with a cycle fails.
    """
    n = nodes.select(F.col(run).alias("__run"), F.col(node).alias("__node"), F.col(cost).cast("double").alias("__cost"))
    e = edges.select(F.col(run).alias("__run"), F.col("parent").alias("__node"), F.col("child").alias("__child"))
    none = F.lit(None).cast(e.schema["__child"].dataType)
    rows = n.select("__run", "__node", none.alias("__child"), "__cost", F.lit(False).alias("__is_edge")).unionByName(
        e.select("*", F.lit(None).cast("double").alias("__cost"), F.lit(True).alias("__is_edge"))).where("__run is not null")
    wide = rows.select("__node").union(rows.select("__child")).schema["__node"].dataType
    rows = scratch(rows.withColumns({c: F.col(c).cast(wide) for c in ("__node", "__child")}))
    if not all(isinstance(rows.schema[c].dataType, T.AtomicType) for c in ("__run", "__node")):
        most = 0  # nested values have no order in Arrow
    large = scratch(rows.groupBy("__run").count().where(F.col("count") > most).select("__run"))
    small, found = rows, []
    if not large.isEmpty():
        small, rest = rows.join(large, "__run", "left_anti"), rows.join(large, "__run")
        found.append(_path_by_rounds(rest.where("not __is_edge").select("__run", "__node", "__cost"), rest.where("__is_edge").select("__run", "__node", "__child")))
    kind = dict(rows.dtypes)
    shape = f"__run {kind['__run']}, length double, p array<{kind['__node']}>"
    solved = scratch(dealt(small, "__run").sortWithinPartitions("__run").mapInArrow(paths.whole_runs(100_000), shape))
    if not solved.where("p is null").isEmpty():
        raise ValueError("a run's graph has a cycle")
    return reduce(DataFrame.unionByName, found, solved).select(F.col("__run").alias(run), F.col("length").alias("path_length"), F.col("p").alias("critical_path"))


def account_entitlements(accounts: DataFrame, users: DataFrame, segments: DataFrame, account: str, owners: Sequence[str], segment: str, user: str,
                         manager: str, active: str, basis: str, levels: int = 3) -> DataFrame:
    """Who may see an account: its active owners in any role, and their active managers up to ``levels`` above; ``account_ownership``.

    Users found nowhere among these see the accounts of the segments that ``segments`` (user, segment, basis) gives them,
    with ``geo_`` before its basis. An inactive manager ends the chain.
    """
    staff = users.where(active).select(F.col(user).alias("__u"), F.col(manager).alias("__m"))
    at = accounts.select(account, segment, F.explode(F.array_distinct(F.array_compact(F.array(*owners)))).alias("__next"))
    found = []
    for _ in range(levels + 1):
        at = at.join(staff, F.col("__next") == F.col("__u")).select(account, segment, F.col("__u").alias(user), F.col("__m").alias("__next")).distinct()
        found.append(at.drop("__next"))
        at = at.drop(user)
    owned = reduce(DataFrame.unionByName, found).distinct()
    others = segments.join(owned.select(user).distinct(), user, "left_anti")
    # Distinct on both sides before they meet makes the pairs distinct. A segment has few values, so its accounts are dealt to ``slots`` that
    # each get all its users.
    slots = int(accounts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = accounts.select(account, segment).distinct().withColumn("__slot", F.pmod(F.xxhash64(account), F.lit(slots)).cast("int"))
    others = others.select(user, segment, basis).distinct().withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    seen = sides.repartition(slots, segment, "__slot").join(others, [segment, "__slot"]).select(
        account, segment, user, F.concat(F.lit("geo_"), basis).alias("entitlement_basis"))
    return owned.withColumn("entitlement_basis", F.lit("account_ownership")).unionByName(seen)
