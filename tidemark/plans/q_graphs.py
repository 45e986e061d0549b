"""Hierarchies, chains and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import graphs, ordered
from tidemark.plans import inputs as i
from tidemark.plans.registry import query


@query("order_chains", covers="P27 J21", sql=f"""WITH RECURSIVE {i.SQL_ORDER_EDGES},
c AS (SELECT id, id AS root, 1 AS position, starts FROM order_edges WHERE parent_id IS NULL
 UNION ALL SELECT e.id, c.root, c.position + 1, c.starts FROM c JOIN order_edges e ON e.parent_id = c.id)
SELECT id, root, CAST(position AS BIGINT) AS position, CAST(max(position) OVER (PARTITION BY root) AS BIGINT) AS chain_length, starts AS cohort_start FROM c""")
def order_chains(t):
    return graphs.lineage_paths(i.order_edges(t), "id", "parent_id", "starts")


@query("resolve_redirects", covers="P30", sql=f"""WITH RECURSIVE {i.SQL_ORDER_EDGES},
r AS (SELECT id, CASE WHEN id % 3 <> 0 THEN parent_id END AS target FROM order_edges),
c AS (SELECT id, id AS final_id, 0 AS steps FROM r WHERE target IS NULL UNION ALL SELECT r.id, c.final_id, c.steps + 1 FROM c JOIN r ON r.target = c.id)
SELECT id, final_id, final_id <> id AS is_redirected, CAST(steps AS BIGINT) AS steps FROM c""")
def resolve_redirects(t):
    r = i.order_edges(t).select("id", F.when(F.col("id") % 3 != 0, F.col("parent_id")).alias("target"))
    return graphs.resolve_redirects(r, "id", "target")


@query("flatten_hierarchy", covers="P28", sql=f"""WITH RECURSIVE {i.SQL_GEO_TREE},
h AS (SELECT id, name, 1 AS lvl, id AS lvl_1_id, name AS lvl_1_name, CAST(NULL AS BIGINT) AS lvl_2_id, CAST(NULL AS VARCHAR) AS lvl_2_name, CAST(NULL AS BIGINT) AS lvl_3_id, CAST(NULL AS VARCHAR) AS lvl_3_name FROM geo_tree WHERE parent_id IS NULL
 UNION ALL SELECT g.id, g.name, lvl + 1, lvl_1_id, lvl_1_name, CASE WHEN lvl = 1 THEN g.id ELSE lvl_2_id END, CASE WHEN lvl = 1 THEN g.name ELSE lvl_2_name END, CASE WHEN lvl = 2 THEN g.id END, CASE WHEN lvl = 2 THEN g.name END
 FROM h JOIN geo_tree g ON g.parent_id = h.id)
SELECT id, name, lvl AS hierarchy_level, lvl_1_id, lvl_2_id, lvl_3_id, lvl_1_name, lvl_2_name, lvl_3_name, CAST(NULL AS BIGINT) AS lvl_4_id, 0 AS n_deeper FROM h""")
def flatten_hierarchy(t):
    f = graphs.flatten_hierarchy(i.geo_tree(t), "id", "parent_id", "name")
    return f.select("id", "name", "hierarchy_level", F.size("deeper").alias("n_deeper"), *[f"lvl_{k}_id" for k in range(1, 5)], *[f"lvl_{k}_name" for k in range(1, 4)])


@query("recursive_sql_hierarchy", covers="J21 F07", sql=f"""WITH RECURSIVE {i.SQL_GEO_TREE},
h AS (SELECT id, name AS path, 1 AS lvl FROM geo_tree WHERE parent_id IS NULL UNION ALL SELECT g.id, h.path || '/' || g.name, lvl + 1 FROM h JOIN geo_tree g ON g.parent_id = h.id)
SELECT id, path, lvl FROM h""")
def recursive_sql_hierarchy(t):
    """The engine's own recursion suits shallow trees; the row limit is lifted because the tree grows with the data."""
    i.geo_tree(t).createOrReplaceTempView("tm_geo_tree")
    return t.spark.sql("""WITH RECURSIVE h(id, path, lvl) AS (
      SELECT id, name, 1 FROM tm_geo_tree WHERE parent_id IS NULL
      UNION ALL SELECT g.id, h.path || '/' || g.name, h.lvl + 1 FROM h JOIN tm_geo_tree g ON g.parent_id = h.id)
      SELECT id, path, lvl FROM h LIMIT ALL""")


SQL_TEMPORAL = f"""{i.SQL_ORDER_EDGES}, te AS (SELECT id, CASE WHEN id % 4 <> 0 THEN parent_id END AS parent_id, CAST(starts AS DATE) AS a, CAST(starts + INTERVAL 400 DAY AS DATE) AS b FROM order_edges)"""


@query("temporal_lineage", covers="P29", sql=f"""WITH RECURSIVE {SQL_TEMPORAL},
c AS (SELECT id, id AS root, 1 AS depth, CAST(id AS VARCHAR) AS path, a AS valid_from, b AS valid_to FROM te WHERE parent_id IS NULL
 UNION ALL SELECT te.id, c.root, depth + 1, c.path || ',' || CAST(te.id AS VARCHAR), greatest(c.valid_from, te.a), least(c.valid_to, te.b) FROM c JOIN te ON te.parent_id = c.id AND greatest(c.valid_from, te.a) < least(c.valid_to, te.b))
SELECT * FROM c""")
def temporal_lineage(t):
    e = i.order_edges(t)
    d = F.col("starts").cast("date")
    te = e.select("id", F.when(F.col("id") % 4 != 0, F.col("parent_id")).alias("parent_id"), d.alias("a"), F.date_add(d, 400).alias("b"))
    out = graphs.temporal_lineage(te, "id", "parent_id", "a", "b")
    return out.withColumn("path", F.array_join("path", ","))


@query("expand_membership", covers="P86 U02", sql="""WITH gm AS (SELECT CAST(c_nationkey AS BIGINT) AS source_id, c_custkey AS user_id, CAST((c_custkey % 5 + 1) * 10 AS INTEGER) AS access_level FROM customer),
projects AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS project_id, CAST(p_size % 25 AS BIGINT) AS group_id FROM part),
pm AS (SELECT CAST(s_suppkey % 50 + 1 AS BIGINT) AS project_id, s_suppkey AS user_id, CAST((s_suppkey % 4 + 1) * 10 AS INTEGER) AS access_level FROM supplier),
gl AS (SELECT CAST(n_nationkey AS BIGINT) AS link_id, CAST(n_nationkey AS BIGINT) AS group_id, CAST((n_nationkey * 7 + 1) % 25 AS BIGINT) AS guest_id, CAST((n_nationkey % 5 + 1) * 10 AS INTEGER) AS group_access FROM nation),
pl AS (SELECT project_id + 1000 AS link_id, group_id, (project_id * 3) % 25 AS guest_id, 20 AS group_access FROM projects),
lineage AS (SELECT CAST(n_nationkey AS BIGINT) AS namespace_id, unnest([CAST(n_regionkey + 100 AS BIGINT), CAST(n_nationkey AS BIGINT)]) AS via, CAST(n_regionkey + 100 AS BIGINT) AS top FROM nation),
ways AS (SELECT source_id AS namespace_id, 'group_membership' AS source_type, source_id, access_level, CAST(NULL AS INTEGER) AS group_access, user_id FROM gm
 UNION SELECT group_id, 'project_membership', project_id, access_level, NULL, user_id FROM pm JOIN projects USING (project_id)
 UNION SELECT group_id, CASE WHEN via = guest_id THEN 'group_group_link' ELSE 'group_group_link_ancestor' END, link_id, access_level, group_access, user_id FROM gl JOIN lineage ON guest_id = namespace_id JOIN gm ON via = source_id
 UNION SELECT group_id, CASE WHEN via = guest_id THEN 'project_group_link' ELSE 'project_group_link_ancestor' END, link_id, access_level, group_access, user_id FROM pl JOIN lineage ON guest_id = namespace_id JOIN gm ON via = source_id
 UNION SELECT CAST(c_nationkey AS BIGINT), 'individual_namespace', CAST(c_nationkey AS BIGINT), 50, NULL, min(c_custkey) FROM customer GROUP BY c_nationkey)
SELECT w.*, top AS ultimate_parent_id, coalesce(access_level = 10, false) OR coalesce(group_access = 10, false) AS is_guest FROM ways w JOIN (SELECT DISTINCT namespace_id, top FROM lineage) USING (namespace_id)""")
def expand_membership(t):
    big = lambda x: x.cast("long")
    gm = t.customer.select(big(F.col("c_nationkey")).alias("source_id"), F.col("c_custkey").alias("user_id"), ((F.col("c_custkey") % 5 + 1) * 10).cast("int").alias("access_level"))
    projects = t.part.select(big(F.col("p_size")).alias("project_id"), big(F.col("p_size") % 25).alias("group_id")).distinct()
    pm = t.supplier.select(big(F.col("s_suppkey") % 50 + 1).alias("project_id"), F.col("s_suppkey").alias("user_id"), ((F.col("s_suppkey") % 4 + 1) * 10).cast("int").alias("access_level"))
    n = big(F.col("n_nationkey"))
    gl = t.nation.select(n.alias("link_id"), n.alias("group_id"), ((n * 7 + 1) % 25).alias("guest_id"), ((n % 5 + 1) * 10).cast("int").alias("group_access"))
    pl = projects.select((F.col("project_id") + 1000).alias("link_id"), "project_id", ((F.col("project_id") * 3) % 25).alias("guest_id"), F.lit(20).alias("group_access"))
    lineage = t.nation.select(n.alias("namespace_id"), F.array(big(F.col("n_regionkey")) + 100, n).alias("upstream"))
    owners = t.customer.groupBy(big(F.col("c_nationkey")).alias("namespace_id")).agg(F.min("c_custkey").alias("user_id"))
    return graphs.expand_membership(gm, pm, projects, gl, pl, lineage, owners)


@query("billable_members", covers="P86", sql="""SELECT c_custkey, c_custkey % 5 = 0 AS is_guest, c_acctbal > 0 AND (c_custkey % 7 <> 0) AND c_custkey % 11 <> 0 AS is_active, c_acctbal > 0 AND (c_custkey % 7 <> 0) AND c_custkey % 11 <> 0 AND NOT (c_mktsegment = 'MACHINERY' AND c_custkey % 5 = 0) AS is_billable FROM customer""")
def billable_members(t):
    k = F.col("c_custkey")
    m = t.customer.select("c_custkey", (k % 5 == 0).alias("is_guest"), F.when(F.col("c_acctbal") > 0, "active").otherwise("blocked").alias("state"), F.when(k % 7 == 0, "Project Bot").alias("kind"),
                          F.when(k % 11 == 0, F.lit("2024-01-01")).alias("requested_at"), F.col("c_mktsegment").alias("plan"))
    return graphs.flag_billable(m, "state", "kind", "requested_at", "plan", ["MACHINERY"]).select("c_custkey", "is_guest", "is_active", "is_billable")


SQL_DAG = """nodes AS (SELECT l_orderkey AS run_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS node, l_extendedprice AS cost FROM lineitem)"""


@query("critical_path", covers="P94 M03", sql=f"""WITH RECURSIVE {SQL_DAG},
paths AS (SELECT run_id, node, 0.0::DOUBLE AS length, cost AS c, CAST(node AS VARCHAR) AS path FROM nodes WHERE node = 1
 UNION ALL SELECT n.run_id, n.node, p.length + p.c, n.cost, p.path || ',' || CAST(n.node AS VARCHAR) FROM paths p JOIN nodes n ON n.run_id = p.run_id AND (n.node = p.node + 1 OR n.node = p.node + 3)),
ends AS (SELECT run_id, max(node) AS node FROM nodes GROUP BY 1)
SELECT run_id, round(length, 2) AS path_length, path FROM paths JOIN ends USING (run_id, node) QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY length DESC, path) = 1""")
def critical_path(t):
    cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    ranked = ordered.with_row_index(t.lineitem.select("l_orderkey", *cols), ["l_orderkey"], cols, None, "node")
    nodes = ranked.select(F.col("l_orderkey").alias("run_id"), "node", F.col("l_extendedprice").alias("cost"))
    edges = nodes.select("run_id", F.explode(F.array(F.col("node") - 1, F.col("node") - 3)).alias("parent"), F.col("node").alias("child")).where(F.col("parent") >= 1)
    out = graphs.critical_path(nodes, edges, "run_id", "node", "cost")
    return out.select("run_id", F.round("path_length", 2).alias("path_length"), F.array_join("critical_path", ",").alias("path"))


@query("entitlements", covers="P104", sql="""WITH n AS (SELECT count(*) AS n FROM supplier), u AS (SELECT s_suppkey AS user_id, s_suppkey // 3 AS manager FROM supplier WHERE s_suppkey % 7 <> 0),
a AS (SELECT c_custkey AS account_id, c_mktsegment AS segment, (c_custkey * 7) % (n // 3 + 1) AS o1, (c_custkey * 11) % (n // 4 + 1) AS o2, CASE WHEN c_custkey % 5 = 0 THEN (c_custkey * 13) % (n // 5 + 1) END AS o3 FROM customer, n WHERE c_custkey % 2 = 0),
c AS (SELECT a.account_id, a.segment, u0.user_id AS l0, u1.user_id AS l1, u2.user_id AS l2, u3.user_id AS l3 FROM a JOIN u u0 ON u0.user_id IN (o1, o2, o3) LEFT JOIN u u1 ON u0.manager = u1.user_id LEFT JOIN u u2 ON u1.manager = u2.user_id LEFT JOIN u u3 ON u2.manager = u3.user_id),
owned AS (SELECT DISTINCT account_id, segment, user_id FROM (SELECT account_id, segment, unnest([l0, l1, l2, l3]) AS user_id FROM c) WHERE user_id IS NOT NULL),
g AS (SELECT s_suppkey AS user_id, ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY', 'HOUSEHOLD'][s_suppkey // 10 % 5 + 1] AS segment FROM supplier WHERE s_suppkey % 10 = 0)
SELECT *, 'account_ownership' AS entitlement_basis FROM owned UNION ALL SELECT account_id, segment, user_id, 'geo_segment' FROM (SELECT DISTINCT a.account_id, a.segment, g.user_id FROM a JOIN g ON g.segment = a.segment WHERE g.user_id NOT IN (SELECT user_id FROM owned))""")
def entitlements(t):
    """Three owner roles, inactive users, and segments for those who own nothing."""
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    total = t.supplier.agg(F.count("*").alias("n")).scalar()
    part = lambda d: F.floor(total / d).cast("long") + 1
    users = t.supplier.select(k.alias("user_id"), F.floor(k / 3).cast("long").alias("manager"), (k % 7 != 0).alias("is_active"))
    accounts = t.customer.where(c % 2 == 0).select(
        c.alias("account_id"), F.col("c_mktsegment").alias("segment"), ((c * 7) % part(3)).alias("o1"), ((c * 11) % part(4)).alias("o2"),
        F.when(c % 5 == 0, (c * 13) % part(5)).alias("o3"))
    names = F.array(*[F.lit(x) for x in ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")])
    segments = t.supplier.where(k % 10 == 0).select(k.alias("user_id"), F.element_at(names, (F.floor(k / 10) % 5 + 1).cast("int")).alias("segment"), F.lit("segment").alias("basis"))
    return graphs.account_entitlements(accounts, users, segments, "account_id", ["o1", "o2", "o3"], "segment", "user_id", "manager", "is_active", "basis")
