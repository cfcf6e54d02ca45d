"""Queries on parents' evidence, merged claims and candidates, and reports on graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions import text
from weft.operators import assemble, checks, dedup, metrics, pairs, resolve
from weft.plans.tables import HIERARCHY, hierarchy, table

NONE = "array<string>"


def _outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and suppliers as items of one document, with what the rules on parents look at."""
    empty = F.array().cast(NONE)
    nothing = F.map_from_arrays(empty, empty)
    source = F.array().cast("array<struct<segment:string,window:string,index:int>>")
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.lower("r_name").alias("region"))
    n = table(spark, sf_dir, "nation").join(F.broadcast(r), "n_regionkey")
    s = table(spark, sf_dir, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
    k, i = F.col("n_nationkey"), F.col("s_suppkey")
    name = F.lower("n_name")
    local = lambda c, v: F.when(c, F.map_from_arrays(F.array(F.lit("Nation")), F.array(F.array(v))))
    spot = lambda seg, w, x: F.array(F.struct(seg.cast("string").alias("segment"), w.cast("string").alias("window"), x.cast("int").alias("index")))
    nation = n.select(
        F.lit("d").alias("doc"), F.concat(F.lit("n"), k.cast("string")).alias("id"), F.lit("Nation").alias("type"), F.lit(True).alias("grouping"), (k * 6).cast("int").alias("order"),
        F.concat(F.lit("N"), (k % 10).cast("string")).alias("code"), name.alias("text"), name.alias("value"), F.map_from_arrays(F.array(F.lit("Region")), F.array(F.col("region"))).alias("scope"),
        F.lit(None).cast("map<string,array<string>>").alias("local_values"), empty.alias("section_labels"), F.array(F.concat(F.lit("c"), (k % 9).cast("string"))).alias("context_keys"),
        F.array((k % 4).cast("string")).alias("segments"), F.array(k.cast("string")).alias("windows"), F.array(k.cast("int")).alias("window_indexes"), F.when(k % 2 == 0, F.array((k % 3).cast("string"))).otherwise(empty).alias("table_keys"),
        spot(k % 4, k, k).alias("headers"), source.alias("rows"), (k % 5 == 0).alias("recoded"),
    )
    supplier = s.select(
        F.lit("d").alias("doc"), F.concat(F.lit("s"), i.cast("string")).alias("id"), F.lit("Supplier").alias("type"), F.lit(False).alias("grouping"), (k * 6 + i % 20).cast("int").alias("order"),
        F.concat(F.lit("S"), (i % 10).cast("string")).alias("code"), F.lower("s_name").alias("text"), F.lower("s_name").alias("value"),
        F.when(i % 4 == 0, nothing).when(i % 4 == 1, F.map_from_arrays(F.array(F.lit("Nation"), F.lit("Region")), F.array(name, F.col("region")))).when(i % 4 == 2, F.map_from_arrays(F.array(F.lit("Nation")), F.array(name))).otherwise(F.map_from_arrays(F.array(F.lit("Region")), F.array(F.lit("elsewhere")))).alias("scope"),
        local(i % 3 == 0, name).alias("local_values"), F.when(i % 5 == 0, F.array(F.concat(F.lit("part of "), name, F.lit("s")))).otherwise(empty).alias("section_labels"), F.array(F.concat(F.lit("c"), (i % 30).cast("string"))).alias("context_keys"),
        F.array((i % 50).cast("string")).alias("segments"), F.array((i % 40).cast("string")).alias("windows"), F.array((i % 60).cast("int")).alias("window_indexes"), F.array((i % 25).cast("string")).alias("table_keys"),
        source.alias("headers"), F.when(i % 6 == 0, spot(k % 4, k + i % 5, k + i % 5)).otherwise(source).alias("rows"), F.lit(False).alias("recoded"),
    )
    return nation.unionByName(supplier)


def _outline_inputs(spark: SparkSession, sf_dir: str) -> dict:
    hints = spark.range(10).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("child_code"), F.concat(F.lit("N"), ((F.col("id") * 3) % 10).cast("string")).alias("parent_code"))
    s = table(spark, sf_dir, "supplier")
    end = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    kind = F.element_at(F.array(*map(F.lit, ["covering", "same_unit", "same_row"])), (F.col("s_suppkey") % 3 + 1).cast("int"))
    relations = s.where("s_suppkey % 8 = 0").select(F.lit("d").alias("doc"), end("s", F.col("s_suppkey")).alias("child"), end("n", (F.col("s_nationkey") + 1) % 25).alias("parent"), kind.alias("relation"))
    outline = s.where("s_suppkey % 7 < 3").select(F.lit("d").alias("doc"), end("s", F.col("s_suppkey")).alias("child"), end("n", F.col("s_nationkey")).alias("parent"))
    return {"hints": hints, "relations": relations, "outline": outline}


def parent_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons for which a nation may be the parent of a supplier, by all rules."""
    policy = spark.createDataFrame([("Supplier", "Nation")], "child_type string, parent_type string")
    got = resolve.parent_evidence(_outline(spark, sf_dir), policy, **_outline_inputs(spark, sf_dir))
    return got.select("child", "parent", F.array_join("reasons", ",").alias("reasons"))


def resolved_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded parents of all suppliers and nations, from evidence to order."""
    policy = spark.createDataFrame([("Supplier", "Nation")], "child_type string, parent_type string")
    got = resolve.parents_of(_outline(spark, sf_dir), policy, most=5, must=("identity_scope_complete_parent_match",), **_outline_inputs(spark, sf_dir))
    return got.select("child", "parent", "place", "tier", "weight")


def skill_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as claims within their brands: groups that stay after made-up verdicts on the blocked pairs."""
    return _claims(spark, sf_dir)[0].select("scope", "canonical", F.array_join("texts", "|").alias("texts"), "n_claims", F.size("seeds").alias("n_seeds"))


def skill_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked pairs that no verdict decides."""
    return _claims(spark, sf_dir)[1]


def _claims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    path = F.array(F.struct(F.lit("root").alias("id"), F.array().cast(NONE).alias("parents")), F.struct(F.col("p_type").alias("id"), F.array(F.lit("root")).alias("parents")))
    scope = dedup.dedup_scope("parent", F.col("p_partkey"), path, F.array("p_brand"), F.col("p_partkey") % 29 > 0)
    claims = p.select(scope.alias("scope"), F.col("p_partkey").alias("seed"), F.concat(F.initcap("p_name"), F.when(F.col("p_size") % 2 == 0, " .").otherwise("")).alias("text"), F.col("p_type").alias("tag"), F.concat_ws(":", "p_brand", (F.col("p_size") % 10).cast("string")).alias("parent"))
    names = p.select("p_brand", "p_name").distinct()
    both = names.alias("a").join(names.alias("b"), "p_brand").where("a.p_name < b.p_name")
    h = F.crc32(F.concat("p_brand", F.col("a.p_name"), F.col("b.p_name")).cast("binary")) % 5
    decisions = both.where(h < 4).select(F.col("p_brand").alias("scope"), F.col("a.p_name").alias("text_a"), F.col("b.p_name").alias("text_b"), (h == 0).alias("same"))
    return dedup.dedup_claims(claims, decisions, tags="tag", parents="parent", pack={"stopwords": ["old"], "prefixes": ["an"], "suffixes": ["et"]})


def candidate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as candidates, alike by brand, name and size class: what becomes of them after made-up decisions."""
    p = table(spark, sf_dir, "part").withColumn("id", F.col("p_partkey"))
    edge = F.concat_ws(":", "p_brand", "p_name")
    candidates = p.select("id", F.when(F.col("id") % 3 > 0, F.col("p_brand")).alias("code"), F.col("p_type").alias("type"), (F.col("p_size") % 2).alias("half"))
    least = F.min("p_partkey").over(Window.partitionBy("p_brand", "p_name"))
    n = F.count("*").over(Window.partitionBy("p_brand", "p_name"))
    part = F.when(n > 4, F.concat_ws("/", least.cast("string"), (F.col("p_size") % 2).cast("string"))).otherwise(least.cast("string"))
    verdicts = F.array(*map(F.lit, ["merge", "keep_separate", "conflict", "needs_review"]))
    decided = p.select(part.alias("part"), "id", F.element_at(verdicts, (least % 4 + 1).cast("int")).alias("decision"), F.lit(1).alias("decision_group"), F.when(least % 3 == 0, least).alias("code_from"), least.alias("type_from"), least.alias("_l")).where("_l % 5 > 0").drop("_l")
    return dedup.resolve_candidates(candidates, p.select(edge.alias("edge"), "id"), decided, most=4, split=["half"])[1]


def graph_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on the hierarchy with faults put in: repeated, missing, looping and unreachable nodes."""
    nodes, edges = _faulty(spark, sf_dir)
    policy = spark.createDataFrame([("supplier", 1, 1), ("customer", 1, 1)], "kind string, least int, most int")
    covered = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("id")).union(nodes.where("kind <> 'supplier'").select("id"))
    got = checks.graph_report(nodes, edges, root="root", covered=covered, expected={"nodes": 7}, policy=policy)
    return got.where("rule <> 'wrong_count'").select("rule", "n", F.array_join("examples", ",").alias("examples"))


def graph_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on that graph: errors, and what only warns."""
    got = checks.verdict(checks.graph_report(*_faulty(spark, sf_dir), root="root"), ("unreachable", "cyclic_nodes"))
    return got.select("passed", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


def _faulty(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = hierarchy(spark, sf_dir)
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"))
    nodes = h.select(F.col("child").alias("id"), F.col("child_kind").alias("kind")).union(regions.select("id", F.lit("region"))).union(spark.createDataFrame([("root", "root"), ("n3", "nation"), ("lost", "nation"), ("x1", "nation"), ("x2", "nation")], "id string, kind string"))
    more = spark.createDataFrame([("n4", "nowhere"), ("n5", "n5"), ("s1", "n1"), ("s1", "n1"), ("x1", "x2"), ("x2", "x1")], "child string, parent string")
    return nodes, h.select("child", "parent").union(regions.select("id", F.lit("root"))).union(more)


def uncovered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders that chunks of three, of which every fourth is missing, leave out."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"))
    chunks = l.groupBy("l_orderkey", F.floor((F.col("line") - 1) / 3).alias("c")).agg(F.min("line").alias("first"), F.max("line").alias("last")).where((F.col("l_orderkey") + F.col("c")) % 4 > 0)
    return checks.uncovered_rows(l, chunks, ["l_orderkey"], "line")


def recounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose stated number of orders, their key modulo 20, isn't the found one."""
    stated = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 20).alias("n"))
    return checks.recount(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], stated)


def endpoint_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as items with parts as components, in a hierarchy in which every ninth nation has two parents."""
    second = table(spark, sf_dir, "nation").where("n_nationkey % 9 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("r"), ((F.col("n_regionkey") + 1) % 5).cast("string")).alias("parent"))
    edges = hierarchy(spark, sf_dir).where("child_kind <> 'customer'").select("child", "parent").unionByName(second)
    uses = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("item"), F.col("l_partkey").alias("component"))
    return metrics.endpoint_features(edges, uses, least=30)


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and whether they take part in two relations, with the first reason against it."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    rules = {"builds": [("type not allowed", F.col("p_type") == "PROMO"), ("too small", F.col("p_size") < 5)], "relates": [("unresolved", F.col("p_partkey") % 10 == 0), ("too small", F.col("p_size") < 3)]}
    return pairs.eligibility(p, rules).groupBy("relation", "reason").agg(F.count("*").alias("n"), F.count_if("eligible").alias("n_eligible"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as candidates of windows, in one table with keys; and how the repeats of a key count."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.when(F.col("l_linenumber") < 4, F.col("l_partkey") % 3).alias("local_id"), "l_suppkey"))).alias("c"))
    got = assemble.flatten_windows(l.withColumn("doc", F.lit("orders")), "doc", "l_orderkey", "c")
    return got.select("window", "place", "key", "l_suppkey")


def component_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' brands, types and sizes as signals, restricted to parts of one name and retail price class."""
    p = table(spark, sf_dir, "part")
    signals = p.select(F.col("p_partkey").alias("id"), F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in ("p_brand", "p_type", "p_size")])).alias("s")).select("id", "s.kind", "s.value")
    members = p.select(F.col("p_partkey").alias("id"), F.concat_ws(":", "p_name", F.floor(F.col("p_retailprice") / 50).cast("string")).alias("component"))
    got = assemble.signals_within(signals, members)
    return got.select("component", "kind", "value", "n", F.array_join("ids", ",").alias("ids"))


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of parts as windows: those there are within two of any size that a brand has."""
    p = table(spark, sf_dir, "part")
    return assemble.neighbour_windows(p.where("p_size % 7 = 0").select("p_brand", "p_size"), p.where("p_size % 3 > 0").select("p_size"), "p_brand", "p_size", 2)


def spreads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread of parts' prices by brand and name; 0 for single ones."""
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.round(metrics.spread(F.col("p_retailprice")), 6).alias("sd"))


def registry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of parts by type, brand and size, with those of the names that repeat within each."""
    p = table(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("string"))
    return metrics.sliced(p, ["p_type", "p_brand", "size"], [F.count("*").alias("n"), F.count_distinct("p_name").alias("n_names")])


QUERIES = {f.__name__: f for f in (parent_evidence, resolved_parents, skill_groups, skill_reviews, candidate_groups, graph_report, graph_verdict, uncovered_rows, recounted, endpoint_features, eligibility, registry, component_signals, context_windows, spreads, registry_summary)}

_EVIDENCE = """
p as (select s_suppkey i, s_nationkey sk, lower(o.n_name) own, lower(r.r_name) own_region, n.n_nationkey k, lower(n.n_name) name, lower(q.r_name) region
  from supplier join nation o on o.n_nationkey = s_nationkey join region r on r.r_regionkey = o.n_regionkey, nation n join region q on q.r_regionkey = n.n_regionkey),
v as (select *, case i % 4 when 1 then own when 2 then own end wanted, case i % 4 when 1 then own_region when 3 then 'elsewhere' end above, sk * 6 + i % 20 - k * 6 distance, abs(i % 60 - k) <= 2 near,
  i % 30 = k % 9 ctx, i % 50 = k % 4 seg, i % 40 = k win, k % 2 = 0 and i % 25 = k % 3 tab, i % 5 = 0 and contains('part of ' || own || 's', name) label, i % 6 = 0 and sk % 4 = k % 4 and sk + i % 5 - k between 0 and 2 heads,
  case when i % 8 = 0 and k = (sk + 1) % 25 then ['covering', 'same_unit', 'same_row'][i % 3 + 1] end relation, i % 7 < 3 and k = sk lined from p),
w as (select *, coalesce(wanted = name, false) direct, coalesce(above = region, false) matching, above is not null and above <> region conflicting, above is null absent, i % 3 = 0 local from v),
e as (select i, k, relation, list_filter([case when lined then 'active_outline_stack_parent' end, case when k % 10 = i % 10 * 3 % 10 and (ctx or seg or win or tab or label or (near and k % 5 > 0)) then 'code_parent_hint' end,
  case when matching then 'identity_scope_ancestor_match' end, case when direct and not conflicting and not absent then 'identity_scope_complete_parent_match' end,
  case when direct and (conflicting or absent) then 'identity_scope_direct_parent_match' end, case when lined and (ctx or relation is not null) then 'local_active_outline_direct_parent' end,
  case when label then 'matched_section_path_label' end, case when near then 'nearby_source_context_key' end, case when distance between 1 and 8 then 'nearest_preceding_grouping' end,
  case when relation = 'covering' then 'parent_cell_applies_to_child_row' end, case when relation = 'same_row' then 'same_raw_table_row' end, case when ctx then 'same_source_context_key' end,
  case when seg then 'same_source_segment' end, case when relation = 'same_unit' then 'same_source_unit' end, case when win then 'same_source_window' end, case when tab then 'same_table_context' end,
  case when local and own = name then 'source_local_controlled_parent_scope' end, case when heads then 'source_scope_grouping' end, case when heads then 'source_visible_direct_parent' end,
  case when distance between 1 and 12 then 'statement_type_compatible' end], lambda x: x is not null) good,
  list_filter([case when conflicting then 'identity_scope_ancestor_conflict' end, case when wanted is not null and wanted <> name then 'identity_scope_direct_parent_conflict' end,
  case when local and own <> name then 'source_local_controlled_parent_scope_conflict' end], lambda x: x is not null) bad from w),
f as (select 's' || i child, 'n' || k parent, relation, list_sort(list_concat(good, bad)) reasons from e where len(good) > 0)"""
_TIES = """
g as (select child, parent, case when relation is not null and count(*) over (partition by child, relation) > 1 then list_filter(reasons, lambda x: x not in ('active_outline_stack_parent', 'local_active_outline_direct_parent')) else reasons end r from f),
h as (select child, parent, r, list_has_any(r, ['parent_cell_applies_to_child_row', 'same_raw_table_row', 'same_source_context_key', 'same_source_segment', 'same_source_unit', 'same_source_window']) near from g where len(r) > 0),
t as (select child, parent, list_contains(r, 'identity_scope_complete_parent_match') must, case when list_contains(r, 'identity_scope_complete_parent_match') then 0
  when list_has_any(r, ['code_parent_hint', 'parent_cell_applies_to_child_row', 'source_scope_grouping']) then 1
  when list_has_any(r, ['identity_scope_direct_parent_match', 'same_raw_table_row', 'same_source_unit', 'source_visible_direct_parent']) then 2
  when list_has_any(r, ['local_active_outline_direct_parent', 'same_table_context']) then 3 when list_contains(r, 'active_outline_stack_parent') and near then 4
  when (list_contains(r, 'active_outline_stack_parent') and list_contains(r, 'matched_section_path_label')) or (list_contains(r, 'nearest_preceding_grouping') and list_contains(r, 'nearby_source_context_key') and list_contains(r, 'statement_type_compatible')) then 5
  when near then 6 when list_has_any(r, ['active_outline_stack_parent', 'matched_section_path_label', 'nearby_source_context_key', 'nearest_preceding_grouping', 'statement_type_compatible']) then 7 else 8 end tier,
  coalesce(list_sum(list_transform(r, lambda x: coalesce(map {'active_outline_stack_parent': 70, 'code_parent_hint': 125, 'identity_scope_ancestor_conflict': -110, 'identity_scope_ancestor_match': 80, 'identity_scope_complete_parent_match': 180,
    'identity_scope_direct_parent_conflict': -140, 'identity_scope_direct_parent_match': 120, 'local_active_outline_direct_parent': 100, 'matched_section_path_label': 60, 'nearby_source_context_key': 35, 'nearest_preceding_grouping': 30,
    'parent_cell_applies_to_child_row': 170, 'same_raw_table_row': 135, 'same_source_context_key': 70, 'same_source_segment': 60, 'same_source_unit': 145, 'same_source_window': 55, 'same_table_context': 85,
    'source_local_controlled_parent_scope_conflict': -45, 'source_local_controlled_parent_scope': 75, 'source_scope_grouping': 120, 'source_visible_direct_parent': 125, 'statement_type_compatible': 10}[x], 0))), 0) weight from h),
o as (select *, row_number() over (partition by child order by must desc, tier, weight desc, parent) place from t), c as (select * from o where place <= 4)"""
_FAULTY = f"""{HIERARCHY}, nodes(id, kind) as (select child, child_kind from edges union all select 'r' || r_regionkey, 'region' from region union all values ('root', 'root'), ('n3', 'nation'), ('lost', 'nation'), ('x1', 'nation'), ('x2', 'nation')),
links(child, parent) as (select child, parent from edges union all select 'r' || r_regionkey, 'root' from region union all values ('n4', 'nowhere'), ('n5', 'n5'), ('s1', 'n1'), ('s1', 'n1'), ('x1', 'x2'), ('x2', 'x1'))"""

SQL = {
    "parent_evidence": f"with {_EVIDENCE} select child, parent, array_to_string(reasons, ',') reasons from f",
    "resolved_parents": f"""
with {_EVIDENCE}, {_TIES}, a as (select 's' || s_suppkey child from supplier union all select 'n' || n_nationkey from nation), l as (select child, max(place) p from c group by 1)
select child, parent, place::integer place, tier::integer tier, weight::integer weight from c
union all select child, 'root', (coalesce(p, 0) + 1)::integer, 90, 0 from a left join l using (child)""",
    "candidate_groups": """
with x as (select p_partkey id, case when p_partkey % 3 > 0 then p_brand end code, p_type as type, p_size % 2 h, min(p_partkey) over w least, count(*) over w n from part window w as (partition by p_brand, p_name)),
y as (select *, case when n > 4 then least || '/' || h else least::varchar end part from x), z as (select *, count(*) over (partition by part, n > 1) m from y),
d as (select *, n < 2 or m < 2 alone, m <= 4 fine, least % 5 > 0 said, ['merge', 'keep_separate', 'conflict', 'needs_review'][least % 4 + 1] v from z),
e as (select *, case when alone then 'singleton' when not fine or not said then 'needs_review' when v = 'merge' then 'merged' when v = 'keep_separate' then 'singleton' else v end merge_decision from d),
f as (select *, case when merge_decision = 'singleton' then 'one:' || id when fine and said then 'decided:' || part || ':1' else 'review:' || part end group_id,
  case when fine and said and not alone and least % 3 = 0 and id = least then code end pc, case when fine and said and not alone and id = least then type end pt from e),
g as (select group_id, merge_decision, count(*) n, count(distinct code) nc, min(code) c, min(pc) pc, count(distinct type) nt, min(type) t, min(pt) pt from f group by 1, 2)
select group_id, merge_decision, n, case when nc = 1 then c when nc > 1 then pc end code, case when nc = 0 then 'none' when nc = 1 then 'single' when pc is not null then 'selected' else 'unresolved' end code_choice,
  case when nt = 1 then t else pt end as type, case when nt <= 1 then 'single' when pt is not null then 'selected' else 'unresolved' end type_choice from g""",
    "graph_report": f"""
with recursive {_FAULTY}, sound as (select distinct child, parent from links where child <> parent), down(id) as (select child from sound where parent = 'root' union select child from down join sound on parent = id),
r as (select 'repeated_nodes' as rule, id from nodes group by id having count(*) > 1 union all select 'missing_endpoints', id from (select child id from links union select parent from links) where id not in (select id from nodes)
  union all select 'repeated_edges', child || '>' || parent from links group by child, parent having count(*) > 1 union all select distinct 'self_edges', child from links where child = parent
  union all values ('cyclic_nodes', 'x1'), ('cyclic_nodes', 'x2') union all select distinct 'unreachable', id from nodes where id <> 'root' and id not in (from down)
  union all select distinct 'uncovered', id from nodes where kind = 'supplier' and substr(id, 2)::bigint not in (select l_suppkey from lineitem)
  union all select 'wrong_parents', n.id from (select distinct id from nodes where kind in ('supplier', 'customer')) n left join sound on child = n.id group by n.id having count(parent) <> 1),
u(rule) as (values ('repeated_nodes'), ('missing_endpoints'), ('repeated_edges'), ('self_edges'), ('cyclic_nodes'), ('unreachable'), ('uncovered'), ('wrong_parents'))
select rule, count(id) n, coalesce(array_to_string((list(id order by id) filter (id is not null))[:5], ','), '') examples from u left join r using (rule) group by 1""",
    "graph_verdict": "select false passed, 'missing_endpoints,repeated_edges,repeated_nodes,self_edges' errors, 'cyclic_nodes,unreachable' warnings",
    "uncovered_rows": """
with l as (select distinct l_orderkey, l_linenumber::bigint line from lineitem)
select * from l where (l_orderkey + (line - 1) // 3) % 4 = 0""",
    "recounted": """
with f as (select o_custkey c_custkey, count(*) n from orders group by 1)
select c_custkey, coalesce(c.c_custkey % 20, 0)::bigint stated, coalesce(n, 0) found from customer c full join f using (c_custkey) where coalesce(c.c_custkey % 20, 0) <> coalesce(n, 0)""",
    "endpoint_features": f"""
with recursive {HIERARCHY}, e as (select distinct child, parent from edges where child_kind <> 'customer' union select 'n' || n_nationkey, 'r' || (n_regionkey + 1) % 5 from nation where n_nationkey % 9 = 0),
u as (select distinct 's' || l_suppkey item, l_partkey c from lineitem), o as (select c from u group by 1 having count(*) >= 30), m as (select child from e group by 1 having count(*) > 1),
b(node) as (select child from m union select e.child from b join e on e.parent = b.node), n as (select child node from e union select parent from e union select item from u)
select node, (select count(*) from e where child = node) parents, (select count(*) from e where parent = node) children, (select count(*) from u where item = node) components,
  exists (select 1 from u join o using (c) where item = node) reused, node in (from b) below_many from n""",
    "eligibility": """
with x as (select 'builds' relation, case when p_type = 'PROMO' then 'type not allowed' when p_size < 5 then 'too small' end reason from part
  union all select 'relates', case when p_partkey % 10 = 0 then 'unresolved' when p_size < 3 then 'too small' end from part)
select relation, reason, count(*) n, count(*) filter (reason is null) n_eligible from x group by 1, 2""",
    "registry": """
with l as (select l_orderkey w, l_linenumber n, case when l_linenumber < 4 then l_partkey % 3 end i, l_suppkey, row_number() over (partition by l_orderkey order by l_linenumber, case when l_linenumber < 4 then l_partkey % 3 end nulls first, l_suppkey) - 1 p from lineitem)
select w as window, p::integer place, 'orders:' || w || ':' || coalesce(i::varchar, '#' || p) as key, l_suppkey from l""",
    "component_signals": """
with s as (select p_partkey id, p_name || ':' || floor(p_retailprice / 50)::bigint component, unnest([{'kind': 'p_brand', 'value': p_brand}, {'kind': 'p_type', 'value': p_type}, {'kind': 'p_size', 'value': p_size::varchar}]) s from part)
select component, s.kind as kind, s.value as value, count(*) n, array_to_string(list(id order by id), ',') ids from s group by 1, 2, 3 having count(*) >= 2""",
    "context_windows": "select distinct a.p_brand, b.p_size from part a join part b on a.p_size % 7 = 0 and b.p_size % 3 > 0 and abs(a.p_size - b.p_size) <= 2",
    "spreads": "select p_brand, p_name, round(case when count(*) < 2 then 0 else stddev_pop(p_retailprice) end, 6) sd from part group by 1, 2",
    "registry_summary": """
select 'all' slice, null::varchar as value, count(*) n, count(distinct p_name) n_names from part union all select 'p_type', p_type, count(*), count(distinct p_name) from part group by 2
union all select 'p_brand', p_brand, count(*), count(distinct p_name) from part group by 2 union all select 'size', p_size::varchar, count(*), count(distinct p_name) from part group by 2""",
}
