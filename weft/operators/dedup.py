"""Finding and resolving repeated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.text import fold_affixes, grams, jaccard, skill_key, words
from weft.operators.components import connected_components
from weft.sources.scratch import materialize

# How strong a signal each kind of bucket is.
STRENGTH = {"code": "strong_signal", "description_text": "medium_signal", "source_text": "weak_signal"}


def duplicate_buckets(df: DataFrame, keys: dict[str, Column], item: str, *, type: Column, example: Column, examples: int = 5) -> DataFrame:
    """Groups of two or more rows with one key, for each kind of key: kind, bucket_key, strength, n, ids, types, examples.

    ids and examples are the least ids and the first different examples by id, so many of each; types are all there are.
    So a key that most rows share stays one small row; bucket_members() has all ids, a row each. Null and blank keys make no
    bucket.
    """
    members = bucket_members(df.withColumns({"_type": type, "_example": example}), keys, item, "_type", "_example")
    big = members.groupBy("kind", "bucket_key").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("_type")).alias("types")).where("n >= 2")
    w = Window.partitionBy("kind", "bucket_key")

    def least(rows: DataFrame, order: str, column: str, name: str) -> DataFrame:
        ranked = rows.withColumn("_k", F.row_number().over(w.orderBy(order, column))).where(F.col("_k") <= examples)
        return ranked.groupBy("kind", "bucket_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(column).alias("v")))), lambda x: x["v"]).alias(name))

    ids = least(members.select("kind", "bucket_key", "id"), "id", "id", "ids")
    firsts = least(members.where("_example is not null").groupBy("kind", "bucket_key", "_example").agg(F.min("id").alias("id")), "id", "_example", "examples")
    strength = F.create_map(*[x for k, v in STRENGTH.items() for x in (F.lit(k), F.lit(v))])
    out = big.join(ids, ["kind", "bucket_key"]).join(firsts, ["kind", "bucket_key"], "left")
    return out.select("kind", "bucket_key", F.element_at(strength, F.col("kind")).alias("strength"), "n", "ids", "types", F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def bucket_members(df: DataFrame, keys: dict[str, Column], item: str, *more: str) -> DataFrame:
    """(kind, bucket_key, id) of every row and kind of key, and further columns."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), key.cast("string").alias("bucket_key")) for k, key in keys.items()])
    rows = df.select(F.col(item).alias("id"), *more, F.explode(each).alias("_b"))
    return rows.select("_b.kind", "_b.bucket_key", "id", *more).where("trim(bucket_key) <> ''")


def frequent_tokens(df: DataFrame, tokens: Column, share: float = 0.15) -> DataFrame:
    """Tokens in more than the given share of rows (strictly): token, n."""
    n = df.count()
    return df.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > share * n)


def token_rules(a: Column, b: Column, *, suffix: str = "", threshold: float = 0.55, containment: float = 0.75, shared: int = 2) -> list[Column]:
    """Names of the token-set rules that two sets fulfil, as nullable columns; none for empty sets."""
    some = (F.size(a) > 0) & (F.size(b) > 0)
    common = F.size(F.array_intersect(a, b))
    return [
        F.when(some & (F.size(F.array_union(a, b)) == common), F.lit(f"token_identical{suffix}")),
        F.when(some & (jaccard(a, b) >= threshold), F.lit(f"token_jaccard{suffix}")),
        F.when(some & (common / F.least(F.size(a), F.size(b)) >= containment) & (common >= shared), F.lit(f"containment{suffix}")),
    ]


def scope_stopwords(tokens: DataFrame, share: float) -> DataFrame:
    """(scope, t) of tokens in more than a share of their scope's texts; tokens has scope, text and t, each once."""
    texts = tokens.groupBy("scope").agg(F.count_distinct("text").alias("_n"))
    return tokens.groupBy("scope", "t").agg(F.count("*").alias("_df")).join(texts, "scope").where(F.col("_df") > share * F.col("_n")).select("scope", "t")


def _met(sets: DataFrame, probe: Column, index: Column) -> DataFrame:
    """Pairs of one scope (scope, text_a, text_b) from an inverted index of exploded sets (scope, text, t).

    probe and index give, by size, the fewest elements that a set shares with a partner when it is looked up and when it is
    found; of each set only as many of its rarest elements are used.
    """
    w = Window.partitionBy("scope", "text")
    counted = sets.join(sets.groupBy("scope", "t").agg(F.count("*").alias("df")), ["scope", "t"])
    ranked = counted.withColumns({"size": F.count("*").over(w), "place": F.row_number().over(w.orderBy("df", "t"))}).where("df > 1")
    looked, kept = (ranked.where(F.col("place") <= F.col("size") - least + 1).select("scope", "t", "text") for least in (probe, index))
    return looked.alias("a").join(kept.alias("b"), ["scope", "t"]).where("a.text <> b.text").select("scope", F.least("a.text", "b.text").alias("text_a"), F.greatest("a.text", "b.text").alias("text_b")).distinct()


#: Elements and sets of a block that a cell of similar_pairs() holds two of (some 40 bytes an element), and counts that are added up at once.
BLOCK_ELEMENTS = 4_000_000
BLOCK_SETS = 65_536
COUNTS = 1 << 21


def _packed(values):
    """A sorted set of 64-bit values as bytes: differences, by planes of their bytes, of which small ones leave most empty."""
    import zlib

    import numpy as np

    v = np.unique(values)
    return zlib.compress(np.ascontiguousarray(np.diff(v, prepend=v.dtype.type(0)).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data):
    import zlib

    import numpy as np

    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel(), dtype=np.int64)


def _pack_sets(batches):
    """Rows (item, n, data) of rows (item, elements)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        e = batch.column(1)
        values, ends = e.values.to_numpy(zero_copy_only=False), e.offsets.to_numpy()
        data = [_packed(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(data, pa.binary())], ["item", "n", "data"])


def _overlaps(left: list, right: list, share: float, same: bool):
    """(place in left, place in right, common, total) of the pairs of two lists of sets that have the share in common.

    The elements of some left sets at a time are looked up in an inverted index of the right ones, and what is found is counted.
    """
    import numpy as np

    sizes, others = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    values = np.concatenate(right)
    order = np.argsort(values, kind="stable")
    owner = np.repeat(np.arange(len(right), dtype=np.int32), others)[order]
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    values, ends = values[first], np.append(first, len(owner))
    step = max(1, COUNTS // len(right))
    for a in range(0, len(left), step):
        own = sizes[a : a + step]
        x = np.concatenate(left[a : a + step])
        at = np.minimum(np.searchsorted(values, x), len(values) - 1)
        hit = np.flatnonzero(values[at] == x)
        lo, row = ends[at[hit]], np.repeat(np.arange(len(own)), own)[hit]
        n = ends[at[hit] + 1] - lo
        upto = np.cumsum(n)
        count = np.zeros(len(own) * len(right), np.int64)
        b = 0
        while b < len(n):
            e = max(b + 1, int(np.searchsorted(upto, (upto[b - 1] if b else 0) + COUNTS, side="right")))
            m = n[b:e]
            inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            count += np.bincount(np.repeat(row[b:e] * len(right), m) + owner[np.repeat(lo[b:e], m) + inside], minlength=len(count))
            b = e
        i, j = np.divmod(np.flatnonzero(count), len(right))
        common = count[i * len(right) + j]
        total = own[i] + others[j] - common
        fine = common >= share * total - 1e-9
        if same:
            fine &= i + a < j
        yield i[fine] + a, j[fine], common[fine], total[fine]


def _solve_cells(batches, share: float):
    """Pairs of each cell of two blocks, or of one; a task gets whole cells, sorted, and holds one at a time."""
    import numpy as np
    import pyarrow as pa

    here, held = None, []

    def solved():
        block = np.concatenate([np.asarray(b.column("block")) for b in held])
        item = pa.concat_arrays([b.column("item") for b in held])
        sets = [_unpacked(d) for b in held for d in b.column("data").to_pylist()]
        i, j = here
        rows, others = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(rows) or not len(others):
            return
        for a, b, common, total in _overlaps([sets[k] for k in rows], [sets[k] for k in others], share, i == j):
            yield pa.RecordBatch.from_arrays([item.take(pa.array(rows[a])), item.take(pa.array(others[b])), pa.array(common, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "n_common", "n_total"])

    for batch in batches:
        i, j = np.asarray(batch.column("i")), np.asarray(batch.column("j"))
        cuts = [0, *(np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), len(i)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                if here != (i[a], j[a]):
                    if held:
                        yield from solved()
                    here, held = (i[a], j[a]), []
                held.append(batch.slice(a, b - a))
    if held:
        yield from solved()


def similar_pairs(df: DataFrame, item: str, elements: str, share: float) -> DataFrame:
    """(item_a, item_b, n_common, n_total) of all pairs of items whose sets (arrays without repeats) have at least this share
    of their union in common. Empty sets pair with nothing; nulls in a set don't count.

    A low share rules out hardly any pair by a prefix, so common elements are counted where two blocks of sets meet, and only
    the pairs that have enough are written. Sets travel packed, once for each block; with e elements and s sets there are
    max(e / 4,000,000, s / 65,536) blocks. Whole numbers are compared as they are, other elements by 64-bit hashes.
    """
    kind = df.schema[elements].dataType.elementType.simpleString()
    held = F.filter(elements, lambda x: x.isNotNull())
    values = held.cast("array<bigint>") if kind in ("tinyint", "smallint", "int", "bigint") else F.transform(held, lambda x: F.xxhash64(x))
    name = df.schema[item].dataType.simpleString()
    sets = df.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.coalesce(values, F.array().cast("array<bigint>")).alias("e")).where("size(e) > 0")
    packed = materialize(sets.mapInArrow(_pack_sets, f"item {name}, n long, data binary"), "sets")
    n, rows = packed.agg(F.sum("n"), F.count("*")).first()
    blocks = max(1, -(-(n or 0) // BLOCK_ELEMENTS), -(-rows // BLOCK_SETS))
    placed = packed.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    dealt = placed.withColumn("cell", F.explode(cells)).select("cell.i", "cell.j", "block", "item", "data").repartition("i", "j").sortWithinPartitions("i", "j")
    met = dealt.mapInArrow(lambda b: _solve_cells(b, share), f"a {name}, b {name}, n_common long, n_total long").where("a <> b")
    return met.select(F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b"), "n_common", "n_total")


def blocked_pairs(df: DataFrame, scope: str, text: str, *, threshold: float = 0.55, trigram: float = 0.6, stop_share: float = 0.15, tags: str | None = None, tag_threshold: float = 0.5, parents: str | None = None, neighbourhood: int = 12, pack: dict | None = None) -> DataFrame:
    """Pairs of texts in one scope for which any rule fires: scope, text_a, text_b, rules.

    Rules: the token rules and character trigrams; with tags (a column of texts) the overlap of their tokens; with pack
    (stopwords, prefixes, suffixes) the token rules over folded tokens, named _pack; with parents (a column of keys) any two
    texts under a parent that has at most ``neighbourhood`` texts of the scope. Tokens in more than stop_share of a scope's
    texts don't count for the plain token rules.

    Pairs come from inverted indices, so texts that share nothing never meet. Of each set only the prefix that a partner
    must share an element of is looked up, rarest first: for a share of the union, and for one of the smaller set. The
    smaller set gives no bound for the larger one but the two shared tokens, so all tokens but one are in the index of
    tokens. Pairs are verified on whole sets. Rows with null scope or text pair with nothing.
    """
    base = df.where(F.col(scope).isNotNull() & F.col(text).isNotNull()).select(F.col(scope).alias("scope"), F.col(text).alias("text"), *[F.col(c).alias(n) for c, n in ((tags, "tag"), (parents, "parent")) if c])
    texts = base.select("scope", "text").distinct()
    # Fewest shared elements of a set of that size: by its share of the union, and by containment as the smaller one.
    need = lambda share: F.ceil(F.lit(share) * F.col("size") - 1e-9)
    contained = F.greatest(need(0.75), F.lit(2))
    tokens = texts.select("scope", "text", F.explode(F.array_distinct(words(F.col("text")))).alias("t"))
    kinds = {
        "t": (tokens.join(scope_stopwords(tokens, stop_share), ["scope", "t"], "left_anti").select("scope", "text", "t"), F.least(need(threshold), contained), F.least(need(threshold), F.lit(2))),
        "g": (texts.select("scope", "text", F.explode(grams(F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))))).toDF("scope", "text", "t"), need(trigram), need(trigram)),
    }
    fold = lambda t: F.transform(t, lambda x: fold_affixes(x, pack["prefixes"], pack["suffixes"])) if pack else t
    if pack:
        plain = F.array_except(words(F.col("text")), F.array(*map(F.lit, pack["stopwords"])).cast("array<string>"))
        kinds["p"] = (texts.select("scope", "text", F.explode(F.array_distinct(fold(plain)))).toDF("scope", "text", "t"), F.least(need(threshold), contained), F.least(need(threshold), F.lit(2)))
    if tags:
        kinds["tag"] = (base.select("scope", "text", F.explode(fold(words(F.coalesce("tag", F.lit("")))))).toDF("scope", "text", "t").distinct(), need(tag_threshold), need(tag_threshold))
    found = None
    for sets, probe, index in kinds.values():
        pairs = _met(sets, probe, index)
        found = pairs if found is None else found.union(pairs)
    if parents:
        under = base.where("parent is not null").select("scope", "parent", "text").distinct()
        few = under.groupBy("scope", "parent").agg(F.count("*").alias("n")).where(F.col("n") <= neighbourhood).select("scope", "parent")
        near = under.join(few, ["scope", "parent"])
        beside = near.alias("a").join(near.alias("b"), ["scope", "parent"]).where("a.text < b.text").select("scope", F.col("a.text").alias("text_a"), F.col("b.text").alias("text_b")).distinct()
        found = found.union(beside)
    both = found.distinct()
    none = F.array().cast("array<string>")
    for n, (sets, *_) in kinds.items():
        whole = sets.groupBy("scope", "text").agg(F.collect_list("t").alias("s"))
        for side in "ab":
            both = both.join(whole.select("scope", F.col("text").alias(f"text_{side}"), F.col("s").alias(f"{n}{side}")), ["scope", f"text_{side}"], "left").withColumn(f"{n}{side}", F.coalesce(f"{n}{side}", none))
    rules = [*token_rules(F.col("ta"), F.col("tb"), threshold=threshold), F.when(jaccard(F.col("ga"), F.col("gb")) >= trigram, F.lit("trigram_jaccard"))]
    if pack:
        rules += token_rules(F.col("pa"), F.col("pb"), suffix="_pack", threshold=threshold)
    if tags:
        rules.append(F.when(jaccard(F.col("taga"), F.col("tagb")) >= tag_threshold, F.lit("tag_jaccard")))
    if parents:
        both = both.join(beside.withColumn("_near", F.lit(True)), ["scope", "text_a", "text_b"], "left")
        rules.append(F.when(F.col("_near"), F.lit("neighborhood")))
    return both.select("scope", "text_a", "text_b", F.array_join(F.array_sort(F.array_compact(F.array(*rules))), ",").alias("rules")).where("rules <> ''")


def dedup_scope(kind: str, seed: Column, path: Column, parents: Column, resolved: Column) -> Column:
    """The key within which a claim may be merged: the framework, its top ancestors, its parents, or none but its own.

    path is an array of (id, parents) structs. An empty or unresolved path never allows a merge with other seeds.
    """
    if kind == "framework":
        return F.lit("framework")
    own = seed.cast("string")
    if kind == "none":
        return own
    tops = F.transform(F.filter(path, lambda x: F.size(x["parents"]) == 0), lambda x: x["id"].cast("string"))
    chosen = tops if kind == "top_ancestor" else F.transform(parents, lambda x: x.cast("string"))
    return F.when(F.coalesce(resolved, F.lit(False)) & (F.size(path) > 0), F.array_join(F.array_sort(F.array_distinct(chosen)), "|")).otherwise(own)


def dedup_claims(claims: DataFrame, decisions: DataFrame, **blocking) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, pending pairs, dropped links) of claimed texts within their scopes, end to end.

    claims has scope, seed, text and perhaps tag and parent (named by blocked_pairs' options); texts compare by skill_key().
    decisions has scope, text_a, text_b and same. Pairs that a rule blocks and nobody has decided are pending. A group is a
    cluster of SAME links that joins no DISTINCT pair, or a text that several claims have: scope, canonical (the text of most
    claims, then the shortest, then the first), texts, seeds, n_claims. dropped counts the refused links of each scope.
    """
    keyed = materialize(claims.withColumn("text", skill_key(F.col("text"))).where("text <> ''"), "claims")
    units = keyed.groupBy("scope", "text").agg(F.count("*").alias("n_claims"))
    nominated = materialize(blocked_pairs(keyed, "scope", "text", **blocking), "nominated")
    pair = ["scope", "text_a", "text_b"]
    judged = decisions.select("scope", F.least("text_a", "text_b").alias("text_a"), F.greatest("text_a", "text_b").alias("text_b"), "same").groupBy(*pair).agg(F.min("same").alias("same"))
    pending = nominated.join(judged.select(*pair), pair, "left_anti")
    clusters = materialize(constrained_clusters(nominated.select(*pair).join(judged, pair), "scope"), "clusters")
    placed = units.join(clusters.select("scope", "text", "cluster"), ["scope", "text"], "left").withColumn("cluster", F.coalesce("cluster", "text"))
    seeds = keyed.join(placed.select("scope", "text", "cluster"), ["scope", "text"]).groupBy("scope", "cluster").agg(F.sort_array(F.collect_set("seed")).alias("seeds"))
    groups = placed.groupBy("scope", "cluster").agg(
        F.min_by("text", F.struct((-F.col("n_claims")).alias("n"), F.length("text").alias("l"), "text")).alias("canonical"), F.sort_array(F.collect_list("text")).alias("texts"), F.sum("n_claims").alias("n_claims")
    )
    groups = groups.where((F.size("texts") > 1) | (F.col("n_claims") > 1)).join(seeds, ["scope", "cluster"]).drop("cluster")
    dropped = clusters.groupBy("scope").agg(F.max("dropped").alias("dropped")).where("dropped > 0")
    return groups, pending, dropped


def canonical(df: DataFrame, group: list[str], text: Column) -> DataFrame:
    """The most frequent text of each group, then the shortest, then the first by code point: group, canonical, n, forms."""
    forms = df.groupBy(*group, text.alias("form")).agg(F.count("*").alias("n"))
    return forms.groupBy(*group).agg(F.min_by("form", F.struct((-F.col("n")).alias("n"), F.length("form").alias("len"), "form")).alias("canonical"), F.sum("n").alias("n"), F.count("*").alias("forms"))


def hyperedge_components(members: DataFrame, edge: str, node: str) -> DataFrame:
    """(node, component) of nodes that shared hyper-edges connect: each edge's members are linked to its smallest."""
    hubs = members.groupBy(edge).agg(F.min(node).alias("hub"))
    return connected_components(members.join(hubs, edge).select(F.col(node).alias("a"), F.col("hub").alias("b")))


def constrained_clusters(links: DataFrame, scope: str) -> DataFrame:
    """Clusters from SAME links within scopes that never join a DISTINCT pair.

    links has scope, text_a, text_b and same (boolean). SAME links are taken in order of (text_a, text_b); one that would
    put a distinct pair into one cluster is dropped. Order matters, so a scope is one group; scopes come from decisions
    that people or models took, and are as large as those. Result: scope, text, cluster (its smallest text), dropped.
    """

    def run(key, pdf):
        import pandas as pd

        parent: dict[str, str] = {}
        members: dict[str, set[str]] = {}
        apart: dict[str, set[str]] = {}
        for a, b, same in pdf[["text_a", "text_b", "same"]].itertuples(index=False):
            for x in (a, b):
                parent.setdefault(x, x)
                members.setdefault(x, {x})
            if not same:
                apart.setdefault(a, set()).add(b)
                apart.setdefault(b, set()).add(a)

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        dropped = 0
        for a, b in sorted({(a, b) for a, b, same in pdf[["text_a", "text_b", "same"]].itertuples(index=False) if same}):
            ra, rb = root(a), root(b)
            if ra == rb:
                continue
            small, large = sorted((ra, rb), key=lambda r: len(members[r]))
            if any(not apart.get(x, set()).isdisjoint(members[large]) for x in members[small]):
                dropped += 1
                continue
            parent[small] = large
            members[large] |= members.pop(small)
        rows = [(key[0], x, min(members[root(x)]), dropped) for x in sorted(parent)]
        return pd.DataFrame(rows, columns=["scope", "text", "cluster", "dropped"])

    renamed = links.select(F.col(scope).alias("scope"), "text_a", "text_b", "same")
    kind = renamed.schema["scope"].dataType.simpleString()
    return renamed.groupBy("scope").applyInPandas(run, f"scope {kind}, text string, cluster string, dropped long")


def content_disagreements(df: DataFrame, keys: list[str], content: Column) -> DataFrame:
    """Groups of one key with more than one content: keys, rows, contents."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct(content).alias("n_contents")).where("n_contents > 1")


def choose_code(codes: Column, preferred: Column) -> Column:
    """How a merged record gets its code: none, single, selected by a review, or unresolved."""
    return F.when(F.size(codes) == 0, "none").when(F.size(codes) == 1, "single").when(F.array_contains(codes, preferred), "selected").otherwise("unresolved")


def resolve_candidates(candidates: DataFrame, signals: DataFrame, decisions: DataFrame, *, most: int, split: list[str]) -> tuple[DataFrame, DataFrame]:
    """(members, groups) of candidate records, end to end: components of signals, bounded reviews, decisions, merge groups.

    candidates has id, code, type and the columns of split; signals has edge and id, rows with one edge being alike by some
    signal. Components over ``most`` rows are cut by the split columns in turn, and parts still too large need review without
    a decision. decisions has part, id, decision (merge, keep_separate, conflict, needs_review), decision_group, code_from
    and type_from (ids whose code and type a merged group takes, or null). Rows of a part that nobody decided need review.
    members: id, part, merge_decision (merged, singleton, conflict, needs_review), group_id. groups: group_id,
    merge_decision, n, code, code_choice (none, single, selected, unresolved), type, type_choice (single, selected,
    unresolved).
    """
    from weft.operators.assemble import split_components

    found = hyperedge_components(signals, "edge", "id").withColumnRenamed("node", "id")
    parts = split_components(candidates.join(found, "id"), most=most, keys=split).select("id", "part", "review")
    sizes = parts.groupBy("part").agg(F.count("*").alias("_n"))
    placed = candidates.join(parts.join(sizes, "part"), "id", "left")
    chosen = decisions.groupBy("part", "id").agg(F.min(F.struct("decision_group", "decision", "code_from", "type_from")).alias("d")).select("part", "id", "d.*")
    j = placed.join(chosen, ["part", "id"], "left")
    alone = F.col("part").isNull() | (F.col("_n") < 2)
    kept = ~alone & ~F.coalesce("review", F.lit(False))
    # What was decided on a part too large to be reviewed, or on a single row, doesn't choose a code or type either.
    j = j.withColumns({c: F.when(kept, F.col(c)) for c in ("code_from", "type_from")})
    verdict = F.when(alone, "singleton").when(~kept | F.col("decision").isNull(), "needs_review").when(F.col("decision") == "merge", "merged").when(F.col("decision") == "keep_separate", "singleton").otherwise(F.col("decision"))
    own = F.concat_ws(":", F.lit("one"), F.col("id").cast("string"))
    group = F.when(verdict == "singleton", own).when(kept & F.col("decision").isNotNull(), F.concat_ws(":", F.lit("decided"), "part", F.col("decision_group").cast("string"))).otherwise(F.concat_ws(":", F.lit("review"), "part"))
    members = materialize(j.withColumns({"merge_decision": verdict, "group_id": group}), "candidates")
    groups = members.groupBy("group_id", "merge_decision").agg(
        F.count("*").alias("n"),
        F.count_distinct("code").alias("n_codes"),
        F.min("code").alias("least_code"),
        F.min(F.when(F.col("id") == F.col("code_from"), F.col("code"))).alias("picked_code"),
        F.count_distinct("type").alias("n_types"),
        F.min("type").alias("least_type"),
        F.min(F.when(F.col("id") == F.col("type_from"), F.col("type"))).alias("picked_type"),
    )
    code = F.when(F.col("n_codes") == 0, "none").when(F.col("n_codes") == 1, "single").when(F.col("picked_code").isNotNull(), "selected").otherwise("unresolved")
    kind = F.when(F.col("n_types") <= 1, "single").when(F.col("picked_type").isNotNull(), "selected").otherwise("unresolved")
    groups = groups.withColumns({"code_choice": code, "type_choice": kind})
    one = lambda choice, least, picked: F.when(F.col(choice) == "single", F.col(least)).when(F.col(choice) == "selected", F.col(picked))
    return members.select("id", "part", "merge_decision", "group_id"), groups.select("group_id", "merge_decision", "n", one("code_choice", "least_code", "picked_code").alias("code"), "code_choice", one("type_choice", "least_type", "picked_type").alias("type"), "type_choice")
