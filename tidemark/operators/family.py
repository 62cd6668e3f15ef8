"""Parent/child operators: what the connectors do as one request per parent is a join here.

Joins are left to the optimizer: a small side is broadcast by its measured size, otherwise
both sides are shuffled and adaptive execution splits hot keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import ordered
from tidemark.session import checkpointed



def _prefixed(df: DataFrame, cols: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in cols]


def fan_out(parents: DataFrame, children: DataFrame, on: dict[str, str], stamp: list[str], prefix: str = "") -> DataFrame:
    """Child rows of every parent with the parent's ``stamp`` columns; ``on``: parent -> child column."""
    names = {p: f"__p_{p}" for p in on}
    side = parents.select(*[F.col(p).alias(n) for p, n in names.items()], *_prefixed(parents, stamp, prefix))
    cond = reduce(lambda a, b: a & b, [side[names[p]] == children[c] for p, c in on.items()])
    return children.join(side, cond).drop(*names.values())


def sample_parents(parents: DataFrame, key: str, ids: list | None, n: int) -> DataFrame:
    """The parents a fan-out covers: those named, else the first ``n`` in key order."""
    if ids:
        return parents.filter(F.col(key).isin(ids))
    return ordered.rows_between(parents, [key], 0, n)


def fk_names(levels: list[tuple[str, list[str]]], leaf_columns: list[str]) -> list[dict[str, str]]:
    """Per level: key -> ``<segment>_<key>``, with leading underscores until it is unique."""
    used, out = set(leaf_columns), []
    for segment, keys in levels:
        mine = {}
        for k in keys:
            name = f"{segment}_{k}"
            while name in used:
                name = "_" + name
            used.add(name)
            mine[k] = name
        out.append(mine)
    return out


def tag_ancestor_fks(levels: list[dict], leaf: DataFrame, leaf_link: dict[str, str]) -> DataFrame:
    """Leaf rows with the keys of all ancestors.

    ``levels`` from the root down: {segment, df, keys, link} where ``link`` maps the parent's
    key to this level's column; ``leaf_link`` does so for the leaf. A null ancestor key fails.
    """
    names = fk_names([(lv["segment"], lv["keys"]) for lv in levels], leaf.columns)
    chain = None
    for lv, mine in zip(levels, names):
        df = lv["df"]
        checked = [
            F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k} in {lv['segment']}")).cast(df.schema[k].dataType))
            .otherwise(F.col(k))
            .alias(n)
            if df.schema[k].nullable
            else F.col(k).alias(n)
            for k, n in mine.items()
        ]
        links = [F.col(c).alias(f"__up_{p}") for p, c in (lv.get("link") or {}).items()]
        here = df.select(*checked, *links)
        if chain is None:
            chain = here
        else:
            cond = reduce(lambda a, b: a & b, [here[f"__up_{p}"] == chain[prev[p]] for p in lv["link"]])
            chain = chain.join(here, cond).drop(*[f"__up_{p}" for p in lv["link"]])
        prev = mine
    cond = reduce(lambda a, b: a & b, [leaf[c] == chain[prev[p]] for p, c in leaf_link.items()])
    return leaf.join(chain, cond)


def explode_children(df: DataFrame, items: str, keep: list[str]) -> DataFrame:
    """One row per element with the parent columns; parents without elements vanish."""
    x = df.select(*keep, F.explode(items).alias("__c"))
    kind = df.schema[items].dataType.elementType
    child = ["__c.*"] if isinstance(kind, T.StructType) else [F.col("__c").alias(items)]
    return x.select(*keep, *child)


def explode_filtered_children(df: DataFrame, items: str, keep: list[str], test) -> DataFrame:
    """Only the elements that pass ``test``, merged over the parent: the child's column wins."""
    x = df.select(*keep, F.explode(F.filter(items, test)).alias("__c"))
    fields = df.schema[items].dataType.elementType.names
    return x.select(*[c for c in keep if c not in fields], "__c.*")


def junction(parents: DataFrame, related: DataFrame, on: str, parent_key: str, related_key: str) -> DataFrame:
    """Many-to-many rows with ``_junction_id`` = parent key, underscore, related key."""
    j = parents.select(parent_key, on).join(related.select(related_key, on), on)
    ident = F.concat_ws("_", F.col(parent_key).cast("string"), F.col(related_key).cast("string"))
    return j.select(ident.alias("_junction_id"), parent_key, related_key)


def changed_parents_only(children: DataFrame, parents: DataFrame, on: dict[str, str], cursor: str, since) -> DataFrame:
    """Children of the parents whose own cursor moved past ``since``."""
    moved = parents.filter(F.col(cursor) > F.lit(since)).select(*[F.col(p).alias(f"__p_{p}") for p in on])
    cond = reduce(lambda a, b: a & b, [children[c] == moved[f"__p_{p}"] for p, c in on.items()])
    return children.join(moved, cond, "left_semi")


def ancestor_cursor(children: DataFrame, parents: DataFrame, on: dict[str, str], parent_cursor: str, out: str, own: str | None = None) -> DataFrame:
    """The parent's cursor on the child rows, behind the child's own cursor if it has one."""
    tagged = fan_out(parents, children, on, [parent_cursor], "__a_")
    value = F.col(f"__a_{parent_cursor}")
    return tagged.withColumn(out, F.coalesce(F.col(own), value) if own else value).drop(f"__a_{parent_cursor}")


def flatten_expand(df: DataFrame, levels: list[tuple[str, list[str]]]) -> DataFrame:
    """Nested arrays of structs to leaf rows with the keys of every level.

    ``levels``: (array field, key fields of the row that holds it), outermost first; key
    columns are named ``<level>_<key>``. The leaf keeps all its fields.
    """
    here, prefix, carried = df, "", []
    for i, (items, keys) in enumerate(levels):
        stamped = [F.col(f"{prefix}{k}").alias(f"l{i}_{k}") for k in keys]
        here = here.select(*carried, *stamped, F.explode(f"{prefix}{items}").alias("__e"))
        carried += [f"l{i}_{k}" for k in keys]
        prefix = "__e."
    return here.select(*carried, "__e.*")


def hierarchy(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(key, root, depth, path, cycle) of every node; a root has a null or unknown parent.

    Only nodes that have children are ancestors of others, so these alone are followed upwards, by pointer doubling; the
    others, mostly nearly all, take their parent's path in one join. The nodes are written once. A node that meets an ancestor
    twice is marked ``cycle``. A key that occurs k times with m known parents stands for k * m nodes.
    """
    nodes = df.select(F.col(key).alias("id"), F.col(parent).alias("up"))
    wanted = nodes.filter(F.col("up").isNotNull()).select(F.col("up").alias("id")).distinct().withColumn("inner", F.lit(True))
    keyed = nodes.filter(F.col("id").isNotNull()).join(wanted, "id", "left").select("id", "up", F.col("inner").isNotNull().alias("inner"))
    keyed = keyed.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("id")))
    # a null key has no parent and is no one's parent
    unkeyed = nodes.filter(F.col("id").isNull()).select("id", F.lit(None).cast("string").alias("up"), F.lit(False).alias("inner"), F.lit(1).cast("bigint").alias("times"))
    nodes = checkpointed(keyed.unionByName(unkeyed), "hierarchy")

    above = _named_ancestors(_ancestors(nodes.filter("inner").select("id", "up")))
    leaves = nodes.filter("not inner")
    once, often = leaves.filter("times = 1"), leaves.filter("times > 1")
    known = nodes.filter("inner").select(F.col("id").alias("up")).distinct()
    linked = often.join(known, "up", "left_semi").select("id", "up")
    placed = once.select("id", "up").unionByName(often.select("id").join(linked, "id", "left"))
    up = above.select(F.col("id").alias("up"), *[F.col(c).alias(f"up_{c}") for c in ("root", "depth", "path", "cycle")])
    under = placed.filter(F.col("up").isNotNull()).join(up, "up", "left")
    found = F.col("up_cycle").isNotNull()
    under = under.select(
        "id",
        F.when(found, F.col("up_root")).otherwise(F.col("id")).alias("root"),
        F.when(found, F.col("up_depth") + 1).otherwise(F.lit(0)).alias("depth"),
        F.when(found, F.concat("up_path", F.lit("/"), "id")).otherwise(F.col("id")).alias("path"),
        F.coalesce("up_cycle", F.lit(False)).alias("cycle"),
    )
    alone = placed.filter(F.col("up").isNull()).select(
        "id", F.col("id").alias("root"), F.when(F.col("id").isNotNull(), 0).alias("depth"), F.col("id").alias("path"),
        F.when(F.col("id").isNotNull(), F.lit(False)).alias("cycle"),
    )
    out = above.unionByName(under).unionByName(alone)
    return out.select(F.col("id").alias(key), "root", "depth", "path", "cycle")


_TWICE = "array_contains(above, id) or size(array_distinct(above)) < size(above)"


def _ancestors(nodes: DataFrame) -> DataFrame:
    """(id, above: the ancestors' ids, nearest first) of nodes (id, up), by pointer doubling.

    After k rounds a node knows 2^k ancestors, so depth 1000 takes ten joins. A round joins and writes only the nodes that
    have not arrived; those that have stay in the round's table. A way round a cycle ends where an id comes twice.
    """
    known = nodes.select(F.col("id").alias("up")).distinct()
    # parents that do not exist count as none
    linked = nodes.join(known, "up", "left_semi").select("id", F.col("up").alias("top"))
    state = nodes.select("id").join(linked, "id", "left").select(
        "id", "top", F.when(F.col("top").isNotNull(), F.array("top")).otherwise(F.array().cast("array<string>")).alias("above")
    )
    twice, done = F.expr(_TWICE), None
    while True:
        state = checkpointed(state, "hierarchy")
        arrived, active = state.filter(F.col("top").isNull()), state.filter(F.col("top").isNotNull())
        done = arrived if done is None else done.unionByName(arrived)
        if active.isEmpty():
            return done.select("id", "above")
        right = done.unionByName(active).select(F.col("id").alias("top"), F.col("top").alias("next"), F.col("above").alias("more"))
        state = active.join(right, "top", "left").select(
            "id",
            F.when(~twice, F.col("next")).alias("top"),
            F.when(F.col("more").isNotNull() & ~twice, F.concat("above", "more")).otherwise(F.col("above")).alias("above"),
        )


def _named_ancestors(d: DataFrame) -> DataFrame:
    """(id, root, depth, path, cycle) from (id, above)."""
    cycle = F.expr(_TWICE)
    return d.select(
        "id",
        F.when(~cycle, F.coalesce(F.element_at(F.when(F.size("above") > 0, F.col("above")), -1), F.col("id"))).alias("root"),
        F.when(~cycle, F.size("above")).alias("depth"),
        F.when(~cycle, F.array_join(F.concat(F.reverse("above"), F.array("id")), "/")).alias("path"),
        cycle.alias("cycle"),
    )


def union_groups(groups: dict[str, DataFrame], source: str = "source_id") -> DataFrame:
    """Union of the results of several parents or properties, each row with its source."""
    tagged = [df.withColumn(source, F.lit(name)) for name, df in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def cohort_members(cohorts: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Membership rows: every (cohort, member) pair once."""
    return cohorts.join(members, key).distinct()


def skip_vanished(children: DataFrame, parents: DataFrame, on: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(children whose parent exists, one row ``skipped`` with the number of the others)."""
    keys = parents.select(*[F.col(p).alias(f"__p_{p}") for p in on]).distinct()
    cond = reduce(lambda a, b: a & b, [children[c] == keys[f"__p_{p}"] for p, c in on.items()])
    skipped = children.join(keys, cond, "left_anti").agg(F.count(F.lit(1)).alias("skipped"))
    return children.join(keys, cond, "left_semi"), skipped


def fill_from_parent(children: DataFrame, parents: DataFrame, on: dict[str, str], columns: list[str], source: str | None = None) -> DataFrame:
    """Each column: the child's own value, else the parent's; the source name is stamped."""
    tagged = fan_out(parents, children, on, columns, "__a_")
    filled = tagged.withColumns({c: F.coalesce(F.col(c), F.col(f"__a_{c}")) for c in columns})
    out = filled.drop(*[f"__a_{c}" for c in columns])
    return out.withColumn("source_name", F.lit(source)) if source else out


def enrich_or_fallback(basic: DataFrame, detail: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The detail row where there is one, else the basic row; columns neither has are null."""
    right = detail.select(key, F.struct(*[c for c in columns if c in detail.columns]).alias("__d"))
    joined = basic.join(right, key, "left")
    found = F.col("__d").isNotNull()

    def pick(c: str) -> Column:
        own = F.col(c) if c in basic.columns else F.lit(None)
        if c not in detail.columns:
            return own.alias(c)
        return F.when(found, F.col(f"__d.{c}")).otherwise(own).alias(c)

    return joined.select(key, *[pick(c) for c in columns], found.alias("detailed"))
