"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' members in a tree of levels, such as domain, language and
source. A token budget is propagated from the root by the weights at each
level. A child that cannot use its share (its documents, repeated for as many
epochs as allowed, hold fewer tokens) leaves the shortage to its siblings, and
only what all of them cannot use goes to siblings further up. Each leaf then
takes whole epochs and, of one more, the longest prefix in a seeded order whose
tokens fit its budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.runtime import materialize

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
RADIX = (2, 4)  # hex digits of the seeded order by which a leaf's boundary is narrowed down


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def node_key(column: str) -> Column:
    """The level's value as a key that is never null: '' for null, else '=' and the value."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def weight_of(key: str, weights: Mapping[str | None, float], default: float) -> Column:
    out = F.lit(float(default))
    for value, w in weights.items():
        out = F.when(F.col(key) == F.lit("" if value is None else f"={value}"), F.lit(float(w))).otherwise(out)
    return out


def allocate(leaves: DataFrame, keys: Sequence[str], weights: Sequence[Mapping[str | None, float]], budget: float, max_epochs: int, default_weight: float = 1.0) -> DataFrame:
    """``leaves`` (keys, ``tokens``) with the ``budget`` of each, in tokens.

    Of a parent's budget B, child i with weight w and capacity c gets min(c, L w),
    where L is such that B is used up, or every child is full. In order of c / w,
    the first child that L = (B - capacities before it) / (weights from it on)
    does not fill fixes L. A child of weight 0 gets nothing.
    """
    depth = len(keys)
    nodes = [leaves.select(*keys, (F.col("tokens") * max_epochs).cast("double").alias("capacity"))]
    for d in range(depth - 1, 0, -1):  # bottom up: capacities
        usable = F.when(weight_of(keys[d], weights[d], default_weight) > 0, F.col("capacity")).otherwise(0.0)
        nodes.insert(0, nodes[0].groupBy(*keys[:d]).agg(F.sum(usable).alias("capacity")))
    parents: DataFrame | None = None
    for d in range(depth):  # top down: budgets
        over = Window.partitionBy(*keys[:d]) if d else Window.partitionBy(F.lit(0))
        child = nodes[d].withColumn("w", weight_of(keys[d], weights[d], default_weight)).filter("w > 0 AND capacity > 0")
        child = child.join(parents, list(keys[:d])) if d else child.withColumn("given", F.lit(float(budget)))
        ordered = over.orderBy(F.col("capacity") / F.col("w"), keys[d])
        before = ordered.rowsBetween(Window.unboundedPreceding, -1)
        onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        child = child.withColumn("level", (F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("w").over(onward))
        child = child.withColumn("fixed", F.min(F.when(F.col("capacity") / F.col("w") > F.col("level"), F.struct(F.row_number().over(ordered).alias("at"), F.col("level").alias("l")))).over(over)["l"])
        parents = child.select(*keys[: d + 1], F.least("capacity", F.coalesce(F.col("fixed") * F.col("w"), F.col("capacity"))).alias("given"))
    return leaves.join(parents, list(keys), "left").withColumn("budget", F.floor(F.coalesce("given", F.lit(0.0)) + 1e-6)).drop("given")


def seeded_order(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")).cast("binary"))


def boundaries(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ``prefix``, ``last``) for each leaf: its partial epoch takes all
    documents whose order begins below ``prefix``, and those that begin with it
    up to ``last``, if there is one.

    Sums by (leaf, order's first digits) narrow the boundary down twice, so only
    a leaf's few documents at its boundary are put in order one by one.
    """
    within = members
    for digits in RADIX:
        part = F.substring("place", 1, digits)
        sums = within.groupBy(*keys, part.alias("part")).agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"), *([F.first("taken").alias("taken")] if "taken" in within.columns else []))
        start = F.col("taken") if "taken" in within.columns else F.lit(0)
        so_far = start + F.sum("tokens").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        first = sums.withColumn("so_far", so_far).filter("so_far > rest").groupBy(*keys).agg(F.min_by(F.struct("part", (F.col("so_far") - F.col("tokens")).alias("taken")), "part").alias("b"))
        first = materialize(first.select(*keys, F.col("b.part").alias("prefix"), F.col("b.taken").alias("taken")), "mix-boundary").df
        within = members.join(first, [*keys]).filter(F.substring("place", 1, digits) == F.col("prefix"))
    fits = F.col("taken") + F.sum("tokens").over(Window.partitionBy(*keys).orderBy("place", "doc_id", "content")) <= F.col("rest")  # rows alike in all three count together
    last = within.withColumn("fits", fits).filter("fits").groupBy(*keys).agg(F.max(F.struct("place", "doc_id", "content")).alias("last"))
    return first.select(*keys, "prefix").join(last, list(keys), "left")


def mix_plan(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Sequence[Mapping[str | None, float]],
    budget_share: float = 0.8,
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(members, leaves): every document's id, ``content`` (md5 of its text),
    ``tokens`` (words) and leaf keys; and every leaf's ``tokens``, ``budget``,
    ``epochs`` (whole ones), ``prefix`` and ``last`` (see ``boundaries``).

    ``budget_share``: the budget as a share of all tokens. Weights are looked
    up by the level's value; a value that isn't named has weight 1.
    """
    keys = [f"k{i}" for i in range(len(levels))]
    members = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.md5(F.col(f"`{text_col}`").cast("binary")).alias("content"), word_count(text_col).alias("tokens"), *[node_key(c).alias(k) for c, k in zip(levels, keys)])
    members = materialize(members, "mix-members").df
    leaves = members.groupBy(*keys).agg(F.sum("tokens").alias("tokens"))
    leaves = materialize(leaves, "mix-leaves").df
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    given = allocate(leaves, keys, weights, total * budget_share, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
    given = given.withColumn("epochs", whole.cast("int")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    given = materialize(given, "mix-budgets").df
    placed = members.filter("tokens > 0").join(given.select(*keys, "epochs", "rest").filter("rest > 0"), keys).withColumn("place", seeded_order(seed, F.col("epochs"), F.col("doc_id")))
    edge = materialize(boundaries(placed.select(*keys, "doc_id", "content", "tokens", "place", "rest"), keys), "mix-edges").df
    # Written, so that its true size decides whether the texts' join broadcasts it.
    return members, materialize(given.join(edge, keys, "left").drop("rest"), "mix-plan").df


def copies(members: DataFrame, leaves: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """``members`` (any columns beside keys, doc_id, content, tokens) with
    ``copies``, how often each is taken; those not taken are left out."""
    at = members.filter("tokens > 0").join(leaves.drop("tokens", "budget"), list(keys)).withColumn("place", seeded_order(seed, F.col("epochs"), F.col("doc_id")))
    start, here = F.substring("place", 1, RADIX[-1]), F.struct("place", "doc_id", "content")
    partial = F.col("prefix").isNotNull() & ((start < F.col("prefix")) | ((start == F.col("prefix")) & F.col("last").isNotNull() & (here <= F.col("last"))))
    return at.withColumn("copies", F.col("epochs") + partial.cast("int")).filter("copies > 0").drop("epochs", "prefix", "last", "place")


def mix_counts(docs: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str | None, float]], seed: int = 17, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document that the mixture takes: the id, ``n_tokens`` and
    ``copies``. See ``mix_documents``."""
    members, leaves = mix_plan(docs, levels, weights, seed=seed, id_col=id_col, **options)
    taken = copies(members, leaves, [f"k{i}" for i in range(len(levels))], seed)
    return taken.select(F.col("doc_id").alias(id_col), F.col("tokens").alias("n_tokens"), "copies")


def mix_documents(docs: DataFrame, levels: Sequence[str], weights: Sequence[Mapping[str | None, float]], seed: int = 17, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mixture takes each.

    Null level values are a child of their own. Null texts, and texts without
    words, have no tokens and are never taken. Rows alike in id and text stand
    at one place of the order: a prefix takes all of them or none. Null ids
    stand at one place per text. Without tokens nothing is taken. Only the
    leaves' table is joined to the texts, which Spark broadcasts if it is small.
    """
    _, leaves = mix_plan(docs, levels, weights, seed=seed, id_col=id_col, text_col=text_col, **options)
    names = [f"c{i}" for i in range(len(docs.columns))]
    keys = [f"k{i}" for i in range(len(levels))]
    i, t = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = docs.toDF(*names).select("*", *[node_key(names[docs.columns.index(c)]).alias(k) for c, k in zip(levels, keys)])
    rows = rows.withColumns({"doc_id": F.col(i), "content": F.md5(F.col(t).cast("binary")), "tokens": F.coalesce(F.col(t).rlike(WORD_PATTERN), F.lit(False)).cast("int")})
    taken = copies(rows, leaves, keys, seed)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*names).toDF(*docs.columns)


# Parameters of the mixture over the ``documents`` table.
LEVELS = ("domain", "lang", "source")
WEIGHTS: tuple[Mapping[str | None, float], ...] = (
    {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0},
    {"en": 5.0, "fr": 2.0, "de": 2.0, "es": 1.0},
    {},
)


def with_domain(docs: DataFrame, source: str = "source", name: str = "domain") -> DataFrame:
    """``docs`` with ``name``: one of four groups of sources, by their md5."""
    digit = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.col(f"`{source}`").cast("binary")), 1, 1)) - 1
    return docs.withColumn(name, F.concat(F.lit("domain"), F.floor(digit / 4).cast("string")))
