"""Mixing sources to target weights: hierarchical budgets, token prefixes.

The leaves are sources within languages within domains.  A token budget goes
down the tree by weight.  A child that cannot use its share (its tokens times
the epochs allowed) takes what it can; its shortage goes to its siblings, and
only what a whole family cannot use goes to the siblings of the parent, since
a family is never given more than it can use.  Each leaf then takes whole
epochs of its documents and a token-prefix of one more, in the seeded order of
that epoch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm.common import OWN, staged

LEVELS = ("domain", "lang", "source")
#: Documents of a leaf in one bucket of its order: what a running sum sorts.
BUCKET_ROWS = 2048
NO_VALUE = "(none)"


def source_domain(source: Column) -> Column:
    """Domain of a source where the table has none: one of four by digest."""
    return F.concat(F.lit("domain"), (F.conv(F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1),
                                             16, 10).cast("int") % 4).cast("string"))


@dataclass(frozen=True)
class Recipe:
    """Weights by level and value (1 where none is given), the budget as a
    share of all tokens, epochs a document may be used, and the seed."""

    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    share: float = 0.6
    max_epochs: int = 2
    seed: int = 17


#: Fixed values of the registered query.
PRODUCTION = Recipe(weights={"domain": {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0},
                             "lang": {"en": 3.0, "de": 2.0, "fr": 2.0, "es": 2.0}})


def n_tokens(text: Column) -> Column:
    """Tokens a text counts for: its words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, recipe: Recipe) -> Column:
    out = F.lit(1.0)
    for value, w in recipe.weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def _share_out(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Adds ``given``: the family's ``budget`` by weight, no child above its
    ``cap``.  In the order of cap over weight the full children are a prefix."""
    family = W.partitionBy(*parent, "budget")
    before = family.orderBy(F.col("cap") / F.col("w"), level).rowsBetween(W.unboundedPreceding, -1)
    caps = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    full = F.col("cap") / F.col("w") * rest + caps <= F.col("budget") + 1e-6
    n = nodes.withColumn("full", full)
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(family)
    open_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(family)
    return n.withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * left / open_w)).drop("full")


def leaf_budgets(leaves: DataFrame, recipe: Recipe) -> DataFrame:
    """``leaves`` (levels, ``tokens``) with ``quota``, each leaf's tokens.

    Levels with weight 0 or less get nothing.
    """
    usable = F.lit(True)
    for level in LEVELS:
        usable = usable & (_weight(level, recipe) > 0)
    tree = leaves.withColumn("cap", F.when(usable, F.col("tokens") * float(recipe.max_epochs)).otherwise(0.0))
    all_ = tree.agg(F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap")).first()  # one row
    root = min(float(all_["tokens"] or 0) * float(recipe.share), float(all_["cap"] or 0))
    at = [*LEVELS]
    # The budget of the root, then of each level's nodes, from the caps below.
    nodes = tree.groupBy(LEVELS[0]).agg(F.sum("cap").alias("cap"))
    budgets = nodes.withColumn("budget", F.lit(root))
    for i, level in enumerate(at):
        if i:
            nodes = tree.groupBy(*at[:i + 1]).agg(F.sum("cap").alias("cap"))
            budgets = nodes.join(given.withColumnRenamed("given", "budget"), at[:i])  # noqa: F821
        shared = _share_out(budgets.withColumn("w", F.greatest(_weight(level, recipe), F.lit(1e-300))), at[:i], level)
        given = shared.select(*at[:i + 1], "given")
    return leaves.join(given, at).select(*at, "tokens", "rows", F.floor(F.col("given") + 1e-6).alias("quota"))


def _order(seed: int, epoch: Column, id_text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_text).cast("binary"))


def _bucket(order: Column, n: Column) -> Column:
    """Which of ``n`` equal ranges of the order a digest falls in."""
    return F.shiftright(F.conv(F.substring(order, 1, 7), 16, 10).cast("long") * n, 28)


def mix(docs: DataFrame, recipe: Recipe = PRODUCTION, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", domain: Column | None = None,
        epoch_col: str = "epoch") -> DataFrame:
    """Rows of ``docs`` that the mix takes, once per epoch, with ``epoch_col``.

    A leaf with quota q and t tokens takes all its rows q div t times, then
    the rows of one more epoch, in the order of md5(seed:epoch:id), as long as
    their running tokens stay within the rest.

    * Null domain, language or source is a value of its own, ``(none)``.
    * A null or empty text has no tokens: it goes with the prefix it falls in.
    * Rows with equal ids stand together in the order: all are taken or none.
    * Without rows or tokens nothing is to be shared out, no row is lost to an
      error; other columns pass through, one named ``epoch_col`` is replaced.

    Documents of a leaf are summed by ranges of their order before a running
    sum sorts any, and only one range per leaf is sorted, so a leaf with a
    third of all rows is never in one task.
    """
    value = lambda c: F.coalesce(c.cast("string"), F.lit(NO_VALUE))
    domain = source_domain(F.col(source_col).cast("string")) if domain is None else domain
    keys = {"domain": value(domain), "lang": value(F.col(lang_col)), "source": value(F.col(source_col))}
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    narrow = staged(docs.select(id_text.alias("id"), *[k.alias(c) for c, k in keys.items()],
                                n_tokens(F.col(text_col)).alias("tokens")), "mix-tokens")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    plan = staged(
        leaf_budgets(leaves, recipe)
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.greatest("tokens", F.lit(1))))
                    .otherwise(0).cast("int"))
        .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("tokens"))
        .withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS)), "mix-quotas")
    # What documents meet is written, a row a leaf at most: the planner knows its
    # size, and splits a hot leaf where it does not send the table to all tasks.
    ordered = narrow.join(plan.select(*LEVELS, "epochs", "rest", "buckets"), [*LEVELS]).withColumn(
        "h", _order(recipe.seed, F.col("epochs") + 1, F.col("id"))).withColumn("bucket", _bucket(F.col("h"), F.col("buckets")))
    sums = ordered.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(W.partitionBy(*LEVELS).orderBy("bucket"))
    edge = staged(sums.withColumn("before", upto - F.col("tokens"))
                  .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("tokens")))
                  .select(*LEVELS, "bucket", "before"), "mix-edges")
    running = F.col("before") + F.sum("tokens").over(W.partitionBy(*LEVELS, "bucket").orderBy("h"))  # equal ids together
    last = (ordered.join(edge, [*LEVELS, "bucket"]).withColumn("upto", running).where("upto <= rest")
            .groupBy(*LEVELS).agg(F.max("h").alias("last")))
    cuts = staged(plan.join(edge.select(*LEVELS, F.col("bucket").alias("edge")), [*LEVELS], "left")
                  .join(last, [*LEVELS], "left").select(*LEVELS, "epochs", "buckets", "edge", "last")
                  .withColumnsRenamed({c: f"{OWN}{c}" for c in (*LEVELS, "epochs", "buckets", "edge", "last")}), "mix-cuts")

    own = {f"{OWN}k_{c}": k for c, k in keys.items()}
    met = docs.drop(epoch_col).withColumns(own).join(
        cuts, [F.col(f"{OWN}k_{c}") == F.col(f"{OWN}{c}") for c in LEVELS])
    h = _order(recipe.seed, F.col(f"{OWN}epochs") + 1, id_text)
    bucket, edge_at = _bucket(h, F.col(f"{OWN}buckets")), F.col(f"{OWN}edge")
    taken = edge_at.isNull() | (bucket < edge_at) | ((bucket == edge_at) & (h <= F.col(f"{OWN}last")))
    uses = F.col(f"{OWN}epochs") + F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)
    return (met.withColumn(f"{OWN}uses", uses).where(F.col(f"{OWN}uses") > 0)
            .select(*[c for c in docs.columns if c != epoch_col],
                    F.explode(F.sequence(F.lit(1), F.col(f"{OWN}uses"))).alias(epoch_col)))


def _oracle_weight(level: str, recipe: Recipe) -> str:
    cases = "".join(f" WHEN '{v}' THEN {w}" for v, w in recipe.weights.get(level, {}).items())
    return f"CASE {level}{cases} ELSE 1.0 END" if cases else "1.0"


def _oracle_level(i: int, recipe: Recipe) -> str:
    """One level of the tree: the share by the fullest children first."""
    keys, family = ", ".join(LEVELS[:i + 1]), ", ".join(LEVELS[:i]) or "0"
    source = (f"FROM (SELECT {keys}, sum(cap) AS cap FROM leaf GROUP BY ALL) c JOIN given{i - 1} p USING ({family})"
              if i else "FROM (SELECT domain, sum(cap) AS cap FROM leaf GROUP BY ALL) c, root p")
    return f"""
kid{i} AS (SELECT {keys}, c.cap, p.given AS budget, {_oracle_weight(LEVELS[i], recipe)} AS w {source}),
ratio{i} AS (
  SELECT *, cap / w * (sum(w) OVER (PARTITION BY {family}) - coalesce(sum(w) OVER b, 0))
         + coalesce(sum(cap) OVER b, 0) <= budget + 1e-6 AS sated
  FROM kid{i} WINDOW b AS (PARTITION BY {family} ORDER BY cap / w, {LEVELS[i]}
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
given{i} AS (
  SELECT {keys}, CASE WHEN sated THEN cap ELSE w * (budget - coalesce(sum(cap) FILTER (WHERE sated) OVER f, 0))
                 / sum(w) FILTER (WHERE NOT sated) OVER f END AS given
  FROM ratio{i} WINDOW f AS (PARTITION BY {family}))"""


def oracle(recipe: Recipe = PRODUCTION) -> str:
    return f"""
WITH doc AS (
  SELECT doc_id, lang AS own_lang, source AS own_source, 'domain' || (('0x' || md5(coalesce(source, ''))[1:1])::INT % 4) AS domain,
         coalesce(lang, '{NO_VALUE}') AS lang, coalesce(source, '{NO_VALUE}') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::DOUBLE AS tokens, {float(recipe.max_epochs)} * sum(tokens) AS cap
         FROM doc GROUP BY ALL),
root AS (SELECT least({recipe.share} * sum(tokens), sum(cap)) AS given FROM leaf),
{",".join(_oracle_level(i, recipe) for i in range(len(LEVELS)))},
quota AS (
  SELECT domain, lang, source, floor(given + 1e-6) AS quota, floor(quota / greatest(tokens, 1)) AS epochs,
         quota - epochs * tokens AS rest
  FROM given2 JOIN leaf USING (domain, lang, source)),
ordered AS (
  SELECT doc.*, epochs, rest, sum(tokens) OVER (
    PARTITION BY domain, lang, source ORDER BY md5('{recipe.seed}:' || (epochs + 1)::INT || ':' || doc_id)) AS upto
  FROM doc JOIN quota USING (domain, lang, source)),
uses AS (SELECT *, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS uses FROM ordered)
SELECT doc_id, own_lang AS lang, own_source AS source, unnest(range(1, uses::INT + 1))::INT AS epoch FROM uses
"""
