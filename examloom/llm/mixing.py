"""Mixing sources to target weights: hierarchical budgets, then a token prefix per leaf.

The tree is domain, language, source.  A budget goes down from the root: each node's budget is
shared among its children by weight, no child gets more than its subtree can give (tokens
times epochs), and what a child cannot take goes to its siblings.  As no node is ever given
more than its subtree holds, a shortage is met among siblings, and by siblings of an ancestor
only where that ancestor's whole subtree is short.  Each leaf then gives whole epochs, and of
the last epoch a prefix in the order of a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examloom.llm.common import WHITE, attach, running, staged

LEVELS = ("domain", "lang", "source")
WEIGHTS = {
    "domain": {"d0": 5, "d1": 3, "d2": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 2},
}
OTHER = 1               # weight of a name without an entry
MAX_EPOCHS = 4
BUDGET_PCT = 100        # tokens to select, in per cent of the corpus' tokens
SEED = 17


def source_domain(source: Column) -> Column:
    """Domain of a source: its trailing number modulo 3; without one, the domain `none`."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", F.lit("none")).otherwise(
        F.concat(F.lit("d"), (number.cast("long") % 3).cast("string")))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{WHITE}]+")).cast("long")


def seeded_order(doc_id: Column, epoch: Column, seed: int = SEED) -> Column:
    """Place of a document in an epoch: 60 bits of a hash, spread over the range of longs."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.shiftleft(number - F.lit(1 << 59), 4)


def _weight(level: str, weights) -> Column:
    out = F.lit(OTHER)
    for name, value in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(value)).otherwise(out)
    return out.cast("decimal(38,0)")


def leaf_budgets(leaves: DataFrame, budget: Column, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
                 levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Leaves (levels, tokens) with their `budget`, a long.

    Filling by weight under capacities has a closed form: children in ascending order of
    capacity per weight are full as long as their fair share of what is left exceeds their
    capacity; the others share the rest by weight, rounded down.  One window per level over
    rows that were summed up before; integers throughout.  Capacity is max_epochs * tokens.
    """
    big = "decimal(38,0)"
    node = leaves.withColumn("_cap", (F.col("tokens") * max_epochs).cast(big))
    given = None
    for depth, level in enumerate(levels):
        path, parent = list(levels[:depth + 1]), list(levels[:depth])
        children = node.groupBy(*path).agg(F.sum("_cap").cast(big).alias("_cap")) \
            .withColumn("_w", _weight(level, weights))
        if given is None:
            children = children.withColumn("_budget", budget.cast(big))
        else:
            children = children.alias("c").join(given.alias("g"), _same(parent, "c", "g")).select(
                *[f"c.{c}" for c in path], "c._cap", "c._w", F.col("g._given").alias("_budget"))
        siblings = W.partitionBy(*parent)
        fullest = siblings.orderBy(F.col("_cap").cast("double") / F.col("_w").cast("double"), *path)
        earlier = fullest.rowsBetween(W.unboundedPreceding, -1)
        children = children.select(
            *path, "_cap", "_w", "_budget",
            (F.sum("_w").over(siblings) - F.coalesce(F.sum("_w").over(earlier), F.lit(0))).cast(big).alias("_w_left"),
            F.greatest(F.lit(0).cast(big), (F.col("_budget") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0))).cast(big))
            .alias("_left"))
        full = F.col("_cap") * F.col("_w_left") <= F.col("_w") * F.col("_left")
        children = children.withColumn("_full", full)
        # The first child that is not full fixes the share of all from there on.
        rest = fullest.rowsBetween(W.unboundedPreceding, 0)
        share = lambda c: F.first(F.when(~F.col("_full"), F.col(c)), True).over(rest)
        children = children.withColumn("_l", share("_left")).withColumn("_wl", share("_w_left"))
        taken = F.when(F.col("_l").isNull(), F.col("_cap")).otherwise(
            F.expr("cast((_w * _l) div _wl as decimal(38,0))"))
        given = children.select(*path, taken.alias("_given"))
    out = leaves.alias("c").join(given.alias("g"), _same(list(levels), "c", "g"))
    return out.select("c.*", F.col("g._given").cast("long").alias("budget"))


def _same(names: list[str], left: str, right: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return out


def _leaf(levels=LEVELS) -> Column:
    return F.to_json(F.struct(*levels))  # null levels are left out, so no two leaves agree


def _described(docs: DataFrame, domain) -> list[Column]:
    source = F.col("`source`").cast("string")
    return [F.col("`doc_id`").cast("long").alias("doc_id"), domain(source).alias("domain"),
            F.col("`lang`").cast("string").alias("lang"), source.alias("source"),
            count_words(F.col("`text`")).alias("n_tokens")]


def leaf_plan(rows: DataFrame, weights=WEIGHTS, budget_pct: int = BUDGET_PCT,
              max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per leaf: leaf, _n rows, epochs taken whole, `cut`, the last place taken of the
    epoch after those (null: none), and cut_left, the tokens the prefix takes from there."""
    leaves = staged(rows.groupBy(*LEVELS).agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("_n")), "leaves")
    total, n = leaves.agg(F.sum("tokens"), F.sum("_n")).first()  # two numbers
    budget = F.lit((total or 0) * budget_pct // 100)
    plan = leaf_budgets(leaves, budget, weights, max_epochs).withColumn("leaf", _leaf())
    plan = staged(plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(
        F.lit(0).cast("long"))).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .drop("budget", "tokens", *LEVELS), "leaf-budgets")
    placed = attach(rows.withColumn("leaf", _leaf()).select("leaf", "doc_id", "n_tokens"), plan, "leaf", "_n")
    placed = placed.filter("rest > 0").withColumn("place", seeded_order(F.col("doc_id"), F.col("epochs"), seed))
    before = running(placed, ["leaf"], "place", F.col("n_tokens"), "before", int((n or 1) ** 0.5) + 1)
    cuts = before.filter("before < rest").groupBy("leaf").agg(
        F.max(F.struct("place", F.expr("rest - before").alias("left"))).alias("last"))
    return staged(plan.join(cuts, "leaf", "left").select(
        "leaf", "_n", "epochs", F.col("last.place").alias("cut"), F.col("last.left").alias("cut_left")), "leaf-plan")


def _copies(seed: int) -> Column:
    in_last = F.coalesce(seeded_order(F.col("doc_id"), F.col("epochs"), seed) <= F.col("cut"), F.lit(False))
    return F.col("epochs") + in_last.cast("long")


def select(docs: DataFrame, weights=WEIGHTS, budget_pct: int = BUDGET_PCT, max_epochs: int = MAX_EPOCHS,
           seed: int = SEED, domain=source_domain) -> DataFrame:
    """One row per selected copy: doc_id, domain, lang, source, epoch (from 0), n_tokens, taken_tokens.

    Tokens are words.  The prefix of a leaf's last epoch ends inside a document: that one is
    selected with the `taken_tokens` the prefix reaches.  Null languages and sources are names
    of their own with weight 1, null texts have no tokens, a leaf without tokens gives no rows.
    Rows with one id in one leaf share their place and are taken together.
    """
    rows = staged(docs.select(*_described(docs, domain)), "tokens")
    plan = leaf_plan(rows, weights, budget_pct, max_epochs, seed)
    out = attach(rows.withColumn("leaf", _leaf()), plan, "leaf", "_n").withColumn("copies", _copies(seed))
    out = out.filter("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    at_cut = (F.col("epoch") == F.col("epochs")) & (
        seeded_order(F.col("doc_id"), F.col("epochs"), seed) == F.col("cut"))
    return out.select("doc_id", *LEVELS, "epoch", "n_tokens", F.when(
        at_cut, F.least("n_tokens", "cut_left")).otherwise(F.col("n_tokens")).alias("taken_tokens"))


def mixed(docs: DataFrame, weights=WEIGHTS, budget_pct: int = BUDGET_PCT, max_epochs: int = MAX_EPOCHS,
          seed: int = SEED, domain=source_domain) -> DataFrame:
    """The selected documents with their own columns and whole texts, one row per copy.

    Only a leaf's plan is joined: broadcast while Spark sees it below its threshold, else by
    a sort-merge join that adaptive execution splits where a leaf is hot.
    """
    plan = leaf_plan(staged(docs.select(*_described(docs, domain)), "tokens"),
                     weights, budget_pct, max_epochs, seed).drop("_n")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       *_described(docs, domain)[:-1])
    out = rows.withColumn("leaf", _leaf()).join(plan, "leaf").withColumn("copies", _copies(seed))
    return out.filter("copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("__row.*")


def oracle_sql(weights=WEIGHTS, budget_pct=BUDGET_PCT, max_epochs=MAX_EPOCHS, seed=SEED,
               documents: str = "documents") -> str:
    """Common table expressions that end in `picked`: a row per selected copy, with whole rows."""
    def weight(level):
        cases = "".join(f" WHEN {level} = '{n}' THEN {v}" for n, v in weights.get(level, {}).items())
        return f"CASE{cases} ELSE {OTHER} END" if cases else str(OTHER)

    steps, parent_given = [], None
    for depth, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[:depth + 1]), ", ".join(LEVELS[:depth])
        part = f"PARTITION BY {parent}" if parent else ""
        budget = f"(SELECT sum(tokens) * {budget_pct} // 100 FROM leaves)" if depth == 0 else "g.given"
        join = "" if depth == 0 else f"JOIN given{depth - 1} g ON " + " AND ".join(
            f"c.{x} IS NOT DISTINCT FROM g.{x}" for x in LEVELS[:depth])
        own = ", ".join(f"c.{x}" for x in LEVELS[:depth + 1])
        steps.append(f"""
c{depth} AS (SELECT {own}, cap, w, ({budget})::HUGEINT AS b FROM (
    SELECT {path}, sum(tokens * {max_epochs})::HUGEINT AS cap, {weight(level)} AS w FROM leaves GROUP BY {path}) c {join}),
f{depth} AS (SELECT *, cap * wl <= w * l AS isfull FROM (
    SELECT *, sum(w) OVER ({part}) - coalesce(sum(w) OVER e, 0) AS wl,
           greatest(0, b - coalesce(sum(cap) OVER e, 0)) AS l FROM c{depth}
    WINDOW e AS ({part} ORDER BY cap::DOUBLE / w, {path} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
given{depth} AS (SELECT {path}, CASE WHEN fl IS NULL THEN cap ELSE (w * fl) // fw END AS given FROM (
    SELECT *, first(CASE WHEN NOT isfull THEN l END IGNORE NULLS) OVER u AS fl,
           first(CASE WHEN NOT isfull THEN wl END IGNORE NULLS) OVER u AS fw FROM f{depth}
    WINDOW u AS ({part} ORDER BY cap::DOUBLE / w, {path} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""")
    match = " AND ".join(f"d.{x} IS NOT DISTINCT FROM g.{x}" for x in LEVELS)
    return f"""desc_ AS (SELECT *, coalesce('d' || try_cast(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 3,
           'none') AS domain,
       len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM {documents}),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM desc_ GROUP BY ALL),
{",".join(steps)},
plan AS (SELECT g.domain, g.lang, g.source, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS epochs,
         CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
         FROM given2 g JOIN leaves d ON {match}),
placed AS (SELECT d.*, epochs, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source ORDER BY place
             RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM (SELECT d.*, epochs, rest, ('0x' || substr(md5('{seed}:' || epochs || ':' || doc_id), 1, 15))::BIGINT AS place
        FROM desc_ d JOIN plan g ON {match}) d),
chosen AS (SELECT *, epochs + (rest > coalesce(earlier, 0))::BIGINT AS copies FROM placed),
picked AS (SELECT *, unnest(range(copies::BIGINT)) AS epoch FROM chosen)"""


SQL = f"""WITH {oracle_sql()}
SELECT doc_id, domain, lang, source, epoch, n_tokens,
  CASE WHEN epoch = epochs THEN least(n_tokens, rest - coalesce(earlier, 0)) ELSE n_tokens END::BIGINT AS taken_tokens
FROM picked"""
