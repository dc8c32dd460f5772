"""Mixing sources: rake token weights to three marginals, then sample documents.

Iterative proportional fitting scales the tokens of every (source, language,
topic) cell until the sums by source, by language and by topic meet their
targets. What a token of a cell then weighs, over the largest such weight, is the
probability with which its documents are kept. Native expressions throughout: a
row per source holds its (bounded) cells, so the source step needs no shuffle,
and a sweep reduces all sources to one small language-by-topic table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, chosen, row_key, written

NONE = "(none)"  # a missing source or language is a value of its own

# Topics by the first condition that holds; fixed order.
TOPICS = (
    ("table", "instr(text, ' | ') > 0"),
    ("markup", "text rlike '[*#$%&]{3}'"),
    ("shouting", "instr(text, '!! ') > 0"),
    ("contact", "instr(text, '@') > 0 OR text rlike '[0-9]{3}-[0-9]{4}'"),
)
REST = "prose"

# A target share is proportional to the share of tokens to this power: 1 leaves
# the mix as it is, 0 makes all values equal.
TEMPER = {"source": 0.95, "lang": 0.95, "topic": 1.0}
SWEEPS, CLOSE = 50, 1e-10
SEED = "mix-1"


def topic_of(topics=TOPICS) -> Column:
    out = F.lit(REST)
    for name, rule in reversed(topics):
        out = F.when(F.expr(rule), F.lit(name)).otherwise(out)
    return out


def described(docs: DataFrame, topics=TOPICS) -> DataFrame:
    """doc_id, source, lang, topic and n_tokens (words) of every row."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return rows.select(
        "doc_id", "source", "lang", topic_of(topics).alias("topic"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def shares(tokens: dict[str, float], temper: float, wanted: dict[str, float] | None) -> dict[str, float]:
    """Target share of each value: as wanted, or the tempered share of its tokens."""
    raw = {k: wanted.get(k, 0.0) if wanted else v**temper for k, v in tokens.items()}
    total = sum(raw.values())
    if total <= 0:
        raise ValueError("the targets name no value that occurs")
    return {k: v / total for k, v in raw.items()}


def _factor(column: Column, factors: dict[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in factors.items() for x in (k, float(v))]
    return F.element_at(F.create_map(*pairs), column) if pairs else F.lit(1.0)


def rake(cells: DataFrame, temper=TEMPER, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """source, lang, topic, weight: what a token of the cell weighs, on average 1.

    `cells` has source, lang, topic, tokens. Languages and topics are few (their
    table reaches the driver); sources may be many. `targets` gives shares by
    column and value in place of tempered ones, for source, lang and topic; a
    value that a column's targets do not name has none.
    """
    targets = targets or {}
    if unknown := set(targets) - set(temper):
        raise ValueError(f"targets for unknown columns: {sorted(unknown)}")
    margin = cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens")).collect()
    total = float(sum(r.tokens for r in margin))
    if not total:
        return cells.select("source", "lang", "topic", F.lit(1.0).alias("weight"))
    by = {
        c: {v: float(sum(r.tokens for r in margin if r[c] == v)) for v in sorted({r[c] for r in margin})}
        for c in ("lang", "topic")
    }
    goal = {c: shares({k: v for k, v in by[c].items() if v}, temper[c], targets.get(c)) for c in by}
    rows = (
        cells.where("tokens > 0")
        .groupBy("source")
        .agg(
            F.collect_list(F.struct("lang", "topic", F.col("tokens").cast("double").alias("tokens"))).alias("cells"),
            F.pow(F.sum("tokens").cast("double"), F.lit(temper["source"])).alias("goal"),
        )
    )
    if targets.get("source"):
        wanted = cells.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in targets["source"].items()], "source string, goal double"
        )
        rows = rows.drop("goal").join(wanted, "source", "left").na.fill(0.0, ["goal"])
    rows = written(rows, "sources")
    goals = rows.agg(F.sum("goal")).first()[0]
    if goals <= 0:
        raise ValueError("the targets name no value that occurs")
    g, h = ({k: 1.0 for k in goal[c]} for c in ("lang", "topic"))
    for _ in range(SWEEPS):
        # Sources first: each row scales its own cells. The table of languages by
        # topics is all the other two steps need.
        table = (
            _scaled(rows, g, h, goals)
            .select(F.explode("cells").alias("c"), "f")
            .groupBy("c.lang", "c.topic")
            .agg(F.sum(F.col("f") * F.col("c.tokens") * _product("c", g, h)).alias("w"))
            .collect()
        )
        w = {(r.lang, r.topic): r.w for r in table}
        moved = 0.0
        for k in g:
            have = sum(v for (lang, _), v in w.items() if lang == k)
            step = goal["lang"][k] / have if have else 0.0
            g[k] *= step
            moved = max(moved, abs(step - 1))
            w = {key: v * step if key[0] == k else v for key, v in w.items()}
        for k in h:
            have = sum(v for (_, topic), v in w.items() if topic == k)
            step = goal["topic"][k] / have if have else 0.0
            h[k] *= step
            moved = max(moved, abs(step - 1))
        if moved < CLOSE:
            break
    final = _scaled(rows, g, h, goals).select("source", "f", F.explode("cells").alias("c"))
    return final.select(
        "source", "c.lang", "c.topic",
        (F.col("f") * _product("c", g, h) * F.lit(total)).alias("weight"),
    )


def _product(cell: str, g: dict[str, float], h: dict[str, float]) -> Column:
    return _factor(F.col(f"{cell}.lang"), g) * _factor(F.col(f"{cell}.topic"), h)


def _scaled(rows: DataFrame, g: dict[str, float], h: dict[str, float], goals: float) -> DataFrame:
    """Add f, the source's factor that brings its cells to its target share."""
    whole = F.aggregate(
        "cells",
        F.lit(0.0),
        lambda t, c: t + c["tokens"] * _factor(c["lang"], g) * _factor(c["topic"], h),
    )
    return rows.withColumn("_sum", whole).withColumn(
        "f", F.when(F.col("_sum") > 0, F.col("goal") / F.lit(goals) / F.col("_sum")).otherwise(0.0)
    )


def chance(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the document alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, temper=TEMPER, targets: dict[str, dict[str, float]] | None = None,
    topics=TOPICS, seed: str = SEED,
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, kept for every row.

    Expected tokens by source, language and topic are in the target shares, and
    no sample with them is larger. A missing source or language is the value
    "(none)"; a null or empty text has no tokens, weighs nothing and is kept.
    Repeated rows share their fate; other columns are not looked at; an empty
    table gives none.
    """
    rows = written(described(docs, topics), "described")
    cells = rows.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"))
    weights = written(rake(cells, temper, targets), "weights")
    most = weights.agg(F.max("weight")).first()[0] or 1.0
    key = ["source", "lang", "topic"]
    probability = F.when(F.col("n_tokens") == 0, 1.0).otherwise(
        F.coalesce(F.col("weight") / F.lit(float(most)), F.lit(1.0))
    )
    # The cells are few beside the documents; Spark broadcasts them or splits a
    # hot source's rows.
    out = rows.join(weights, key, "left").withColumn("probability", probability)
    return out.select(
        "doc_id", *key, "n_tokens", F.round("probability", 6).alias("probability"),
        (chance(F.col("doc_id"), seed) < F.col("probability")).alias("kept"),
    )


def sample(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns; cases as above.

    Rows that share a doc_id stay when any of them is kept; rows without one
    are drawn by their text.
    """
    return chosen(docs, mix(docs.withColumn("doc_id", row_key())).where("kept"))
