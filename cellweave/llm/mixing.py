"""Mixing to target weights by iterative proportional fitting, with DataFrame functions only.

Documents fall into cells (source, language, topic). Raking multiplies the cells' token weights by target over present share of each
source, then of each language, then of each topic, round after round, until all three marginals hold within TOLERANCE or `rounds` are done. A
document of a cell is kept with probability min(1, c * raked share / present share), c chosen so that the kept tokens are the stated share of
all: cells that would exceed 1 are taken whole and the others scaled up for them.

Targets: for each dimension a table of values and weights (of rows with the same value the weights add up, null or negative ones count as 0), or an
exponent e by which the present shares are tempered (share ** e). Values without a target get weight 0 and none of their documents with tokens is kept; null sources and
languages are a value of their own, ''. Where that leaves less than the stated share, all of what has a weight is kept. A draw is a hash of
doc_id (null: of ''), so equal doc_ids are kept or dropped together if their cells are, and the same rows in any order give the same result.

The topic of a text is a parameter: any string Column, or a list of (topic, term), of which the first whose term the text contains applies.

One pass over the texts counts tokens by cell (partial sums first, so a source with a third of all rows is no load); rounds work on the cells only,
which number at most sources x languages x topics; a second pass draws. Texts are read whole, however long. Null and empty texts have no tokens, and
cells without tokens have no share to change: their documents stay. Repeated rows count as often as they stand there. An empty table gives an
empty result. Other columns pass through; where one of them begins with `cell_`, the new columns begin with `cell__` (and so on) instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import SPACES, written

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.7}
ROUNDS, TOLERANCE, SHARE, SEED = 60, 1e-11, 0.9, "mix"
#: Rounds between two looks at the marginals.
STRIDE = 4
#: Coarse topics by what a text contains; PROSE where nothing applies.
TOPICS, PROSE = (("legal", "icense"), ("contact", "@"), ("tabular", " | ")), "prose"


def n_tokens(text: Column) -> Column:
    """Words between white space; null: 0."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACES), lambda x: x != "")), F.lit(0)).cast("long")


def topic(text: Column, topics: Sequence[tuple[str, str]] = TOPICS) -> Column:
    """The first topic whose term the text contains."""
    return F.coalesce(*[F.when(text.contains(term), F.lit(name)) for name, term in topics], F.lit(PROSE))


def free_prefix(docs: DataFrame) -> str:
    """`cell_`, with more underscores where columns of docs begin like that."""
    prefix = "cell_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def with_cells(docs: DataFrame, topics: Column | Sequence[tuple[str, str]] = TOPICS) -> DataFrame:
    """The rows with their source, lang, topic and tokens under free_prefix."""
    of = topics if isinstance(topics, Column) else topic(F.col("text"), topics)
    new = {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": F.coalesce(of, F.lit("")), "tokens": n_tokens(F.coalesce("text", F.lit("")))}
    return docs.withColumns({free_prefix(docs) + c: v for c, v in new.items()})


def targeted(cells: DataFrame, dimension: str, target: float | DataFrame) -> DataFrame:
    """cells with the column target_<dimension>, a share. target: an exponent, or a table of value and weight."""
    name = f"target_{dimension}"
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("n"))
    if isinstance(target, DataFrame):
        weight = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
        given = target.groupBy(F.coalesce(F.col("value").cast("string"), F.lit("")).alias(dimension)).agg(F.sum(weight).alias("wanted"))
        wanted = present.join(given, dimension, "left").select(dimension, F.when(F.col("n") > 0, F.coalesce("wanted", F.lit(0.0))).otherwise(0.0).alias("wanted"))
    else:
        wanted = present.select(dimension, F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(float(target)))).otherwise(0.0).alias("wanted"))
    total = wanted.agg(F.sum("wanted").alias("all"))
    share = F.coalesce(F.try_divide(F.col("wanted"), F.col("all")), F.lit(0.0))
    return cells.join(wanted.crossJoin(F.broadcast(total)).select(dimension, share.alias(name)), dimension)


def farthest(cells: DataFrame) -> float:
    """The largest distance of a marginal's share from its target."""
    each = [cells.groupBy(d).agg(F.sum("weight").alias("now"), F.first(f"target_{d}").alias("wanted")).select(F.lit(d).alias("d"), "now", "wanted") for d in DIMENSIONS]
    every = each[0].unionAll(each[1]).unionAll(each[2])
    sums = every.groupBy("d").agg(F.sum("now").alias("all"))
    found = every.join(F.broadcast(sums), "d").agg(F.max(F.abs(F.coalesce(F.try_divide(F.col("now"), F.col("all")), F.lit(0.0)) - F.col("wanted")))).first()[0]
    return found or 0.0


def rake(cells: DataFrame, rounds: int, tolerance: float = TOLERANCE) -> DataFrame:
    """cells (source, lang, topic, tokens and the targets) with the column weight, whose marginals are the targets."""
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for done in range(1, rounds + 1):
        for d in DIMENSIONS:
            now = F.sum("weight").over(Window.partitionBy(d))
            cells = cells.withColumn("weight", F.when(now > 0, F.try_divide(F.col("weight") * F.col(f"target_{d}"), now)).otherwise(0.0))
        if done % STRIDE == 0 or done == rounds:
            cells = written(cells, "raked")
            if farthest(cells) <= tolerance:
                break
    return cells


def probabilities(cells: DataFrame, share: float) -> DataFrame:
    """source, lang, topic, weight (the raked share) and probability of each cell; the kept tokens are expected to be `share` of all."""
    total = cells.agg(F.sum("tokens").alias("all_tokens"), F.sum("weight").alias("all_weight"))
    part = F.coalesce(F.try_divide(F.col("weight"), F.col("all_weight")), F.lit(0.0))
    cells = cells.crossJoin(F.broadcast(total)).withColumn("weight", part).where("tokens > 0").withColumn("ratio", F.col("weight") * F.col("all_tokens") / F.col("tokens"))
    cells = written(cells.select(*DIMENSIONS, "tokens", "weight", "ratio", "all_tokens"), "ratios")
    # the factor of the cells that aren't taken whole grows with each cell that is, until no further one exceeds 1
    factor, whole = 0.0, -1
    while True:
        full = F.col("ratio") * factor >= 1
        now = cells.agg(F.count_if(full).alias("whole"), F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("taken"), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("ratio"))).alias("rest"), F.max("all_tokens").alias("all")).first()
        if now.whole == whole or not now.rest:
            # nothing is left to scale: all cells with a weight are taken whole
            chance = F.when(F.col("ratio") > 0, 1.0).otherwise(0.0) if not now.rest else F.least(F.lit(1.0), F.col("ratio") * factor)
            return cells.select(*DIMENSIONS, "weight", chance.alias("probability"))
        factor, whole = (share * now.all - now.taken) / now.rest, now.whole


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 by a hash of doc_id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(2.0**32)


def mix(docs: DataFrame, targets: dict[str, float | DataFrame] | None = None, share: float = SHARE, rounds: int = ROUNDS, seed: str = SEED, topics: Column | Sequence[tuple[str, str]] = TOPICS) -> DataFrame:
    """All rows of docs with the columns cell_source, cell_lang, cell_topic, cell_tokens, cell_weight, cell_probability and cell_kept."""
    p, each = free_prefix(docs), with_cells(docs, topics)
    cells = written(each.groupBy(*[F.col(p + d).alias(d) for d in DIMENSIONS]).agg(F.sum(p + "tokens").alias("tokens")), "cells")
    for d in DIMENSIONS:
        cells = targeted(cells, d, (targets or TEMPER)[d])
    chances = written(probabilities(rake(written(cells, "targets"), rounds), share), "probabilities")
    chances = chances.select(*[F.col(d).alias(p + d) for d in DIMENSIONS], F.col("weight").alias(p + "weight"), F.col("probability").alias(p + "probability"))
    found = each.join(chances, [p + d for d in DIMENSIONS], "left").withColumns({p + "weight": F.coalesce(p + "weight", F.lit(0.0)), p + "probability": F.coalesce(p + "probability", F.lit(1.0))})
    found = found.withColumn(p + "kept", draw(F.col("doc_id"), seed) < F.col(p + "probability"))
    return found.select(*docs.columns, *[p + c for c in (*DIMENSIONS, "tokens", "weight", "probability", "kept")])


def keep_mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows that are drawn, with all their columns."""
    return mix(docs, **options).where(free_prefix(docs) + "kept").select(docs.columns)


#: Rounds of the SQL, which cannot stop by itself; the marginals hold within TOLERANCE by then.
SQL_ROUNDS = 12


def oracle_sql(rounds: int = SQL_ROUNDS, share: float = SHARE) -> str:
    """The query over `documents` in DuckDB's SQL, with the default targets."""
    parts = ["""each AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN text LIKE '%icense%' THEN 'legal' WHEN text LIKE '%@%' THEN 'contact' WHEN text LIKE '% | %' THEN 'tabular' ELSE 'prose' END AS topic,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS tokens FROM documents)"""]
    parts.append("cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM each GROUP BY ALL)")
    wanted = []
    for d in DIMENSIONS:
        parts.append(f"wanted_{d} AS (SELECT {d}, pow(sum(tokens), {TEMPER[d]}) / sum(pow(sum(tokens), {TEMPER[d]})) OVER () AS target_{d} FROM cells GROUP BY {d})")
        wanted.append(f"JOIN wanted_{d} USING ({d})")
    parts.append(f"raked_0 AS (SELECT cells.*, {', '.join(f'target_{d}' for d in DIMENSIONS)}, tokens AS weight FROM cells {' '.join(wanted)})")
    step = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            parts.append(f"raked_{step + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {d}) > 0 THEN weight * target_{d} / sum(weight) OVER (PARTITION BY {d}) ELSE 0 END AS weight) FROM raked_{step})")
            step += 1
    parts.append(f"""shares AS (SELECT source, lang, topic, tokens, weight / sum(weight) OVER () AS weight, weight / sum(weight) OVER () * sum(tokens) OVER () / nullif(tokens, 0) AS ratio, sum(tokens) OVER () AS all_tokens FROM raked_{step}),
factors AS (SELECT *, ({share} * all_tokens - coalesce(sum(tokens) OVER (ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(tokens * ratio) OVER (ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM shares WHERE tokens > 0),
chosen AS (SELECT max_by(factor, ratio) AS c FROM factors WHERE factor * ratio <= 1),
chances AS (SELECT source, lang, topic, weight, CASE WHEN c IS NULL THEN 1 ELSE least(1, c * ratio) END AS probability FROM factors, chosen)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, source, lang, topic, tokens AS n_tokens, round(coalesce(weight, 0), 6) AS weight, round(coalesce(probability, 1), 6) AS probability,
  (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0 < coalesce(probability, 1) AS kept
FROM each LEFT JOIN chances USING (source, lang, topic)"""
