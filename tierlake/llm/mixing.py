"""Mixing to target weights by iterative proportional fitting, DataFrame functions only.

Tokens are summed into cells of (source, language, topic). Raking then scales the cells'
weights to each margin's targets in turn, ``rounds`` times. A document's factor is its
cell's raked over its observed tokens. Its probability is its factor over the largest factor of
all cells, so no probability is cut and the expected token shares of the sampled rows are the
raked ones, without weights. A document is taken when the hash of its id and the seed, as a
number in [0, 1), is below its probability, so the sample does not depend on partitions or
retries. With a smaller ``most`` given in place of the largest factor more documents are taken,
probabilities end at 1 and the rest of the factor is the document's ``weight``.
``drawn`` needs no weight: a document becomes the whole part of factor / ``MOST`` rows, and one
more when that number is below the fraction, so the expected shares of the rows are the raked ones.

Only cells are joined and shuffled during raking, and each margin's sums are a partial
aggregate; a hot source is one row for each language and topic. After each margin the cells are
written to the shared folder, which cuts the lineage: all plans of a raking are small.

Targets: observed shares to the power ``alpha`` (below 1: flatter), or given shares for
the labels of a margin; labels that are not given keep their observed shares of the rest.

Cases: null labels count as the empty label, a null text as an empty one; a text counts
at least one token; a null doc_id hashes as the empty string; rows that share a doc_id are
taken or left together if their cells agree; an empty table gives an empty result; columns
of the input stay, those named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.session import run_dir
from tierlake.sources.fs import delete

ALPHA, ROUNDS, SEED = 0.7, 8, "mix-1"
#: The factor that ``drawn`` makes one row on average of.
MOST = 1.5
MARGINS = ("source", "lang", "topic")
WORD = r"[^ \t\n\r]+"


def token_count(text: Column) -> Column:
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long"), F.lit(1))


def topic_of(text: Column) -> Column:
    """The kind of a text by plain marks: the topic margin where no topic column is given."""
    text = F.coalesce(text, F.lit(""))
    has = lambda mark: F.instr(text, mark) > 0
    size = F.length(text)
    kind = F.when(size == 0, "empty").when(has(" | "), "table").when(has("!! "), "shout").when(has("@"), "contact")
    return kind.when(size < 1000, "short").when(size < 4000, "medium").otherwise("long")


def cells_of(docs: DataFrame) -> DataFrame:
    return docs.groupBy(*[F.col(f"_mix_{m}").alias(m) for m in MARGINS]).agg(F.sum("_mix_tokens").alias("observed"))


def scalar(df: DataFrame, *aggs: Column) -> tuple:
    return tuple(df.agg(*aggs).first())


def targets_of(cells: DataFrame, margin: str, alpha: float, given: dict[str, float] | None) -> DataFrame:
    """(label, target tokens) of one margin; its targets sum to all tokens."""
    sums = cells.groupBy(margin).agg(F.sum("observed").cast("double").alias("seen"))
    if given is None:
        power, total = scalar(sums, F.sum(F.pow("seen", F.lit(alpha))), F.sum("seen"))
        return sums.select(margin, (F.pow("seen", F.lit(alpha)) * F.lit(total or 0.0) / F.lit(power or 1.0)).alias("target"))
    named = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    share = F.try_element_at(named, F.col(margin)) if given else F.lit(None).cast("double")
    (total, rest, fixed) = scalar(sums.withColumn("share", share), F.sum("seen"), F.sum(F.when(F.col("share").isNull(), F.col("seen"))), F.sum("share"))
    left = max(0.0, 1 - (fixed or 0.0))
    scale = (total or 0.0) / ((fixed or 0.0) + (left if rest else 0.0) or 1.0)
    other = F.col("seen") * F.lit(left / rest if rest else 0.0)
    return sums.select(margin, (F.coalesce(share, other) * F.lit(scale)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int, folder: str) -> DataFrame:
    """Cells with their raked weight ``w``. Each margin's step is written under ``folder`` and
    read again, as it reads its cells twice: the plans of steps in one would double with each."""
    spark = cells.sparkSession
    cells = cells.withColumn("w", F.col("observed").cast("double"))
    for margin, target in targets.items():
        cells = cells.join(target.withColumnRenamed("target", f"_target_{margin}"), margin)
    at = f"{folder}/step-0"
    cells.write.parquet(at)
    cells = spark.read.schema(cells.schema).parquet(at)
    for i, margin in enumerate([*targets] * rounds, 1):
        sums = cells.groupBy(margin).agg(F.sum("w").alias("_sum"), F.max(f"_target_{margin}").alias("_target"))
        scale = sums.select(margin, F.when(F.col("_sum") > 0, F.col("_target") / F.col("_sum")).otherwise(0.0).alias("_scale"))
        cells = cells.join(scale, margin).withColumn("w", F.col("w") * F.col("_scale")).drop("_scale")
        before, at = at, f"{folder}/step-{i}"
        cells.write.parquet(at)
        cells = spark.read.schema(cells.schema).parquet(at)
        delete(spark, before)
    return cells


def assigned(docs: DataFrame, columns: dict[str, Column] | None, alpha: float, given: dict[str, dict[str, float]] | None, rounds: int, seed: str, most: float | None) -> DataFrame:
    """``docs`` with columns of the prefix ``_mix_``: labels, tokens, factor, chance, prob, taken."""
    spark = docs.sparkSession
    folder = run_dir(spark, "mixing")
    asked = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text")), "tokens": token_count(F.col("text"))} | (columns or {})
    keyed = docs.withColumns({f"_mix_{m}": F.coalesce(asked[m].cast("string"), F.lit("")) for m in MARGINS} | {"_mix_tokens": asked["tokens"]})
    cells_of(keyed).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")
    for m in MARGINS:
        targets_of(cells, m, alpha, (given or {}).get(m)).write.parquet(f"{folder}/target-{m}")
    raked = rake(cells, {m: spark.read.parquet(f"{folder}/target-{m}") for m in MARGINS}, rounds, folder)
    rates = raked.select(*[F.col(m).alias(f"_mix_{m}") for m in MARGINS], (F.col("w") / F.col("observed")).alias("_mix_factor"))
    if most is None:
        (most,) = scalar(rates, F.max("_mix_factor"))
    most = most or 1.0
    out = keyed.join(rates, [f"_mix_{m}" for m in MARGINS]).withColumn("_mix_most", F.lit(float(most)))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"|{seed}")))
    chance = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    out = out.withColumn("_mix_chance", chance).withColumn("_mix_prob", F.least(F.lit(1.0), F.col("_mix_factor") / F.col("_mix_most")))
    return out.withColumn("_mix_taken", F.col("_mix_chance") < F.col("_mix_prob"))


def mix(docs: DataFrame, columns: dict[str, Column] | None = None, alpha: float = ALPHA, given: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS, seed: str = SEED, most: float | None = None) -> DataFrame:
    """``docs`` with topic, n_tokens, factor, prob, weight and sampled. ``columns`` gives the
    expressions of source, lang, topic and tokens where they are not the usual ones."""
    made = {
        "topic": F.col("_mix_topic"),
        "n_tokens": F.col("_mix_tokens"),
        "factor": F.col("_mix_factor"),
        "prob": F.col("_mix_prob"),
        "weight": F.greatest(F.lit(1.0), F.col("_mix_factor") / F.col("_mix_most")),
        "sampled": F.col("_mix_taken"),
    }
    out = assigned(docs, columns, alpha, given, rounds, seed, most)
    return out.select(*[c for c in docs.columns if c not in made], *[c.alias(name) for name, c in made.items()])


def sample(docs: DataFrame, columns: dict[str, Column] | None = None, alpha: float = ALPHA, given: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS, seed: str = SEED, most: float | None = None) -> DataFrame:
    """The documents taken, once each, with the columns of ``docs``."""
    return assigned(docs, columns, alpha, given, rounds, seed, most).where("_mix_taken").select(*docs.columns)


def drawn(docs: DataFrame, columns: dict[str, Column] | None = None, alpha: float = ALPHA, given: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS, seed: str = SEED, most: float = MOST) -> DataFrame:
    """The documents as rows, with the columns of ``docs``: on average factor / ``most`` rows
    each, so that the rows themselves have the raked token shares."""
    out = assigned(docs, columns, alpha, given, rounds, seed, most)
    whole = F.floor(F.col("_mix_factor") / F.lit(most))
    more = F.col("_mix_chance") < F.col("_mix_factor") / F.lit(most) - whole
    copies = F.sequence(F.lit(1).cast("long"), whole + more.cast("long"))
    return out.where((whole > 0) | more).withColumn("_mix_copy", F.explode(copies)).select(*docs.columns)


def mix_sql(alpha: float = ALPHA, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same result for ``documents`` in DuckDB SQL: raking as a chain of windows."""
    ctes = [
        r"""base as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, coalesce(text, '') as text from documents),
        docs as (select doc_id, source, lang,
            case when length(text) = 0 then 'empty' when contains(text, ' | ') then 'table' when contains(text, '!! ') then 'shout'
                 when contains(text, '@') then 'contact' when length(text) < 1000 then 'short' when length(text) < 4000 then 'medium' else 'long' end as topic,
            greatest(len(regexp_extract_all(text, '[^ \t\n\r]+')), 1)::bigint as n_tokens from base),
        c as (select source, lang, topic, sum(n_tokens)::bigint as observed, sum(n_tokens)::double as w from docs group by all)"""
    ]
    for m in MARGINS:
        ctes.append(f"s_{m} as (select {m}, sum(observed)::double as seen from c group by all)")
        ctes.append(f"t_{m} as (select {m}, pow(seen, {alpha}) * (select sum(seen) from s_{m}) / (select sum(pow(seen, {alpha})) from s_{m}) as target from s_{m})")
    at = "c"
    for i in range(rounds):
        for m in MARGINS:
            name = f"r{i}_{m}"
            ctes.append(f"{name} as (select a.* exclude (w), a.w * (t.target / sum(a.w) over (partition by a.{m})) as w from {at} a join t_{m} t using ({m}))")
            at = name
    return f"""with {', '.join(ctes)},
        f as (select source, lang, topic, w / observed as factor from {at}),
        p as (select *, factor / (select max(factor) from f) as prob from f)
        select doc_id, source, lang, topic, n_tokens, round(factor, 9) as factor, round(prob, 9) as prob, 1.0::double as weight,
               ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|{seed}'), 1, 13))::bigint / 4503599627370496.0 < prob as sampled
        from docs join p using (source, lang, topic)"""


__all__ = ["drawn", "mix", "mix_sql", "sample", "topic_of"]
