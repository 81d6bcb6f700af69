"""Mixing sources to target weights by soft membership (operator 8), with DataFrame and
SQL functions only.

1. *Classifier.* A table of labelled documents trains a multinomial naive Bayes model
   on hashed words: word counts per (bucket, domain), aggregated in Spark over a bounded
   sample of labelled rows, become at most ``buckets`` rows of log weights. Every
   document's whole text is scored by a join of its words with those rows; the softmax
   of the scores are its posteriors over the domains.
2. *Rates.* Document i with n_i tokens and posteriors p_i gets a nonnegative rate r_i.
   Projected gradient minimises the squared, mass-scaled deviations of the expected
   domain totals sum_i r_i n_i p_ik from the targets. Each step is one aggregation over
   the corpus that gives as many numbers as there are domains; the next rates are
   max(least, r_i - sum_k p_ik g_k), an expression on the row. Rates are written to the
   shared folder every few steps, so expressions and lineage stay short.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import free_names, written

BUCKETS = 4096
SAMPLE = 20_000
#: Target shares are natural shares to this power: under 1 raises the rare domains.
TEMPERATURE = 0.7
#: Steps of the projected gradient at most; it ends before when the targets are met or the totals stand still.
STEPS = 200


def _words(text: Column) -> Column:
    """The pieces of a lower-cased text between single white-space characters; the empty ones are
    not words. (A split at one plain character needs no regular expression.)"""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(F.lower(text), " ")


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def train(docs: DataFrame, labelled: DataFrame, *, buckets: int = BUCKETS, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[list[str], DataFrame]:
    """Domains (sorted) and ``(bucket, w_0, w_1, ...)``: log weights of the buckets, from
    ``labelled(id, domain)``, of which the ``sample`` rows with the least hash of the id are used
    (rows without id or domain are passed over). Domains are labels: a bounded set."""
    chosen = labelled.select(F.col(id_col).alias("_id"), F.col("domain").cast("string").alias("domain")).where("_id is not null and domain is not null")
    chosen = chosen.distinct().orderBy(F.xxhash64("_id"), "_id", "domain").limit(sample)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text"))
    # word counts per domain; the sample is bounded, so it may be sent to every executor
    counts = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("domain", F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    counts = counts.groupBy("domain", _bucket(F.col("word"), buckets).alias("bucket")).agg(F.count("*").alias("n")).collect()
    domains = sorted({r["domain"] for r in counts} | {r["domain"] for r in chosen.select("domain").distinct().collect()})
    total = {d: buckets * 0.5 for d in domains}
    by: dict[int, dict[str, int]] = {}
    for r in counts:
        total[r["domain"]] += r["n"]
        by.setdefault(r["bucket"], {})[r["domain"]] = r["n"]
    rows = [(b, *[math.log((by.get(b, {}).get(d, 0) + 0.5) / total[d]) for d in domains]) for b in range(buckets)]
    schema = "bucket int" + "".join(f", w_{k} double" for k in range(len(domains)))
    return domains, docs.sparkSession.createDataFrame(rows, schema)


def posteriors(docs: DataFrame, domains: list[str], weights: DataFrame, *, priors: list[float] | None = None, buckets: int = BUCKETS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, h, tokens, p_0, p_1, ...)``, one row for each distinct (id, text) of ``docs`` (``h``: hash
    of the text): its words and the posterior of each domain. A text without words has the
    priors (equal, if none are given)."""
    m = len(domains)
    base = [math.log(p) for p in (priors or [1 / m] * m)]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # hash and pieces are made once for a text, before the pieces become rows
    words = texts.select("id", F.xxhash64("text").alias("h"), _words(F.col("text")).alias("words"))
    words = words.select("id", "h", F.explode("words").alias("word")).where("word <> ''")
    scored = words.select("id", "h", _bucket(F.col("word"), buckets).alias("bucket")).join(F.broadcast(weights), "bucket")  # `buckets` rows
    # rows that repeat id and text fall together; `same` counts them, and texts without words
    per = scored.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"w_{k}").alias(f"a_{k}") for k in range(m)])
    per = per.withColumnsRenamed({"id": "i_", "h": "h_"})
    many = texts.groupBy("id", F.xxhash64("text").alias("h")).agg(F.count("*").alias("same"))
    per = many.join(per, F.col("id").eqNullSafe(F.col("i_")) & (F.col("h") == F.col("h_")), "left")
    per = per.withColumn("tokens", F.coalesce(F.col("n") / F.col("same"), F.lit(0)).cast("long"))
    score = [F.lit(base[k]) + F.coalesce(F.col(f"a_{k}") / F.col("same"), F.lit(0.0)) for k in range(m)]
    per = per.select("id", "h", "same", "tokens", *[s.alias(f"s_{k}") for k, s in enumerate(score)])
    top = F.greatest(*[F.col(f"s_{k}") for k in range(m)]) if m > 1 else F.col("s_0")
    per = per.select("id", "h", "same", "tokens", *[F.exp(F.col(f"s_{k}") - top).alias(f"e_{k}") for k in range(m)])
    whole = sum((F.col(f"e_{k}") for k in range(m)), F.lit(0.0))
    return per.select("id", "h", "same", "tokens", *[(F.col(f"e_{k}") / whole).alias(f"p_{k}") for k in range(m)])


def fit_rates(members: DataFrame, targets: list[float], *, budget: float | None = None, steps: int = STEPS, every: int = 5,
              least: float = 0.0, tolerance: float = 1e-4) -> tuple[DataFrame, dict]:
    """Rates for ``members(tokens, same, p_0, ...)``: the column ``rate`` is added. ``targets`` are the
    domains' shares; ``budget`` the tokens they share out (None: the least at which no
    domain with a target falls below one pass of its expected tokens), ``least`` the least rate
    of a document. Ends when every total is within ``tolerance`` of its target, or when a step no longer
    moves the totals (targets out of reach: the nearest totals). The second result holds the
    masses, targets and totals reached, and the greatest relative deviation ``off``; a warning says when it
    is above the tolerance."""
    m = len(targets)
    total = sum(targets)
    shares = [t / total for t in targets]
    n = F.col("tokens") * F.col("same")

    def totals(df: DataFrame) -> list[float]:
        row = df.agg(*[F.sum(F.col("rate") * n * F.col(f"p_{k}")).alias(f"t_{k}") for k in range(m)]).head()
        return [float(x or 0.0) for x in row]

    current = members.withColumn("rate", F.lit(max(1.0, least)))
    mass = totals(current)
    if budget is None:
        budget = max((mass[k] / shares[k] for k in range(m) if shares[k] > 0), default=0.0)
    wanted = [budget * s for s in shares]
    reached, step = mass, 1.0

    def deviation() -> float:
        return max((abs(reached[k] - wanted[k]) / max(wanted[k], 1.0) for k in range(m) if mass[k] > 0), default=0.0)

    for i in range(steps):
        if deviation() <= tolerance:
            break
        gap = [(reached[k] - wanted[k]) / mass[k] if mass[k] > 0 else 0.0 for k in range(m)]
        move = sum((F.col(f"p_{k}") * F.lit(step * gap[k]) for k in range(m)), F.lit(0.0))
        current = current.withColumn("rate", F.greatest(F.lit(float(least)), F.col("rate") - move))
        if i % every == every - 1:
            current = written(current, "rates")
        before, reached = reached, totals(current)
        if all(abs(reached[k] - before[k]) <= 1e-3 * tolerance * max(wanted[k], 1.0) for k in range(m)):
            break
    off = deviation()
    if off > tolerance:
        warnings.warn(f"domain totals are up to {off:.2%} off their targets: {reached} of {wanted}", stacklevel=2)
    return current, {"mass": mass, "targets": wanted, "reached": reached, "budget": budget, "off": off}


def mix(docs: DataFrame, labelled: DataFrame, *, targets: dict[str, float] | None = None, temperature: float = TEMPERATURE,
        budget: float | None = None, least: float = 0.0, buckets: int = BUCKETS, sample: int = SAMPLE, steps: int = STEPS, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """``(id, h, tokens, domain, rate, posteriors)`` for each distinct (id, text) of ``docs``; ``h`` is
    ``xxhash64`` of the text (null as empty), ``domain`` the likeliest domain, ``posteriors`` a map.

    ``targets`` gives the domains' shares (domains it leaves out get none); without it they
    are the labelled domains' natural token shares to the power ``temperature``. ``least`` is the least
    rate of a document (1: none is dropped). Targets that are missed are warned of (:func:`fit_rates`). Rows that
    repeat id and text count each, and share one result row. Null ids and texts are
    allowed: a text without words has no tokens and rate 1 or as its priors bid. Without
    any labelled row there is one nameless domain and all rates are 1. Other columns
    are not read; an empty table gives an empty table.
    """
    domains, weights = train(docs, labelled, buckets=buckets, sample=sample, id_col=id_col, text_col=text_col)
    if not domains:
        domains = [""]
        weights = docs.sparkSession.createDataFrame([(b, 0.0) for b in range(buckets)], "bucket int, w_0 double")
    members = written(posteriors(docs, domains, weights, buckets=buckets, id_col=id_col, text_col=text_col), "members")
    m = len(domains)
    if targets is None:
        mass = members.agg(*[F.sum(F.col("tokens") * F.col("same") * F.col(f"p_{k}")) for k in range(m)]).head()
        mass = [float(x or 0.0) for x in mass]
        aims = [(x / (sum(mass) or 1.0)) ** temperature if x > 0 else 0.0 for x in mass]
    else:
        aims = [float(targets.get(d, 0.0)) for d in domains]
    if not sum(aims):
        aims = [1.0] * m
    rated, _ = fit_rates(members, aims, budget=budget, steps=steps, least=least)
    likeliest = F.greatest(*[F.col(f"p_{k}") for k in range(m)]) if m > 1 else F.col("p_0")
    domain = F.coalesce(*[F.when(F.col(f"p_{k}") == likeliest, F.lit(d)) for k, d in enumerate(domains)])
    return rated.select(F.col("id").alias(id_col), "h", "tokens", domain.alias("domain"), "rate",
                        F.create_map(*[x for k, d in enumerate(domains) for x in (F.lit(d), F.col(f"p_{k}"))]).alias("posteriors"))


def apply_rates(docs: DataFrame, mixed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with each row as many times as its rate says: the whole part, and
    once more where a hash of id and text falls below the rest. Deterministic."""
    i, hash_, rate, copy = free_names(docs, "_i", "_h", "_rate", "_copy")
    r = mixed.select(F.col(id_col).alias(i), F.col("h").alias(hash_), F.col("rate").alias(rate))
    h = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    joined = docs.join(r, docs[id_col].eqNullSafe(F.col(i)) & (h == F.col(hash_)))
    dice = F.pmod(F.xxhash64(F.col(i), F.col(hash_), F.lit(8)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    copies = (F.floor(rate) + (dice < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).select(*[docs[c] for c in docs.columns])


def labelled_domains(docs: DataFrame, labels: DataFrame, *, domain_col: str = "lang") -> DataFrame:
    """The labelled table: documents that ``labels`` covers, with the value of ``domain_col`` as domain."""
    covered = labels.select(F.col("doc_id").alias("_l")).where("_l is not null").distinct()
    return docs.join(covered, F.col("doc_id") == F.col("_l")).select("doc_id", F.col(domain_col).cast("string").alias("domain"))
