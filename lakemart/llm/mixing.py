"""Mixing by soft membership: nonnegative document rates that meet domain targets.

A classifier learnt from a table of labels gives each document a posterior over
domains. A document of n words at rate r then adds r * n * posterior to the expected
totals of the domains. Projected gradient steps on the weighted least squares

    | sum of rates * words * posteriors - targets |^2,  rates >= 0,

start from rate 1 for all. Distances of rates are weighted by words, so the step of a
document is the product of its posterior with one vector that all share, whatever its
length; residuals are weighted by the inverse of the domains' cross totals, so the
step length is 1. Documents with the same posterior, to GRID parts, share a rate: cells of
such documents with their exact totals are what the steps run over, and a rate follows
from the posterior and the short list of step vectors.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.columns import named
from lakemart.plans.lineage import cut_lineage

#: Labelled documents of each domain that the classifier is fitted on, at most.
SAMPLE = 2000
#: Rounds and ridge of the fit.
ROUNDS = 50
RIDGE = 0.0001
#: Parts into which a posterior is rounded for the rates.
GRID = 64
#: Steps at most, and the share of all words by which totals may miss the targets.
STEPS = 200
TOLERANCE = 1e-6
#: Steps that don't come nearer to the targets after which the fit ends.
PATIENCE = 8

log = logging.getLogger(__name__)

_SHAPE = ("capitals", "symbols", "repeats", "word_length", "digits", "stops")


def word_count(words: Column) -> Column:
    return F.when((F.size(words) == 1) & (words[0] == ""), 0).otherwise(F.size(words)).cast("long")


def with_features(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with _words, _n (words) and shares that describe the shape of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.split(F.regexp_replace(F.lower(whole), r"^\s+|\s+$", ""), r"\s+")
    docs = docs.withColumn("_words", words).withColumn("_n", word_count(F.col("_words")))
    length, n = F.greatest(F.length(whole), F.lit(1)), F.greatest("_n", F.lit(1))
    shape = {
        "capitals": F.regexp_count(whole, F.lit("[A-Z]")) / length,
        "symbols": F.regexp_count(whole, F.lit("[#$%&*|!]")) / length,
        "repeats": 1 - F.size(F.array_distinct("_words")) / n,
        "word_length": length / n / 10,
        "digits": F.regexp_count(whole, F.lit("[0-9]")) / length,
        "stops": F.regexp_count(whole, F.lit("[.,;:?]")) / n,
    }
    return docs.withColumns({f"_{name}": shape[name].cast("double") for name in _SHAPE})


@dataclass(frozen=True)
class Domains:
    """A fitted classifier; without two labelled domains it has no stages."""

    names: list[str]
    present: list[int]
    stages: object | None

    def posteriors(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with _n and _p, an array with the probability of each domain."""
        columns = docs.columns
        rows = with_features(docs, text)
        if self.stages is None:
            known = self.present or range(len(self.names))
            even = [1.0 / len(known) if i in known else 0.0 for i in range(len(self.names))]
            return rows.select(*columns, "_n", F.array(*map(F.lit, even)).alias("_p"))
        found = self.stages.transform(rows).withColumn("_found", vector_to_array("_probability"))
        each = [
            F.col("_found")[self.present.index(i)] if i in self.present else F.lit(0.0)
            for i in range(len(self.names))
        ]
        return found.select(*columns, "_n", F.array(*each).alias("_p"))


def fit_domains(docs: DataFrame, labels: DataFrame, names: list[str], sample: int = SAMPLE) -> Domains:
    """Classifier from (doc_id, text) and (doc_id, domain); other domains and NULLs don't count.

    Of each domain the ``sample`` documents with the smallest hashes of their ids are read.
    """
    order = [F.xxhash64("doc_id", F.lit(9)), F.col("doc_id")]
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    parts = [
        labels.where(F.col("domain") == name).orderBy(*order).limit(sample).select(
            "doc_id", F.lit(float(i)).alias("_domain")
        )
        for i, name in enumerate(names)
    ]
    # At most ``sample`` rows of two numbers for each domain.
    chosen = F.broadcast(reduce(DataFrame.unionAll, parts))
    known = cut_lineage(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "_domain"), "domains")
    present = sorted(int(row["_domain"]) for row in known.select("_domain").distinct().collect())
    if len(present) < 2:
        return Domains(names, present, None)
    place = F.create_map(*(F.lit(x) for i, d in enumerate(present) for x in (float(d), float(i))))
    known = known.withColumn("_label", place[F.col("_domain")])
    # The sample is drawn by domain; weights give each its share of all labels again.
    sizes = {row["domain"]: row["count"] for row in labels.groupBy("domain").count().collect()}
    drawn = {int(row["_domain"]): row["count"] for row in known.groupBy("_domain").count().collect()}
    weight = F.create_map(*(F.lit(x) for d in present for x in (float(d), sizes[names[d]] / drawn[d])))
    known = known.withColumn("_weight", weight[F.col("_domain")])
    stages = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"_{name}" for name in _SHAPE], outputCol="_features"),
            LogisticRegression(
                featuresCol="_features",
                labelCol="_label",
                probabilityCol="_probability",
                rawPredictionCol="_raw",
                predictionCol="_prediction",
                weightCol="_weight",
                family="multinomial",
                maxIter=ROUNDS,
                regParam=RIDGE,
            ),
        ]
    )
    return Domains(names, present, stages.fit(with_features(known, "text")))


def rate_of(posterior: Column, steps: list[np.ndarray]) -> Column:
    """Rate of a document after the steps."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*(F.array(*(F.lit(float(x)) for x in step)) for step in steps))

    def moved(rate: Column, step: Column) -> Column:
        product = F.aggregate(
            F.zip_with(posterior, step, lambda p, s: p * s), F.lit(0.0), lambda a, b: a + b
        )
        return F.greatest(F.lit(0.0), rate - product)

    return F.aggregate(moves, F.lit(1.0), moved)


def _cell(posterior: Column) -> Column:
    return F.transform(posterior, lambda p: F.round(p * GRID) / GRID)


def fit_steps(members: DataFrame, shares: list[float]) -> list[np.ndarray]:
    """Step vectors for rows with _n words and posterior _p, towards ``shares`` of the words.

    The total is the largest for which no wanted domain has to be repeated on average. A wanted
    domain that no document can be of is left out, with a warning; so is what remains
    when the steps no longer come nearer to the targets. Each step is that of the least
    squares over the cells whose rate is not 0 yet.
    """
    size = len(shares)
    cells = members.groupBy(_cell(F.col("_p")).alias("_cell")).agg(
        F.sum("_n").cast("double").alias("_n"),
        *(F.sum(F.col("_n") * F.col("_p")[k]).alias(f"_e{k}") for k in range(size)),
    )
    cells = cut_lineage(cells, "cells")

    def totals(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Words of each domain at the present rates, and the matrix of the cells that count."""
        rate = cells.withColumn("r", rate_of(F.col("_cell"), steps))
        active = F.when(F.col("r") > 0, F.col("_n")).otherwise(0.0)
        row = rate.agg(
            *(F.sum(F.col("r") * F.col(f"_e{k}")) for k in range(size)),
            *(F.sum(active * F.col("_cell")[i] * F.col("_cell")[j]) for i in range(size) for j in range(size)),
        ).first()
        found = np.array([x or 0.0 for x in row], float)
        return found[:size], found[size:].reshape(size, size)

    expected, matrix = totals([])
    every = expected.sum()
    if every <= 0:
        return []
    wanted = np.array(shares, float) / sum(shares)
    absent = (wanted > 0) & (expected <= 1e-9 * every)
    if absent.any():
        log.warning("no document is of the wanted domains at %s", np.flatnonzero(absent).tolist())
        wanted = np.where(absent, 0.0, wanted)
        if not wanted.any():
            return []
        wanted /= wanted.sum()
    target = wanted * min(expected[k] / wanted[k] for k in range(size) if wanted[k] > 0)
    steps: list[np.ndarray] = []
    reached, best, since = expected, np.inf, 0
    while True:
        missed = np.abs(reached - target)[~absent].max() / every
        if missed <= TOLERANCE:
            return steps
        best, since = (missed, 0) if missed < 0.99 * best else (best, since + 1)
        if since >= PATIENCE or len(steps) >= STEPS:
            log.warning("mixing misses its targets by %.3g of all words", missed)
            return steps
        steps.append(np.linalg.solve(matrix + 1e-9 * every * np.eye(size), reached - target))
        reached, matrix = totals(steps)


def rates(members: DataFrame, steps: list[np.ndarray]) -> DataFrame:
    """``members`` (with _n and _p) and ``rate``, how often a document should come on average.

    Empty texts have no words and change no total; their rate follows from their
    posterior as any other's. Without words at all every rate is 1.
    """
    return members.withColumn("rate", rate_of(_cell(F.col("_p")), steps))


def mixed(docs: DataFrame, domains: Domains, shares: list[float]) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says. Columns may have any name and type."""
    rest = F.struct(*(named(c) for c in docs.columns if c != "text"))
    found = domains.posteriors(docs.select(rest.alias("rest"), "text"))
    # The posteriors cost more to keep beside the texts than to compute a second time.
    steps = fit_steps(cut_lineage(found.select("_n", "_p"), "members"), shares)
    times = copies(rate_of(_cell(F.col("_p")), steps), F.col("rest").getField("doc_id"), F.xxhash64("text"))
    # A sequence from 1 up to 0 would count down.
    found = found.withColumn("_times", times).where("_times > 0")
    columns = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return found.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select(*columns)


def copies(rate: Column, *seed: Column) -> Column:
    """Whole number of copies, ``rate`` on average over documents, settled by a hash."""
    chance = F.pmod(F.xxhash64(*seed, F.lit(13)), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")
