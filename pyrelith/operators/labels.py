"""Labelled samples: judged rows, votes, metric blocks, cross-event classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.functions.scalar import scores
from pyrelith.operators.overlay import whole_groups
from pyrelith.runtime import Scratch, fresh

FEATURES = ("b2", "b3", "b4", "b6", "b7", "b8a", "b11", "b12")


def model_table(df: DataFrame, label: str, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Every row with ``judged``: labelled 0 or 1 and all features finite. Counting what falls out is a group-by on it."""
    fine = F.col(label).isin(0, 1)
    for f in features:
        fine = fine & F.col(f).isNotNull() & ~F.isnan(f) & (F.abs(F.col(f)) < float("inf"))
    return df.withColumn("judged", F.coalesce(fine, F.lit(False)))


def majority(df: DataFrame, box: list[str], predicted: str = "predicted") -> DataFrame:
    """A box is 1 if more than half of its pixels are; a tie is 0 and is counted."""
    return df.groupBy(*box).agg((F.avg(predicted) > 0.5).cast("int").alias("vote"), (F.avg(predicted) == 0.5).cast("int").alias("tie"), F.count(F.lit(1)).alias("pixels"))


def metric_blocks(df: DataFrame, truth: str, guess: str, by: str) -> DataFrame:
    """Metrics of everything and of each stratum, in one pass over grouping sets."""
    t, g = F.col(truth), F.col(guess)
    parts = df.groupingSets([[], [F.col(by)]], F.col(by)).agg(F.grouping(by).alias("whole"), F.count(F.lit(1)).alias("n"), *[F.count_if((g == x) & (t == y)).cast("double").alias(n) for n, x, y in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))])
    return parts.select(F.when(F.col("whole") == 1, F.lit("all")).otherwise(F.col(by)).alias(by), "n", *[v.alias(k) for k, v in scores(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]).items()])


def threshold_rule(df: DataFrame, event: str, value: str, reference: DataFrame) -> DataFrame:
    """Above the own event's threshold, strictly; an event without one has no prediction."""
    return df.join(reference, event, "left").withColumn("predicted", (F.col(value) > F.col("threshold")).cast("int"))


def classifiers(seed: int = 42, trees: int = 20, rounds: int = 10) -> dict:
    """Boosted trees, a forest and a tree of depth 3, all with one seed."""
    from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier

    return {"boosted trees": GBTClassifier(seed=seed, maxIter=rounds, maxDepth=4), "forest": RandomForestClassifier(seed=seed, numTrees=trees), "tree of depth 3": DecisionTreeClassifier(maxDepth=3, seed=seed)}


def equal_rows(df: DataFrame, event: str, label: str, features: tuple[str, ...]) -> DataFrame:
    """A table of the distinct rows ``(event, label, *features, weight)``, each with the number of its equals."""
    d = df.select(event, F.col(label).cast("double").alias("label"), *features)
    counted = d.groupBy(*d.columns).agg(F.count(F.lit(1)).cast("double").alias("weight")).sortWithinPartitions(*d.columns)
    return Scratch(df.sparkSession, "equal").table(counted, "rows")


#: Rows from which on a forest is fitted on equal rows, if these are a quarter at most. Below, twenty fits cost more than one on all rows.
MANY_ROWS = 1_000_000


def many_equal(counted: DataFrame) -> bool:
    """Whether a table of equal rows stands for so many rows that work on each of them is worth saving."""
    distinct, rows = counted.agg(F.count(F.lit(1)), F.sum("weight")).first()
    return (rows or 0) >= MANY_ROWS and 4 * distinct <= rows


def folds(df: DataFrame, counted: DataFrame, event: str, label: str, features: tuple[str, ...], models: dict):
    """For each event and model ``(event, name, fitted on the other events)``. Events that are judged are few and drawn by hand: they are listed on the driver.

    Boosting goes over its rows some seventy times, so equal rows are one with their number as weight (``counted``). A model that draws rows gets each of them,
    but for a forest on many equal ones, whose trees draw numbers of equal rows.
    """
    from pyspark.ml.feature import VectorAssembler

    scratch, few = Scratch(df.sparkSession, "folds"), many_equal(counted)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features")
    weighted = vectors.transform(counted).select(event, "features", "label", "weight")
    rows, drawn = None, {}
    for name, model in models.items():
        if few and model.hasParam("bootstrap") and model.getBootstrap():
            t = vectors.transform(bootstrap(counted, model.getSeed(), model.getNumTrees(), model.getSubsamplingRate()))
            drawn[name] = scratch.table(t.select(event, "features", "label", "draws"), f"drawn{len(drawn)}")
    if any(draws_rows(m) for name, m in models.items() if name not in drawn):
        d = df.select(event, F.col(label).cast("double").alias("label"), *features)
        rows = scratch.table(vectors.transform(d).select(event, "features", "label"), "rows")
    for (e,) in counted.select(event).distinct().orderBy(event).collect():
        for name, model in models.items():
            if name in drawn:
                yield e, name, forest_of_draws(model, drawn[name].where(F.col(event) != e))
            elif draws_rows(model):
                yield e, name, model.fit(rows.where(F.col(event) != e))
            else:
                yield e, name, model.copy({model.weightCol: "weight"}).fit(weighted.where(F.col(event) != e))


def bootstrap(counted: DataFrame, seed: int, trees: int, rate: float) -> DataFrame:
    """How many of each distinct row's equals every tree draws (``draws``). A row is drawn a Poisson number of times, so ``weight`` equal rows are drawn Poisson(``rate * weight``) times."""
    keyed = counted.withColumn("__hash", F.xxhash64(*[c for c in counted.columns if c != "weight"], F.lit(seed)))
    schema = T.StructType([*counted.schema.fields, T.StructField("draws", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rngs = (np.random.Generator(np.random.Philox(key=int(h) % (1 << 64))) for h in b["__hash"])
            yield b.drop(columns="__hash").assign(draws=[rng.poisson(rate * w, trees) for rng, w in zip(rngs, b["weight"], strict=True)])

    return keyed.mapInPandas(run, schema)


#: Trees of one forest that are fitted at a time: their jobs are small.
TREES_AT_ONCE = 8


def forest_of_draws(model, drawn: DataFrame) -> Forest:
    """A forest whose trees are fitted one by one, each on the distinct rows with their numbers in its draw as weights."""
    strategy = model.getFeatureSubsetStrategy()
    if strategy == "auto" and model.getNumTrees() > 1:
        strategy = "sqrt"

    def fitted(k: int):
        one = model.copy({model.numTrees: 1, model.bootstrap: False, model.subsamplingRate: 1.0, model.featureSubsetStrategy: strategy, model.seed: model.getSeed() + k, model.weightCol: "weight"})
        return one.fit(drawn.select("features", "label", F.col("draws")[k].cast("double").alias("weight")).where("weight > 0"))

    with ThreadPool(TREES_AT_ONCE) as pool:
        return Forest(pool.map(inheritable_thread_target(drawn.sparkSession)(fitted), range(model.getNumTrees())))


class Forest(Model, HasFeaturesCol):
    """Trees that predict as a forest does: the class of the greatest sum of the trees' shares, the lower one of equals."""

    def __init__(self, trees: list):
        super().__init__()
        self.trees = trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, shares = dataset, []
        for tree in self.trees:
            shares.append(fresh(out, f"share{len(shares)}"))
            out = tree.copy({tree.featuresCol: self.getFeaturesCol(), tree.probabilityCol: shares[-1], tree.rawPredictionCol: "", tree.predictionCol: ""}).transform(out)
        each = [vector_to_array(F.col(c)) for c in shares]
        votes = F.array(*[sum((F.coalesce(F.get(a, F.lit(k)), F.lit(0.0)) for a in each), F.lit(0.0)) for k in range(max(t.numClasses for t in self.trees))])
        return out.withColumn("prediction", (F.array_position(votes, F.array_max(votes)) - 1).cast("double")).drop(*shares)


def draws_rows(model) -> bool:
    """Whether a model is fitted on rows drawn by chance: then equal rows are drawn one by one, not together."""
    return model.hasParam("bootstrap") or model.hasParam("subsamplingRate") and model.getSubsamplingRate() < 1


def leave_one_out(df: DataFrame, event: str, label: str, features: tuple[str, ...], models: dict) -> DataFrame:
    """The rows of ``df`` once for each model, with ``model`` and ``predicted``, each by a model that never saw the row's event; one pass an event.

    Many equal rows are predicted once, and each row finds its prediction by its event and features.
    """
    from pyspark.ml.feature import VectorAssembler

    counted = equal_rows(df, event, label, features)
    fitted: dict = {}
    for e, name, model in folds(df, counted, event, label, features, models):
        fitted.setdefault(e, {})[name] = model
    few = many_equal(counted)
    own = counted.select(event, *features).distinct() if few else df
    data = VectorAssembler(inputCols=list(features), outputCol=fresh(df, "features")).transform(own)
    vector, kept, out = data.columns[-1], list(data.columns), None
    for e, of in fitted.items():
        p, guesses = data.where(F.col(event) == e), [fresh(data, f"p{k}") for k in range(len(of))]
        for k, (guess, model) in enumerate(zip(guesses, of.values(), strict=True)):
            p = model.copy({model.featuresCol: vector}).transform(p).select(*kept, *guesses[:k], F.col("prediction").cast("int").alias(guess))
        part = p.select(*own.columns, F.array(*[F.struct(F.lit(name).alias("model"), F.col(g).alias("predicted")) for g, name in zip(guesses, of, strict=True)]).alias(vector))
        out = part if out is None else out.unionByName(part)
    if few:
        out = df.join(Scratch(df.sparkSession, "predicted").table(out, "predicted"), [event, *features])
    return out.select(*df.columns, F.explode(vector).alias(vector)).select(*df.columns, f"{vector}.model", f"{vector}.predicted")


#: Rows of an event that are dealt among one another, about; one task holds one such block.
BLOCK_ROWS = 50_000


def dealt_anew(df: DataFrame, event: str, features: tuple[str, ...], key: str, seed: int, repeats: int) -> DataFrame:
    """Each row once for each repeat and feature, with that feature's value taken from another row of its event.

    Rows of an event are dealt to blocks of about ``BLOCK_ROWS`` by a hash, so a block is a random part of its event; an event of fewer
    rows is one block. In each repeat a block's rows get the values of one another in a new order. So rows move once, whatever the
    repeats, and no task sees a large event whole. ``feature`` is null for the rows as they are, once for each repeat.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    sizes = df.groupBy(event).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("__blocks")).withColumnRenamed(event, "__event")
    r = df.select(event, key, "label", *features).join(sizes, F.col(event).eqNullSafe(F.col("__event"))).drop("__event")
    r = r.withColumn("__hash", F.xxhash64(key, F.lit(seed))).withColumn("__block", F.xxhash64(event, F.pmod("__hash", "__blocks"), F.lit(seed))).drop("__blocks")
    together = r.repartition("__block").sortWithinPartitions("__block", "__hash", key, *features, "label")
    schema = T.StructType([*[T.StructField(c, fields[c]) for c in (event, key, "label")], T.StructField("repeat", T.IntegerType()), *[T.StructField(f, fields[f]) for f in features], *[T.StructField(f"__{f}", fields[f]) for f in features]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(batches, ["__block"]):
            cuts = np.flatnonzero(np.diff(g["__block"].to_numpy())) + 1
            for t in np.split(np.arange(len(g)), cuts):
                part = g.iloc[t].reset_index(drop=True)
                for k in range(repeats):
                    order = np.random.default_rng([seed, k, abs(int(part["__block"][0]))]).permutation(len(part))
                    others = part[list(features)].iloc[order].reset_index(drop=True).add_prefix("__")
                    yield pd.concat([part[[event, key, "label"]].assign(repeat=k), part[list(features)], others], axis=1)

    which = F.explode(F.array(F.lit(None).cast("string"), *[F.lit(f) for f in features]))
    j = together.mapInPandas(run, schema).withColumn("feature", which)
    return j.select(event, key, "label", "repeat", "feature", *[F.when(F.col("feature") == f, F.col(f"__{f}")).otherwise(F.col(f)).alias(f) for f in features])


#: Pairs of a distinct row and a value of one feature that a task of ``dealt_counts`` counts, at most.
MOST_PAIRS = 1 << 23
#: Rows that such a task stands for, at most; numpy's draws end at 10^9.
MOST_DRAWN = 500_000_000


def dealt_counts(counted: DataFrame, features: tuple[str, ...], seed: int, repeats: int, strata: int = 1) -> DataFrame:
    """What ``dealt_anew`` gives for one event, counted: ``(label, feature, *features, n0, n1, ...)`` with how many rows are such in each repeat.

    ``counted`` has the distinct rows and their numbers (``weight``). Dealing a feature's values anew to all rows gives a distinct row of ``weight`` rows
    that many draws from the values left by the rows before it, without putting back: a multivariate hypergeometric draw. So the work is that of the pairs
    of a distinct row and a value, however many rows they stand for. ``feature`` is null for the rows as they are. Rows are dealt within ``strata`` equal parts of each distinct row.
    """
    fields = {f.name: f.dataType for f in counted.schema.fields}
    n = [f"n{k}" for k in range(repeats)]
    weight, turn = F.col("weight").cast("long"), F.pmod(F.col("stratum") + F.xxhash64("label", *features), F.lit(strata))
    share = F.floor(weight / strata) + (turn < weight % strata).cast("long")
    parts = counted.select("label", *features, "weight", F.explode(F.sequence(F.lit(0), F.lit(strata - 1))).alias("stratum")).withColumn("weight", share).where("weight > 0")
    parts = parts.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    keys = ["feature", "stratum"]
    together = parts.repartition(max(parts.sparkSession.sparkContext.defaultParallelism, len(features) * strata), *keys).sortWithinPartitions(*keys, *features, "label")
    schema = T.StructType([T.StructField("label", fields["label"]), T.StructField("feature", T.StringType()), *[T.StructField(f, fields[f]) for f in features], *[T.StructField(c, T.LongType()) for c in n]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in whole_groups(batches, keys):
            for (feature, stratum), part in g.groupby(keys, sort=False):
                weights, (code, values) = part["weight"].to_numpy(), pd.factorize(part[feature])
                left = np.zeros((repeats, len(values)), np.int64)
                np.add.at(left[0], code, weights)
                left[1:] = left[0]
                rngs = [np.random.default_rng([seed, k, features.index(feature), int(stratum)]) for k in range(repeats)]
                many = max(1, (1 << 17) // len(values))
                for at in range(0, len(part), many):
                    drawn = np.zeros((min(many, len(part) - at), repeats, len(values)), np.int64)
                    for i, row in enumerate(drawn):
                        for k, rng in enumerate(rngs):
                            row[k] = rng.multivariate_hypergeometric(left[k], weights[at + i], method="marginals")
                            left[k] -= row[k]
                    i, v = np.nonzero(drawn.any(axis=1))
                    out = part[["label", "feature", *features]].iloc[at + i].reset_index(drop=True)
                    out[feature] = values.take(v)
                    yield pd.concat([out, pd.DataFrame(drawn[i, :, v], columns=n)], axis=1)

    as_is = counted.select("label", F.lit(None).cast("string").alias("feature"), *features, *[weight.alias(c) for c in n])
    return together.mapInPandas(run, schema).unionByName(as_is)


def permutation_importance(df: DataFrame, event: str, label: str, features: tuple[str, ...], key: str, models: dict, seed: int = 42, repeats: int = 10) -> DataFrame:
    """``(event, model, feature, importance)``: the mean loss of balanced accuracy on the event that was held out, over the repeats.

    Dealt rows are never written: they are made, predicted by all models of their event and counted in one pass. Where an event has
    fewer pairs of a distinct row and a value than rows to deal, those are drawn and predicted in place of its rows.
    """
    from pyspark.ml.feature import VectorAssembler

    rows = df.select(event, key, F.col(label).cast("int").alias("label"), *features)
    counted = equal_rows(df, event, label, features)
    fitted: dict = {}
    for e, name, model in folds(df, counted, event, label, features, models):
        fitted.setdefault(e, {})[name] = model
    values = F.array(*[F.approx_count_distinct(f) for f in features])
    sizes = {s[event]: s for s in counted.groupBy(event).agg(F.sum("weight").alias("rows"), F.count(F.lit(1)).alias("distinct"), values.alias("values")).collect()}
    vectors, scored = VectorAssembler(inputCols=list(features), outputCol="features"), None
    for e, of in fitted.items():
        size, guesses = sizes[e], [f"p{k}" for k in range(len(of))]
        counts = size["distinct"] * max(size["values"]) <= MOST_PAIRS and size["distinct"] * sum(size["values"]) <= size["rows"] * len(features)
        if counts:
            kept = ["label", "feature", "features", *[f"n{k}" for k in range(repeats)]]
            dealt = dealt_counts(counted.where(F.col(event) == e), features, seed, repeats, int(size["rows"] // MOST_DRAWN) + 1)
        else:
            kept = ["label", "feature", "features", "repeat"]
            # rows as they are have the same score in each repeat
            dealt = dealt_anew(rows.where(F.col(event) == e), event, features, key, seed, repeats).where("feature is not null or repeat = 0")
        p = vectors.transform(dealt).select(*kept)
        for k, model in enumerate(of.values()):
            p = model.transform(p).select(*kept, *guesses[:k], F.col("prediction").cast("int").alias(f"p{k}"))
        if counts:
            g = p.groupBy("feature", "label", *guesses).agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(repeats)])
            g = g.select("feature", "label", *guesses, F.posexplode(F.array(*[f"n{k}" for k in range(repeats)])).alias("repeat", "n")).where("feature is not null or repeat = 0")
        else:
            g = p.groupBy("repeat", "feature", "label", *guesses).agg(F.count(F.lit(1)).alias("n"))
        total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
        halves = lambda c: [F.try_divide(total((F.col("label") == v) & (F.col(c) == v)), total(F.col("label") == v)) for v in (0, 1)]
        each = F.array(*[F.struct(F.lit(name).alias("model"), (sum(halves(c), F.lit(0.0)) / 2).alias("score")) for c, name in zip(guesses, of, strict=True)])
        s = g.groupBy("repeat", "feature").agg(each.alias("s")).select(F.lit(e).alias(event), "repeat", "feature", F.explode("s").alias("s")).select(event, "repeat", "feature", "s.model", "s.score")
        scored = s if scored is None else scored.unionByName(s)
    s = Scratch(df.sparkSession, "importance").table(scored, "scores")
    whole = s.where("feature is null").select(event, "model", F.col("score").alias("whole"))
    return s.where("feature is not null").join(whole, [event, "model"]).groupBy(event, "model", "feature").agg(F.avg(F.col("whole") - F.col("score")).alias("importance"))


def quality_checks(df: DataFrame) -> DataFrame:
    """One row a check with how many samples fail it."""
    ids = df.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    checks = df.agg(F.count_if(F.col("first_reader").isNull()).alias("unjudged"), F.count_if(~F.col("first_reader").isin(0, 1)).alias("unknown class"), F.count_if(F.col("size") < 200).alias("too small"), F.count_if(F.col("stratum").isNull()).alias("no stratum"))
    names = checks.columns
    long = checks.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names]))).alias("check", "failing"))
    return long.unionByName(ids.agg(F.lit("repeated id").alias("check"), F.count(F.lit(1)).alias("failing")))
