"""Model scoring, evaluation, comparison and saving (all work runs in executors).

Fitted members come from ``trees`` (forests, boosting) and ``nets`` (perceptrons), which fit all folds
of a model together, or are ``pyspark.ml`` pipelines (``estimator``, ``fit``, ``score_vote``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcraft.operators import evaluate as ev
from panelcraft.operators import nets, trees
from panelcraft.session import written

SEED = 42


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def estimator(kind: str, n_features: int, label: str = "label", weight: str | None = None,
              **p) -> object:
    """Estimators with the reference's sizes as defaults (override through ``p``)."""
    common = dict(labelCol=label, featuresCol="features", seed=p.pop("seed", SEED))
    if weight and kind != "mlp":
        common["weightCol"] = weight
    if kind == "rf":
        return RandomForestClassifier(numTrees=p.get("numTrees", 500), maxDepth=p.get("maxDepth", 12),
                                      minInstancesPerNode=p.get("minInstancesPerNode", 2),
                                      featureSubsetStrategy=p.get("featureSubsetStrategy", "sqrt"),
                                      **common)
    if kind == "gbt":           # histogram boosting stand-in: lr 0.03
        return GBTClassifier(maxIter=p.get("maxIter", 400), stepSize=p.get("stepSize", 0.03),
                             maxDepth=p.get("maxDepth", 4), **common)
    if kind == "gbt_sub":       # boosted trees with row and column subsampling
        return GBTClassifier(maxIter=p.get("maxIter", 400), stepSize=p.get("stepSize", 0.03),
                             maxDepth=p.get("maxDepth", 4), subsamplingRate=p.get("subsamplingRate", 0.85),
                             featureSubsetStrategy=p.get("featureSubsetStrategy", "0.85"),
                             minInstancesPerNode=p.get("minInstancesPerNode", 3), **common)
    if kind == "mlp":
        hidden = p.get("hidden", (128, 64, 32))
        common.pop("weightCol", None)
        return MultilayerPerceptronClassifier(layers=[n_features, *hidden, 2],
                                              maxIter=p.get("maxIter", 1000), **common)
    raise ValueError(f"unknown estimator kind {kind!r}")


def score_column(scored: DataFrame, name: str = "score") -> DataFrame:
    """P(class 1) from the probability vector."""
    return scored.withColumn(name, vector_to_array(F.col("probability"))[1])


def fit(train: DataFrame, features: Sequence[str], est) -> PipelineModel:
    return Pipeline(stages=[assembler(features), est]).fit(train)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return score_column(model.transform(df)).select(*keep, "score")


def evaluate(name: str, scored: DataFrame, label: str, tune: DataFrame | None,
             lo: int = 10, hi: int = 90, default: float = 0.5) -> DataFrame:
    """One metrics row of ``scored`` at the F1-best threshold of ``tune``: scores of validation rows
    (``None``: the scored rows themselves, as the reference does, which is optimistic).  The
    lowest threshold wins ties, ``default`` holds when none has F1 > 0.  The sweep
    already has the confusion counts at every grid threshold, so the chosen row is
    picked from it with an equi-join on the threshold (<= hi - lo rows per side)."""
    # the scores feed both the sweep and the AUC: scored once, read twice
    scored = written(scored.select(label, "score"), "scores")
    sweep = ev.threshold_sweep(scored, label, "score", lo, hi)
    tsweep = sweep if tune is None else ev.threshold_sweep(tune, label, "score", lo, hi)
    w = F.max(F.col("f1")).over(Window.partitionBy())
    key = F.struct(F.col("f1"), (F.col("_best") == 0) & (F.col("threshold") == default),
                   -F.col("threshold"))
    chosen = (tsweep.withColumn("_best", w)
                    .agg(F.max_by(F.col("threshold"), key).alias("threshold")))
    auc = ev.roc_auc(scored, label, "score").select("auc").scalar()
    return (sweep.join(chosen, "threshold")
                 .select(F.lit(name).alias("model"), "threshold", "tp", "fp", "fn", "tn",
                         "accuracy", "balanced_accuracy", "precision", "recall", "f1",
                         auc.alias("auc")))


def run_parallel(tasks: Sequence[Callable[[], object]], parallelism: int = 4) -> list:
    """Run independent fits from a driver thread pool (like ``CrossValidator``'s
    ``parallelism``): their Spark jobs run concurrently on the executors."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))


#: nodes of a forest's fits up to which they are sent to the tasks that score (some 30 MB); beyond, rows and blocks of
#: trees meet in tasks, ``ROWS_A_BLOCK`` rows at most with one block
SENT_NODES, ROWS_A_BLOCK = 1_000_000, 200_000
#: rows of a record that goes to a block of trees
PACKED_ROWS = 32
#: rows scored by one task with the members sent to it: a small file is read by one task, and would be scored there
ROWS_TO_SCORE = 8192


def score_fitted(models: dict[int, Sequence], df: DataFrame, features: Sequence[str], keep: Sequence[str],
                 fold_col: str | None = None) -> DataFrame:
    """(keep..., score): the mean probability of a fit's members for every row, by the models of its fold
    (``fold_col``: out-of-fold scores), else by the final ones.  Rows are spread over tasks first.

    ``models`` maps a fit (``trees.FINAL``, or the fold left out) to its members, which have
    ``proba(matrix)``.  Members bounded by their trees and layers go to the tasks once; forests of more than
    ``SENT_NODES`` nodes stay tables (``_forest_sums``)."""
    from panelcraft.operators.trees import FINAL
    spark, keep = df.sparkSession, list(keep)
    n = max((len(m) for m in models.values()), default=0)
    size = lambda i: sum(m[i].nodes for m in models.values() if isinstance(m[i], trees.Forest))
    apart = [i for i in range(n) if size(i) > SENT_NODES]
    sent = spark.sparkContext.broadcast({f: [None if i in apart else m.model if isinstance(m, trees.Forest) else m
                                             for i, m in enumerate(members)] for f, members in models.items()})
    names = [f"_x{i}" for i in range(len(features))]

    def each(frames):
        for pdf in frames:
            x = pdf[names].to_numpy(np.float64)
            fits = pdf["_fit"].to_numpy()
            out = np.zeros((len(pdf), n))
            for f in np.unique(fits):
                at = np.flatnonzero(fits == f)
                for i, m in enumerate(sent.value[int(f)]):
                    if m is not None:
                        out[at, i] = m.proba(x[at])
            yield pdf, out

    def run(frames):
        for pdf, out in each(frames):
            yield pdf[keep].assign(score=sum(out[:, i] for i in range(n)) / n)

    def run_apart(frames):
        for pdf, out in each(frames):
            yield pdf.assign(_p=list(out))

    fit_of = F.col(fold_col).cast("int") if fold_col else F.lit(FINAL)
    given = df.select(*keep, fit_of.alias("_fit"), *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.select(*keep).schema)
    if len(apart) < n and (parts := -(-df.count() // ROWS_TO_SCORE)) > 1:
        given = given.repartition(parts)
    if not apart:
        return given.mapInPandas(run, schema + ", score double")
    given = given.withColumn("_id", F.monotonically_increasing_id())
    both = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    rows = written(given.mapInPandas(run_apart, both + ", _p array<double>"), "to-score")      # ids are drawn once
    sums = _forest_sums({f: {i: m[i] for i in apart} for f, m in models.items()}, rows, names)
    total = F.lit(0.0)
    for i in range(n):
        mine = F.aggregate(F.filter("_sums", lambda s: s["member"] == i), F.lit(0.0), lambda t, s: t + s["s"])  # noqa: B023
        count = F.coalesce(*[F.when(F.col("_fit") == f, F.lit(float(m[i].trees))) for f, m in models.items()]) if i in apart else None
        total = total + (mine / count if i in apart else F.col("_p")[i])
    return rows.join(sums, "_id").select(*keep, (total / F.lit(float(n))).alias("score"))


def _forest_sums(forests: dict[int, dict[int, trees.Forest]], rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(_id, _sums): for every row the sums of its fit's blocks of trees, in order of member and block.

    A task has a part of the rows of its fit, and a block of ``trees.BLOCK`` trees comes by, one tree at a time."""
    count = {r["_fit"]: r["n"] for r in rows.groupBy("_fit").agg(F.count("*").alias("n")).collect()}       # a row a fit
    parts = {f: -(-n // ROWS_A_BLOCK) for f, n in count.items()}
    if not parts:
        return rows.select("_id", F.array().cast("array<struct<member:int,block:int,s:double>>").alias("_sums"))
    first, units = {}, []
    for f in sorted(parts):
        for i, m in sorted(forests[f].items()):
            first[f, i] = len(units)
            units += [(i, b) for b in range(-(-m.trees // trees.BLOCK)) for _ in range(parts[f])]

    def packed(frames):
        for pdf in frames:
            out = []
            for f, part in pdf.groupby("_fit"):
                ids, x = part["_id"].to_numpy(np.int64), np.ascontiguousarray(part[names].to_numpy(np.float64))
                out += [(f, ids[a], ids[a:a + PACKED_ROWS].tobytes(), x[a:a + PACKED_ROWS].tobytes()) for a in range(0, len(ids), PACKED_ROWS)]
            if out:
                yield pd.DataFrame(out, columns=["_fit", "first", "ids", "x"])

    def add(frames):
        """Of each unit first come its rows, then its trees in order."""
        records = (r for pdf in frames for r in pdf.to_dict("records"))
        for unit, mine in groupby(records, lambda r: r["unit"]):
            ids, x, s = [], [], None
            for tree, some in groupby(mine, lambda r: r["tree"]):
                if tree < 0:
                    for r in some:
                        ids.append(r["ids"])
                        x.append(r["x"])
                    ids, x = np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(x), np.float64).reshape(-1, len(names))
                    s = np.zeros(len(ids))
                elif s is not None:
                    s += trees.block_sums([trees.arrays_of(list(some))], x)
            if s is not None:
                i, b = units[unit]
                for a in range(0, len(s), 1 << 16):
                    yield pd.DataFrame({"_id": ids[a:a + (1 << 16)], "member": i, "block": b, "s": s[a:a + (1 << 16)]})

    whole = rows.select("_fit", "_id", *names).mapInPandas(packed, "_fit int, first long, ids binary, x binary")
    # a part of a fit's rows goes to all its blocks, a block's trees to all parts
    blocks = [F.when(F.col("_fit") == f, F.transform(F.sequence(F.lit(0), F.lit(-(-m.trees // trees.BLOCK) - 1)), lambda b: (  # noqa: B023
        F.lit(first[f, i]) + b * parts[f] + F.pmod(F.xxhash64("first"), F.lit(parts[f]))).cast("int"))).otherwise(F.array().cast("array<int>"))  # noqa: B023
        for f in parts for i, m in forests[f].items()]
    tables: dict[tuple, list] = {}
    for f in parts:
        for i, m in forests[f].items():
            tables.setdefault((i, id(m.table)), []).append((f, m))
    grown = None
    for (i, _), of in tables.items():
        low = F.floor(F.col("tree") / trees.BLOCK)
        unit = F.coalesce(*[F.when(F.col("fit") == m.fit, F.sequence(
            (F.lit(first[f, i]) + low * parts[f]).cast("int"), (F.lit(first[f, i]) + (low + 1) * parts[f] - 1).cast("int"))) for f, m in of])
        one = of[0][1].table.where(F.col("fit").isin([m.fit for _, m in of])).withColumn("unit", F.explode(unit))
        grown = one if grown is None else grown.unionByName(one)
    spread = 2 * max(len(units), 1)
    left = whole.select("ids", "x", F.explode(F.flatten(F.array(*blocks))).alias("unit"), F.lit(-1).alias("tree"), F.lit(0).alias("part"))
    both = left.unionByName(grown.drop("fit", "gain"), allowMissingColumns=True).repartition(spread, "unit")
    found = both.sortWithinPartitions("unit", "tree", "part").mapInPandas(add, "_id long, member int, block int, s double")
    return found.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("member", "block", "s"))).alias("_sums"))


def cv_f1(scores: DataFrame, label: str, fold_col: str = "fold") -> DataFrame:
    """Mean over the folds of F1 at the 0.5 cut, from ``fold_scores``."""
    per = ev.binary_metrics(ev.confusion_at(scores, label, "score", 0.5, [fold_col]))
    return per.agg(F.avg("f1").alias("cv_f1"))


def feature_importance(model: object, features: Sequence[str],
                       spark: SparkSession, top: int = 15) -> DataFrame:
    """(feature, importance) of a fitted tree model (or the first member of a vote
    that has them), uniform when none has;
    the ``top`` largest with bands by strict ``>`` q75 / q40 of those values."""
    members = list(model) if isinstance(model, (list, tuple)) else [model]
    vals = [1.0 / len(features)] * len(features)
    for m in members:            # a vote takes its first member that has importances
        if hasattr(m, "importances"):
            vals = m.importances().tolist()
            break
        imp = getattr(m.stages[-1], "featureImportances", None) if hasattr(m, "stages") else None
        if imp is not None:
            vals = imp.toArray().tolist()
            break
    # a fitted model's importances are one small vector per feature (bounded by the schema)
    df = spark.createDataFrame(list(zip(features, [float(v) for v in vals])),
                               "feature string, importance double")
    topk = df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)
    q = topk.select(F.percentile("importance", F.array(F.lit(0.75), F.lit(0.4))).alias("q")).scalar()
    return (topk.withColumn("_q", q)             # one subquery, projected once
                .select("feature", "importance",
                        F.when(F.col("importance") > F.col("_q")[0], "high")
                         .when(F.col("importance") > F.col("_q")[1], "medium")
                         .otherwise("low").alias("band")))


#: members whose probabilities are added up in one pass over the rows
MEMBERS_AT_ONCE = 50


def score_vote(models: Sequence[PipelineModel], df: DataFrame, keep: Sequence[str], row_id: str
               ) -> DataFrame:
    """Average the class-1 probability of several models per row (soft voting).

    All members see the same assembled vector; each pass over the rows adds up to
    ``MEMBERS_AT_ONCE`` of them."""
    if len(models) == 1:
        return score(models[0], df, keep)
    vectors = models[0].stages[0].transform(df).select(*keep, "features")
    parts = []
    for a in range(0, len(models), MEMBERS_AT_ONCE):
        part, total = vectors, F.lit(0.0)
        for i, m in enumerate(models[a:a + MEMBERS_AT_ONCE]):
            member = m.stages[-1].copy()
            member.setPredictionCol("")
            member.setRawPredictionCol("")
            member.setProbabilityCol(f"_p{i}")
            part = member.transform(part)
            total = total + vector_to_array(F.col(f"_p{i}"))[1]
        parts.append(part.select(*keep, total.alias("_s")))
    if len(parts) == 1:
        return parts[0].select(*keep, (F.col("_s") / len(models)).alias("score"))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    others = [k for k in keep if k != row_id]
    return (long.groupBy(row_id).agg(*[F.first(k).alias(k) for k in others], F.sum("_s").alias("_s"))
            .select(*keep, (F.col("_s") / len(models)).alias("score")))


def vectors_to_columns(df: DataFrame, vec_col: str, features: Sequence[str]) -> DataFrame:
    """array<double> -> one column per feature (for synthetic SMOTE rows)."""
    return df.select("*", *[F.col(vec_col)[i].alias(c) for i, c in enumerate(features)]).drop(vec_col)


def scaler_model(stats: dict[str, tuple[float, float]]) -> PipelineModel:
    """The fitted standardizer as a stage that can be saved: raw columns to standardised ones."""
    names = ", ".join(f"`{c}`" for c in stats)
    scaled = ", ".join(f"(`{c}` - ({m!r})) / ({(s if s and s == s else 1.0)!r}) AS `{c}`" for c, (m, s) in stats.items())
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {scaled} FROM __THIS__")])


def save_model(models: Sequence, scaler: PipelineModel, meta: DataFrame, path: str) -> None:
    """All members of a fitted model (trees, nets or pipelines), its scaler, and a one-row metadata table."""
    spark, kinds = meta.sparkSession, []
    scaler.write().overwrite().save(f"{path}/scaler")
    for i, m in enumerate(models):
        at = f"{path}/member-{i:04d}"
        kinds.append("trees" if isinstance(m, trees.TreeModel | trees.Forest) else "net" if isinstance(m, nets.Net) else "pipeline")
        if kinds[-1] == "pipeline":
            m.write().overwrite().save(at)
        else:
            (trees if kinds[-1] == "trees" else nets).save(m, spark, at)
    meta.withColumn("members", F.array(*[F.lit(k) for k in kinds])).write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[list, PipelineModel, DataFrame]:
    meta = spark.read.parquet(f"{path}/meta")
    readers = {"trees": partial(trees.load, spark), "net": partial(nets.load, spark), "pipeline": PipelineModel.load}
    members = [readers[k](f"{path}/member-{i:04d}") for i, k in enumerate(meta.first()["members"])]
    return members, PipelineModel.load(f"{path}/scaler"), meta


__all__ = ["assembler", "estimator", "fit", "score", "evaluate", "cv_f1", "score_fitted", "feature_importance", "score_vote", "vectors_to_columns", "scaler_model", "save_model", "load_model",
           "array_to_vector"]
