"""Class models: balanced folds, forests, AUC, importances and the permutation null."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import stored
from .relational import digest_rank, varying_inside


def _digest(salt: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(salt), F.col("id").cast("string")))


def folds(labels: DataFrame, k: int = 5, seed: int = 7, replicate: int = 0) -> DataFrame:
    """labels (id, positive) with fold 0 .. k - 1 for positives, by the order of a digest; negatives are dealt alike, so classes stay in proportion."""
    ranked = digest_rank(labels, ["positive"], _digest(str(seed + 7 * replicate)))
    return ranked.withColumn("fold", ((F.col("k_") - 1) % k).cast("int")).drop("k_")


def balanced(train: DataFrame, seed: int = 7) -> DataFrame:
    """As many negatives as positives, the first by a digest."""
    n = train.filter("positive").groupBy().agg(F.count("*").alias("n_"))
    some = digest_rank(train.filter("NOT positive"), [], _digest(f"n{seed}")).join(F.broadcast(n)).filter("k_ <= n_").drop("k_", "n_")
    return train.filter("positive").unionByName(some)


def balanced_split(features: DataFrame, fold: int, k: int = 5, seed: int = 7, replicate: int = 0) -> DataFrame:
    """features (id, positive, ...) of one fold with `test`: positives by their own folds, and negatives drawn anew for the fold.

    By a digest of seed, replicate and fold the first negatives, as many as training positives, train, and the next, as many as test positives, test; others stay out."""
    own = digest_rank(features.filter("positive"), [], _digest(str(seed + 7 * replicate))).withColumn("test", (F.col("k_") - 1) % k == fold).drop("k_")
    n = own.agg(F.sum((~F.col("test")).cast("long")).alias("n_train"), F.sum(F.col("test").cast("long")).alias("n_test"))
    others = digest_rank(features.filter("NOT positive"), [], _digest(f"n{seed + 7 * replicate}.{fold}")).join(F.broadcast(n)).filter("k_ <= n_train + n_test")
    return own.unionByName(others.withColumn("test", F.col("k_") > F.col("n_train")).drop("k_", "n_train", "n_test"))


#: Least positives and features for a fit, least valid AUCs for a summary, least core genes of a cluster (fixed values).
LEAST_POSITIVES, LEAST_FEATURES, LEAST_AUCS, LEAST_CORE = 30, 10, 10, 10


def fit_gates(features: DataFrame, by: list[str] = (), least: int = LEAST_POSITIVES, width: int = LEAST_FEATURES) -> DataFrame:
    """Groups with their positives, features and whether a model may be fitted: enough positives and enough features (an array or a vector column)."""
    size = F.size("features") if dict(features.dtypes)["features"].startswith("array") else F.size(vector_to_array("features"))
    n = features.groupBy(*by).agg(F.sum(F.col("positive").cast("long")).alias("n_positive"), F.max(size).cast("long").alias("n_features"))
    return n.withColumn("ready", (F.col("n_positive") >= least) & (F.col("n_features") >= width))


def summarised_auc(scores: DataFrame, by: list[str] = (), least: int = LEAST_AUCS) -> DataFrame:
    """mean, sd and number of the AUCs of each group (auc), without nulls; groups with fewer than `least` drop out."""
    valid = scores.filter("auc IS NOT NULL").groupBy(*by).agg(F.round(F.avg("auc"), 6).alias("mean"), F.round(F.stddev_samp("auc"), 6).alias("sd"), F.count("*").alias("n"))
    return valid.filter(F.col("n") >= least)


def auc(scored: DataFrame, by: list[str] = (), score: str = "score") -> DataFrame:
    """auc by the rank sum of positives, ties half. Ranks come from counts of distinct scores, not from a window over all rows."""
    by = list(by)
    n = scored.groupBy(*by, score).agg(F.sum(F.col("positive").cast("long")).alias("p"), F.sum((~F.col("positive")).cast("long")).alias("q"))
    below = F.sum("q").over(W.partitionBy(*by).orderBy(score)) - F.col("q")
    n = n.withColumn("won", F.col("p") * (below + F.col("q") / 2))
    return n.groupBy(*by).agg(F.round(F.try_divide(F.sum("won"), F.sum("p") * F.sum("q")), 6).alias("auc"))


def forest_scores(features: DataFrame, k: int = 3, trees: int = 20, seed: int = 7, replicates: int = 1, depth: int = 5) -> tuple[DataFrame, DataFrame]:
    """((replicate, fold, id, positive, score), (replicate, fold, feature, importance)) of cross-validated forests; features: id, positive, features (vector).

    Every replicate deals its own folds, and every fold draws its own negatives, for training and for testing alike."""
    spark = features.sparkSession
    scored, importance = [], []
    for replicate in range(replicates):
        for fold in range(k):
            split = stored(balanced_split(features, fold, k, seed, replicate).withColumn("label", F.col("positive").cast("double")), "fold")
            model = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed + 7 * replicate + fold).fit(split.filter("NOT test"))
            out = model.transform(split.filter("test"))
            scored.append(out.select(F.lit(replicate).alias("replicate"), F.lit(fold).alias("fold"), "id", "positive", F.round(vector_to_array("probability")[1], 9).alias("score")))
            importance += [(replicate, fold, j, float(v)) for j, v in enumerate(model.featureImportances.toArray())]
    return reduce(lambda a, b: a.unionByName(b), scored), spark.createDataFrame(importance, "replicate int, fold int, feature int, importance double")


def permuted_auc(features: DataFrame, rounds: int = 10, k: int = 5, trees: int = 200, seed: int = 11, depth: int = 5) -> DataFrame:
    """round, auc: forests fitted again to labels that are permuted over the rows, in plain folds; auc is the mean over a round's folds.

    The null of ST17: what the same features reach when the labels say nothing."""
    labels = shuffled_labels(features, rounds, seed)
    out = []
    for r in range(1, rounds + 1):
        own = labels.filter(F.col("round") == r).select("id", F.col("positive").alias("drawn"))
        dealt = stored(folds(features.drop("positive").join(own, "id").withColumnRenamed("drawn", "positive"), k, seed + r).withColumn("label", F.col("positive").cast("double")), "permuted")
        for fold in range(k):
            model = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed + r).fit(dealt.filter(F.col("fold") != fold))
            out.append(model.transform(dealt.filter(F.col("fold") == fold)).select(F.lit(r).alias("round"), F.lit(fold).alias("fold"), "positive", F.round(vector_to_array("probability")[1], 9).alias("score")))
    return auc(reduce(lambda a, b: a.unionByName(b), out), ["round", "fold"]).groupBy("round").agg(F.round(F.avg("auc"), 6).alias("auc"))


def importance_summary(importance: DataFrame) -> DataFrame:
    """feature, mean, sd, selected (share of fits that use it), rank."""
    s = importance.groupBy("feature").agg(F.round(F.avg("importance"), 6).alias("mean"), F.round(F.stddev_samp("importance"), 6).alias("sd"), F.round(F.avg((F.col("importance") > 0).cast("double")), 6).alias("selected"))
    return s.withColumn("rank", F.row_number().over(W.orderBy(F.desc("mean"), "feature")))


def shuffled_labels(labels: DataFrame, rounds: int, seed: int = 11) -> DataFrame:
    """round, id, positive: labels permuted over ids in each round, by digests."""
    each = labels.select("id", "positive", F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"))
    key = lambda salt: F.md5(F.concat_ws("|", F.lit(f"{seed}{salt}"), F.col("round").cast("string"), F.col("id").cast("string")))
    place = lambda salt: digest_rank(each, ["round"], key(salt), "k")
    return place("a").select("round", "id", "k").join(place("b").select("round", "positive", "k"), ["round", "k"]).select("round", "id", "positive")


def empirical(null: DataFrame, real: Column, rounds: int) -> DataFrame:
    """p, effect, q95, q99, mark of a real value against null values: (count of null at or above it + 1) / (rounds + 1)."""
    p = (F.sum((F.col("value") >= real).cast("long")) + 1) / (rounds + 1)
    out = null.agg(F.round(p, 6).alias("p"), F.round((F.first(real) - F.avg("value")) / F.stddev_samp("value"), 6).alias("effect"), F.round(F.percentile("value", F.lit(0.95)), 6).alias("q95"), F.round(F.percentile("value", F.lit(0.99)), 6).alias("q99"))
    return out.withColumn("mark", F.when(F.col("p") < 0.001, "***").when(F.col("p") < 0.01, "**").when(F.col("p") < 0.05, "*").otherwise("ns"))


def principal_components(rows: DataFrame, k: int = 2) -> DataFrame:
    """id, pc1 .. pck and share1 .. sharek (percent of variance, to 1 digit) of centred vectors (id, v array); signs are such that the largest loading of each is positive."""
    import numpy as np
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    v = rows.select("id", array_to_vector("v").alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="pc").fit(v)
    load = model.pc.toArray()
    sign = np.sign(load[np.abs(load).argmax(0), np.arange(k)])
    shift = v.select(Summarizer.mean(F.col("x")).alias("m")).first().m.toArray() @ load
    share = np.round(100 * model.explainedVariance.toArray(), 1)
    pc = vector_to_array("pc")
    out = model.transform(v)
    return out.select("id", *[F.round((pc[j] - float(shift[j])) * float(sign[j]), 6).alias(f"pc{j + 1}") for j in range(k)], *[F.lit(float(share[j])).alias(f"share{j + 1}") for j in range(k)])


def sample_components(values: DataFrame, k: int = 2, least: int = 3) -> DataFrame:
    """group, sample, pc1 .. pck, share1 .. sharek: components of samples over genes (group, sample, gene, value), for each group with `least` samples or more.

    Genes are centred, not scaled; those that do not vary in a group drop out, as do those that a sample lacks. The products of samples are
    summed up over genes where they lie; only the samples' matrix, of tens of rows, is decomposed, one group in a task. Signs are such that the largest score is positive."""
    import numpy as np
    import pandas as pd

    v = varying_inside(values, ["group", "gene"])
    full = v.join(v.select("group", "sample").distinct().groupBy("group").agg(F.count("*").alias("n_")).filter(F.col("n_") >= least), "group")
    own = F.sort_array(F.collect_list(F.struct("sample", "value")))
    g = full.groupBy("group", "gene", "n_").agg(own.alias("s"), F.avg("value").alias("m")).filter(F.size("s") == F.col("n_"))
    pairs = F.explode(F.flatten(F.transform("s", lambda a: F.transform("s", lambda b: F.struct(a["sample"].alias("a"), b["sample"].alias("b"), ((a["value"] - F.col("m")) * (b["value"] - F.col("m"))).alias("p"))))))
    gram = g.select("group", pairs.alias("x")).groupBy("group", F.col("x.a").alias("a"), F.col("x.b").alias("b")).agg(F.sum("x.p").alias("p"))
    sample, group = dict(values.dtypes)["sample"], dict(values.dtypes)["group"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.pivot(index="a", columns="b", values="p").sort_index(axis=0).sort_index(axis=1)
        lengths, vectors = np.linalg.eigh(m.to_numpy())
        top = np.argsort(lengths)[::-1][:k]
        scores = vectors[:, top] * np.sqrt(np.maximum(lengths[top], 0))
        scores = scores * np.where(scores[np.abs(scores).argmax(0), np.arange(len(top))] < 0, -1, 1)
        out = pd.DataFrame({"group": pdf["group"].iloc[0], "sample": m.index})
        for j in range(k):
            out[f"pc{j + 1}"] = np.round(scores[:, j], 6)
        for j in range(k):
            out[f"share{j + 1}"] = round(float(100 * lengths[top[j]] / lengths.sum()), 1)
        return out

    names = [*(f"pc{j + 1}" for j in range(k)), *(f"share{j + 1}" for j in range(k))]
    return gram.groupBy("group").applyInPandas(one, f"group {group}, sample {sample}, " + ", ".join(f"{n} double" for n in names))
