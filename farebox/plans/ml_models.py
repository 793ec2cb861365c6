"""Models trained on the tables. Each query returns one row per model with its measures;
``good`` says whether it beats the floor a trivial model would reach."""

import math

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as mc
from pyspark.ml import clustering as mk
from pyspark.ml import feature as mf
from pyspark.ml import regression as mr
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest, Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.plans.ranks import ks_one_sample, normal_cdf
from farebox.registry import query
from farebox.tables import Tables

INPUTS = ["price", "l_discount", "l_tax"]


def line_features(t: Tables) -> DataFrame:
    """Price, discount and tax against the charge: dear or not, its class, and its value."""
    price = F.col("l_extendedprice") / 50000
    charge = price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = t.lineitem.select(
        price.alias("price"),
        "l_discount",
        "l_tax",
        (charge > 1).cast("double").alias("dear"),
        F.when(charge < 0.6, 0.0).when(charge < 1.3, 1.0).otherwise(2.0).alias("class"),
        charge.alias("charge"),
        F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(5)).alias("fold"),
    )
    assembled = mf.VectorAssembler(inputCols=INPUTS, outputCol="features").transform(rows)
    return workspace.stored(assembled, "features")


def halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Four fifths to learn from, one fifth to test on; the split is a hash of the row's key."""
    return rows.filter("fold > 0"), rows.filter("fold = 0")


def report(t: Tables, rows: list[tuple[str, str, float, bool]]) -> DataFrame:
    return t.spark.createDataFrame([(m, k, float(v), bool(g)) for m, k, v, g in rows], "model string, measure string, value double, good boolean")


@query("ml_classify")
def ml_classify(t: Tables) -> DataFrame:
    train, test = halves(line_features(t))
    auc = BinaryClassificationEvaluator(labelCol="dear")
    accuracy = MulticlassClassificationEvaluator(labelCol="class", metricName="accuracy")
    two = {
        "svm": mc.LinearSVC(labelCol="dear", maxIter=10, regParam=0.01),
        "logistic": mc.LogisticRegression(labelCol="dear", maxIter=10, regParam=0.01, elasticNetParam=0.5),
        "boosted trees": mc.GBTClassifier(labelCol="dear", maxIter=5, maxDepth=3, seed=1),
    }
    many = {
        "tree": mc.DecisionTreeClassifier(labelCol="class", maxDepth=4),
        "forest": mc.RandomForestClassifier(labelCol="class", numTrees=10, maxDepth=4, seed=1),
        "bayes": mc.NaiveBayes(labelCol="class", modelType="gaussian"),
        "perceptron": mc.MultilayerPerceptronClassifier(labelCol="class", layers=[3, 5, 3], maxIter=30, seed=1),
        "logistic, 3 classes": mc.LogisticRegression(labelCol="class", maxIter=10, family="multinomial"),
        "one against rest": mc.OneVsRest(labelCol="class", classifier=mc.LogisticRegression(maxIter=5)),
    }
    found = []
    for name, estimator in two.items():
        value = auc.evaluate(estimator.fit(train).transform(test))
        found.append((name, "area under ROC", value, value > 0.7))
    most = train.groupBy("class").count().agg(F.max("count") / F.sum("count")).first()[0]
    for name, estimator in many.items():
        value = accuracy.evaluate(estimator.fit(train).transform(test))
        found.append((name, "accuracy", value, value > most))
    return report(t, found)


@query("ml_regress")
def ml_regress(t: Tables) -> DataFrame:
    train, test = halves(line_features(t).withColumn("done", (F.col("l_tax") > 0).cast("double")).withColumn("wait", F.col("charge") + 1))
    models = {
        "linear": mr.LinearRegression(labelCol="charge"),
        "lasso": mr.LinearRegression(labelCol="charge", regParam=0.1, elasticNetParam=1.0),
        "ridge": mr.LinearRegression(labelCol="charge", regParam=0.1, elasticNetParam=0.0),
        "generalized": mr.GeneralizedLinearRegression(labelCol="charge", family="gaussian", link="identity", maxIter=5),
        "tree": mr.DecisionTreeRegressor(labelCol="charge", maxDepth=4),
        "forest": mr.RandomForestRegressor(labelCol="charge", numTrees=10, maxDepth=4, seed=1),
        "boosted trees": mr.GBTRegressor(labelCol="charge", maxIter=5, maxDepth=3, seed=1),
        "isotonic": mr.IsotonicRegression(labelCol="charge", featureIndex=0),
        "survival": mr.AFTSurvivalRegression(labelCol="wait", censorCol="done", maxIter=10),
    }
    found = []
    for name, estimator in models.items():
        label = estimator.getLabelCol()
        if name == "survival":  # a scale of times, not a mean: held to the order it puts rows in
            pairs = estimator.fit(train).transform(test)
            value = pairs.agg(F.corr("prediction", label)).first()[0]
            found.append((name, "correlation", value, value > 0.5))
            continue
        value = RegressionEvaluator(labelCol=label, metricName="r2").evaluate(estimator.fit(train).transform(test))
        found.append((name, "r2", value, value > 0.3))
    return report(t, found)


class WholeLDA(mk.LDA):
    """The library's online topic model, its texts drawn without replacement: at a rate of 1 each step learns from all of them once.

    The library draws with replacement, so at a rate of 1 a step still misses more than a third of the texts. Its optimizer
    can be told not to, which no parameter of the model does.
    """

    def _fit_java(self, dataset):
        self._transfer_params_to_java()
        java, jvm = self._java_obj, dataset.sparkSession._jvm
        helper = getattr(getattr(jvm.org.apache.spark.ml.clustering, "LDA$"), "MODULE$")
        model = (
            jvm.org.apache.spark.mllib.clustering.LDA()
            .setK(self.getK())
            .setDocConcentration(jvm.org.apache.spark.mllib.linalg.Vectors.fromML(java.getOldDocConcentration()))
            .setTopicConcentration(java.getOldTopicConcentration())
            .setMaxIterations(self.getMaxIter())
            .setSeed(self.getSeed())
            .setCheckpointInterval(self.getCheckpointInterval())
            .setOptimizer(java.getOldOptimizer().setSampleWithReplacement(False))
            .run(helper.getOldDataset(dataset._jdf, self.getFeaturesCol()))
        )
        model = jvm.org.apache.spark.ml.clustering.LocalLDAModel(java.uid(), model.vocabSize(), model, dataset.sparkSession._jsparkSession)
        return java.copyValues(model, jvm.org.apache.spark.ml.param.ParamMap()).setParent(java)


@query("ml_cluster")
def ml_cluster(t: Tables) -> DataFrame:
    rows = mf.VectorAssembler(inputCols=["c_acctbal", "c_nationkey"], outputCol="raw").transform(t.customer)
    rows = workspace.stored(mf.StandardScaler(inputCol="raw", outputCol="features").fit(rows).transform(rows), "scaled")
    silhouette = ClusteringEvaluator()
    found = []
    for name, estimator in {
        "k-means": mk.KMeans(k=4, seed=1, maxIter=10),
        "bisecting k-means": mk.BisectingKMeans(k=4, seed=1, maxIter=10),
        "mixture": mk.GaussianMixture(k=3, seed=1, maxIter=10),
    }.items():
        value = silhouette.evaluate(estimator.fit(rows).transform(rows))
        found.append((name, "silhouette", value, value > 0))
    words = Pipeline(
        stages=[
            mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\P{L}+"),
            mf.HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 14),
        ]
    )
    # Each step and each measure reads the texts again: they are cut into words once.
    texts = words.fit(t.documents).transform(t.documents).select("doc_id", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        topics = WholeLDA(k=3, maxIter=3, seed=1, optimizer="online", subsamplingRate=1.0).fit(texts)
        perplexity = topics.logPerplexity(texts)
    finally:
        texts.unpersist()
    found.append(("topics", "log perplexity", perplexity, perplexity < math.log(1 << 14)))  # words drawn evenly
    # Who trades with whom: at most one edge per pair of nations.
    pairs = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("c_nationkey").cast("bigint").alias("a"), F.col("s_nationkey").cast("bigint").alias("b"))
        .agg(F.count("*").cast("double").alias("weight"))
        .filter("a <> b")
        .groupBy(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        .agg(F.sum("weight").alias("weight"))
    )
    groups = mk.PowerIterationClustering(k=3, maxIter=10, weightCol="weight").assignClusters(pairs)
    n, k = groups.agg(F.count_distinct("id"), F.count_distinct("cluster")).first()
    traders = pairs.select("src").union(pairs.select("dst")).distinct().count()
    found.append(("power iteration", "nations placed", n, n == traders and 1 < k <= 3))
    return report(t, found)


BASKETS = """types AS (SELECT p_type AS item, CAST(1 << CAST(row_number() OVER (ORDER BY p_type) - 1 AS INT) AS BIGINT) AS bit FROM (SELECT DISTINCT p_type FROM part)),
  baskets AS (SELECT l_orderkey, bit_or(bit) AS b FROM lineitem JOIN part ON l_partkey = p_partkey JOIN types ON p_type = item GROUP BY 1),
  masks AS (SELECT CAST(m AS BIGINT) AS m, (SELECT string_agg(item, ',' ORDER BY item) FROM types WHERE m & bit > 0) AS names FROM range(1, (SELECT 1 << count(*) FROM types)) r(m)),
  sets AS (SELECT m, names, count(*) AS freq FROM masks JOIN (SELECT b, 1 AS one FROM baskets) ON b & m = m GROUP BY ALL
           HAVING count(*) >= ceil(0.05 * (SELECT count(*) FROM baskets)))"""


@query(
    "ml_patterns",
    f"""WITH {BASKETS} SELECT 'set' AS kind, names AS pattern, freq::DOUBLE AS value FROM sets
        UNION ALL SELECT 'rule', a.names || ' => ' || c.names, round(u.freq / a.freq, 6) FROM sets u JOIN sets a ON u.m & a.m = a.m AND u.m <> a.m AND bit_count(u.m) = bit_count(a.m) + 1
          JOIN masks c ON c.m = u.m - a.m WHERE u.freq / a.freq >= 0.2""",
)
def ml_patterns(t: Tables) -> DataFrame:
    """Frequent sets of part types per order and rules between them. A basket holds each type once."""
    types = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    baskets = types.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.2).fit(baskets)
    sets = model.freqItemsets.select(
        F.lit("set").alias("kind"), F.array_join(F.array_sort("items"), ",").alias("pattern"), F.col("freq").cast("double").alias("value")
    )
    rules = model.associationRules.select(
        F.lit("rule"), F.concat_ws(" => ", F.array_join(F.array_sort("antecedent"), ","), F.array_join("consequent", ",")), F.round("confidence", 6)
    )
    return sets.union(rules)


@query(
    "ml_sequences",
    """WITH n AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
         d AS (SELECT user_id, day, max_by(event_type, (n, event_type)) AS kind FROM n GROUP BY ALL),
         s1 AS (SELECT DISTINCT user_id, kind AS p FROM d), s2 AS (SELECT DISTINCT a.user_id, a.kind || '>' || b.kind AS p FROM d a JOIN d b ON a.user_id = b.user_id AND a.day < b.day),
         s3 AS (SELECT DISTINCT a.user_id, a.kind || '>' || b.kind || '>' || c.kind AS p FROM d a JOIN d b ON a.user_id = b.user_id AND a.day < b.day
                JOIN d c ON b.user_id = c.user_id AND b.day < c.day)
       SELECT p AS pattern, count(*) AS users FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) GROUP BY 1
       HAVING count(*) >= ceil(0.6 * (SELECT count(DISTINCT user_id) FROM events))""",
)
def ml_sequences(t: Tables) -> DataFrame:
    """Sequences of daily main event types that most users show. A user has one entry per day."""
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    daily = daily.groupBy("user_id", "day").agg(F.max_by("event_type", F.struct("n", "event_type")).alias("kind"))
    sequences = daily.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("day", "kind"))).alias("days"))
    sequences = sequences.select(F.transform("days", lambda d: F.array(d["kind"])).alias("sequence"))
    found = PrefixSpan(minSupport=0.6, maxPatternLength=3).findFrequentSequentialPatterns(sequences)
    return found.select(F.array_join(F.flatten("sequence"), ">").alias("pattern"), F.col("freq").alias("users"))


@query("ml_recommend")
def ml_recommend(t: Tables) -> DataFrame:
    """Factors of suppliers and brands; the three best brands for each supplier.

    There are few brands, so scoring all of them grows with the suppliers only.
    """
    brand = F.substring("p_brand", 7, 10).cast("int")
    ratings = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_suppkey").cast("int").alias("supplier"), brand.alias("brand"))
        .agg(F.avg("l_quantity").alias("rating"))
    )
    model = ALS(userCol="supplier", itemCol="brand", ratingCol="rating", rank=4, maxIter=3, regParam=0.1, seed=1, coldStartStrategy="drop").fit(ratings)
    rmse = RegressionEvaluator(labelCol="rating", metricName="rmse").evaluate(model.transform(ratings))
    best = model.recommendForAllUsers(3).select("supplier", F.inline("recommendations"))
    return best.withColumn("rmse", F.lit(rmse))


@query("ml_stats")
def ml_stats(t: Tables) -> DataFrame:
    """Column statistics, correlations and tests."""
    rows = line_features(t)
    found = []
    for method in ("pearson", "spearman"):
        matrix = Correlation.corr(mf.VectorAssembler(inputCols=["price", "charge"], outputCol="pair").transform(rows), "pair", method).first()[0]
        value = matrix.toArray()[0, 1]
        found.append((f"{method} of price and charge", "r", value, value > 0.5))
    chi = ChiSquareTest.test(mf.VectorAssembler(inputCols=["l_discount"], outputCol="q").transform(rows), "q", "class").first()
    cells = rows.groupBy("l_discount", "class").agg(F.count("*").alias("n"))  # a few discounts and three classes
    by_row, by_class = Window.partitionBy("l_discount"), Window.partitionBy("class")
    expected = F.sum("n").over(by_row) * F.sum("n").over(by_class) / F.lit(rows.count())
    plain = cells.select(F.pow(F.col("n") - expected, 2).alias("d"), expected.alias("e")).agg(F.sum(F.col("d") / F.col("e"))).first()[0]
    found.append(("discount against class", "chi-squared", chi["statistics"][0], abs(chi["statistics"][0] - plain) < 1e-6 * plain))
    normal = KolmogorovSmirnovTest.test(rows.select("price"), "price", "norm", 1.0, 0.5).first()
    own = ks_one_sample(rows, "price", lambda x: normal_cdf(x, 1.0, 0.5)).first()
    found.append(("price against normal", "Kolmogorov-Smirnov", normal["statistic"], abs(normal["statistic"] - own["statistic"]) < 1e-9))
    summary = rows.select(Summarizer.metrics("mean", "variance", "count", "min", "max", "normL1").summary(F.col("features")).alias("s")).first()["s"]
    mean, variance, n = rows.agg(F.avg("price"), F.variance("price"), F.count("*")).first()
    found.append(("price", "mean", summary["mean"][0], math.isclose(summary["mean"][0], mean, rel_tol=1e-9)))
    found.append(("price", "variance", summary["variance"][0], math.isclose(summary["variance"][0], variance, rel_tol=1e-9)))
    found.append(("rows", "count", summary["count"], summary["count"] == n))
    return report(t, found)


@query("ml_tune")
def ml_tune(t: Tables) -> DataFrame:
    """Grid search by cross validation and by one split."""
    rows = line_features(t)
    logistic = mc.LogisticRegression(labelCol="dear", maxIter=5)
    grid = ParamGridBuilder().addGrid(logistic.regParam, [0.01, 1.0]).addGrid(logistic.elasticNetParam, [0.0]).build()
    auc = BinaryClassificationEvaluator(labelCol="dear")
    folds = CrossValidator(estimator=logistic, estimatorParamMaps=grid, evaluator=auc, numFolds=2, seed=1, parallelism=2).fit(rows)
    linear = mr.LinearRegression(labelCol="charge", maxIter=5)
    linear_grid = ParamGridBuilder().addGrid(linear.regParam, [0.0, 1.0]).build()
    rmse = RegressionEvaluator(labelCol="charge")
    split = TrainValidationSplit(estimator=linear, estimatorParamMaps=linear_grid, evaluator=rmse, trainRatio=0.8, seed=1).fit(rows)
    found = [(f"logistic {i}", "area under ROC", v, v > 0.7) for i, v in enumerate(folds.avgMetrics)]
    spread = rows.agg(F.stddev_pop("charge")).first()[0]  # the error of the mean alone
    found += [(f"linear {i}", "rmse", v, v < spread) for i, v in enumerate(split.validationMetrics)]
    return report(t, found)


@query("ml_stages")
def ml_stages(t: Tables) -> DataFrame:
    """Text to label in one chain of stages; the fitted chain is saved, loaded and applied."""
    texts = t.documents.join(t.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    chain = Pipeline(
        stages=[
            mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+"),
            mf.HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 12),
            mc.LogisticRegression(maxIter=5, regParam=0.01),
        ]
    )
    path = workspace.scratch(t.spark, "model")
    chain.fit(texts).write().overwrite().save(path)
    return PipelineModel.load(path).transform(texts).select("doc_id", "label", "prediction")
