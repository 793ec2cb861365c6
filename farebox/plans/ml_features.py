"""Feature transforms fitted and applied on whole tables.

Transforms with a closed form have a SQL twin. Fits run as distributed aggregates; only
the fitted parameters (means, vocabularies, hash seeds) reach the driver.
"""

from pyspark.ml import Pipeline
from pyspark.ml import feature as mf
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.plans.topics import word_counts
from farebox.registry import query
from farebox.tables import Tables


def entry(vector: str, i: int, digits: int = 6) -> Column:
    return F.round(vector_to_array(vector)[i], digits) + 0.0


def customer_vectors(t: Tables) -> DataFrame:
    return mf.VectorAssembler(inputCols=["c_acctbal", "c_nationkey"], outputCol="v").transform(t.customer)


@query(
    "ml_text_features",
    r"""WITH d AS (SELECT doc_id, string_split_regex(lower(text), '\s') AS w, list_filter(regexp_extract_all(lower(text), '\p{L}+'), lambda x: length(x) > 0) AS r FROM documents)
        SELECT doc_id, len(w) AS tokens, len(r) AS words, len(list_filter(r, lambda x: x NOT IN ('the', 'of', 'and'))) AS kept,
          greatest(len(list_filter(r, lambda x: x NOT IN ('the', 'of', 'and'))) - 1, 0) AS pairs FROM d""",
)
def ml_text_features(t: Tables) -> DataFrame:
    """Tokens by blanks and by pattern, without stop words, and as word pairs."""
    stages = [
        mf.Tokenizer(inputCol="text", outputCol="tokens"),
        mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\P{L}+"),
        mf.StopWordsRemover(inputCol="words", outputCol="kept", stopWords=["the", "of", "and"]),
        mf.NGram(inputCol="kept", outputCol="pairs", n=2),
    ]
    cut = Pipeline(stages=stages).fit(t.documents).transform(t.documents)
    return cut.select("doc_id", *(F.size(c).cast("bigint").alias(c) for c in ("tokens", "words", "kept", "pairs")))


@query(
    "ml_text_vectors",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\p{L}+') AS ws FROM documents),
         c AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY ALL), f AS (SELECT word, count(*) AS df FROM c GROUP BY 1),
         v AS (SELECT doc_id, sum(n) FILTER (df >= 2) AS kept, sqrt(sum((n * ln((1 + (SELECT count(*) FROM documents)) / (1 + df))) ** 2)) AS norm FROM c JOIN f USING (word) GROUP BY 1)
       SELECT doc_id, CAST(len(ws) AS INT) AS n_words, len(ws)::DOUBLE AS n_hashed, coalesce(kept, 0)::DOUBLE AS in_vocabulary, round(coalesce(norm, 0), 6) + 0 AS tfidf_norm FROM w LEFT JOIN v USING (doc_id)""",
)
def ml_text_vectors(t: Tables) -> DataFrame:
    """Hashed term counts, and counts and tf-idf by the words themselves.

    Hashing needs no vocabulary. The vocabulary (words of two texts or more) and its document counts are a table that
    the words join; it never is on the driver.
    """
    texts = t.documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    stages = [
        mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\P{L}+"),
        mf.HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 12),
    ]
    hashed = Pipeline(stages=stages).fit(texts).transform(texts)
    total = F.aggregate(F.unwrap_udt("tf")["values"], F.lit(0.0), lambda s, x: s + x)  # the entries that a sparse vector holds
    sizes = hashed.select("doc_id", F.size("words").alias("n_words"), total.alias("n_hashed"))
    counts = workspace.stored(word_counts(t.documents), "text-words")
    frequency = counts.groupBy("word").agg(F.count("*").alias("df"))
    weight = F.col("n") * F.log((F.lit(float(t.documents.count())) + 1) / (F.col("df") + 1))
    kept = counts.join(frequency, "word").groupBy(F.col("doc").alias("doc_id")).agg(
        F.sum(F.when(F.col("df") >= 2, F.col("n"))).alias("kept"), F.sqrt(F.sum(weight * weight)).alias("norm")
    )
    zero = F.lit(0.0)
    both = sizes.join(kept, "doc_id", "left")
    return both.select("doc_id", "n_words", "n_hashed", F.coalesce("kept", zero).alias("in_vocabulary"), (F.round(F.coalesce("norm", zero), 6) + 0).alias("tfidf_norm"))


@query(
    "ml_scaling",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd, min(c_acctbal) AS lo, max(c_acctbal) AS hi, max(abs(c_acctbal)) AS mx FROM customer)
       SELECT c_custkey, round((c_acctbal - m) / sd, 6) + 0 AS standard, round((c_acctbal - lo) / (hi - lo), 6) + 0 AS min_max, round(c_acctbal / mx, 6) + 0 AS max_abs,
         round(c_acctbal / sqrt(c_acctbal * c_acctbal + c_nationkey * c_nationkey), 6) + 0 AS unit, round(c_acctbal * 0.5, 6) + 0 AS weighted,
         round((c_acctbal + c_nationkey) / sqrt(2), 4) + 0 AS cosine_0, round((c_acctbal - c_nationkey) / sqrt(2), 4) + 0 AS cosine_1,
         round(c_acctbal * c_nationkey, 4) + 0 AS poly_xy FROM customer, s""",
)
def ml_scaling(t: Tables) -> DataFrame:
    """Scalers, norms, products, cosine transform and polynomial terms of (balance, nation)."""
    stages = [
        mf.StandardScaler(inputCol="v", outputCol="standard", withMean=True, withStd=True),
        mf.MinMaxScaler(inputCol="v", outputCol="min_max"),
        mf.MaxAbsScaler(inputCol="v", outputCol="max_abs"),
        mf.Normalizer(inputCol="v", outputCol="unit", p=2.0),
        mf.ElementwiseProduct(inputCol="v", outputCol="weighted", scalingVec=Vectors.dense([0.5, 2.0])),
        mf.DCT(inputCol="v", outputCol="cosine", inverse=False),
        mf.PolynomialExpansion(inputCol="v", outputCol="poly", degree=2),
    ]
    rows = customer_vectors(t)
    scaled = Pipeline(stages=stages).fit(rows).transform(rows)
    return scaled.select(
        "c_custkey",
        *(entry(c, 0).alias(c) for c in ("standard", "min_max", "max_abs", "unit", "weighted")),
        entry("cosine", 0, 4).alias("cosine_0"),
        entry("cosine", 1, 4).alias("cosine_1"),
        entry("poly", 3, 4).alias("poly_xy"),
    )


@query(
    "ml_buckets",
    """SELECT c_custkey, (c_acctbal > 5000)::DOUBLE AS rich, CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE WHEN c_acctbal < 2500 THEN 1.0 WHEN c_acctbal < 7500 THEN 2.0 ELSE 3.0 END AS class,
         round(coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal >= 0)), 4) AS filled FROM customer""",
)
def ml_buckets(t: Tables) -> DataFrame:
    """Threshold, given classes, and missing values set to the mean."""
    rows = t.customer.withColumn("known", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    edges = [-float("inf"), 0.0, 2500.0, 7500.0, float("inf")]
    stages = [
        mf.Binarizer(inputCol="c_acctbal", outputCol="rich", threshold=5000.0),
        mf.Bucketizer(inputCol="c_acctbal", outputCol="class", splits=edges),
        mf.Imputer(inputCols=["known"], outputCols=["filled"], strategy="mean"),
    ]
    cut = Pipeline(stages=stages).fit(rows).transform(rows)
    return cut.select("c_custkey", "rich", "class", F.round("filled", 4).alias("filled"))


@query("ml_quantile_buckets")
def ml_quantile_buckets(t: Tables) -> DataFrame:
    """Five classes of nearly equal size, and gaps filled with the approximate median."""
    rows = t.orders.withColumn("known", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    stages = [
        mf.QuantileDiscretizer(inputCol="o_totalprice", outputCol="fifth", numBuckets=5, relativeError=0.001),
        mf.Imputer(inputCols=["known"], outputCols=["filled"], strategy="median", relativeError=0.001),
    ]
    cut = Pipeline(stages=stages).fit(rows).transform(rows)
    return cut.groupBy("fifth").agg(F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.avg("filled").alias("mean_filled"))


@query(
    "ml_encoding",
    """WITH s AS (SELECT c_mktsegment AS seg, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS idx FROM customer GROUP BY 1)
       SELECT c_custkey, idx::DOUBLE AS idx, c_mktsegment AS back, (idx < 4)::DOUBLE AS ones, (idx = 0)::DOUBLE AS is_first, c_acctbal AS sliced, c_acctbal * 2 AS doubled,
         c_nationkey::DOUBLE AS nation, round(c_acctbal * (idx = 0)::DOUBLE, 4) + 0 AS crossed FROM customer JOIN s ON c_mktsegment = seg""",
)
def ml_encoding(t: Tables) -> DataFrame:
    """Categories as indices and indicator vectors, and vectors put together, cut and crossed."""
    rows = t.customer.withColumn("nation", F.col("c_nationkey").cast("double"))
    stages = [
        mf.StringIndexer(inputCol="c_mktsegment", outputCol="idx", stringOrderType="frequencyDesc"),
        mf.OneHotEncoder(inputCols=["idx"], outputCols=["hot"]),
        mf.VectorAssembler(inputCols=["nation", "c_acctbal", "hot"], outputCol="raw"),
        mf.VectorSizeHint(inputCol="raw", size=6, handleInvalid="error"),
        mf.VectorSlicer(inputCol="raw", outputCol="slice", indices=[1]),
        mf.SQLTransformer(statement="SELECT *, c_acctbal * 2 AS doubled FROM __THIS__"),
        mf.Interaction(inputCols=["c_acctbal", "hot"], outputCol="cross"),
    ]
    model = Pipeline(stages=stages).fit(rows)
    encoded = mf.IndexToString(inputCol="idx", outputCol="back", labels=model.stages[0].labels).transform(model.transform(rows))
    return encoded.select(
        "c_custkey",
        "idx",
        "back",
        F.aggregate(vector_to_array("hot"), F.lit(0.0), lambda s, x: s + x).alias("ones"),
        vector_to_array("hot")[0].alias("is_first"),
        vector_to_array("slice")[0].alias("sliced"),
        "doubled",
        "nation",
        entry("cross", 0, 4).alias("crossed"),
    )


@query(
    "ml_encoding_fitted",
    """WITH n AS (SELECT c_nationkey, row_number() OVER (ORDER BY c_nationkey <> 0, c_nationkey) - 1 AS i FROM (SELECT DISTINCT c_nationkey FROM customer)),
         s AS (SELECT count(DISTINCT c_mktsegment) AS segments FROM customer)
       SELECT c_custkey, 2 + (c_acctbal <> 0)::INT AS hashed_values, i::DOUBLE AS nation_index, CAST(segments AS INT) AS design_width, c_acctbal AS target
       FROM customer JOIN n USING (c_nationkey), s""",
)
def ml_encoding_fitted(t: Tables) -> DataFrame:
    """Encodings by hash, by formula and by counting distinct values."""
    rows = mf.VectorAssembler(inputCols=["c_nationkey", "c_acctbal"], outputCol="raw").transform(t.customer)
    stages = [
        mf.FeatureHasher(inputCols=["c_mktsegment", "c_nationkey", "c_acctbal"], outputCol="hashed", numFeatures=1 << 18, categoricalCols=["c_nationkey"]),
        mf.VectorIndexer(inputCol="raw", outputCol="indexed", maxCategories=25),
        mf.RFormula(formula="c_acctbal ~ c_mktsegment + c_nationkey", featuresCol="design", labelCol="target"),
    ]
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    return encoded.select(
        "c_custkey",
        # The entries that the sparse vector holds: as an array of all 2^18 a row would take 2 MB.
        F.size(F.filter(F.unwrap_udt("hashed")["values"], lambda x: x != 0)).alias("hashed_values"),
        vector_to_array("indexed")[0].alias("nation_index"),
        F.size(vector_to_array("design")).alias("design_width"),
        "target",
    )


@query("ml_selection")
def ml_selection(t: Tables) -> DataFrame:
    """Features kept by a chi-squared test, and the position of each vector on the main axes."""
    vectors = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"), F.col("embedding").cast("array<double>").alias("row"))
    signs = F.transform("row", lambda x: F.when(x > 0, 1.0).otherwise(0.0))
    rows = workspace.stored(vectors.select("vec_id", "label", array_to_vector("row").alias("v"), array_to_vector(signs).alias("signs")), "vectors")
    selector = mf.UnivariateFeatureSelector(featuresCol="signs", outputCol="best", labelCol="label", selectionMode="numTopFeatures")
    selector = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(8).fit(rows)
    axes = mf.PCA(k=3, inputCol="v", outputCol="pca").fit(rows)
    placed = axes.transform(selector.transform(rows))
    return placed.select(
        "vec_id",
        F.size(vector_to_array("best")).alias("n_best"),
        *(vector_to_array("pca")[i].alias(f"axis{i}") for i in range(3)),
        F.lit(float(sum(axes.explainedVariance.toArray()))).alias("explained"),
    )


#: A pair of Jaccard similarity J meets in one of k tables with chance 1 - (1-J)^k: 0.99 at the least similarity asked for, 0.1.
MINHASH_TABLES = 44
#: Buckets meet at 0, so two short vectors part in a table by the angle between them: at worst in half of the tables.
PROJECTION_TABLES = 10


@query("ml_lsh")
def ml_lsh(t: Tables) -> DataFrame:
    """Near neighbours by hashing: texts close to benchmark items, and vectors close to class means.

    One side of each join is a table of distinct items, and exact copies of a text count
    as one text, so a large group of copies is never paired with itself. There are enough tables for the weakest pairs.
    """
    texts = t.documents.groupBy("text").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    items = t.benchmark.filter(r"text rlike '\\S'").groupBy("text").agg(F.min("item_id").alias("id"))
    prepare = Pipeline(
        stages=[
            mf.RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\s+"),
            mf.HashingTF(inputCol="words", outputCol="bag", numFeatures=1 << 16, binary=True),
        ]
    ).fit(items)
    # A text without words has no hash and is near to none. The join reads the hashes in several places: they are made once, and written.
    bags = prepare.transform(texts.filter(r"text rlike '\\S'")).select("id", "copies", "bag")
    minhash = mf.MinHashLSH(inputCol="bag", outputCol="hashes", numHashTables=MINHASH_TABLES, seed=3).fit(bags)
    texts = workspace.stored(minhash.transform(bags), "bags")
    pairs = minhash.approxSimilarityJoin(texts, prepare.transform(items).select("id", "bag"), 0.9, distCol="distance")
    near_texts = pairs.select(
        F.lit("text").alias("kind"), F.col("datasetA.id").alias("id"), F.col("datasetB.id").alias("item"), "distance"
    )
    rows = t.embeddings.select(F.col("vec_id").alias("id"), "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    means = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    means = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("m"))  # 64 entries per class
    means = means.select(F.col("label").cast("bigint").alias("id"), array_to_vector(F.transform("m", lambda e: e["x"])).alias("v"))
    projection = mf.BucketedRandomProjectionLSH(inputCol="v", outputCol="hashes", bucketLength=2.0, numHashTables=PROJECTION_TABLES, seed=3).fit(rows)
    near_means = projection.approxSimilarityJoin(rows, means, 1.0, distCol="distance").select(
        F.lit("vector"), F.col("datasetA.id"), F.col("datasetB.id"), "distance"
    )
    probe = Vectors.dense([0.0] * 64)
    nearest = projection.approxNearestNeighbors(rows, probe, 5, distCol="distance").select(
        F.lit("nearest"), "id", F.lit(None).cast("bigint"), "distance"
    )
    return near_texts.union(near_means).union(nearest)
