"""Features, neighbours, class balance, evaluation and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.models import network, search, training
from tablework.models.group_mean import GroupMeanRegressor
from tablework.models.network import Network, NetworkClassifier, training_rows
from tablework.models.stacks import NeighborRegressor, ResidualStackRegressor, fit_blend, on_columns, out_of_fold
from tablework.operators import evaluate, features
from tablework.operators.counts import category_widths
from tablework.operators.mapping import first_columns
from tablework.operators.neighbors import knn_predict, nearest
from tablework.operators.position import rolling_mean as moving_mean
from tablework.operators.resample import oversample, oversample_and_clean
from tablework.plans.registry import Tables, query
from tablework.session import pin, scratch

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LANGS = ("en", "de", "fr", "es")

# Features of the labelled documents, in SQL for the answers below and as columns for the queries.
FEATURES_SQL = r"""SELECT doc_id, n_chars, len(regexp_extract_all(text, '\n')) + 1 AS n_lines,
      len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[0-9]')) AS n_digits,
      len(regexp_extract_all(text, '[.,;:!?]')) AS n_marks,
      CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 4 END AS lang_code, quality, toxic
    FROM documents JOIN labels USING (doc_id)"""
MEASURED_SQL = FEATURES_SQL.replace(", quality, toxic", ", source").replace(" JOIN labels USING (doc_id)", "")
NUMERIC = ["n_chars", "n_lines", "n_upper", "n_digits", "n_marks"]


def measured(t: Tables) -> DataFrame:
    """The features of all documents."""

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    lang = F.array_position(F.array(*[F.lit(x) for x in LANGS]), F.col("lang"))
    return t.documents.select(
        "doc_id", "source", "n_chars", (count(r"\n") + 1).alias("n_lines"), count("[A-Z]").alias("n_upper"),
        count("[0-9]").alias("n_digits"), count("[.,;:!?]").alias("n_marks"),
        F.when(lang > 0, lang - 1).otherwise(len(LANGS)).cast("int").alias("lang_code"),
    )


def labelled(t: Tables) -> DataFrame:
    """Labelled documents with their features, stored once for the many passes of training. Features are measured before
    the join, so that no text is shuffled."""
    labels = t.labels.select("doc_id", "quality", "toxic")
    return pin(measured(t).drop("source").join(labels, "doc_id"), "labelled")


@query("""
    SELECT c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total, count(*) AS n,
           CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean,
           (SELECT count(DISTINCT c_nationkey) FROM customer) AS n_groups
    FROM customer GROUP BY 1""")
def group_mean(t: Tables) -> DataFrame:
    balances = t.customer.select("c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
    means = features.group_mean(balances, "c_nationkey", "c_acctbal")
    n_groups = balances.agg(F.countDistinct("c_nationkey").alias("n")).scalar()
    return means.withColumn("n_groups", n_groups)


@query("""
    WITH train AS (SELECT * FROM customer WHERE c_nationkey <> 7),
    m AS (SELECT c_nationkey, avg(c_acctbal) AS a FROM train GROUP BY 1)
    SELECT c_custkey, round(coalesce(a, (SELECT avg(c_acctbal) FROM train)), 4) AS prediction
    FROM customer LEFT JOIN m USING (c_nationkey)""")
def group_mean_predict(t: Tables) -> DataFrame:
    """Balances by nation, trained without one nation, predicted for all customers."""
    model = GroupMeanRegressor(groupCol="c_nationkey", labelCol="c_acctbal").fit(t.customer.filter("c_nationkey <> 7"))
    return model.transform(t.customer).select("c_custkey", F.round("prediction", 4).alias("prediction"))


@query("""
    SELECT quality, count(*) AS n, 'doc_id' AS feature_columns FROM labels GROUP BY 1""")
def class_balance(t: Tables) -> DataFrame:
    """Rows per label; all columns before the labels are features."""
    names = ",".join(first_columns(t.labels, 1))
    return t.labels.groupBy("quality").agg(F.count("*").alias("n")).withColumn("feature_columns", F.lit(names))


@query("""
    SELECT event_id, CASE WHEN count(v) OVER w = 1000 THEN round(avg(v) OVER w, 6) END AS mean
    FROM (SELECT *, CASE WHEN event_id % 4000 <> 17 THEN value END AS v FROM events)
    WINDOW w AS (ORDER BY ts, event_id ROWS 999 PRECEDING)""")
def rolling_mean(t: Tables) -> DataFrame:
    """A window with a missing value has no mean."""
    value = F.when(F.col("event_id") % 4000 != 17, F.col("value").cast("decimal(18,4)"))
    values = t.events.select("event_id", "ts", value.alias("value"))
    means = moving_mean(values, ["ts", "event_id"], "value", 1000, "mean")
    return means.select("event_id", F.round("mean", 6).alias("mean"))


def _scale_sql(c: str) -> str:
    return f"round(({c} - (SELECT avg({c}) FROM part)) / (SELECT stddev_pop({c}) FROM part), 6)"


@query(f"""
    SELECT p_partkey, {_scale_sql('p_size')} AS p_size_scaled, {_scale_sql('p_retailprice')} AS p_retailprice_scaled,
           0.0::DOUBLE AS constant_scaled FROM part""")
def standard_scale(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_size", "p_retailprice", F.lit(3).alias("constant"))
    scaled = features.standard_scale(parts, ["p_size", "p_retailprice", "constant"])
    return scaled.select(
        "p_partkey", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in ("p_size", "p_retailprice", "constant")]
    )


@query(f"SELECT {_scale_sql('p_retailprice')} AS p_retailprice, p_partkey, p_size FROM part")
def column_transform(t: Tables) -> DataFrame:
    out = features.scale_selected(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_retailprice"])
    return out.withColumn("p_retailprice", F.round("p_retailprice", 6))


@query("""
    SELECT user_id, """ + ", ".join(
    f"max(CAST(event_type = '{e}' AS INTEGER)) AS {e}" for e in EVENT_TYPES) + " FROM events GROUP BY 1")
def multi_hot(t: Tables) -> DataFrame:
    return features.multi_hot(t.events, "user_id", "event_type", features.vocabulary(t.events, "event_type"))


@query("""
    WITH n AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS i FROM (SELECT DISTINCT l_partkey AS p FROM lineitem)),
    o AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
    SELECT l_orderkey, (SELECT count(*) FROM n) AS size, string_agg(i::VARCHAR, ',' ORDER BY i) AS indices, count(*)::INTEGER AS n_set
    FROM o JOIN n ON p = l_partkey GROUP BY 1""")
def sparse_indicators(t: Tables) -> DataFrame:
    """Which parts an order has, as a sparse row over all parts that were ever ordered."""
    rows = features.sparse_indicators(t.lineitem, "l_orderkey", "l_partkey")
    return rows.select("l_orderkey", "size", F.array_join("indices", ",").alias("indices"), F.size("indices").alias("n_set"))


@query("""
    SELECT c AS column_name, n AS n_values, CAST(least(600, round(1.6 * pow(n, 0.56))) AS INTEGER) AS width FROM (
      SELECT 'p_brand' AS c, count(DISTINCT p_brand) AS n FROM part
      UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
      UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part
      UNION ALL SELECT 'p_partkey', count(DISTINCT p_partkey) FROM part)""")
def category_width(t: Tables) -> DataFrame:
    return category_widths(t.part, ["p_brand", "p_type", "p_size", "p_partkey"])


@query("""
    WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
    r AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id
      ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.vec_id) AS r FROM e a, e b)
    SELECT vec_id, avg(label) AS prediction FROM r WHERE r <= 5 GROUP BY 1""")
def knn_regress(t: Tables) -> DataFrame:
    points = t.embeddings.select(
        "vec_id", F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"), "label"
    )
    near = nearest(points.drop("label"), points, id_col="vec_id", features=["x", "y"], k=5, carry=["label"])
    return knn_predict(near, ["vec_id"], "label")


@query("""
    WITH w AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
    d AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
    x AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1) AS w
          FROM c JOIN d USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""")
def tfidf(t: Tables) -> DataFrame:
    weights = features.tfidf(t.documents.select("doc_id", "text"), "doc_id", "text")
    return weights.withColumn("weight", F.round("weight", 6))


@query("""
    SELECT o_orderkey, CAST('0x' || substr(md5('43:' || o_orderkey), 1, 8) AS BIGINT) % 100 < 67 AS is_train FROM orders""")
def train_test_split(t: Tables) -> DataFrame:
    return features.split_train_test(t.orders.select("o_orderkey"), ["o_orderkey"])


def _ruled(t: Tables) -> DataFrame:
    """Quality label against a rule: long texts are good."""
    return t.documents.join(t.labels, "doc_id").select(
        "quality", (F.col("n_chars") >= 600).cast("int").alias("predicted")
    )


RULED_SQL = "SELECT quality, CAST(n_chars >= 600 AS INTEGER) AS predicted FROM documents JOIN labels USING (doc_id)"


@query(f"""
    WITH p AS ({RULED_SQL})
    SELECT round(1 - sum((quality - predicted) ** 2) / (var_pop(quality) * count(*)), 6) AS r2 FROM p""")
def r2(t: Tables) -> DataFrame:
    return evaluate.r2(_ruled(t), "quality", "predicted").withColumn("r2", F.round("r2", 6))


@query(f"""
    WITH p AS ({RULED_SQL})
    SELECT round(avg(CAST(quality = predicted AS INTEGER)), 6) AS accuracy,
           CAST(round(100 * avg(CAST(quality = predicted AS INTEGER))) AS INTEGER) AS percent FROM p""")
def accuracy(t: Tables) -> DataFrame:
    return evaluate.accuracy(_ruled(t), "quality", "predicted").withColumn("accuracy", F.round("accuracy", 6))


@query(f"""
    WITH p AS ({RULED_SQL})
    SELECT a AS actual, b AS predicted, (SELECT count(*) FROM p WHERE quality = a AND predicted = b) AS n
    FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, b)""")
def confusion(t: Tables) -> DataFrame:
    return evaluate.confusion(_ruled(t), "quality", "predicted")


@query(f"""
    WITH p AS ({RULED_SQL}),
    c AS (SELECT k, count(*) FILTER (quality = k AND predicted = k) AS tp, count(*) FILTER (predicted = k) AS said,
          count(*) FILTER (quality = k) AS support FROM p, (VALUES (0), (1)) v(k) GROUP BY k),
    s AS (SELECT k, support, coalesce(tp / nullif(said, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r FROM c),
    f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM s),
    a AS (SELECT avg(CAST(quality = predicted AS INTEGER)) AS acc, count(*) AS n FROM p)
    SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
      SELECT CAST(k AS VARCHAR) AS name, p AS precision, r AS recall, f AS f1, support FROM f
      UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM a
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM f
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f)""")
def classification_report(t: Tables) -> DataFrame:
    rows = evaluate.classification_report(_ruled(t), "quality", "predicted")
    return rows.select("name", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("""
    WITH s AS (SELECT covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS v, avg(l_quantity) AS mx,
               avg(l_extendedprice) AS my, count(*) AS n FROM lineitem)
    SELECT round(c / (v + 10.0 / n), 3) AS slope, round(my - c / (v + 10.0 / n) * mx, 3) AS intercept FROM s""")
def ridge(t: Tables) -> DataFrame:
    """Line price on quantity with penalty 10; one feature, so that the closed form can check the solver."""
    lines = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        t.lineitem.select("l_quantity", "l_extendedprice")
    )
    model = training.ridge(lines, "l_extendedprice", 10.0)
    fitted = F.lit(float(model.coefficients[0])), F.lit(float(model.intercept))
    return t.spark.range(1).select(F.round(fitted[0], 3).alias("slope"), F.round(fitted[1], 3).alias("intercept"))


def _smote_sql(numeric: list[str], seed: int, categorical: str | None) -> str:
    """Synthetic rows by all pairs of minority rows, as an independent answer."""

    def h(*parts: str) -> str:
        text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
        return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"

    distance = " + ".join(f"(CAST(a.{c} AS DOUBLE) - b.{c}) * (CAST(a.{c} AS DOUBLE) - b.{c})" for c in numeric)
    spreads = ", ".join(f"(SELECT stddev_pop({c}) FROM m)" for c in numeric)
    if categorical:
        distance += f" + CASE WHEN a.{categorical} <> b.{categorical} THEN (SELECT penalty FROM pen) ELSE 0 END"
    cat_col = f", {categorical}" if categorical else ""
    cat_syn = f", g.{categorical}" if categorical else ""
    cat_join = f"""JOIN (SELECT doc_id, {categorical} FROM (SELECT doc_id, n_{categorical} AS {categorical}, row_number()
        OVER (PARTITION BY doc_id ORDER BY count(*) DESC, n_{categorical}) AS o FROM nb
        GROUP BY doc_id, n_{categorical}) WHERE o = 1) g
        ON g.doc_id = c.doc_id""" if categorical else ""
    cat_nb = f", b.{categorical} AS n_{categorical}" if categorical else ""
    return f"""
    f AS ({FEATURES_SQL}), m AS (SELECT * FROM f WHERE quality = 0),
    pen AS (SELECT median(s) * median(s) / 2 AS penalty FROM (SELECT unnest([{spreads}]) AS s)),
    sizes AS (SELECT count(*) FILTER (quality = 1) - count(*) FILTER (quality = 0) AS missing,
      count(*) FILTER (quality = 0) AS small FROM f),
    nb AS (SELECT * FROM (SELECT a.doc_id, {', '.join(f'b.{c} AS n_{c}' for c in numeric)}{cat_nb}, row_number() OVER (
      PARTITION BY a.doc_id ORDER BY {distance}, b.doc_id) AS r FROM m a, m b WHERE a.doc_id <> b.doc_id) WHERE r <= 5),
    placed AS (SELECT *, row_number() OVER (ORDER BY {h(str(seed), 'doc_id')}, doc_id) - 1 AS pos FROM m),
    copies AS (SELECT * EXCLUDE (pos), unnest(generate_series(1, CAST(missing // small
      + CASE WHEN pos < missing % small THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM placed, sizes),
    c AS (SELECT *, {h(str(seed), 'doc_id', 'copy')} % 5 + 1 AS pick,
      {h(str(seed), "'gap'", 'doc_id', 'copy')} / 4294967296.0 AS gap FROM copies),
    grown AS (SELECT doc_id, 0 AS copy, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in numeric)}{cat_col},
        quality, false AS synthetic FROM f
      UNION ALL SELECT c.doc_id, CAST(copy AS INTEGER),
        {', '.join(f'c.{x} + CAST(gap AS DOUBLE) * (n_{x} - c.{x})' for x in numeric)}{cat_syn}, 0, true
      FROM c JOIN nb ON nb.doc_id = c.doc_id AND nb.r = c.pick {cat_join})"""


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


SMOTE_NUMERIC = ["n_chars", "n_upper", "n_marks"]
SMOTE_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in SMOTE_NUMERIC)


@query(f"""
    WITH {_smote_sql(SMOTE_NUMERIC, 42, 'lang_code')}
    SELECT doc_id, copy, {SMOTE_ROUNDED}, lang_code, quality, synthetic FROM grown""")
def smote_nc(t: Tables) -> DataFrame:
    """Labelled documents with the poor ones grown to the number of good ones, language as a category."""
    grown = oversample(labelled(t), id_col="doc_id", label="quality", numeric=SMOTE_NUMERIC, categorical=["lang_code"])
    return _rounded(grown, SMOTE_NUMERIC)


_ENN_DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMOTE_NUMERIC)


@query(f"""
    WITH {_smote_sql(SMOTE_NUMERIC, 0, None)},
    k AS (SELECT *, doc_id || ':' || copy AS id FROM grown),
    near AS (SELECT a.id, b.quality <> a.quality AS differs, row_number() OVER (PARTITION BY a.id
      ORDER BY {_ENN_DISTANCE}, b.id) AS r FROM k a, k b WHERE a.id <> b.id)
    SELECT doc_id, copy, {SMOTE_ROUNDED}, quality, synthetic FROM k
    WHERE id NOT IN (SELECT id FROM near WHERE r <= 3 AND differs)""")
def smote_enn(t: Tables) -> DataFrame:
    """Labelled documents grown to equal classes, then without those whose neighbours disagree."""
    cleaned = oversample_and_clean(labelled(t), id_col="doc_id", label="quality", numeric=SMOTE_NUMERIC)
    return _rounded(cleaned, SMOTE_NUMERIC)


def _vectors(df: DataFrame, scaled: list[str], passthrough: list[str]) -> DataFrame:
    out = df
    for stage in training.feature_stages(scaled, passthrough):
        out = (stage.fit(out) if hasattr(stage, "fit") else stage).transform(out)
    return out


def _split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Split before anything is resampled or fitted, so that no test row leaks into training."""
    marked = features.split_train_test(df, [key])
    return marked.filter("is_train").drop("is_train"), marked.filter("not is_train").drop("is_train")


@query(f"""
    WITH f AS ({FEATURES_SQL}),
    x AS (SELECT n_chars::DOUBLE AS x, n_upper::DOUBLE AS y, CAST('0x' || substr(md5('7:' || doc_id), 1, 8) AS BIGINT) % 4 AS fold FROM f),
    p AS (SELECT unnest([0.0::DOUBLE, 1e9::DOUBLE]) AS penalty), k AS (SELECT unnest([0, 1, 2, 3]) AS fold),
    fit AS (SELECT k.fold, penalty, covar_pop(y, x) / (var_pop(x) + penalty / stddev_pop(y)) AS slope, avg(x) AS mx, avg(y) AS my
            FROM x, k, p WHERE x.fold <> k.fold GROUP BY k.fold, penalty),
    score AS (SELECT fold, penalty, 1 - sum((y - my - slope * (x - mx)) ** 2) / (var_pop(y) * count(*)) AS r2
              FROM x JOIN fit USING (fold) GROUP BY fold, penalty)
    SELECT penalty, round(avg(r2), 6) AS r2, round(stddev_pop(r2), 6) AS spread FROM score GROUP BY penalty""")
def cross_validate(t: Tables) -> DataFrame:
    """R2 of two penalties of a line through lengths and capitals, in four folds."""
    rows = VectorAssembler(inputCols=["n_chars"], outputCol="features").transform(labelled(t))
    estimator = training.line("n_upper")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.0, 1e9]).build()
    model = training.cross_validate(rows, estimator, grid, training.r2_evaluator("n_upper"), ["doc_id"])
    scores = [
        (float(p[estimator.regParam]), float(m), float(s)) for p, m, s in zip(grid, model.avgMetrics, model.stdMetrics)
    ]
    found = t.spark.createDataFrame(scores, "penalty double, r2 double, spread double")
    return found.select("penalty", F.round("r2", 6).alias("r2"), F.round("spread", 6).alias("spread"))


SEARCHED, PENALTIES = ["n_chars", "n_marks", "n_digits"], [0.0, 1e4, 1e6, 1e8, 1e10]


def _penalty_sql() -> str:
    """Three normal equations solved by determinants, scored row by row."""
    x = dict(zip(SEARCHED, "pqr"))
    n, moments = "count(*)", []
    for i, a in enumerate(SEARCHED):
        moments += [f"{n} * covar_pop(x.{a}, x.{b}) AS {x[a]}{x[b]}" for b in SEARCHED[i:]]
        moments += [f"{n} * covar_pop(x.{a}, n_upper) AS {x[a]}y", f"avg(x.{a}) AS m{x[a]}"]
    return f"""
    WITH x AS (SELECT *, CAST('0x' || substr(md5('7:' || doc_id), 1, 8) AS BIGINT) % 4 AS fold FROM ({FEATURES_SQL})),
    k AS (SELECT unnest([0, 1, 2, 3]) AS held), l AS (SELECT unnest({PENALTIES}::DOUBLE[]) AS penalty),
    m AS (SELECT held, avg(n_upper) AS my, {', '.join(moments)} FROM x, k WHERE fold <> held GROUP BY held),
    s AS (SELECT held, penalty, mp, mq, mr, my, pp + penalty AS a, pq AS b, pr AS c, qq + penalty AS d, qr AS e,
                 rr + penalty AS f, py AS g, qy AS h, ry AS i FROM m, l),
    w AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM s),
    fit AS (SELECT held, penalty, mp, mq, mr, my, (g * (d * f - e * e) - b * (h * f - e * i) + c * (h * e - d * i)) / det AS p,
                   (a * (h * f - e * i) - g * (b * f - c * e) + c * (b * i - h * c)) / det AS q,
                   (a * (d * i - h * e) - b * (b * i - h * c) + g * (b * e - d * c)) / det AS r FROM w)
    SELECT penalty, held::INTEGER AS fold, round(1 - sum((n_upper - my - p * (n_chars - mp) - q * (n_marks - mq) - r * (n_digits - mr)) ** 2)
             / (var_pop(n_upper) * count(*)), 6) AS r2
    FROM fit JOIN x ON fold = held GROUP BY penalty, held"""


@query(_penalty_sql())
def penalty_search(t: Tables) -> DataFrame:
    """R2 of ridge regressions with three features by penalty and held-out fold, all from one aggregate."""
    scores = search.penalty_search(labelled(t), SEARCHED, "n_upper", PENALTIES, ["doc_id"])
    return scores.withColumn("r2", F.round("r2", 6))


@query("""
    WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
    r AS (SELECT a.vec_id, a.label, b.label AS near, row_number() OVER (PARTITION BY a.vec_id
      ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.vec_id) AS r FROM e a, e b WHERE a.vec_id <> b.vec_id),
    k AS (SELECT unnest([1, 2, 5, 10, 20]) AS k),
    p AS (SELECT k, vec_id, any_value(label) AS label, avg(near) AS p FROM r, k WHERE r <= k GROUP BY k, vec_id)
    SELECT k, count(*) AS n, round(1 - sum((label - p) ** 2) / (var_pop(label) * count(*)), 6) AS r2 FROM p GROUP BY k""")
def k_search(t: Tables) -> DataFrame:
    """R2 by number of neighbours, each point predicted from the others, by one search."""
    points = t.embeddings.select(
        "vec_id", F.get("embedding", F.lit(0)).alias("x"), F.get("embedding", F.lit(1)).alias("y"), "label")
    scores = search.k_search(points, ["x", "y"], "label", [1, 2, 5, 10, 20], "vec_id")
    return scores.withColumn("r2", F.round("r2", 6))


def _order_features(t: Tables) -> DataFrame:
    """Order price with what its lines say about it, stored once."""
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_lines"), F.sum("l_extendedprice").alias("gross"), F.avg("l_discount").alias("discount"),
        F.avg("l_quantity").alias("quantity"),
    )
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), F.month("o_orderdate").alias("month"))
    return pin(orders.join(per_order, "o_orderkey"), "order-features")


@query("""
    WITH g AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
    r AS (SELECT o_orderkey, o_totalprice AS price, n,
                 CAST('0x' || substr(md5('43:' || o_orderkey), 1, 8) AS BIGINT) % 100 < 67 AS is_train
          FROM orders JOIN g ON o_orderkey = l_orderkey),
    m AS (SELECT regr_slope(price, n) AS a, regr_intercept(price, n) AS b FROM r WHERE is_train)
    SELECT o_orderkey, price, round(a * n + b, 2) AS linear, TRUE AS is_sum, TRUE AS is_near FROM r, m WHERE NOT is_train""")
def residual_stack(t: Tables) -> DataFrame:
    """Hold-out predictions of a line corrected by boosted trees: the line itself, whether the prediction is the sum of
    both parts, and whether the hold-out R2 stays within 0.1 of the line's or above; the prices here follow no feature."""
    assembler = VectorAssembler(inputCols=["n_lines"], outputCol="base").transform(_order_features(t))
    rows = VectorAssembler(inputCols=["n_lines", "gross", "discount", "quantity", "month"], outputCol="features").transform(assembler)
    train, test = _split(rows, "o_orderkey")
    predicted = pin(training.residual_stack(train, "price", linear="base").transform(test).drop("base", "features"), "stacked")
    after, before = (evaluate.r2(predicted, "price", c).first()["r2"] for c in ("prediction", "linear"))
    is_sum = F.abs(F.col("prediction") - F.col("linear") - F.col("correction")) < 1e-6
    return predicted.select(
        "o_orderkey", "price", F.round("linear", 2).alias("linear"), is_sum.alias("is_sum"), F.lit(after >= before - 0.1).alias("is_near"))


_IS_TRAIN = "CAST('0x' || substr(md5('43:' || doc_id), 1, 8) AS BIGINT) % 100 < 67"


@query(f"""
    WITH x AS (SELECT *, {_IS_TRAIN} AS is_train FROM ({MEASURED_SQL})),
    m AS (SELECT covar_pop(n_chars, n_chars) AS a, covar_pop(n_chars, n_marks) AS b, covar_pop(n_marks, n_marks) AS d,
                 covar_pop(n_chars, n_upper) AS g, covar_pop(n_marks, n_upper) AS h, avg(n_chars) AS mp, avg(n_marks) AS mq,
                 avg(n_upper) AS my FROM x WHERE is_train)
    SELECT doc_id, n_upper::INTEGER AS n_upper, TRUE AS is_sum, TRUE AS is_not_below, round(my + (g * d - b * h) / (a * d - b * b) * (n_chars - mp)
             + (a * h - b * g) / (a * d - b * b) * (n_marks - mq), 3) AS linear
    FROM x, m WHERE NOT is_train""")
def stack_documents(t: Tables) -> DataFrame:
    """Capitals of held-out documents by a stack: its linear part on two features, whether the prediction is the sum of both
    parts, and whether trees on all features bring the hold-out R2 at least to that of the linear part."""
    base = VectorAssembler(inputCols=["n_chars", "n_marks"], outputCol="base").transform(pin(measured(t), "measured"))
    rows = VectorAssembler(inputCols=BLENDED, outputCol="features").transform(base)
    train, test = _split(rows, "doc_id")
    stack = ResidualStackRegressor(linearCol="base", labelCol="n_upper").fit(train)
    predicted = pin(stack.transform(test).drop("base", "features"), "stacked")
    scores = evaluate.r2(predicted, "n_upper", "prediction").crossJoin(
        evaluate.r2(predicted, "n_upper", "linear").toDF("before")).first()
    is_sum = F.abs(F.col("prediction") - F.col("linear") - F.col("correction")) < 1e-6
    return predicted.select(
        "doc_id", "n_upper", is_sum.alias("is_sum"), F.lit(scores["r2"] >= scores["before"]).alias("is_not_below"),
        F.round("linear", 3).alias("linear"))


BLENDED = ["n_chars", "n_marks", "n_lines", "n_digits"]


@query(f"""
    WITH x AS (SELECT *, CAST('0x' || substr(md5('7:' || doc_id), 1, 8) AS BIGINT) % 4 AS fold FROM ({MEASURED_SQL}) WHERE {_IS_TRAIN}),
    k AS (SELECT unnest([0, 1, 2, 3]) AS held),
    g AS (SELECT held, source, avg(n_upper) AS p FROM x, k WHERE fold <> held GROUP BY ALL),
    o AS (SELECT held, avg(n_upper) AS p, regr_slope(n_upper, n_marks) AS a, regr_intercept(n_upper, n_marks) AS b
          FROM x, k WHERE fold <> held GROUP BY ALL),
    near AS (SELECT a.doc_id, b.n_upper, row_number() OVER (PARTITION BY a.doc_id ORDER BY
               (a.n_chars - b.n_chars) * (a.n_chars - b.n_chars) + (a.n_marks - b.n_marks) * (a.n_marks - b.n_marks), b.doc_id) AS r
             FROM x a JOIN x b ON a.fold <> b.fold),
    n AS (SELECT doc_id, avg(n_upper) AS p FROM near WHERE r <= 5 GROUP BY 1),
    p AS (SELECT x.n_upper AS y, coalesce(g.p, o.p) AS source_mean, a * n_marks + b AS line, n.p AS neighbours
          FROM x JOIN o ON o.held = fold LEFT JOIN g ON g.held = fold AND g.source = x.source JOIN n ON n.doc_id = x.doc_id)
    SELECT part, round(1 - CASE part WHEN 'source_mean' THEN sum((y - source_mean) ** 2) WHEN 'line' THEN sum((y - line) ** 2)
             WHEN 'neighbours' THEN sum((y - neighbours) ** 2) END / (var_pop(y) * count(*)), 6) AS r2, TRUE AS is_better
    FROM p, (SELECT unnest(['source_mean', 'line', 'neighbours', 'forest', 'linear blend', 'forest blend']) AS part) GROUP BY part""")
def blend(t: Tables) -> DataFrame:
    """Capitals of documents by four models: R2 of each one's out-of-fold predictions where SQL can tell it; and for blends
    over these predictions whether they are better on held-out documents than the mean of the four models."""
    train, test = _split(pin(measured(t), "measured"), "doc_id")
    forest = {"labelCol": "n_upper", "numTrees": 10, "maxDepth": 5, "seed": 1}
    parts = {
        "source_mean": GroupMeanRegressor(groupCol="source", labelCol="n_upper", predictionCol="source_mean"),
        "line": on_columns(["n_marks"], "line", LinearRegression(
            featuresCol="line_features", labelCol="n_upper", predictionCol="line", solver="normal")),
        "neighbours": NeighborRegressor(
            inputCols=["n_chars", "n_marks"], labelCol="n_upper", predictionCol="neighbours", idCol="doc_id"),
        "forest": on_columns(BLENDED, "forest", RandomForestRegressor(featuresCol="forest_features", predictionCol="forest", **forest)),
    }
    predicted = out_of_fold(train, parts, ["doc_id"])
    rows = [(name, evaluate.r2(predicted, "n_upper", name).first()["r2"] if name != "forest" else None, True) for name in parts]
    blends = {
        "linear blend": LinearRegression(featuresCol="blend_features", labelCol="n_upper"),
        "forest blend": RandomForestRegressor(featuresCol="blend_features", **forest),
    }
    # both blends stand on the same parts, which are fitted once
    fitted = fit_blend(train, predicted, parts, blends["linear blend"])
    tested = pin(fitted.transform(test).drop("line_features", "forest_features", "prediction"), "parts")
    mean = sum((F.col(c) for c in parts), F.lit(0.0)) / len(parts)
    before = evaluate.r2(tested.withColumn("mean", mean), "n_upper", "mean").first()["r2"]
    assembled = fitted.stages[-2].transform(predicted)
    for name, last in (("linear blend", fitted.stages[-1]), ("forest blend", blends["forest blend"].fit(assembled))):
        after = evaluate.r2(last.transform(tested), "n_upper", "prediction").first()["r2"]
        rows.append((name, None, after >= before))
    found = t.spark.createDataFrame(rows, "part string, r2 double, is_better boolean")
    return found.withColumn("r2", F.round("r2", 6))


# the two networks, by their hidden units
NETWORKS = {
    "128-128": {"hidden": [128, 128], "rate": 0.01, "dropout": 0.2, "epochs": 40, "batch": 128},
    "64-64": {"hidden": [64, 64], "rate": 0.001, "dropout": 0.1, "epochs": 50, "batch": 64, "adam": True},
}
SHARES = ["mark_share", "upper_share"]


def _with_shares(df: DataFrame) -> DataFrame:
    """Marks and capitals by character; a text without characters has none."""
    shares = {"mark_share": F.try_divide("n_marks", "n_chars"), "upper_share": F.try_divide("n_upper", "n_chars")}
    return df.withColumns({name: F.coalesce(share, F.lit(0.0)) for name, share in shares.items()})


def _network_stages() -> list:
    """Numbers scaled, and the language as indicators."""
    stages, encoded = training.category_stages(["lang_code"])
    return [*stages, *training.feature_stages([*NUMERIC, *SHARES], encoded)]


TEST_SQL = f"""SELECT * FROM ({FEATURES_SQL}) WHERE CAST('0x' || substr(md5('43:' || doc_id), 1, 8) AS BIGINT) % 100 >= 67"""


@query(f"""
    WITH test AS ({TEST_SQL}),
    n AS (SELECT CAST(quality AS VARCHAR) AS name, count(*) AS support FROM test GROUP BY 1
          UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), count(*) FROM test)
    SELECT network, rows, name, support, TRUE AS is_better FROM n,
      (VALUES ('128-128', 'all'), ('64-64', 'all'), ('128-128', 'balanced')) v(network, rows)""")
def mlp_classify(t: Tables) -> DataFrame:
    """Reports of stored networks on held-out documents, and whether each is better than always naming the larger class:
    in accuracy if it learned from all rows, in mean recall if it learned from balanced ones."""
    train, test = _split(_with_shares(labelled(t)), "doc_id")
    grown = pin(
        oversample(train, id_col="doc_id", label="quality", numeric=[*NUMERIC, *SHARES], categorical=["lang_code"]), "balanced"
    )
    out = []
    for name, rows in (("128-128", "all"), ("64-64", "all"), ("128-128", "balanced")):
        net = NetworkClassifier(labelCol="quality", **NETWORKS[name])
        model = training.train_and_store(train if rows == "all" else grown, [*_network_stages(), net], scratch(t.spark, "network"))
        report = {r["name"]: r for r in evaluate.classification_report(model.transform(test), "quality", "prediction").collect()}
        largest = max(report[c]["support"] for c in ("0", "1"))
        if rows == "all":
            better = report["accuracy"]["precision"] * report["accuracy"]["support"] >= largest
        else:
            better = report["macro avg"]["recall"] > 0.5
        out += [(name, rows, r["name"], r["support"], better) for r in report.values()]
    return t.spark.createDataFrame(out, "network string, rows string, name string, support long, is_better boolean")


def _fold_rows(t: Tables) -> DataFrame:
    """Network inputs of the labelled documents with their fold, stored."""
    rows = features.folds(_with_shares(labelled(t)), ["doc_id"], 4)
    for stage in _network_stages():
        rows = (stage.fit(rows) if hasattr(stage, "fit") else stage).transform(rows)
    return training_rows(rows, "features", "quality", "fold")


def _n_inputs(rows: DataFrame) -> int:
    return len(rows.select("x").first()["x"])


FOLDS_SQL = f"SELECT CAST('0x' || substr(md5('7:' || doc_id), 1, 8) AS BIGINT) % 4 AS fold FROM ({FEATURES_SQL})"


@query(f"""
    WITH f AS ({FOLDS_SQL}), n AS (SELECT fold::INTEGER AS fold, count(*) AS n_held FROM f GROUP BY 1)
    SELECT rate, dropout, fold, (SELECT count(*) FROM f) - n_held AS n_train, n_held, TRUE AS is_scored, TRUE AS is_mean,
           4::BIGINT AS n_folds, 1::BIGINT AS n_best
    FROM n, (SELECT unnest([0.01::DOUBLE, 0.001::DOUBLE]) AS rate), (SELECT unnest([0.2::DOUBLE, 0.5::DOUBLE]) AS dropout)""")
def grid_search(t: Tables) -> DataFrame:
    """Two rates by two dropout shares in four folds: rows of each fold, whether each accuracy is a share of the held-out
    rows, whether the mean is that of the network's folds, and how many networks come first."""
    rows = _fold_rows(t)
    inputs = _n_inputs(rows)
    networks = [Network(inputs, (128, 128), rate, dropout) for rate in (0.01, 0.001) for dropout in (0.2, 0.5)]
    scores = network.fold_scores(t.spark, network.cross_validate(rows, networks, epochs=40))
    hits = F.col("accuracy") * F.col("n_held")
    own, all_rows = Window.partitionBy("rate", "dropout"), Window.partitionBy()  # sixteen rows
    return scores.select(
        "rate", "dropout", "fold", "n_train", "n_held",
        (F.col("accuracy").between(0, 1) & (F.abs(hits - F.round(hits)) < 1e-6)).alias("is_scored"),
        (F.abs(F.avg("accuracy").over(own) - F.col("mean_accuracy")) < 1e-9).alias("is_mean"),
        F.count("*").over(own).alias("n_folds"),
        (F.sum((F.col("place") == 1).cast("long")).over(all_rows) / F.count("*").over(own)).cast("long").alias("n_best"))


@query(f"""
    WITH f AS ({FOLDS_SQL})
    SELECT fold::INTEGER AS fold, epoch::INTEGER AS epoch, TRUE AS is_finite, TRUE AS has_fallen
    FROM (SELECT DISTINCT fold FROM f), (SELECT unnest(generate_series(1, 40)) AS epoch)""")
def loss_history(t: Tables) -> DataFrame:
    """Loss on training and on held-out rows, by fold and epoch: whether both are finite, and whether the fold's last are
    not above its first."""
    rows = _fold_rows(t)
    found = network.cross_validate(rows, [Network(_n_inputs(rows), (128, 128), 0.01, 0.2)], epochs=40)
    losses = network.epoch_losses(t.spark, found)
    own = Window.partitionBy("fold").orderBy("epoch").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fallen = [F.last(c).over(own) <= F.first(c).over(own) for c in ("train_loss", "held_loss")]
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("train_loss", "held_loss")]
    return losses.select(
        "fold", "epoch", (finite[0] & finite[1]).alias("is_finite"), (fallen[0] & fallen[1]).alias("has_fallen"))


@query(f"""
    SELECT doc_id, n_upper::INTEGER AS n_upper, round(regr_intercept(n_upper, n_chars) OVER () + regr_slope(n_upper, n_chars) OVER () * n_chars, 4)
      AS prediction, round(avg(n_upper) OVER (PARTITION BY lang_code), 4) AS lang_mean, TRUE AS is_sum, TRUE AS is_not_below
    FROM ({FEATURES_SQL})""")
def batch_score(t: Tables) -> DataFrame:
    """A stored pipeline, loaded again and applied to a stream of all labelled documents: a line, the mean by language, and
    a stack on all numbers and the language, whose linear part is not below the line on the rows both were fitted on."""
    rows = labelled(t)
    path, folder, out = (scratch(t.spark, x) for x in ("model", "arriving", "scored"))
    rows.write.parquet(folder)
    coded, encoded = training.category_stages(["lang_code"])
    stack = ResidualStackRegressor(
        featuresCol="all", linearCol="all", labelCol="n_upper", predictionCol="stacked", trees=5, depth=3)
    training.train_and_store(rows, [
        *training.feature_stages(["n_chars"]), training.line("n_upper"),
        GroupMeanRegressor(groupCol="lang_code", labelCol="n_upper", predictionCol="lang_mean"), *coded,
        VectorAssembler(inputCols=[*BLENDED, *encoded], outputCol="all"), stack], path)
    arriving = t.spark.readStream.schema(rows.schema).parquet(folder)
    scored, _ = training.score(PipelineModel.load(path), arriving, BLENDED)
    wanted = scored.select("doc_id", "n_upper", "prediction", "lang_mean", "linear", "correction", "stacked")
    wanted.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(t.spark, "scoring")).trigger(
        availableNow=True).start().awaitTermination()
    scored = t.spark.read.schema(wanted.schema).parquet(out)
    errors = [F.sum((F.col("n_upper") - F.col(c)) ** 2).alias(c) for c in ("linear", "prediction")]
    error = scored.agg(*errors).first()
    return scored.select(
        "doc_id", "n_upper", F.round("prediction", 4).alias("prediction"), F.round("lang_mean", 4).alias("lang_mean"),
        (F.abs(F.col("stacked") - F.col("linear") - F.col("correction")) < 1e-6).alias("is_sum"),
        F.lit(error["linear"] <= error["prediction"] * (1 + 1e-9)).alias("is_not_below"))
