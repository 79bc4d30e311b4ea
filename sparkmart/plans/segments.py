"""Segmentation and interpretation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.operators import boosting, interpret, rfm, segment
from sparkmart.plans.registry import register
from sparkmart.plans.retail import RFM_CTES
from sparkmart.plans.sqltext import with_fact
from sparkmart.session import reliable_checkpoint
from sparkmart.sources.tables import table, transaction_fact

FEATS = segment.FEATURES


def _profile(spark, sf_dir, fact=None):
    """The customer profile, written once: every query here reads it several
    times (quantile ranking, scaling, joins) and it is small next to the fact."""
    return reliable_checkpoint(rfm.customer_profile(transaction_fact(spark, sf_dir) if fact is None else fact))


def _scaled_cte():
    stats = ",\n".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med_{c}, "
        f"CASE WHEN quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) = 0 "
        f"THEN 1.0 ELSE quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) END "
        f"AS iqr_{c}" for c in FEATS)
    scaled = ", ".join(f"(CAST(p.{c} AS DOUBLE) - s.med_{c}) / s.iqr_{c} AS {c}" for c in FEATS)
    return (RFM_CTES + f",\nrstats AS (SELECT {stats} FROM profile),\n"
            f"scaled AS (SELECT p.CustomerID, {scaled} FROM profile p CROSS JOIN rstats s)")


_SCALED_SQL = with_fact(extra_ctes=_scaled_cte(),
                        body="SELECT CustomerID, " + ", ".join(f"round({c}, 6) AS {c}" for c in FEATS)
                             + " FROM scaled")


@register("robust_scaled_profile", oracle=_SCALED_SQL, covers=("M1", "A14", "J9"))
def robust_scaled_profile(spark, sf_dir):
    return segment.robust_scale(_profile(spark, sf_dir), digits=6, stored=True)


_K1_SQL = with_fact(extra_ctes=_scaled_cte(),
                    body="SELECT round(count(*) * (" + " + ".join(f"var_pop({c})" for c in FEATS)
                         + "), 4) AS inertia FROM scaled")


@register("single_cluster_inertia", oracle=_K1_SQL, covers=("A15",))
def single_cluster_inertia(spark, sf_dir):
    sc = segment.robust_scale(_profile(spark, sf_dir), stored=True)
    return segment.single_cluster_inertia(sc).select(F.round("inertia", 4).alias("inertia"))


_LABEL_SQL = """
WITH conf AS (SELECT CAST(toxic AS DOUBLE) AS y, CAST(quality AS DOUBLE) AS p, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT y AS c FROM conf UNION SELECT p FROM conf),
per AS (
  SELECT c.c,
         coalesce((SELECT sum(n) FROM conf WHERE y = c.c AND p = c.c), 0) AS tp,
         coalesce((SELECT sum(n) FROM conf WHERE y = c.c), 0) AS nt,
         coalesce((SELECT sum(n) FROM conf WHERE p = c.c), 0) AS np
  FROM cls c),
pr AS (SELECT tp, nt, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS prec,
              CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END AS rec FROM per)
SELECT round(avg(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END), 4) AS f1_score_macro,
       round(sum(tp) / sum(nt), 4) AS accuracy, round(avg(prec), 4) AS precision, round(avg(rec), 4) AS recall
FROM pr"""


@register("label_agreement_metrics", oracle=_LABEL_SQL, covers=("A16",))
def label_agreement_metrics(spark, sf_dir):
    """Macro metrics of the quality label read as a predictor of the toxic label."""
    lab = table(spark, sf_dir, "labels")
    return interpret.classification_metrics(lab, "toxic", "quality")


_REPORT_SQL = """
WITH conf AS (SELECT CAST(toxic AS DOUBLE) AS y, CAST(quality AS DOUBLE) AS p, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT y AS c FROM conf UNION SELECT p FROM conf),
per AS (SELECT c.c, coalesce(sum(n) FILTER (y = c.c AND p = c.c), 0) AS tp, coalesce(sum(n) FILTER (y = c.c), 0) AS nt,
               coalesce(sum(n) FILTER (p = c.c), 0) AS np FROM cls c, conf GROUP BY c.c)
SELECT c AS class, round(CASE WHEN np > 0 THEN tp / np ELSE 0.0 END, 4) AS precision, round(CASE WHEN nt > 0 THEN tp / nt ELSE 0.0 END, 4) AS recall,
       round(2 * tp / (nt + np), 4) AS f1_score, CAST(nt AS BIGINT) AS support FROM per"""


@register("label_class_report", oracle=_REPORT_SQL, covers=("M16",))
def label_class_report(spark, sf_dir):
    """Precision, recall, F1 and support by class of the same pair of labels."""
    return interpret.class_report(table(spark, sf_dir, "labels"), "toxic", "quality")


def _segment_scores(spark, sf_dir):
    sc = segment.robust_scale(_profile(spark, sf_dir), stored=True)
    seg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"),
                                                  F.col("c_mktsegment").alias("segment"))
    j = sc.join(seg, "CustomerID")
    long = j.select("segment", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v"))
                                                   for c in FEATS])).alias("fv"))
    return long.groupBy("segment", F.col("fv.feature").alias("feature")).agg(F.avg("fv.v").alias("importance"))


_RANK_SQL = with_fact(extra_ctes=_scaled_cte() + """,
seg AS (SELECT s.*, c.c_mktsegment AS segment FROM scaled s JOIN customer c ON s.CustomerID = c.c_custkey),
long AS (""" + " UNION ALL ".join(f"SELECT segment, '{c}' AS feature, {c} AS v FROM seg" for c in FEATS) + """),
sc AS (SELECT segment, feature, round(avg(v), 4) AS score FROM long GROUP BY 1, 2),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY score DESC, feature) AS INTEGER)
                 AS rank_important FROM sc),
top AS (SELECT * FROM rk WHERE rank_important <= 5),
anom AS (SELECT segment, sum(CASE WHEN score = 0 THEN 1 ELSE 0 END) = 5 AS is_anomaly FROM top GROUP BY 1)""",
                      body="""
SELECT t.segment, t.feature AS important_feature, t.score, t.rank_important, a.is_anomaly
FROM top t JOIN anom a ON t.segment = a.segment""")


@register("segment_feature_ranks", oracle=_RANK_SQL, covers=("M12", "M13", "T3", "W5", "X13"))
def segment_feature_ranks(spark, sf_dir):
    """Top-5 distinguishing features per market segment (mean robust-scaled
    value as the score) with the all-zero anomaly flag."""
    return interpret.top_features(_segment_scores(spark, sf_dir), group_col="segment")


@register("kmeans_inertia_sweep", covers=("M3", "M4", "A15"))
def kmeans_inertia_sweep(spark, sf_dir):
    sc = reliable_checkpoint(segment.robust_scale(_profile(spark, sf_dir), stored=True))
    inertia = segment.inertia_sweep(sc)
    k = segment.find_optimal_k(inertia)
    return spark.createDataFrame([(i + 1, float(v), i + 1 == k) for i, v in enumerate(inertia)],
                                 "k int, inertia double, chosen boolean")


@register("kmeans_centres", covers=("M3",))
def kmeans_centres(spark, sf_dir):
    """The centres of every k of the sweep with their rows and the k's inertia."""
    sc = reliable_checkpoint(segment.robust_scale(_profile(spark, sf_dir), stored=True))
    found = segment.lloyd(sc, range(2, len(FEATS) + 1))
    rows = [(k, i, int(n[i]), inertia, *map(float, c)) for k, (centres, n, inertia) in found.items() for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "k int, cluster int, n bigint, inertia double, " + ", ".join(f"{c} double" for c in FEATS))


@register("customer_segments", covers=("M1", "M3", "M4", "M5"))
def customer_segments(spark, sf_dir):
    prof = _profile(spark, sf_dir)
    out, _, _, _ = segment.segment_customers(prof, stored=True)
    return out


def labelled_customers(spark, sf_dir, fact=None):
    """The profile with its k-means cluster, written once."""
    return reliable_checkpoint(segment.segment_customers(_profile(spark, sf_dir, fact), stored=True)[0])


@register("cluster_importance", covers=("M7", "M8", "M9", "M11", "M12", "M13"))
def cluster_importance(spark, sf_dir):
    """The interpreter of the published search (10 draws, 10 folds) and its clusters' top features."""
    return interpret.interpret_clusters(labelled_customers(spark, sf_dir), n_draws=10, folds=10, n_repeats=5)["top"]


# The published interpreter's parameters.
PUBLISHED = boosting.Params(rounds=200, rate=0.5, depth=6, leaves=63)


@register("feature_importance", covers=("M8", "M11", "M17"))
def feature_importance(spark, sf_dir):
    """50 repeats of permutation importance, of all customers and by cluster, for boosted
    trees of the published parameters."""
    labelled = labelled_customers(spark, sf_dir)
    train, _ = interpret.holdout_split(labelled)
    model = boosting.fit(train, list(FEATS), interpret.LABEL, segment.KEY, PUBLISHED, True)
    whole = interpret.permutation_importance(model, labelled, FEATS, group_col=None, n_repeats=50)
    each = interpret.permutation_importance(model, labelled, FEATS, n_repeats=50)
    return whole.select(F.lit("all").alias("scope"), "feature", "importance").unionByName(
        each.select(F.col("cluster").cast("int").cast("string").alias("scope"), "feature", "importance"))


_GAIN_BINS, _GAIN_ROWS = 32, 20
_GAIN_SQL = with_fact(extra_ctes=RFM_CTES + """,
lab AS (SELECT p.*, CASE c.c_mktsegment """ + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(
    ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))) + """ END AS y FROM profile p JOIN customer c ON p.CustomerID = c.c_custkey),
k AS (SELECT count(DISTINCT y) AS k FROM lab),
long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, y FROM lab" for c in FEATS) + f"""),
run AS (SELECT *, (count(*) OVER (PARTITION BY feature ORDER BY v) - 1) * {_GAIN_BINS} // count(*) OVER (PARTITION BY feature) AS r FROM long),
edge AS (SELECT feature, r, max(v) AS upper, max(max(r)) OVER (PARTITION BY feature) AS last FROM run GROUP BY feature, r),
cls AS (SELECT DISTINCT y AS class FROM lab),
side AS (SELECT e.feature, e.upper, c.class, count(*) FILTER (v <= upper) AS nl, count(*) AS n,
                count(*) FILTER (v <= upper AND y = class) AS yl, count(*) FILTER (y = class) AS yn
         FROM edge e JOIN long l ON l.feature = e.feature JOIN cls c ON TRUE WHERE e.r < e.last GROUP BY ALL),
sums AS (SELECT *, nl / k.k - yl AS gl, n / k.k - yn AS g, nl * (1 / k.k) * (1 - 1 / k.k) AS hl, n * (1 / k.k) * (1 - 1 / k.k) AS h FROM side, k)""",
    body=f"""SELECT CAST(class AS DOUBLE) AS class, feature, upper, nl AS left_rows,
       round(gl * gl / hl + (g - gl) * (g - gl) / (h - hl) - g * g / h, 4) AS gain
FROM sums WHERE least(nl, n - nl) >= {_GAIN_ROWS}""")


@register("root_split_gains", oracle=_GAIN_SQL, covers=("M8", "M16"))
def root_split_gains(spark, sf_dir):
    """The gain of every possible first split of the boosted trees of the market segments."""
    code = F.array_position(F.array(*map(F.lit, ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])), F.col("c_mktsegment")) - 1
    seg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), code.alias("label"))
    data = boosting.binned(_profile(spark, sf_dir).join(seg, "CustomerID"), list(FEATS), "label", segment.KEY, True, bins=_GAIN_BINS)
    return boosting.root_gains(data, list(FEATS), boosting.Params(min_rows=_GAIN_ROWS)).withColumn("gain", F.round("gain", 4))


@register("silhouette_scores", covers=("M6",))
def silhouette_scores(spark, sf_dir):
    sc = reliable_checkpoint(segment.robust_scale(_profile(spark, sf_dir), stored=True))
    return spark.createDataFrame(segment.silhouette(sc), "k int, silhouette double")


_SIL_SQL = with_fact(extra_ctes=_scaled_cte() + """,
lab AS (SELECT s.*, c.c_mktsegment AS segment, """ + " + ".join(f"{c} * {c}" for c in FEATS) + """ AS sq
        FROM scaled s JOIN customer c ON s.CustomerID = c.c_custkey),
st AS (SELECT segment AS other, count(*) AS n, avg(sq) AS msq, """ + ", ".join(f"avg({c}) AS mu_{c}" for c in FEATS) + """ FROM lab GROUP BY segment),
d AS (SELECT CustomerID, segment, other, n, sq + msq - 2 * (""" + " + ".join(f"{c} * mu_{c}" for c in FEATS) + """) AS d FROM lab, st),
ab AS (SELECT CustomerID, segment, max(CASE WHEN other = segment AND n > 1 THEN d * n / (n - 1) END) AS a,
              min(CASE WHEN other <> segment THEN d END) AS b FROM d GROUP BY 1, 2)""",
    body="SELECT CustomerID, segment, round(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette FROM ab")


@register("segment_silhouette", oracle=_SIL_SQL, covers=("M6",))
def segment_silhouette(spark, sf_dir):
    """Silhouette of every customer in its market segment, squared Euclidean in closed form."""
    sc = segment.robust_scale(_profile(spark, sf_dir), stored=True)
    seg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"), F.col("c_mktsegment").alias("segment"))
    return segment.silhouette_per_sample(sc.join(seg, "CustomerID"), "segment").withColumn("silhouette", F.round("silhouette", 6))


@register("surrogate_models", covers=("M15", "M16", "M9"))
def surrogate_models(spark, sf_dir):
    """Tree and boosted surrogates of the customer clusters, 10 draws on 5 folds each, with their reports."""
    return interpret.surrogate_report(labelled_customers(spark, sf_dir))
