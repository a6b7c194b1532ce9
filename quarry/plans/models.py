"""Registered queries: features and models.

All model keys share one prepared frame and fit each model once per session
(``Lab``): the prepared rows are written as a table in the shared checkpoint
folder (lineage cut, survives lost executors) and fitted models and
out-of-fold predictions are kept for the other keys.

The "default" forest has 100 trees of full depth, as the reference's
(``ml.forest``).  The Shapley attribution explains that forest as far as it has
grown at depth 12, as exact values cost rows times leaves and a full tree has about
as many leaves as rows; the README states it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.ml import attribute as at
from quarry.ml import features as mf
from quarry.ml import linear as li
from quarry.ml import models as mm
from quarry.ml import scenario as sc
from quarry.ml import stack as sk
from quarry.ml import validate as va
from quarry.ml.forest import GrownRandomForest, RandomForest
from quarry.ml.truncate import Grid
from quarry.plans import fixtures as fx
from quarry.plans.registry import query
from quarry.session import scratch_path

EXPLAINED_DEPTH = 12
#: The reference's axes: number of trees, depth, least rows to split.
GRID = Grid((50, 100, 150), (4, 6, 8), (2, 5, 10))
WHAT_IF_COLUMN, WHAT_IF_VALUES = "l_quantity", [1.0, 25.0, 50.0]

_LABS: dict = {}


class Lab:
    """Prepared model data and fitted models for one input folder."""

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        t = fx.Tables(spark, sf_dir)
        feat = fx.feat(t)
        self.levels = mf.category_levels(feat, fx.FEAT_TEXT)
        self.wide = mf.one_hot_drop_first(feat, fx.FEAT_TEXT, self.levels)
        self.names = fx.FEAT_NUMERIC + mf.dummy_columns(self.levels, fx.FEAT_TEXT)
        data = mf.assemble(self.wide, self.names, fx.FEAT_TARGET, keep=["row_id"])
        data = mf.fold_column(mf.split_column(data, "row_id"), "row_id")
        path = scratch_path(spark, "model_data")
        data.write.parquet(path)
        self.data = spark.read.parquet(path)
        self.train = self.data.filter(F.col("split") == "train")
        self.test = self.data.filter(F.col("split") == "test")
        self._models: dict = {}
        self._oof = None

    def linear(self):
        """The full least-squares fit and those without a fold, from one scan."""
        if "_linear" not in self._models:
            self._models["_linear"] = li.fold_fits(self.train)
        return self._models["_linear"]

    def estimators(self) -> dict:
        return {
            "random_forest": mm.Unlimited(RandomForest()),
            "gradient_boosting": mm.Spread(mm.gradient_boosting()),
        }

    def model(self, name: str):
        if name not in self._models:
            if name == "stacking_ensemble":
                self._models[name] = self.stacked()
            elif name == "linear_regression":
                self._models[name] = self.linear()[0]
            elif name == "tuned_forest":
                self._models[name] = self.grid()[1]
            elif name == "explained_forest":
                self._models[name] = self.estimators()["random_forest"].to_depth(EXPLAINED_DEPTH).fit(self.train)
            else:
                self._models[name] = self.estimators()[name].fit(self.train)
        return self._models[name]

    def oof(self):
        """Out-of-fold predictions of the three base models (shared by CV and
        stacking: both use the same five folds), written once."""
        if self._oof is None:
            path = scratch_path(self.spark, "oof")
            va.oof_predictions(self.estimators(), self.train,
                               fitted={"linear_regression": self.linear()[1]}).write.parquet(path)
            self._oof = self.spark.read.parquet(path)
        return self._oof

    def stacked(self):
        fitted = {n: self.model(n) for n in ["linear_regression", *self.estimators()]}
        return sk.fit_stacking(fitted, self.train, alpha=1.0, oof=self.oof(), fitted=fitted)

    def grid(self):
        """The scores of all candidates and the best one's refit model."""
        if "_grid" not in self._models:
            rf = mm.random_forest(num_trees=max(GRID.trees)).setMaxMemoryInMB(1024)
            rf = mm.keep_node_ids(rf, self.train.count())
            self._models["_grid"] = va.grid_search(rf, GRID, self.train)
        return self._models["_grid"]

    def explained(self):
        """What is attributed: the default forest, of a grown one its first levels."""
        forest = self._models.get("random_forest", GrownRandomForest)
        grown = forest is GrownRandomForest or isinstance(forest, GrownRandomForest)
        return self.model("explained_forest") if grown else forest

    def shap(self):
        if "_shap" not in self._models:
            path = scratch_path(self.spark, "shap")
            at.tree_shap(self.train, self.explained()).write.parquet(path)
            self._models["_shap"] = at.shap_long(self.spark.read.parquet(path), self.names)
        return self._models["_shap"]


def lab(spark, sf_dir: str) -> Lab:
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _LABS:
        _LABS[k] = Lab(spark, sf_dir)
    return _LABS[k]


# ------------------------------------------------------------ features ------

_LEVELS = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"],
           "p_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}


@query("one_hot_drop_first", sql="SELECT l_orderkey, l_linenumber, " + ", ".join(fx.FEAT_NUMERIC) + ", "
       + fx.FEAT_TARGET + ", " + ", ".join(
           f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for c, lv in _LEVELS.items() for v in lv[1:])
       + " FROM lineitem JOIN part ON l_partkey = p_partkey")
def one_hot_drop_first(spark, sf_dir):
    """M1: get_dummies(drop_first=True), wide form, on lineitem x part."""
    t = fx.Tables(spark, sf_dir)
    l, p = t("lineitem"), t("part")
    base = l.join(p, l.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", *fx.FEAT_NUMERIC, *fx.FEAT_TEXT, fx.FEAT_TARGET)
    return mf.one_hot_drop_first(base, fx.FEAT_TEXT)


_SPARSE_TEXT = [*fx.FEAT_TEXT, "p_brand", "p_name"]


@query("one_hot_sparse", sql="WITH base AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),\nv AS ("
       + " UNION ALL ".join(f"SELECT DISTINCT {i} AS c, {c} AS value FROM base WHERE {c} IS NOT NULL"
                            for i, c in enumerate(_SPARSE_TEXT)) + """),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY value) AS in_column FROM v),
d AS (SELECT c, value, CAST(row_number() OVER (ORDER BY c, value) - 1 AS INTEGER) AS feature_index,
             CAST(count(*) OVER () AS INTEGER) AS size FROM r WHERE in_column > 1)
""" + " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, size, feature_index FROM base JOIN d ON c = {i} AND value = {c}"
    for i, c in enumerate(_SPARSE_TEXT)))
def one_hot_sparse(spark, sf_dir):
    """M1 as sparse vectors on lineitem x part, names and brands included; one row
    per entry of a vector that is not zero."""
    t = fx.Tables(spark, sf_dir)
    l, p = t("lineitem"), t("part")
    base = l.join(p, l.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", "l_partkey", *_SPARSE_TEXT)
    v = mf.one_hot_sparse(base, _SPARSE_TEXT).withColumn("v", F.unwrap_udt("features"))
    return v.select("l_orderkey", "l_linenumber", "l_partkey", F.col("v.size").alias("size"),
                    F.explode("v.indices").alias("feature_index"))


@query("assemble_features")
def assemble_features(spark, sf_dir):
    """M2: row key, feature vector, label."""
    return lab(spark, sf_dir).data.select("row_id", "features", "label")


def _drawn_sql(seed: int, n: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || row_id), 1, 8))::BIGINT % {n}"


#: FEAT with its row key, split and fold, in SQL.
_FEAT_SQL = f"""feat AS (SELECT *, CASE WHEN {_drawn_sql(42, 100)} < 20 THEN 'test' ELSE 'train' END AS split,
         ({_drawn_sql(7, 5)})::INT AS fold
  FROM (SELECT l_orderkey, l_linenumber, {", ".join([*fx.FEAT_NUMERIC, *fx.FEAT_TEXT, fx.FEAT_TARGET])},
               row_number() OVER (ORDER BY l_orderkey, l_linenumber,
                   {", ".join([*fx.FEAT_NUMERIC, *fx.FEAT_TEXT, fx.FEAT_TARGET])}) AS row_id
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""


@query("train_test_split", sql=f"WITH {_FEAT_SQL} SELECT row_id, split, fold FROM feat")
def train_test_split(spark, sf_dir):
    """M3: hashed 80/20 split and 5 folds on the training part."""
    return lab(spark, sf_dir).data.select("row_id", "split", "fold")


# ------------------------------------------------------------ models --------

def _ols_sql() -> str:
    """Gauss-Jordan elimination of the centred normal equations."""
    dummies = [(f"{c}_{v}", f"({c} = '{v}')::INT") for c, lv in _LEVELS.items() for v in lv[1:]]
    columns = [*[(c, c) for c in fx.FEAT_NUMERIC], *dummies, ("y", fx.FEAT_TARGET)]
    values = ", ".join(f"({e})::DOUBLE" for _, e in columns)
    p = len(columns) - 1
    return f"""
WITH RECURSIVE {_FEAT_SQL},
z AS (SELECT row_id, unnest([{values}]) AS v, unnest(range(1, {p + 2})) AS i FROM feat WHERE split = 'train'),
mean AS (SELECT i, avg(v) AS m FROM z GROUP BY i),
d AS MATERIALIZED (SELECT row_id, i, v - m AS v FROM z JOIN mean USING (i)),
s AS (SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM d a JOIN d b USING (row_id) WHERE a.i <= {p} GROUP BY ALL),
r AS (SELECT i, list(v ORDER BY j) AS row FROM s GROUP BY i),
g(k, m) AS (SELECT 0, list(row ORDER BY i) FROM r UNION ALL
  SELECT k + 1, list_transform(m, lambda row, i: CASE WHEN i = k + 1 THEN list_transform(row, lambda x: x / row[k + 1])
      ELSE list_transform(row, lambda x, j: x - row[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM g WHERE k < {p}),
w AS (SELECT unnest(range(1, {p + 1})) AS i, unnest(list_transform(m, lambda row: row[{p + 1}])) AS c FROM g WHERE k = {p}),
f AS (SELECT {[n for n, _ in columns[:-1]]}[i] AS feature, c AS coefficient FROM w UNION ALL
  SELECT '(intercept)', (SELECT m FROM mean WHERE i = {p + 1}) - (SELECT sum(c * m) FROM w JOIN mean USING (i)))
SELECT feature, round(coefficient, 4) AS coefficient FROM f"""


@query("ols_regression", sql=_ols_sql())
def ols_regression(spark, sf_dir):
    """M4: OLS coefficients."""
    lb = lab(spark, sf_dir)
    return mm.coefficients(spark, lb.model("linear_regression"), lb.names).withColumn(
        "coefficient", F.round("coefficient", 4))


def _test_predictions(spark, sf_dir, name):
    lb = lab(spark, sf_dir)
    return lb.model(name).transform(lb.test).select("row_id", "label", "prediction")


@query("random_forest")
def random_forest(spark, sf_dir):
    """M5: forest predictions on the test rows."""
    return _test_predictions(spark, sf_dir, "random_forest")


@query("gradient_boosting")
def gradient_boosting(spark, sf_dir):
    """M6: boosting predictions on the test rows."""
    return _test_predictions(spark, sf_dir, "gradient_boosting")


@query("cross_validate")
def cross_validate(spark, sf_dir):
    """M7: 5-fold R^2 and MAE per model and fold, with the means."""
    from quarry.operators.stats import metric_mean, regression_metrics

    per_fold = regression_metrics(lab(spark, sf_dir).oof(), "label", "prediction", by=["model", "fold"])
    return per_fold.join(metric_mean(per_fold, by=["model"]), "model")


def _importances(spark, sf_dir):
    lb = lab(spark, sf_dir)
    return mm.importances(spark, lb.model("random_forest"), lb.names)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """M8: top 10 impurity importances of the forest."""
    return mm.top_importances(_importances(spark, sf_dir), 10)


@query("prune_candidates")
def prune_candidates(spark, sf_dir):
    """M9: features with importance below 0.01."""
    return mm.prune_candidates(_importances(spark, sf_dir), 0.01)


@query("stacking_ensemble")
def stacking_ensemble(spark, sf_dir):
    """Ridge over out-of-fold base predictions; test predictions."""
    return _test_predictions(spark, sf_dir, "stacking_ensemble")


@query("compare_models")
def compare_models(spark, sf_dir):
    """Test R^2 and MAE of the four models, each fitted once."""
    lb = lab(spark, sf_dir)
    names = ["linear_regression", "random_forest", "gradient_boosting", "stacking_ensemble"]
    return sk.compare_models({n: lb.model(n) for n in names}, lb.test)


# ------------------------------------------------------------ attribution ---

@query("tree_attribution")
def tree_attribution(spark, sf_dir):
    """Shapley value of every feature for every training row."""
    return lab(spark, sf_dir).shap()


@query("attribution_summary")
def attribution_summary(spark, sf_dir):
    """Per-feature spread of Shapley values, ranked by mean |phi|."""
    return at.attribution_summary(lab(spark, sf_dir).shap())


@query("attribution_row")
def attribution_row(spark, sf_dir):
    """Base value and contributions of the first training row."""
    lb = lab(spark, sf_dir)
    first = lb.train.select(F.min("row_id")).scalar()
    one = at.tree_shap(lb.train.filter(F.col("row_id") == first), lb.explained())
    return at.attribution_row(at.shap_long(one, lb.names), first)


# ------------------------------------------------------------ tuning --------

@query("grid_search")
def grid_search(spark, sf_dir):
    """3x3x3 grid, 5 folds, R^2; the best is flagged."""
    return lab(spark, sf_dir).grid()[0]


@query("overfit_gap")
def overfit_gap(spark, sf_dir):
    """train/test R^2 and their gap before and after tuning."""
    lb = lab(spark, sf_dir)
    models = {"before_tuning": lb.model("random_forest"), "after_tuning": lb.model("tuned_forest")}
    return va.overfit_gap(models, lb.train, lb.test)


@query("what_if_scoring")
def what_if_scoring(spark, sf_dir):
    """Every row re-scored by the tuned forest with l_quantity set to each
    scenario value."""
    lb = lab(spark, sf_dir)
    return sc.what_if(lb.model("tuned_forest"), lb.wide, lb.names, WHAT_IF_COLUMN, WHAT_IF_VALUES)
