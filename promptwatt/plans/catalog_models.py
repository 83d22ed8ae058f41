"""Registered queries of models grown or solved from sums (F1, F2, F4, F6, F7, F9,
F10, A10, E13, E14), with SQL that repeats the fit.

Features and label come from ``measurements``; SQL solves the ridge system by
elimination without pivots and grows the forest level by level.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import forest as FO
from ..operators import isolation as ISO
from ..operators import linear as LN
from ..operators.anomaly import anomaly_features
from ..operators.energy import main_contributors
from ..session import stored
from . import sqlgen as S
from .catalog import register
from .catalog_ml import _IF_COLS, _r, _unit, measurements, with_meas
from .catalog_near import ANOMALY_FEATURES_SQL

COLS = ["token_count", "complexity_score", "avg_word_length", "avg_sentence_length"]
LABEL = "label_b"
PENALTY, PENALTIES, FOLDS = 1.0, LN.drawn_penalties(4), 5
TREES, DEPTH, CANDIDATES, SEED = 8, 4, 4, 42
MIN_SPLIT, MIN_LEAF = 5, 2


def _frame(spark, sf_dir, *more):
    return stored(measurements(spark, sf_dir).select("doc_id", *COLS, LABEL, *more), "measurements")


def _z(c: str, src: str = "") -> str:
    x = f"CAST({src}{c} AS DOUBLE)"
    return f"(CASE WHEN stddev_pop({x}) OVER () > 0 THEN ({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER () ELSE {S.d(0.0)} END)"


# F1 / F9 ------------------------------------------------------------------------
_POLY = [*COLS[:3], *[f"{a}__{b}" for i, a in enumerate(COLS[:3]) for b in COLS[i:3]]]


@register("polynomial_features", with_meas(f"SELECT doc_id, {', '.join(f'{_r(_z(c))} AS {c}' for c in _POLY)} FROM pf", extra=[
    ("pf", f"SELECT doc_id, {', '.join(COLS[:3])}, {', '.join(f'CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS {a}__{b}' for i, a in enumerate(COLS[:3]) for b in COLS[i:3])} FROM m")]))
def polynomial_features(spark, sf_dir):
    wide, names = LN.degree_two(_frame(spark, sf_dir), COLS[:3])
    return LN.scaled(wide, names, ["doc_id"]).select("doc_id", *[T.round_half(F.col(c), 6).alias(c) for c in names])


# Elimination in SQL ---------------------------------------------
_P = len(COLS)
_TERMS = ["1", *[f"x{i}" for i in range(_P)], "y"]
_SCALED = ("lz", f"SELECT doc_id, {', '.join(f'{_z(c)} AS x{i}' for i, c in enumerate(COLS))}, {LABEL} AS y, CAST(floor({_unit('CAST(doc_id AS VARCHAR)', 'fold')} * {FOLDS}) AS INTEGER) AS fold FROM m")
_SUM = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
_SUMS = [(i, j) for i in range(_P + 2) for j in range(i, _P + 2)]


def _system(src: str, penalty: str, keep: str) -> list[tuple[str, str]]:
    """CTEs from the sums of `src` to the solution b0.. and its intercept (c0)."""
    centred = lambda i, j: f"{_SUM(i, j)} - {_SUM(0, i)} * {_SUM(0, j)} / {_SUM(0, 0)}"
    cols = [f"{centred(i + 1, j + 1)}{f' + {penalty}' if i == j else ''} AS a{i}_{j}" for i in range(_P) for j in range(_P)] + [f"{centred(i + 1, _P + 1)} AS b{i}" for i in range(_P)]
    ctes = [("rg0", f"SELECT *, {', '.join(cols)} FROM {src}")]
    for k in range(_P):
        step = [f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i in range(_P) if i != k for j in range(_P)] + [f"b{i} - a{i}_{k} * b{k} / a{k}_{k} AS b{i}" for i in range(_P) if i != k]
        ctes.append((f"rg{k + 1}", f"SELECT * REPLACE ({', '.join(step)}) FROM rg{k}"))
    beta = [f"b{i} / a{i}_{i}" for i in range(_P)]
    free = f"({_SUM(0, _P + 1)} - {' - '.join(f'{_SUM(0, i + 1)} * {b}' for i, b in enumerate(beta))}) / {_SUM(0, 0)}"
    ctes.append(("sol", f"SELECT {keep}, {', '.join(f'{b} AS w{i}' for i, b in enumerate(beta))}, {free} AS w FROM rg{_P}"))
    return ctes


_ALL = ("ls", f"SELECT {', '.join(f'sum({_TERMS[i]} * {_TERMS[j]}) AS {_SUM(i, j)}' for i, j in _SUMS)} FROM lz")
_ABS = " + ".join(f"abs(w{i})" for i in range(_P))


@register("ridge_fit", with_meas(" UNION ALL ".join(
    [f"SELECT {S.s(c)} AS feature, {_r(f'w{i}')} AS coefficient, {_r(f'abs(w{i}) / ({_ABS})')} AS importance FROM sol" for i, c in enumerate(COLS)]
    + [f"SELECT 'intercept', {_r('w')}, NULL FROM sol"]), extra=[_SCALED, _ALL] + _system("ls", S.d(PENALTY), "1 AS one")))
def ridge_fit(spark, sf_dir):
    out = LN.ridge_fit(_frame(spark, sf_dir), COLS, LABEL, PENALTY)
    return out.select("feature", *[T.round_half(F.col(c), 6).alias(c) for c in ("coefficient", "importance")])


_FOLD_SUMS = ("lf", f"SELECT fold, {', '.join(f'sum({_TERMS[i]} * {_TERMS[j]}) AS t{i}_{j}' for i, j in _SUMS)} FROM lz GROUP BY fold")
_TRAIN = ("lt", f"""SELECT lf.*, point, penalty, {', '.join(f'(sum(t{i}_{j}) OVER (PARTITION BY point)) - t{i}_{j} AS {_SUM(i, j)}' for i, j in _SUMS)}
    FROM lf, (VALUES {', '.join(f'({k}, {S.d(p)})' for k, p in enumerate(PENALTIES))}) g(point, penalty)""")
_W = ["-w", *[f"-w{i}" for i in range(_P)], "1"]
_SQUARES = " + ".join(f"({_W[i]}) * ({_W[j]}) * t{min(i, j)}_{max(i, j)}" for i in range(_P + 2) for j in range(_P + 2))
_SCORES = ("sc", f"""SELECT fold, point, penalty, CAST(t0_0 AS BIGINT) AS n, sqrt(greatest(sq, 0) / t0_0) AS rmse,
    1 - sq / (t{_P + 1}_{_P + 1} - t0_{_P + 1} * t0_{_P + 1} / t0_0) AS r2 FROM (SELECT *, {_SQUARES} AS sq FROM sol)""")
_SEARCH = [_SCALED, _FOLD_SUMS, _TRAIN] + _system("lt", "penalty", f"fold, point, penalty, {', '.join(f't{i}_{j}' for i, j in _SUMS)}") + [_SCORES]


def _search(spark, sf_dir):
    return LN.ridge_search(_frame(spark, sf_dir), "doc_id", COLS, LABEL, PENALTIES, FOLDS)


@register("ridge_search", with_meas(f"SELECT fold, point, {_r('penalty')} AS penalty, n, {_r('rmse')} AS rmse, {_r('r2')} AS r2 FROM sc", extra=_SEARCH))
def ridge_search(spark, sf_dir):
    return _search(spark, sf_dir).select("fold", "point", "n", *[T.round_half(F.col(c), 6).alias(c) for c in ("penalty", "rmse", "r2")])


@register("ridge_search_summary", with_meas(f"""SELECT point, {_r('any_value(penalty)')} AS penalty, count(*) AS folds, {_r('avg(r2)')} AS mean_r2,
    {_r('stddev_pop(r2)')} AS std_r2, {_r('avg(rmse)')} AS mean_rmse FROM sc GROUP BY point""", extra=_SEARCH))
def ridge_search_summary(spark, sf_dir):
    out = LN.search_summary(_search(spark, sf_dir))
    return out.select("point", "folds", *[T.round_half(F.col(c), 6).alias(c) for c in ("penalty", "mean_r2", "std_r2", "mean_rmse")])


def _u(key: str) -> str:
    return f"(CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) / {S.d(float(16 ** 13))})"


# A10: the isolation forest grown and walked in SQL -------------------------------------
IF_TREES, IF_SAMPLE = 100, 256


def _path(n: str) -> str:
    """Mean path length of an unsuccessful search among n."""
    return f"(CASE WHEN {n} <= 1 THEN {S.d(0.0)} ELSE 2 * (ln({n} - 1) + {S.d(0.5772156649)}) - 2 * ({n} - 1) / CAST({n} AS DOUBLE) END)"


def isolation_ctes() -> list[tuple[str, str]]:
    p, depth, key = len(_IF_COLS), (IF_SAMPLE - 1).bit_length(), f"tree || ':' || node || ':{SEED}:{{}}'"
    ctes = [("af", ANOMALY_FEATURES_SQL),
            ("ix", f"SELECT doc_id, [{', '.join(S.round_half(_z(c), 6) for c in _IF_COLS)}] AS x FROM af"),
            ("it", f"SELECT doc_id, x, tree, 1 AS node, {_u(f"doc_id || '/' || tree || ':{SEED}:sample'")} AS k FROM ix, (SELECT unnest(range({IF_TREES})) AS tree)"),
            ("im", f"SELECT least({IF_SAMPLE}, count(*)) AS m, CAST(ceil(log2(greatest(2, least({IF_SAMPLE}, count(*))))) AS INTEGER) AS depth FROM ix"),
            ("ia0", "SELECT doc_id, x, tree, node, false AS leaf, r <= m AS bag FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY k, doc_id) AS r FROM it), im")]
    for d in range(depth):
        spans = ", ".join(f"max(x[{i + 1}]) > min(x[{i + 1}]) AS v{i}, min(x[{i + 1}]) AS l{i}, max(x[{i + 1}]) AS h{i}" for i in range(p))
        some = "list_filter([" + ", ".join(f"CASE WHEN v{i} THEN {i} END" for i in range(p)) + "], lambda z: z IS NOT NULL)"
        lo, hi = (f"[{', '.join(f'{side}{i}' for i in range(p))}][f + 1]" for side in "lh")
        ctes += [
            (f"ig{d}", f"SELECT tree, node, count(*) AS n, {spans} FROM ia{d}, im WHERE bag AND NOT leaf AND depth > {d} GROUP BY tree, node"),
            (f"ib{d}", f"""SELECT tree, node, f, {lo} + {_u(key.format('threshold'))} * ({hi} - {lo}) AS thr FROM (
                SELECT *, cand[CAST(floor({_u(key.format('feature'))} * len(cand)) AS INTEGER) + 1] AS f FROM (SELECT *, {some} AS cand FROM ig{d} WHERE n > 1) WHERE len(cand) > 0)"""),
            (f"ia{d + 1}", f"""SELECT a.doc_id, a.x, a.tree, CASE WHEN b.f IS NULL THEN a.node ELSE 2 * a.node + CAST(NOT (a.x[b.f + 1] < b.thr) AS INTEGER) END AS node, b.f IS NULL AS leaf, bag
                FROM ia{d} a LEFT JOIN ib{d} b ON a.tree = b.tree AND a.node = b.node"""),
        ]
    last = f"ia{depth}"
    return ctes + [("il", f"SELECT tree, node, count(*) AS n FROM {last} WHERE bag GROUP BY tree, node"),
                   ("ip", f"SELECT doc_id, avg(floor(log2(node)) + {_path('n')}) AS path FROM {last} JOIN il USING (tree, node) GROUP BY doc_id"),
                   ("isc", f"SELECT doc_id, {_r(f'CASE WHEN {_path('m')} > 0 THEN pow({S.d(2.0)}, -path / {_path('m')}) ELSE {S.d(0.5)} END')} AS if_score FROM ip, im"),
                   ("iq", "SELECT quantile_cont(if_score, 0.9) AS thr FROM isc")]


@register("isolation_forest", with_meas(f"SELECT doc_id, if_score, if_score > thr AS if_anomaly, {_r('thr - if_score')} AS decision_score FROM isc, iq", extra=isolation_ctes()))
def isolation_forest(spark, sf_dir):
    m = anomaly_features(measurements(spark, sf_dir)).select("doc_id", *_IF_COLS)
    out = ISO.detect(m, _IF_COLS, "doc_id", n_trees=IF_TREES, sample=IF_SAMPLE, seed=SEED)
    return out.select("doc_id", "if_score", "if_anomaly", T.round_half(F.col("decision_score"), 6).alias("decision_score"))


# The forest grown in SQL ----------------------------------------
def forest_ctes() -> list[tuple[str, str]]:
    p, key = len(COLS), "tree || ':' || node || ':' || c || ':{}:{}'"
    ctes = [("fx", f"SELECT doc_id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in COLS)}] AS x, {LABEL} AS y FROM m"),
            ("fr", f"SELECT [{', '.join(f'min(x[{i + 1}])' for i in range(p))}] AS lo, [{', '.join(f'max(x[{i + 1}])' for i in range(p))}] AS hi FROM fx"),
            ("fa0", f"""SELECT doc_id, x, y, tree, 1 AS node, false AS leaf, {_u(f"doc_id || '/' || tree || ':{SEED}:bag'")} < {S.d(FO.BAG)} AS bag
                FROM fx, (SELECT unnest(range({TREES})) AS tree)""")]
    for d in range(DEPTH):
        f, t = (_u(key.format(SEED, what)) for what in ("feature", "threshold"))
        gain = S.round_half("sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n", FO.DECIMALS)
        ctes += [
            (f"fc{d}", f"""SELECT tree, node, c, f, lo[f + 1] + {t} * (hi[f + 1] - lo[f + 1]) AS thr FROM (
                SELECT *, CAST(floor({f} * {p}) AS INTEGER) AS f FROM (SELECT DISTINCT tree, node FROM fa{d} WHERE NOT leaf), (SELECT unnest(range({CANDIDATES})) AS c)), fr"""),
            (f"fs{d}", f"""SELECT tree, node, c, f, thr, count(*) AS n, sum(y) AS s, count(*) FILTER (x[f + 1] <= thr) AS nl, sum(y) FILTER (x[f + 1] <= thr) AS sl
                FROM fa{d} JOIN fc{d} USING (tree, node) WHERE bag GROUP BY ALL"""),
            (f"fb{d}", f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, c) AS r FROM (
                SELECT *, {gain} AS gain FROM fs{d} WHERE n >= {MIN_SPLIT} AND nl >= {MIN_LEAF} AND n - nl >= {MIN_LEAF}) WHERE gain > 0) WHERE r = 1"""),
            (f"fa{d + 1}", f"""SELECT doc_id, x, y, a.tree, CASE WHEN b.f IS NULL THEN a.node ELSE 2 * a.node + CAST(x[b.f + 1] > b.thr AS INTEGER) END AS node, b.f IS NULL AS leaf, bag
                FROM fa{d} a LEFT JOIN fb{d} b ON a.tree = b.tree AND a.node = b.node"""),
        ]
    splits = " UNION ALL ".join(f"SELECT tree, node, f, thr, n, s / n AS value, gain FROM fb{d}" for d in range(DEPTH))
    leaves = f"SELECT tree, node, NULL, NULL, count(*), avg(y), NULL FROM fa{DEPTH} WHERE bag GROUP BY tree, node"
    return ctes + [("fn", f"{splits} UNION ALL {leaves}")]


def _forest(frame):
    return FO.grow(frame, "doc_id", COLS, LABEL, trees=TREES, depth=DEPTH, candidates=CANDIDATES, min_split=MIN_SPLIT, min_leaf=MIN_LEAF, seed=SEED)


@register("forest_nodes", with_meas(f"""SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(coalesce(f, -1) AS INTEGER) AS feature, {_r('thr')} AS threshold, n,
    {_r('value')} AS value, {_r('gain', 4)} AS gain FROM fn""", extra=forest_ctes()))
def forest_nodes(spark, sf_dir):
    out = _forest(_frame(spark, sf_dir))
    return out.select("tree", "node", F.coalesce("feature", F.lit(-1)).alias("feature"), T.round_half(F.col("threshold"), 6).alias("threshold"), "n", T.round_half(F.col("value"), 6).alias("value"), T.round_half(F.col("gain"), 4).alias("gain"))


@register("forest_confidence", with_meas(f"""SELECT doc_id, {_r('prediction')} AS prediction, {_r('spread')} AS spread,
    {_r(f'greatest({S.d(0.0)}, least({S.d(1.0)}, 1 - spread / (prediction + {S.d(1e-6)})))')} AS confidence
    FROM (SELECT doc_id, avg(value) AS prediction, stddev_pop(value) AS spread FROM fa{DEPTH} JOIN fn USING (tree, node) GROUP BY doc_id)""", extra=forest_ctes()))
def forest_confidence(spark, sf_dir):
    frame = _frame(spark, sf_dir)
    out = FO.predict(frame, _forest(frame), COLS)
    return out.select("doc_id", *[T.round_half(F.col(c), 6).alias(c) for c in ("prediction", "spread", "confidence")])


_NAMES = "(VALUES " + ", ".join(f"({i}, {S.s(c)})" for i, c in enumerate(COLS)) + ") v(i, feature)"
_IMPORTANCE = ("fi", f"""SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, i) AS INTEGER) AS rank FROM (
    SELECT i, feature, {_r('coalesce(sum(gain) / (SELECT sum(gain) FROM fn), 0)')} AS importance FROM {_NAMES} LEFT JOIN fn ON fn.f = i GROUP BY i, feature)""")


@register("forest_importances", with_meas("SELECT * FROM fi", extra=forest_ctes() + [_IMPORTANCE]))
def forest_importances(spark, sf_dir):
    return FO.importances(_forest(_frame(spark, sf_dir)), COLS)


@register("model_contributors", with_meas("""SELECT doc_id, (SELECT string_agg(feature || '=' || printf('%.6f', importance), ',' ORDER BY feature) FROM fi WHERE rank <= 5) AS contributors
    FROM m""", extra=forest_ctes() + [_IMPORTANCE]))
def model_contributors(spark, sf_dir):
    """E14, the branch of a model with importances."""
    frame = _frame(spark, sf_dir)
    top = {r.feature: r.importance for r in FO.importances(_forest(frame), COLS).collect()}  # a row for each feature
    each = F.transform(F.array_sort(F.map_entries(main_contributors(F.col("token_count"), F.col("complexity_score"), importances=top))),
                       lambda e: F.format_string("%s=%.6f", e["key"], e["value"]))
    return frame.select("doc_id", F.array_join(each, ",").alias("contributors"))
