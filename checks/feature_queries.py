"""Golden features, intervals, enrichment and valuation, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.price_queries import _SURVIVE, _bag_sql
from checks.registry import register
from checks.silver_queries import ROW, TS, c
from checks.views import AS_OF, cte, view
from tasador import schemas
from tasador.operators import enrich as E
from tasador.operators import features as X
from tasador.operators import intervals as I
from tasador.operators.valuation import CONDITION_OLD, CONDITION_YOUNG, RESIDUAL_PERCENT, residual_value
from tasador.plans import golden as G
from tasador.plans.silver import stamp

# The test data has few categories: a rare one needs a higher threshold than the default.
PERCENT = 4.0


def _listing(spark, sf_dir):
    return view(spark, sf_dir, "listing")


_SHORT = """bm AS (SELECT "Brand" || '_' || "Model" AS k, CAST(count(*) AS DOUBLE) AS n FROM listing WHERE "Brand" IS NOT NULL AND "Model" IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(n) AS t FROM bm), sh AS (SELECT k, 1.0 / (n / t) AS s FROM bm, tot)"""


@register(
    "ftr_shortage",
    f"""{cte('listing')}, {_SHORT} SELECT l_orderkey, l_linenumber, round(s, 6) AS shortage FROM listing LEFT JOIN sh ON "Brand" || '_' || "Model" = k""",
)
def ftr_shortage(spark, sf_dir):
    return X.scarcity(_listing(spark, sf_dir)).select(*ROW, F.round("Shortage", 6).alias("shortage"))


def simple(name, where, fn):
    @register(name, f"{cte('listing')} SELECT l_orderkey, l_linenumber FROM listing WHERE {where}")
    def query(spark, sf_dir):
        return fn(_listing(spark, sf_dir)).select(*ROW)


_VALID = "\"CV\" IS NOT NULL AND \"Segment\" IS NOT NULL AND \"Web\" NOT IN ('COMPRAMOSTUCOCHE.ES', 'CICAR')"
_RECENT = f"floor(epoch({TS} - \"Publication\") / 86400) <= 365"
simple("ftr_nonempty", 'length("Features") > 0 AND "Sale" IS NOT NULL', lambda df: X.described(df).dropna(subset=["Sale"]))
simple("ftr_valid", _VALID, X.valid)
simple("ftr_recent", _RECENT, lambda df: X.recent(df, stamp(AS_OF)))
simple("ftr_bounds", '"Age" < 20 AND "Kms" < 300000 AND "CV" <= 650', X.in_bounds)


@register(
    "ftr_other_fuel",
    f"""{cte('listing')} SELECT l_orderkey, l_linenumber, CASE WHEN "Fuel" IN ('GASOLINA', 'DIESEL') THEN "Fuel" ELSE 'OtroFuel' END AS fuel FROM listing""",
)
def ftr_other_fuel(spark, sf_dir):
    return _listing(spark, sf_dir).select(*ROW, X.other_fuel(c("Fuel")).alias("fuel"))


def _dense(x):
    return f"replace(replace({x}, '-', ''), ' ', '')"


@register("ftr_strip", f"""{cte('listing')} SELECT l_orderkey, l_linenumber, {_dense('"Brand"')} AS brand, {_dense('"Model"')} AS model FROM listing""")
def ftr_strip(spark, sf_dir):
    return _listing(spark, sf_dir).select(*ROW, X.dense(c("Brand")).alias("brand"), X.dense(c("Model")).alias("model"))


def _share(col, source):
    return f"""(SELECT {col} AS v, 100.0E0 * count(*) / (SELECT count(*) FROM {source}) AS p FROM {source} WHERE {col} IS NOT NULL GROUP BY 1)"""


@register(
    "ftr_group_rare",
    f"""{cte('listing')}, s AS {_share('"Segment"', 'listing')}, b AS {_share('"Brand"', 'listing')}
    SELECT l_orderkey, l_linenumber, CASE WHEN s.p < {PERCENT} THEN 'OtroSegmento' ELSE "Segment" END AS segment,
      CASE WHEN b.p < {PERCENT} THEN 'OTROS' ELSE "Brand" END AS brand
    FROM listing LEFT JOIN s ON "Segment" = s.v LEFT JOIN b ON "Brand" = b.v""",
)
def ftr_group_rare(spark, sf_dir):
    df = X.group_rare(_listing(spark, sf_dir), {"Segment": X.OTHER_SEGMENT, "Brand": X.OTHER_BRAND}, PERCENT)
    return df.select(*ROW, c("Segment").alias("segment"), c("Brand").alias("brand"))


@register(
    "ftr_drop_rare",
    f"""{cte('listing')}, b AS {_share('"Brand"', 'listing')} SELECT l_orderkey, l_linenumber, "Brand" AS brand FROM listing JOIN b ON "Brand" = b.v WHERE b.p > {PERCENT}""",
)
def ftr_drop_rare(spark, sf_dir):
    return X.drop_rare(_listing(spark, sf_dir), "Brand", PERCENT).select(*ROW, c("Brand").alias("brand"))


_FEATURES = ", ".join(f'"{n}"' for n in schemas.GOLDEN_FEATURES)


@register("ftr_distinct", f"{cte('golden')} SELECT DISTINCT {_FEATURES} FROM golden")
def ftr_distinct(spark, sf_dir):
    return X.distinct_features(view(spark, sf_dir, "golden"))


_GOLDEN_SQL = f"""{_SURVIVE}, {_SHORT},
g0 AS (SELECT l.* REPLACE ({_dense('l."Brand"')} AS "Brand", {_dense('l."Model"')} AS "Model",
    CASE WHEN l."Fuel" IN ('GASOLINA', 'DIESEL') THEN l."Fuel" ELSE 'OtroFuel' END AS "Fuel"), round(sh.s, 6) AS "Shortage", round(md."PriceMed", 6) AS "PriceMed"
  FROM listing l LEFT JOIN sh ON l."Brand" || '_' || l."Model" = sh.k JOIN si s ON l."Brand" IS NOT DISTINCT FROM s."Brand"
    AND l."Model" IS NOT DISTINCT FROM s."Model" AND l."CV" IS NOT DISTINCT FROM s."CV" AND l."Fuel" IS NOT DISTINCT FROM s."Fuel"
    AND l."Registration" = s."Registration" AND array_to_string({_bag_sql("coalesce(l.\"Features\", '')")}, ' ') = s."Bag" JOIN md ON md.sid = s.sid
  WHERE length(l."Features") > 0 AND l."Sale" IS NOT NULL AND l."CV" IS NOT NULL AND l."Segment" IS NOT NULL
    AND l."Web" NOT IN ('COMPRAMOSTUCOCHE.ES', 'CICAR') AND {_RECENT.replace('"Publication"', 'l."Publication"')}),
gs AS {_share('"Segment"', 'g0')}, gb AS {_share('"Brand"', 'g0')},
g1 AS (SELECT g0.* REPLACE (CASE WHEN gs.p < {PERCENT} THEN 'OtroSegmento' ELSE "Segment" END AS "Segment",
    CASE WHEN gb.p < {PERCENT} THEN 'OTROS' ELSE "Brand" END AS "Brand") FROM g0 LEFT JOIN gs ON "Segment" = gs.v LEFT JOIN gb ON "Brand" = gb.v)
SELECT DISTINCT {_FEATURES} FROM g1 WHERE "Age" >= 0 AND "Age" < 20 AND "Kms" < 300000 AND "CV" <= 650
"""


@register("ftr_golden", _GOLDEN_SQL)
def ftr_golden(spark, sf_dir):
    df = G.build_golden(_listing(spark, sf_dir), view(spark, sf_dir, "price_list"), "p_partkey", AS_OF, True, PERCENT)
    return df.withColumns({"Shortage": F.round("Shortage", 6), "PriceMed": F.round("PriceMed", 6)})


# -- intervals ------------------------------------------------------------

_GRID = f"""{cte('scored')}, sc AS (SELECT *, abs(y_real - y_pred) AS error FROM scored WHERE "Brand" IS NOT NULL),
st AS (SELECT "Brand", avg(error) AS m, avg(y_pred) AS p, count(*) AS n FROM sc GROUP BY 1),
zs AS (SELECT 0.5E0 + i * 0.01E0 AS z FROM range(450) t(i)),
gr AS (SELECT st."Brand", z, avg(CAST(y_real >= y_pred - z * m AND y_real <= y_pred + z * m AS INT)) AS cov, 2 * z * m AS w, m, p
  FROM sc JOIN st USING ("Brand"), zs GROUP BY st."Brand", z, m, p),
gc AS (SELECT *, (1 - cov) * (1 - cov) + (w / p) * (w / p) AS cost FROM gr)
"""


def _best_sql(name, target):
    return f"""{name} AS (SELECT * EXCLUDE (rn), printf('%.2f%%', m / p * 100) AS pct FROM (SELECT *, row_number() OVER (PARTITION BY "Brand" ORDER BY cost, z) AS rn FROM gc WHERE cov >= {target}) x WHERE rn = 1)"""


def _scores(spark, sf_dir):
    return I.scored(view(spark, sf_dir, "scored"), "y_real", "y_pred")


def _rounded(df, names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@register("scr_folds", f"{cte('scored')} SELECT \"Brand\", y_real, round(y_pred, 6) AS y_pred, round(abs(y_real - y_pred), 6) AS error FROM scored")
def scr_folds(spark, sf_dir):
    return _rounded(_scores(spark, sf_dir), ["y_pred", "error"])


@register("ci_grid", f'{_GRID} SELECT "Brand", round(z, 6) AS "Z", round(cov, 6) AS "Coverage", round(w, 6) AS "Width", round(cost, 6) AS "Cost" FROM gc')
def ci_grid(spark, sf_dir):
    return _rounded(I.grid(_scores(spark, sf_dir)), ["Z", "Coverage", "Width", "Cost"]).select("Brand", "Z", "Coverage", "Width", "Cost")


_OUT = 'round(z, 6) AS "Z", round(cov, 6) AS "Coverage", round(w, 6) AS "Width", round(m, 6) AS "Mean_error", round(cost, 6) AS "Cost", pct AS "Error_pct"'
_NUMBERS = ["Z", "Coverage", "Width", "Mean_error", "Cost"]


@register("ci_best", f"{_GRID}, {_best_sql('s', 0.95)}, {_best_sql('t', 0.85)} SELECT 'safe' AS kind, \"Brand\", {_OUT} FROM s UNION ALL SELECT 'tight', \"Brand\", {_OUT} FROM t")
def ci_best(spark, sf_dir):
    table = I.grid(_scores(spark, sf_dir))
    both = I.best(table, I.SAFE).withColumn("kind", F.lit("safe")).unionByName(I.best(table, I.TIGHT).withColumn("kind", F.lit("tight")))
    return _rounded(both, _NUMBERS).select("kind", *schemas.INTERVALS.names)


@register(
    "ci_best_width",
    f"{_GRID.replace('(1 - cov) * (1 - cov) + (w / p) * (w / p)', 'w')}, {_best_sql('s', 0.95)} SELECT \"Brand\", {_OUT} FROM s",
)
def ci_best_width(spark, sf_dir):
    return _rounded(I.best(I.grid(_scores(spark, sf_dir), use_cost=False), I.SAFE), _NUMBERS).select(*schemas.INTERVALS.names)


@register("ci_error_pct", f"{_GRID} SELECT \"Brand\", printf('%.2f%%', m / p * 100) AS error_pct FROM st")
def ci_error_pct(spark, sf_dir):
    return I.brand_stats(_scores(spark, sf_dir)).select("Brand", I.error_percent(c("Mean_error"), c("mean_pred")).alias("error_pct"))


@register(
    "ci_compare",
    f"""{_GRID}, {_best_sql('s', 0.95)}, {_best_sql('t', 0.85)}, pk AS (SELECT t.* FROM s JOIN t USING ("Brand") WHERE NOT s.cost < t.cost
    UNION ALL SELECT s.* FROM s JOIN t USING ("Brand") WHERE s.cost < t.cost) SELECT "Brand", {_OUT} FROM pk""",
)
def ci_compare(spark, sf_dir):
    return _rounded(I.intervals(_scores(spark, sf_dir)), _NUMBERS)


# -- enrichment -----------------------------------------------------------

_ENR_S = """ks AS (SELECT "Brand", "Model", min("Shortage") AS s FROM golden GROUP BY 1, 2), q AS (SELECT quantile_disc("Shortage", 0.9) AS q FROM golden),
es AS (SELECT clients.*, coalesce(ks.s, q.q) AS "Shortage" FROM clients LEFT JOIN ks USING ("Brand", "Model"), q)"""
_ENR_P = """ep AS (SELECT c.c_custkey, median(g."PriceMed") AS "PriceMed" FROM clients c JOIN golden g ON c."Brand" = g."Brand" AND c."Model" = g."Model"
  AND c."Fuel" = g."Fuel" AND abs(g."CV" - c."CV") <= 5 AND abs(g."Age" - c."Age") <= 1 GROUP BY 1)"""


def _inputs(spark, sf_dir):
    return view(spark, sf_dir, "clients"), view(spark, sf_dir, "golden")


@register("enr_shortage", f'{cte("clients", "golden")}, {_ENR_S} SELECT c_custkey, "Shortage" FROM es')
def enr_shortage(spark, sf_dir):
    return E.add_shortage(*_inputs(spark, sf_dir)).select("c_custkey", "Shortage")


@register("enr_pricemed", f'{cte("clients", "golden")}, {_ENR_P} SELECT clients.c_custkey, round("PriceMed", 6) AS "PriceMed" FROM clients LEFT JOIN ep ON clients.c_custkey = ep.c_custkey')
def enr_pricemed(spark, sf_dir):
    return E.add_price_med(*_inputs(spark, sf_dir)).select("c_custkey", F.round("PriceMed", 6).alias("PriceMed"))


@register(
    "enr_vehicle",
    f"""{cte('clients', 'golden')}, {_ENR_S}, {_ENR_P} SELECT "Brand", "Shortage", es.c_custkey, "Model", CAST("CV" AS DOUBLE) AS "CV", "Fuel", "Gearbox", "Segment", "Kms",
    CAST("Age" AS BIGINT) AS "Age", "Sale", round("PriceMed", 6) AS "PriceMed" FROM es LEFT JOIN ep ON es.c_custkey = ep.c_custkey""",
)
def enr_vehicle(spark, sf_dir):
    return E.enrich(*_inputs(spark, sf_dir)).withColumn("PriceMed", F.round("PriceMed", 6))


_STATES = list(CONDITION_YOUNG)


def _case(x, pairs):
    return f"CASE {x} " + " ".join(f"WHEN {k} THEN {v}E0" for k, v in pairs) + " END"


_STATE_SQL = f"list_extract(list_value({', '.join(chr(39) + s + chr(39) for s in _STATES)}), CAST(l_linenumber % 4 AS INT) + 1)"
_PCT = _case('least("Age", 12)', [(i, float(p)) for i, p in enumerate(RESIDUAL_PERCENT)])
_YOUNG = _case("st", [(f"'{k}'", v) for k, v in CONDITION_YOUNG.items()])
_OLD = _case("st", [(f"'{k}'", v) for k, v in CONDITION_OLD.items()])


@register(
    "val_residual",
    f"""{cte('listing')}, x AS (SELECT *, {_STATE_SQL} AS st FROM listing) SELECT l_orderkey, l_linenumber, st AS state,
    "Price" * ({_PCT}) / 100 * CASE WHEN "Age" < 2 THEN {_YOUNG} ELSE {_OLD} END AS residual FROM x""",
)
def val_residual(spark, sf_dir):
    state = F.get(F.array(*[F.lit(s) for s in _STATES]), c("l_linenumber") % 4)
    return _listing(spark, sf_dir).select(*ROW, state.alias("state"), residual_value(c("Price"), c("Age"), state).alias("residual"))
