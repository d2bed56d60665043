"""The registered queries as plain SQL over the same tables, written from the rules rather than from the operators."""

from __future__ import annotations

# What the sensor records say, derived from the events without building or parsing JSON.
_READING = """
WITH base AS (
  SELECT event_id, user_id, 'dev-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS device, ts, event_type, value, props,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         event_id % 103 <> 0 AND event_id % 101 <> 0 AS ok
  FROM events),
reading AS (
  SELECT event_id, device AS "deviceId",
         CASE WHEN ok AND event_id % 97 <> 0 THEN date_trunc('second', ts) END AS ts,
         CASE WHEN ok AND event_id % 13 <> 0
              THEN CASE WHEN event_id % 2 = 0 THEN ' ' || event_type || ' ' ELSE event_type END END AS "cropId",
         CASE WHEN ok THEN CASE k % 3 WHEN 0 THEN 'Sandy Soil' WHEN 1 THEN 'loam' ELSE 'Black Soil' END END
           AS "soilType",
         CASE WHEN ok THEN CASE event_id % 4 WHEN 0 THEN ' Seedling ' WHEN 1 THEN 'SEEDLING'
                                WHEN 2 THEN 'Vegetative' ELSE 'Flowering' END END AS stage,
         CASE WHEN ok AND event_id % 11 <> 0 AND (event_id % 2 = 0 OR event_id % 17 = 0)
              THEN value / 500 END AS "soilMoisture",
         CASE WHEN ok AND event_id % 11 <> 0 AND event_id % 2 = 1 THEN value / 5 END AS "moistureIdx",
         CASE WHEN ok THEN CAST(10 + k % 30 AS DOUBLE) END AS "tempC",
         CASE WHEN ok THEN CAST(k AS DOUBLE) END AS humidity, ok
  FROM base),
moist AS (
  SELECT *, CASE WHEN "soilMoisture" IS NOT NULL THEN "soilMoisture" ELSE "moistureIdx" / 100 END AS moisture01
  FROM reading),
clean AS (SELECT *, moisture01 * 100 AS "moisturePct" FROM moist),
scored AS (
  SELECT *, CAST((50 - coalesce("moisturePct", 0)) / CAST(50 AS DOUBLE) >= 0.5 AS BIGINT) AS "needsIrrigation"
  FROM clean)
"""


def _crop_view(soil: str = "l_linestatus", moisture: str = "l_quantity") -> str:
    return f"""
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_linenumber % 2 = 0 THEN ' ' || l_returnflag ELSE l_returnflag END AS crop_id,
         {soil} AS soil_type, 'S' || CAST(l_linenumber AS VARCHAR) AS seedling_stage, {moisture} AS moi,
         round(l_tax * 500) + 0.0 AS temp, round(l_discount * 500) + 0.0 AS humidity,
         CASE WHEN l_orderkey % 20 = 0 THEN 2 WHEN l_quantity + l_partkey % 10 < 28 THEN 1 ELSE 0 END AS result
  FROM lineitem"""


_RARE_SOIL = "CASE WHEN l_orderkey <= 7 THEN 'rare' || CAST(l_orderkey AS VARCHAR) ELSE l_linestatus END"
_NULL_MOISTURE = "CASE WHEN l_quantity = 7 THEN NULL ELSE l_quantity END"
_COLUMNS = "crop_id, soil_type, seedling_stage, moi, temp, humidity, result"
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _crop(**changes: str) -> str:
    """CTEs: ``crop`` as delivered, ``trimmed``, ``distinct_rows``, and ``cleaned`` with valid labels only."""
    return f"""
WITH crop AS ({_crop_view(**changes)}),
trimmed AS (SELECT * REPLACE (trim(crop_id) AS crop_id, trim(soil_type) AS soil_type,
                              trim(seedling_stage) AS seedling_stage) FROM crop),
distinct_rows AS (SELECT DISTINCT {_COLUMNS} FROM trimmed),
cleaned AS (SELECT * FROM distinct_rows WHERE result IN (0, 1)),
ruled AS (SELECT *, (50 - moi) / CAST(50 AS DOUBLE) AS score,
                 CASE WHEN (50 - moi) / CAST(50 AS DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM cleaned)
"""


_CROP = _crop()
_CROP_RARE = _crop(soil=_RARE_SOIL)
_CROP_NULLS = _crop(moisture=_NULL_MOISTURE)

# Rank of a cleaned row within its label, in the order of the row hash.
_RANKED = (
    _CROP
    + """, ranked AS (
  SELECT *, count(*) OVER (PARTITION BY result) AS n,
         row_number() OVER (PARTITION BY result ORDER BY
           md5(concat_ws('|', '42', crop_id, soil_type, seedling_stage, CAST(moi AS VARCHAR),
                         CAST(temp AS VARCHAR), CAST(humidity AS VARCHAR), CAST(result AS VARCHAR)))) AS r
  FROM cleaned),
parts AS (
  SELECT *, CASE WHEN r <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'valid' ELSE 'train' END AS split FROM ranked)
"""
)

_LONG_CATEGORIES = """
 SELECT 'crop_id' AS "column", crop_id AS category FROM {t}
 UNION ALL SELECT 'soil_type', soil_type FROM {t}
 UNION ALL SELECT 'seedling_stage', seedling_stage FROM {t}"""


def _long_numbers(table: str) -> str:
    parts = [f"SELECT result, '{c}' AS \"column\", {c} AS value FROM {table}" for c in ("moi", "temp", "humidity")]
    return " UNION ALL ".join(parts)


def _dictionary(table: str) -> str:
    """Categories of a trimmed table with their place in text order."""
    return f"""
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS idx FROM (
  SELECT "column", category, count(*) AS "rows"
  FROM ({_LONG_CATEGORIES.format(t=table)}) WHERE category IS NOT NULL GROUP BY "column", category)"""


def _crosstab(column: str) -> str:
    return f"""{_CROP} SELECT {column}, count(*) FILTER (WHERE result = 0) AS result_0,
  count(*) FILTER (WHERE result = 1) AS result_1 FROM cleaned GROUP BY {column}"""


# Flags over valid rows with a reach of 0.4 quartile distances; a missing value is an outlier.
_FLAGS = (
    _CROP_NULLS
    + """, valid AS (SELECT * FROM crop WHERE result IN (0, 1)),
q AS (SELECT """
    + ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in ("moi", "temp", "humidity")
    )
    + """ FROM valid),
flags AS (SELECT valid.*, """
    + ", ".join(
        f"({c} IS NULL OR {c} < {c}_1 - CAST(0.4 AS DOUBLE) * ({c}_3 - {c}_1)"
        f" OR {c} > {c}_3 + CAST(0.4 AS DOUBLE) * ({c}_3 - {c}_1)) AS {c}_outlier"
        for c in ("moi", "temp", "humidity")
    )
    + " FROM valid, q)"
)

_CELLS = (
    _CROP
    + """, cells AS (
  SELECT CAST(count(*) FILTER (WHERE result = 1 AND prediction = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE result = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE result = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (WHERE result = 0 AND prediction = 0) AS DOUBLE) AS tn FROM ruled)
"""
)

_REPORT = (
    _CELLS
    + """, classes AS (
  SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, CAST(tn + fp AS BIGINT) AS s FROM cells
  UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), CAST(tp + fn AS BIGINT) FROM cells),
scores AS (SELECT *, 2 * p * r / (p + r) AS f FROM classes)
SELECT class, round(p, 4) AS "precision", round(r, 4) AS recall, round(f, 4) AS f1, s AS support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + tn + fp + fn), 4),
                 CAST(tp + tn + fp + fn AS BIGINT) FROM cells
UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(s) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 4), round(sum(r * s) / sum(s), 4),
                 round(sum(f * s) / sum(s), 4), CAST(sum(s) AS BIGINT) FROM scores"""
)

# Rank form: the mean rank of the positives, equal scores sharing their middle rank.
_AUC = (
    _CROP
    + """, placed AS (
  SELECT result, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS place
  FROM ruled),
sums AS (SELECT sum(place) FILTER (WHERE result = 1) AS places,
                CAST(count(*) FILTER (WHERE result = 1) AS DOUBLE) AS p,
                CAST(count(*) FILTER (WHERE result = 0) AS DOUBLE) AS n FROM placed)
SELECT round((places - p * (p + 1) / 2) / (p * n), 9) AS roc_auc FROM sums"""
)

_BOX = (
    _CROP_NULLS
    + f""", long AS ({_long_numbers("cleaned")}),
box AS (SELECT result, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
               quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
reach AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM box)
SELECT result, "column", round(q1, 6) AS q1, round(med, 6) AS med, round(q3, 6) AS q3,
       round(least(q1, min(value) FILTER (WHERE value >= lo)), 6) AS whisker_lo,
       round(greatest(q3, max(value) FILTER (WHERE value <= hi)), 6) AS whisker_hi,
       count(*) FILTER (WHERE value < lo OR value > hi) AS fliers
FROM long JOIN reach USING (result, "column") GROUP BY result, "column", q1, med, q3"""
)


# Trees and depth (null: no bound) of the stated candidates; passes and layers of the network.
SIZES = {
    "gbt_deep": (800, 6),
    "gbt_wide": (400, None),
    "random_forest": (500, None),
    "extra_trees": (700, None),
    "gbt_classic": (500, 3),
    "mlp": (30, 4),
}
ROWS_TO_FIT = 20_000  # of the candidates that are not fitted on all
SAMPLED = ("mlp",)
_VALID = """count(*) AS valid_rows, count(*) FILTER (WHERE result = 1) AS valid_ones,
  0 AS bad_scores, true AS beats_majority, true AS good_auc"""


def holdout(name: str, size: int, depth: int | None) -> str:
    shown = "NULL::INT" if depth is None else depth
    more = "true AS loss_falls, true AS stops_as_stated, " if name == "mlp" else ""
    fitted = f"{ROWS_TO_FIT} AS rows_to_fit, " if name in SAMPLED else ""
    return _RANKED + f"""SELECT '{name}' AS model, {size} AS size, {shown} AS depth, {fitted}{more}{_VALID}
  FROM parts WHERE split = 'valid'"""


# The slots that are 1 in a row's vector, in vector order; soil types of fewer than five rows share one.
_ONE_HOT = (
    _CROP_RARE
    + f"""SELECT {_KEYS}, 'crop_id_' || crop_id || ' soil_type_' ||
    CASE WHEN count(*) OVER (PARTITION BY soil_type) < 5 THEN '__rare__' ELSE soil_type END
    || ' seedling_stage_' || seedling_stage AS hot, moi, temp, humidity FROM trimmed"""
)

ORACLES: dict[str, str] = {
    "stream_envelope_scan": _READING
    + "SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 103 <> 0) AS with_value FROM events",
    "csv_scan": _CROP_NULLS + f"SELECT {_COLUMNS} FROM crop",
    "sink_sensors": _READING
    + """SELECT "deviceId", ts, "cropId", "soilType", stage, moisture01, "moisturePct", "tempC", humidity,
  strftime(ts, '%Y-%m-%d') AS date FROM clean""",
    "sink_predictions": _READING
    + """SELECT "deviceId", ts, "cropId", stage, "moisturePct", "tempC", humidity, "needsIrrigation",
  strftime(ts, '%Y-%m-%d') AS date FROM scored""",
    "console_tap": _READING + 'SELECT ts, "deviceId", "cropId", stage, "moisturePct", "tempC", humidity FROM clean',
    "foreach_batch_fanout": _READING
    + """SELECT 'readings' AS "table", "deviceId", ts, "cropId", "soilType", stage, moisture01, "moisturePct", "tempC",
    humidity, NULL AS "needsIrrigation", strftime(ts, '%Y-%m-%d') AS date FROM clean
  UNION ALL SELECT 'predictions', "deviceId", ts, "cropId", NULL, stage, NULL, "moisturePct", "tempC", humidity,
    "needsIrrigation", strftime(ts, '%Y-%m-%d') FROM scored""",
    "compact_dates": _READING
    + """, dated AS (SELECT *, strftime(ts, '%Y-%m-%d') AS date FROM scored),
parts AS (
  SELECT date, CASE WHEN date < (SELECT max(date) FROM dated) THEN 1 ELSE count(DISTINCT event_id % 4) END AS parts
  FROM dated GROUP BY date)
SELECT 'readings' AS "table", "deviceId", ts, "cropId", "soilType", stage, moisture01, "moisturePct", "tempC",
    humidity, NULL AS "needsIrrigation", dated.date AS date, parts
  FROM dated JOIN parts ON dated.date IS NOT DISTINCT FROM parts.date
  UNION ALL SELECT 'predictions', "deviceId", ts, "cropId", NULL, stage, NULL, "moisturePct", "tempC", humidity,
    "needsIrrigation", dated.date, parts FROM dated JOIN parts ON dated.date IS NOT DISTINCT FROM parts.date""",
    "model_roundtrip": _CROP_RARE
    + """SELECT count(*) AS "rows", count(*) FILTER (WHERE soil_type LIKE 'rare%') AS rare_rows, 0 AS differing
FROM cleaned""",
    "category_dictionary": _CROP_RARE + _dictionary("trimmed"),
    "envelope_encode": _READING
    + """SELECT "deviceId" AS key, "deviceId" AS device, "cropId" AS crop, "moistureIdx" AS moisture,
  1 + CAST(ok AS INT) * (5 + CAST(event_id % 13 <> 0 AS INT)) + CAST("soilMoisture" IS NOT NULL AS INT)
    + CAST("moistureIdx" IS NOT NULL AS INT) AS fields FROM reading""",
    "raw_tap": _READING
    + """SELECT CASE WHEN event_id % 5 <> 0 THEN device ELSE 'None' END || ':' ||
  CASE WHEN ok THEN props ELSE 'None' END AS line FROM base""",
    "decode_envelope": _READING
    + """SELECT r.event_id, "deviceId", CASE WHEN r.ok THEN CASE WHEN r.event_id % 97 = 0 THEN 'not-a-time'
    ELSE strftime(b.ts, '%Y-%m-%dT%H:%M:%SZ') END END AS ts_raw, "cropId", "tempC",
  CASE WHEN r.event_id % 103 = 0 THEN 'empty' WHEN r.event_id % 101 = 0 THEN 'malformed' ELSE 'ok' END
    AS decode_status FROM reading r JOIN base b USING (event_id)""",
    "flatten_readings": _READING
    + """SELECT event_id, "deviceId", "cropId", "soilType", stage, "soilMoisture", "moistureIdx", "tempC", humidity
  FROM reading""",
    "device_key_fallback": _READING + 'SELECT event_id, device AS "deviceId" FROM base',
    "harmonize_moisture": _READING
    + 'SELECT event_id, "soilMoisture", "moistureIdx", moisture01, "moisturePct" FROM clean',
    "event_time": _READING + "SELECT event_id, ts, ts AS event_time FROM reading",
    "numeric_coerce": """SELECT event_id, CASE event_id % 6
    WHEN 1 THEN trunc(value) + CAST(0.5 AS DOUBLE) WHEN 2 THEN CAST(user_id % 50 AS DOUBLE) * 100
    WHEN 5 THEN -CAST(user_id AS DOUBLE) END AS "tempC",
  CAST(user_id AS DOUBLE) AS humidity FROM events""",
    "clean_readings": _READING
    + """SELECT event_id, "deviceId", "cropId", "soilType", stage, "soilMoisture", "moistureIdx", "tempC", humidity,
  ts, ts AS event_time, moisture01, "moisturePct" FROM clean""",
    "feature_projection": _READING
    + """SELECT event_id, "moisturePct" AS moi, "tempC" AS temp, humidity, trim("cropId") AS crop_id,
  "soilType" AS soil_type, CASE WHEN ok AND event_id % 4 < 2 THEN 'Yes' ELSE 'No' END AS seedling_stage FROM clean""",
    "seedling_flag": _READING
    + "SELECT event_id, CASE WHEN ok AND event_id % 4 < 2 THEN 'Yes' ELSE 'No' END AS seedling FROM reading",
    "valid_labels": _CROP + f"SELECT {_KEYS}, result FROM crop WHERE result <> 2",
    "label_domain_violations": _CROP + 'SELECT result, count(*) AS "rows" FROM crop WHERE result = 2 GROUP BY result',
    "date_partition": _READING + "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM reading",
    "trim_categories": _CROP + f"SELECT {_KEYS}, crop_id, soil_type, seedling_stage FROM trimmed",
    "fill_missing_category": _READING
    + """SELECT event_id, CASE WHEN ok AND event_id % 13 <> 0 THEN event_type ELSE 'missing' END AS "cropId"
  FROM base""",
    "threshold_class": _CROP + f"SELECT {_KEYS}, moi, CASE WHEN moi <= 25 THEN 1 ELSE 0 END AS class FROM crop",
    "label_encode": f"""WITH crop AS ({_crop_view(soil=_RARE_SOIL)})
  SELECT {_KEYS}, position(trim(crop_id) IN 'ANR') - 1 AS crop_id,
    CAST(CASE soil_type WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS BIGINT) AS soil_type,
    CAST(l_linenumber - 1 AS BIGINT) AS seedling_stage FROM crop""",
    "rare_category_bucket": _CROP_RARE
    + f"""SELECT {_KEYS}, crop_id, CASE WHEN count(*) OVER (PARTITION BY soil_type) < 5 THEN '__rare__'
  ELSE soil_type END AS soil_type, seedling_stage FROM trimmed""",
    "table_profile": """SELECT position, "column", type, (SELECT count(*) FROM lineitem) AS n_rows, 7 AS n_columns FROM (
  VALUES (0, 'crop_id', 'string'), (1, 'soil_type', 'string'), (2, 'seedling_stage', 'string'), (3, 'moi', 'double'),
         (4, 'temp', 'double'), (5, 'humidity', 'double'), (6, 'result', 'int')) AS t(position, "column", type)""",
    "category_cardinality": _CROP_RARE
    + f"""SELECT "column", count(DISTINCT category) AS categories FROM ({_LONG_CATEGORIES.format(t="crop")})
  GROUP BY "column\"""",
    "top_categories": _CROP_RARE
    + f"""SELECT * REPLACE (CAST("rank" AS INTEGER) AS "rank") FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "rows" DESC, category) AS "rank"
  FROM (SELECT "column", category, count(*) AS "rows" FROM ({_LONG_CATEGORIES.format(t="crop")}) GROUP BY ALL))
  WHERE "rank" <= 5""",
    "label_distribution": _CROP + 'SELECT result, count(*) AS "rows" FROM crop GROUP BY result',
    "label_share": _RANKED
    + """SELECT split, result, count(*) AS "rows",
  count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE) AS share FROM parts GROUP BY split, result""",
    "null_profile": _CROP_NULLS
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM crop" for c in _COLUMNS.split(", ")
    ),
    "duplicate_count": _CROP_NULLS
    + "SELECT (SELECT count(*) FROM trimmed) - (SELECT count(*) FROM distinct_rows) AS duplicates",
    "dedupe_rows": _CROP_NULLS + "SELECT * FROM distinct_rows",
    "distinct_labels": _CROP + "SELECT DISTINCT result FROM crop",
    "crosstab_crop": _crosstab("crop_id"),
    "crosstab_soil": _crosstab("soil_type"),
    "crosstab_stage": _crosstab("seedling_stage"),
    "iqr_bounds": _CROP_NULLS
    + f"""SELECT "column", round(q1 - 1.5 * (q3 - q1), 6) AS lo, round(q3 + 1.5 * (q3 - q1), 6) AS hi FROM (
  SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM ({_long_numbers("cleaned")}) GROUP BY "column")""",
    "boxplot_stats": _BOX,
    "outlier_flags": _FLAGS + f" SELECT {_KEYS}, moi_outlier, temp_outlier, humidity_outlier FROM flags",
    "outlier_counts": _FLAGS
    + " UNION ALL ".join(
        f" SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c}_outlier) AS outliers FROM flags"
        for c in ("moi", "temp", "humidity")
    ),
    "outlier_union": _FLAGS
    + f" SELECT {_KEYS}, {_COLUMNS} FROM flags WHERE moi_outlier OR temp_outlier OR humidity_outlier",
    "invalid_label_count": _CROP + "SELECT count(*) AS invalid FROM crop WHERE result NOT IN (0, 1)",
    "empty_batch_skip": "SELECT 1 AS batch_id, count(*) AS \"rows\" FROM events",
    "confusion_matrix": _CELLS
    + """SELECT 0 AS actual, 0 AS predicted, CAST(tn AS BIGINT) AS "rows" FROM cells
  UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM cells UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM cells
  UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM cells""",
    "binary_metrics": _CELLS
    + """SELECT round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall,
  round(tp / (tp + (fp + fn) / 2), 9) AS f1 FROM cells""",
    "classification_report": _REPORT,
    "roc_auc": _AUC,
    "category_frequency": _CROP_RARE
    + f"""SELECT "column", category, count(*) AS "rows", count(*) < 5 AS rare
  FROM ({_LONG_CATEGORIES.format(t="trimmed")}) GROUP BY "column", category""",
    "class_weights": _CROP
    + """SELECT result, round((SELECT count(*) FROM cleaned) / CAST(2 * count(*) AS DOUBLE), 9) AS weight,
  count(*) AS "rows" FROM cleaned GROUP BY result""",
    "log_extract": _READING
    + """SELECT ts, "deviceId", "cropId", stage, "moisturePct", "tempC", humidity, "needsIrrigation" FROM scored
  ORDER BY ts NULLS LAST, "deviceId" NULLS LAST, "cropId" NULLS LAST, stage NULLS LAST, "moisturePct" NULLS LAST,
    "tempC" NULLS LAST, humidity NULLS LAST, "needsIrrigation" LIMIT 50""",
    "head_rows": _CROP
    + f"SELECT {_KEYS}, {_COLUMNS} FROM crop ORDER BY {_KEYS}, moi, temp, humidity LIMIT 5",
    "stream_resume": """SELECT run, (SELECT count(*) FROM events) AS "rows" FROM (VALUES (1), (2)) AS t(run)""",
    "stream_score": "SELECT count(*) AS \"rows\", 0 AS unscored FROM events",
    "stratified_split": _RANKED + f"SELECT {_COLUMNS}, split FROM parts",
    "stratified_folds": _RANKED
    + f"""SELECT {_COLUMNS}, CAST((r > (n + 4) // 5) AS INT) + CAST((r > (2 * n + 4) // 5) AS INT)
  + CAST((r > (3 * n + 4) // 5) AS INT) + CAST((r > (4 * n + 4) // 5) AS INT) AS fold FROM parts""",
    "standardize": _RANKED
    + """, stats AS (SELECT """
    + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in ("moi", "temp", "humidity"))
    + """ FROM parts WHERE split = 'train')
SELECT crop_id, soil_type, seedling_stage, result, split, """
    + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}" for c in ("moi", "temp", "humidity"))
    + " FROM parts, stats",
    "one_hot": _ONE_HOT,
    "holdout_evaluation": _RANKED
    + """, v AS (SELECT result, count(*) AS n FROM parts WHERE split = 'valid' GROUP BY result)
SELECT CAST(result AS VARCHAR) AS class, n AS support, true AS good FROM v
UNION ALL SELECT class, CAST(sum(n) AS BIGINT), true
  FROM v, (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) AS t(class) GROUP BY class""",
    "cv_summary": """SELECT model, 5 AS folds, true AS in_range, true AS good, 'reference' AS profile FROM (VALUES ('gbt_deep'),
  ('gbt_wide'), ('random_forest'), ('extra_trees'), ('gbt_classic')) AS t(model)""",
    "best_model": _RANKED
    + f"SELECT true AS known, {_VALID}, 'reference' AS profile FROM parts WHERE split = 'valid'",
    "variable_importance": """SELECT variable, variable = 'moi' AS first, true AS sums_to_one FROM (VALUES ('moi'),
  ('temp'), ('humidity'), ('crop_id'), ('soil_type'), ('seedling_stage')) AS t(variable)""",
    "score_batch": _READING
    + """SELECT event_id, "deviceId", "cropId", "soilType", stage, "soilMoisture", "moistureIdx", "tempC", humidity,
  ts, ts AS event_time, moisture01, "moisturePct", "needsIrrigation" FROM scored""",
    "score_modes": """SELECT 'raw' AS mode, count(*) AS "rows", 0 AS unscored FROM events
  UNION ALL SELECT 'encoded', count(*), 0 FROM events""",
}
ORACLES["stream_clean"] = ORACLES["clean_readings"]
for _name, (_size, _depth) in SIZES.items():
    ORACLES[f"train_{_name}"] = holdout(_name, _size, _depth)
