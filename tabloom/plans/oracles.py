"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from tabloom.contracts import (
    COMPANY_SIZES,
    COMPANY_TYPES,
    EDUCATION_LEVELS,
    ENROLLED_UNIVERSITY,
    EXPERIENCE,
    GENDERS,
    LAST_NEW_JOB,
    MAJOR_DISCIPLINES,
    PEOPLE,
    RELEVANT_EXPERIENCE,
)
from tabloom.functions.clean import MISSING_GROUP
from tabloom.operators import boosting
from tabloom.operators.capacity import CURVE_FRACTIONS
from tabloom.operators.scoring import MAX_REQUEST_ROWS
from tabloom.operators.search import SEARCH_SPACE, SEARCH_SPACE_VERSION, STUDY_PREFIX, initial_designs
from tabloom.plans import catalogue, views

EXPECTED_ROWS = 19158
TEXT_COLUMNS = [
    "city", "gender", "enrolled_university", "education_level", "major_discipline", "experience",
    "company_size", "company_type", "last_new_job",
]
DOMAINS = {
    "gender": (GENDERS, False),
    "relevant_experience": (RELEVANT_EXPERIENCE, True),
    "enrolled_university": (ENROLLED_UNIVERSITY, False),
    "education_level": (EDUCATION_LEVELS, False),
    "major_discipline": (MAJOR_DISCIPLINES, False),
    "experience": (EXPERIENCE, False),
    "company_size": (COMPANY_SIZES, False),
    "company_type": (COMPANY_TYPES, False),
    "last_new_job": (LAST_NEW_JOB, False),
}


def names(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


RAW = views.RAW_PEOPLE.format(events="events")
EVERYONE = views.ALL_SCORED.format(events="events")
SCORED = views.SCORED_PEOPLE.format(events="events")
LABELS = views.DOC_LABELS.format(documents="documents", labels="labels")
TRIALS = views.TRIALS.format(events="events")
REQUESTS = views.REQUESTS.format(events="events")
DESCRIPTORS = views.DESCRIPTORS.format(events="events")

_CLEANED = ",\n  ".join(f"nullif(trim({name}), '') AS {name}" for name in TEXT_COLUMNS)
PEOPLE_SQL = f"""
SELECT
  TRY_CAST(nullif(trim(enrollee_id), '') AS BIGINT) AS enrollee_id,
  {_CLEANED},
  TRY_CAST(nullif(trim(city_development_index), '') AS DOUBLE) AS city_development_index,
  replace(trim(relevent_experience), 'relevent', 'relevant') AS relevant_experience,
  TRY_CAST(nullif(trim(training_hours), '') AS BIGINT) AS training_hours,
  CASE TRY_CAST(nullif(trim(target), '') AS DOUBLE) WHEN 0 THEN 0 WHEN 1 THEN 1 END::BIGINT AS target,
  '{views.SOURCE_URI}' AS source_uri,
  '{views.SOURCE_SHA256}' AS source_sha256
FROM ({RAW})
"""


def with_tables(body: str, **tables: str) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in tables.items())
    return f"WITH {parts}\n{body}"


# --- quality ---------------------------------------------------------------

_CHECKS = {
    "expected_row_count": f"abs(count(*) - {EXPECTED_ROWS})",
    "raw_and_modeling_row_counts_match": "abs((SELECT count(*) FROM r) - count(*))",
    "enrollee_id_not_null": "count(*) FILTER (enrollee_id IS NULL)",
    "enrollee_id_unique": "count(enrollee_id) - count(DISTINCT enrollee_id)",
    "target_not_null": "count(*) FILTER (target IS NULL)",
    "target_is_binary": "count(*) FILTER (target NOT IN (0, 1))",
    "both_target_classes_present": "CASE WHEN count(DISTINCT target) = 2 THEN 0 ELSE 1 END",
    "city_development_index_between_0_and_1":
        "count(*) FILTER (city_development_index IS NULL OR city_development_index NOT BETWEEN 0 AND 1)",
    "training_hours_nonnegative": "count(*) FILTER (training_hours IS NULL OR training_hours < 0)",
    "no_exact_duplicate_rows": "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m))",
    "city_domain": "count(*) FILTER (city IS NULL OR NOT regexp_full_match(city, 'city_[0-9]+'))",
    "source_uri_matches": f"count(*) FILTER (source_uri <> '{views.SOURCE_URI}')",
    "source_sha256_matches": f"count(*) FILTER (source_sha256 <> '{views.SOURCE_SHA256}')",
    **{
        f"{name}_domain": f"count(*) FILTER ({name} NOT IN ({names(values)}){f' OR {name} IS NULL' if required else ''})"
        for name, (values, required) in DOMAINS.items()
    },
}
_DQ = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS check_name, 'ERROR' AS severity, CAST({value} AS BIGINT) AS failed_rows FROM m"
    for name, value in _CHECKS.items()
)
_PROFILED = [column.name for column in PEOPLE.columns if column.name != "enrollee_id"]
_FRAME = {
    "row_count": f"abs(count(*) - {EXPECTED_ROWS})",
    "identifier_missing": "count(*) FILTER (enrollee_id IS NULL)",
    "identifier_duplicated": "count(enrollee_id) - count(DISTINCT enrollee_id)",
    "label_missing": "count(*) FILTER (target IS NULL)",
    "label_not_binary": "count(*) FILTER (target NOT IN (0, 1))",
    "source_hash_missing": "count(*) FILTER (source_sha256 IS NULL)",
    "source_hash_other": f"count(*) FILTER (source_sha256 <> '{views.SOURCE_SHA256}')",
    "city_development_index_missing": "count(*) FILTER (city_development_index IS NULL)",
    "city_development_index_out_of_range": "count(*) FILTER (city_development_index NOT BETWEEN 0 AND 1)",
    "class_too_small":
        "CASE WHEN least(count(*) FILTER (target = 0), count(*) FILTER (target = 1)) < 2 THEN 1 ELSE 0 END",
}


def tall(checks: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, CAST({value} AS BIGINT) AS failed_rows FROM m"
        for name, value in checks.items()
    )


# --- split -----------------------------------------------------------------


def split_sql(table: str, key: str, label: str, test_size: float, seed: int) -> str:
    """All rows of a table with their split."""
    return f"""
SELECT t.*, CASE WHEN row_number() OVER (PARTITION BY t.{label} ORDER BY md5('{seed}:' || t.{key}), t.{key}) <= q.quota
       THEN 'development' ELSE 'test' END AS split
FROM {table} t JOIN (
  SELECT label, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, label) <= dev - sum(base) OVER ()
         THEN 1 ELSE 0 END AS quota
  FROM (
    SELECT label, dev, CAST(n * dev AS DOUBLE) / total AS share, (n * dev) // total AS base
    FROM (
      SELECT label, n, sum(n) OVER ()::BIGINT AS total,
             (sum(n) OVER () - ceil(sum(n) OVER () * {test_size}::DOUBLE))::BIGINT AS dev
      FROM (SELECT {label} AS label, count(*) AS n FROM {table} GROUP BY 1)
    )
  )
) q ON q.label = t.{label}
"""


def folds_sql(table: str, key: str, label: str, folds: int = 5, seed: int = 42) -> str:
    """All rows of a table with their fold: class-sorted rows are dealt out, then packed per class."""
    return f"""
SELECT t.*, f.fold FROM (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:fold:' || {key}), {key}) AS place FROM {table}
) t JOIN (
  SELECT label, fold, sum(n) OVER (PARTITION BY label ORDER BY fold) AS upto,
         sum(n) OVER (PARTITION BY label ORDER BY fold) - n AS start
  FROM (
    SELECT label, fold, count(*) AS n FROM (
      SELECT {label} AS label, 1 + (row_number() OVER (ORDER BY {label}) - 1) % {folds} AS fold FROM {table}
    ) GROUP BY ALL
  )
) f ON f.label = t.{label} AND t.place > f.start AND t.place <= f.upto
"""


def leaves_sql(table: str, key: str, group: str, sums: str = "") -> str:
    """Leaves of the hash tree over the keys of each group; ``sums`` are carried along."""
    carried = "".join(f", sum({name})::BIGINT AS {name}" for name in sums.split())
    return f"""
SELECT {group}, substr(h, 1, 6) AS leaf, sum(n)::BIGINT AS n{carried}, sha256(string_agg(h || ':' || n, ',' ORDER BY h)) AS d
FROM (
  SELECT {group}, sha256(coalesce('=' || CAST({key} AS VARCHAR), '-')) AS h, count(*) AS n{carried}
  FROM {table} GROUP BY ALL
) GROUP BY ALL
"""


def digest_sql(table: str, key: str, group: str, sums: str = "") -> str:
    """Rows, sums and digest of each group: leaves, the nodes above them, the root."""
    carried = "".join(f", sum({name})::BIGINT AS {name}" for name in sums.split())
    return f"""
SELECT {group}, sum(n)::BIGINT AS "rows"{carried}, sha256(string_agg(node || ':' || d, ',' ORDER BY node)) AS digest
FROM (
  SELECT {group}, substr(leaf, 1, 3) AS node, sum(n) AS n{carried}, sha256(string_agg(leaf || ':' || d, ',' ORDER BY leaf)) AS d
  FROM ({leaves_sql(table, key, group, sums)}) GROUP BY ALL
) GROUP BY ALL
"""


# --- metrics ---------------------------------------------------------------


def curve_sql(table: str, groups: str = "") -> str:
    """Counts at or above each distinct score of (y, p) rows."""
    keys = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    return f"""
SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(n - pos) OVER w AS fp
FROM (SELECT {keys}p, sum(y) AS pos, count(*) AS n FROM {table} GROUP BY ALL)
WINDOW w AS ({part}ORDER BY p DESC)
"""


AP = "sum(pos * (tp / k)) / sum(pos)"
AUC = "1 - sum(pos * (fp - (n - pos) / 2.0)) / (sum(pos) * sum(n - pos)::DOUBLE)"
BRIER = "sum(pos * (p - 1) ** 2 + (n - pos) * p ** 2) / sum(n)"
BOTH = "sum(pos) > 0 AND sum(n - pos) > 0"


def zero_safe(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0)"


def threshold_metrics(threshold: float) -> dict[str, str]:
    tp = f"count(*) FILTER (y = 1 AND p >= {threshold}::DOUBLE)"
    predicted = f"count(*) FILTER (p >= {threshold}::DOUBLE)"
    positives = "sum(y)"
    return {
        "recall": zero_safe(tp, positives),
        "precision": zero_safe(tp, predicted),
        "f1": zero_safe(f"2 * {tp}", f"({positives} + {predicted})"),
        "f2": zero_safe(f"5 * {tp}", f"(4 * {positives} + {predicted})"),
    }


_THRESHOLD = threshold_metrics(0.4)


def capacity_sql(fractions: tuple[float, ...]) -> str:
    rows = ", ".join(f"({fraction}::DOUBLE)" for fraction in fractions)
    return f"""
SELECT f AS selection_fraction, k AS selected_rows, base AS baseline_rate, sel AS selected_rate,
       base - sel AS absolute_reduction, (base - sel) / base AS relative_reduction
FROM (
  SELECT f, k, (SELECT avg(y) FROM s) AS base, avg(y) AS sel
  FROM (
    SELECT f, greatest(1, round_even((SELECT count(*) FROM s) * f, 0))::BIGINT AS k FROM (VALUES {rows}) v(f)
  ) JOIN (SELECT y, row_number() OVER (ORDER BY p, enrollee_id) AS rn FROM s) r ON rn <= k
  GROUP BY f, k
)
"""


def rounded_sql(sql: str, *columns: str) -> str:
    inner = ", ".join(f"round({name}, 6) AS {name}" for name in columns)
    return f"SELECT * REPLACE ({inner}) FROM ({sql})"


_CAPACITY = ("baseline_rate", "selected_rate", "absolute_reduction", "relative_reduction")
_FAIRNESS = ("positive_rate", "predicted_positive_rate", "recall", "average_precision")


def fairness_sql(table: str, group: str, label: str, threshold: float) -> str:
    return f"""
SELECT g AS "group", rows, positive_rate, predicted_positive_rate, recall, average_precision FROM (
  SELECT g, count(*) AS rows, avg(y) AS positive_rate, avg((p >= {threshold}::DOUBLE)::INT) AS predicted_positive_rate,
         {zero_safe(f"count(*) FILTER (y = 1 AND p >= {threshold}::DOUBLE)", "sum(y)")} AS recall
  FROM {table} GROUP BY g HAVING count(*) >= 30
) JOIN (
  SELECT g, CASE WHEN {BOTH} THEN {AP} END AS average_precision FROM ({curve_sql(table, "g")}) GROUP BY g
) USING (g)
"""


_GROUPED = f"SELECT coalesce(gender, '__MISSING__') AS g, y, p FROM ({SCORED})"
_DOC_GROUPED = f"SELECT lang AS g, quality AS y, n_chars / (n_chars + 1000) AS p FROM ({LABELS})"

_HOLDOUT = f"""
SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM s
UNION ALL SELECT 'positive_rate', avg(y) FROM s
UNION ALL SELECT 'average_precision', {AP} FROM c
UNION ALL SELECT 'roc_auc', {AUC} FROM c
UNION ALL SELECT 'brier_score', avg((p - y) ** 2) FROM s
UNION ALL SELECT 'threshold', 0.4
""" + "".join(f"UNION ALL SELECT '{name}', {value} FROM s\n" for name, value in _THRESHOLD.items()) + "".join(
    f"UNION ALL SELECT 'capacity_' || (selection_fraction * 100)::INT || '_{name}', {name}::DOUBLE FROM k\n"
    for name in ("selected_rows", *_CAPACITY)
)

# --- cross-validation ------------------------------------------------------

_FOLD_METRICS = (
    "train_average_precision", "validation_average_precision", "validation_roc_auc", "validation_brier_score",
)


def fold_metrics_sql(scores: str) -> str:
    """Fold metrics of a table (fold, part, y, p)."""
    return f"""
SELECT fold,
       max(rows) FILTER (part = 'train')::BIGINT AS train_rows,
       max(rows) FILTER (part = 'validation')::BIGINT AS validation_rows,
       max(ap) FILTER (part = 'train') AS train_average_precision,
       max(ap) FILTER (part = 'validation') AS validation_average_precision,
       max(auc) FILTER (part = 'validation') AS validation_roc_auc,
       max(brier) FILTER (part = 'validation') AS validation_brier_score
FROM (
  SELECT fold, part, sum(n) AS rows, {AP} AS ap, {AUC} AS auc, {BRIER} AS brier
  FROM ({curve_sql(scores, "fold, part")}) GROUP BY fold, part
) GROUP BY fold
"""


_MODELS = "SELECT unnest([1, 2, 3, 4, 5])::INT AS fold"
_CV_SCORES = """
SELECT m.fold, CASE WHEN f.fold = m.fold THEN 'validation' ELSE 'train' END AS part, y, p FROM f, m
"""
_PRIOR_SCORES = """
SELECT m.fold, CASE WHEN f.fold = m.fold THEN 'validation' ELSE 'train' END AS part, f.y, q.prior AS p
FROM f, m JOIN (
  SELECT m.fold, avg(f.y) FILTER (f.fold <> m.fold) AS prior FROM f, m GROUP BY m.fold
) q ON q.fold = m.fold
"""
_SUMMARY = """
SELECT count(*) AS cv_folds, sum(validation_rows)::BIGINT AS development_rows,
       avg(validation_average_precision) AS validation_average_precision_mean,
       stddev_samp(validation_average_precision) AS validation_average_precision_std,
       avg(train_average_precision) AS train_average_precision_mean,
       avg(train_average_precision) - avg(validation_average_precision) AS average_precision_gap,
       avg(validation_roc_auc) AS validation_roc_auc_mean,
       stddev_samp(validation_roc_auc) AS validation_roc_auc_std,
       avg(validation_brier_score) AS validation_brier_score_mean
FROM fm
"""
_SUMMARY_COLUMNS = (
    "validation_average_precision_mean", "validation_average_precision_std", "train_average_precision_mean",
    "average_precision_gap", "validation_roc_auc_mean", "validation_roc_auc_std", "validation_brier_score_mean",
)

# --- features --------------------------------------------------------------

LABELLED = {
    "m": f"SELECT * FROM ({PEOPLE_SQL}) WHERE target IS NOT NULL",
    "a": split_sql("m", "enrollee_id", "target", 0.2, 42),
    "d": "SELECT * FROM a WHERE split = 'development'",
}
_ORDERS = PEOPLE.ordinal
_ONE_HOT = [*PEOPLE.high_cardinality, *PEOPLE.nominal]


def modes_sql() -> str:
    return ", ".join(
        f"(SELECT {name} FROM d WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS {name}"
        for name in _ORDERS
    )


def code_sql(value: str, order: tuple[str, ...]) -> str:
    return f"coalesce(list_position([{names(order)}], {value}), 0) - 1"


def words_sql(columns: list[str], min_frequency: int) -> str:
    """(feature, category, n, frequent) of the development rows."""
    arms = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, coalesce({name}, '__MISSING__') AS category FROM d" for name in columns
    )
    return (
        f"SELECT feature, category, count(*) AS n, count(*) >= {min_frequency} AS frequent"
        f" FROM ({arms}) GROUP BY feature, category"
    )


_IMPUTED = """
SELECT a.*, coalesce(city_development_index, median) AS x, (city_development_index IS NULL)::INT AS missing
FROM a, (SELECT median(city_development_index) AS median FROM d)
"""
_SCALING = "SELECT avg(x) AS mean, stddev_pop(x) AS sd FROM i WHERE split = 'development'"
_CODED = "SELECT a.enrollee_id, a.split, " + ", ".join(
    f"{code_sql(f'coalesce(a.{name}, o.{name})', order)} AS {name}" for name, order in _ORDERS.items()
) + " FROM a, o"
_CODE_SCALING = "SELECT " + ", ".join(
    f"avg({name}) AS {name}_mean, stddev_pop({name}) AS {name}_sd" for name in _ORDERS
) + " FROM e WHERE split = 'development'"
_LONG = " UNION ALL ".join(
    f"SELECT enrollee_id, '{name}' AS feature, coalesce({name}, '__MISSING__') AS category FROM a" for name in _ONE_HOT
)
_ACTIVE = """
SELECT l.enrollee_id, l.feature, l.category, CASE WHEN w.frequent THEN l.feature || '=' || l.category
       WHEN l.feature IN (SELECT feature FROM w WHERE NOT frequent) THEN l.feature || '=__INFREQUENT__' END AS name
FROM l LEFT JOIN w ON w.feature = l.feature AND w.category = l.category
"""


def width_sql(strategy: str, include_city: bool) -> str:
    columns = [*(PEOPLE.high_cardinality if include_city else ()), *PEOPLE.nominal]
    extra = "0"
    if strategy == "all_ohe":
        columns += list(_ORDERS)
    else:
        extra = str(len(_ORDERS))
    return f"""
SELECT '{strategy}_{"with" if include_city else "without"}_city' AS name, '{strategy}' AS strategy,
       {str(include_city).lower()} AS include_city, 10 AS min_category_frequency,
       (1 + (SELECT max((city_development_index IS NULL)::INT) FROM d) + {extra} + (
         SELECT sum(c) FROM (
           SELECT count(*) FILTER (frequent) + max((NOT frequent)::INT) AS c
           FROM ({words_sql(columns, 10)}) GROUP BY feature)))::BIGINT AS transformed_feature_count
"""


_FEATURE_ORDER = f"list_position([{names(tuple(_ONE_HOT))}], feature)"
_MATRIX = f"""
SELECT 0 AS position, round((SELECT sum((x - mean) / sd) FROM i, g) , 4) + 0 AS total
UNION ALL SELECT 1, round(sum((missing - m.mean) / m.sd), 4)
FROM i, (SELECT avg(missing) AS mean, stddev_pop(missing) AS sd FROM i WHERE split = 'development') m
""" + "".join(
    f"UNION ALL SELECT {2 + place}, round(sum(({name} - {name}_mean) / {name}_sd), 4) FROM e, z\n"
    for place, name in enumerate(_ORDERS)
) + f"""
UNION ALL SELECT ({1 + len(_ORDERS)} + row_number() OVER (ORDER BY {_FEATURE_ORDER}, rare, name))::INT,
       (SELECT count(*) FROM act WHERE act.name = h.name)::DOUBLE
FROM (
  SELECT DISTINCT feature, NOT frequent AS rare,
         CASE WHEN frequent THEN feature || '=' || category ELSE feature || '=__INFREQUENT__' END AS name FROM w
) h
"""

# --- search ----------------------------------------------------------------


def draw_sql(parameter) -> str:
    uniform = (
        "(('0x' || substr(md5('42:' || study || ':' || trial || ':"
        f"{parameter.name}'), 1, 13))::BIGINT::DOUBLE / {float(16**13)!r})"
    )
    low, high = f"{float(parameter.low)!r}::DOUBLE", f"{float(parameter.high)!r}::DOUBLE"
    if parameter.choices:
        return f"[{names(parameter.choices)}][floor({uniform} * {len(parameter.choices)})::INT + 1]"
    if parameter.whole and parameter.log:
        return f"least(floor(exp(ln({low}) + {uniform} * (ln({high} + 1) - ln({low})))), {high})::BIGINT"
    if parameter.whole:
        steps = int(parameter.high - parameter.low) // parameter.step + 1
        return f"({int(parameter.low)} + {parameter.step} * floor({uniform} * {steps}))::BIGINT"
    if parameter.log:
        return f"round(exp(ln({low}) + {uniform} * (ln({high}) - ln({low}))), 6)"
    return f"round({low} + {uniform} * ({high} - {low}), 6)"


_MODEL = next(parameter for parameter in SEARCH_SPACE if parameter.name == "model_name")
_CANDIDATES = "SELECT study, trial, " + ", ".join(
    (
        draw_sql(parameter)
        if parameter.model is None
        else f"CASE WHEN {draw_sql(_MODEL)} = '{parameter.model}' THEN {draw_sql(parameter)} END"
    )
    + f" AS {parameter.name}"
    for parameter in SEARCH_SPACE
) + " FROM t"
_CONTRACT = {"source_sha256": "'a'", "cv_folds": "5", "random_state": "42", "search_space_version": "1"}
_FINITE = "NOT isnan(value) AND NOT isinf(value)"

# --- scoring ---------------------------------------------------------------


def request_fields() -> str:
    parts = []
    for name in PEOPLE.features:
        parts.append(f"json_type(j, '$.{name}') AS k_{name}")
        if name == "city_development_index":
            parts.append(
                f"CASE WHEN json_type(j, '$.{name}') IN ('DOUBLE', 'UBIGINT', 'BIGINT')"
                f" THEN CAST(j->>'$.{name}' AS DOUBLE) END AS {name}"
            )
        else:
            parts.append(
                f"CASE WHEN json_type(j, '$.{name}') = 'VARCHAR'"
                f" THEN nullif(trim(j->>'$.{name}'), '') END AS {name}"
            )
    return f"SELECT event_id, j, {', '.join(parts)} FROM (SELECT event_id, payload::JSON AS j FROM q)"


def request_rules(typed: bool) -> str:
    """Reasons in text order: fields by name, rules by name inside a field."""
    parts: list[str] = []

    def add(name: str, rule: str, bad: str) -> None:
        parts.append(f"CASE WHEN {bad} THEN '{name}:{rule}' END")

    for name in sorted([*PEOPLE.features, "surprise"]):
        if name == "surprise":
            if not typed:
                add(name, "unknown", "json_exists(j, '$.surprise')")
            continue
        good_kind = (
            f"k_{name} IN ('DOUBLE', 'UBIGINT', 'BIGINT', 'NULL')"
            if name == "city_development_index"
            else f"k_{name} IN ('VARCHAR', 'NULL')"
        )
        readable = "true" if typed else f"k_{name} IS NOT NULL AND {good_kind}"
        required = name in ("city", "city_development_index", "relevant_experience")
        if name == "city":
            add(name, "domain", f"{readable} AND NOT regexp_full_match(city, 'city_[0-9]+')")
            add(name, "length", f"{readable} AND length(city) NOT BETWEEN 6 AND 20")
        elif name in DOMAINS:
            add(name, "domain", f"{readable} AND {name} NOT IN ({names(DOMAINS[name][0])})")
        if not typed:
            add(name, "missing", f"k_{name} IS NULL")
        if name == "city_development_index":
            add(name, "range", f"{readable} AND {name} NOT BETWEEN 0 AND 1")
        if required:
            add(name, "required", f"{readable} AND {name} IS NULL")
        if not typed:
            add(name, "type", f"k_{name} IS NOT NULL AND NOT {good_kind}")
    return f"concat_ws(';', {', '.join(parts)})"


_CHECKED = f"SELECT *, {request_rules(False)} AS reasons FROM f"
_BATCH = f"""
SELECT event_id, r.request_id, CASE WHEN why = '' THEN 'scored' ELSE 'rejected' END AS status, why AS reasons,
       CASE WHEN why = '' THEN true END AS valid, CASE WHEN why = '' THEN true END AS ranked
FROM (
  SELECT event_id, x.request_id, concat_ws(';', nullif(reasons, ''),
    CASE WHEN x.request_id IS NULL THEN 'request:key' WHEN z.n > {MAX_REQUEST_ROWS} THEN 'request:size'
         WHEN z.flawed AND reasons = '' THEN 'request:refused' END) AS why
  FROM y x LEFT JOIN (SELECT request_id, count(*) AS n, bool_or(reasons <> '') AS flawed FROM y GROUP BY request_id) z
    ON z.request_id = x.request_id
) r
"""
_LATE = _BATCH.replace(
    "WHEN z.flawed", f"WHEN x.request_id % 10 = {catalogue.LATE_DIGIT} THEN 'request:late' WHEN z.flawed"
)
_KEYED = f"SELECT event_id, reasons, {views.REQUEST_ID} AS request_id FROM x"
BATCH = with_tables(_BATCH, q=REQUESTS, f=request_fields(), x=_CHECKED, y=_KEYED)

_LABELLED = f"SELECT * FROM ({PEOPLE_SQL}) WHERE target IS NOT NULL"
_HELD_OUT = f"SELECT * FROM ({split_sql('p', 'enrollee_id', 'target', 0.2, 42)}) WHERE split = 'test'"


def splits_sql() -> str:
    """Leaf-wise trees grown step by step: cells, gains, the best cut of all leaves, and the rows below it."""
    set_, names = catalogue.LEAFWISE, list(catalogue.LINE_FEATURES)
    scale, alpha, lam = float(boosting.SCALE), set_["regAlpha"], set_["regLambda"]

    def part(g: str, h: str) -> str:
        weight = f"greatest(abs({g} / {scale!r}::DOUBLE) - {alpha}::DOUBLE, 0::DOUBLE)"
        return f"{weight} * {weight} / ({h} / {scale!r}::DOUBLE + {lam}::DOUBLE)"

    bins = ", ".join(f"(dense_rank() OVER (ORDER BY {sql}) - 1)::BIGINT AS f{i}" for i, sql in enumerate(catalogue.LINE_FEATURES.values()))
    base = f"SELECT ({catalogue.LINE_LABEL})::INT::DOUBLE AS label, {bins} FROM lineitem"
    kept = ", ".join(["label", *[f"f{i}" for i in range(len(names))]])
    parts = {"base": base}
    parts["rows_0"] = "SELECT *, ln(avg(label) OVER () / (1 - avg(label) OVER ())) AS score FROM base"
    able = " AND ".join(
        f"{side}_n >= {set_['minRowsPerLeaf']} AND {side}_h / {scale!r}::DOUBLE >= {boosting.MIN_HESSIAN}" for side in ("left", "right")
    )
    for tree in range(1, set_["numTrees"] + 1):
        p = "(1 / (1 + exp(-score)))"
        parts[f"at_{tree}_0"] = (
            f"SELECT {kept}, score, 0 AS leaf, 0 AS depth, floor(({p} - label) * {scale!r}::DOUBLE + 0.5)::BIGINT AS g,"
            f" floor({p} * (1 - {p}) * {scale!r}::DOUBLE + 0.5)::BIGINT AS h FROM rows_{tree - 1}"
        )
        for step in range(1, set_["numLeaves"]):
            before = f"at_{tree}_{step - 1}"
            cells = " UNION ALL ".join(
                f"SELECT leaf, {i} AS feature, f{i} AS bin, sum(g) AS g, sum(h) AS h, count(*) AS n"
                f" FROM {before} WHERE depth < {set_['maxDepth']} GROUP BY ALL"
                for i in range(len(names))
            )
            left = ", ".join(f"sum({x}) OVER (PARTITION BY leaf, feature ORDER BY bin) AS left_{x}" for x in "ghn")
            all_ = ", ".join(f"sum({x}) OVER (PARTITION BY leaf, feature) AS all_{x}" for x in "ghn")
            right = ", ".join(f"all_{x} - left_{x} AS right_{x}" for x in "ghn")
            gain = f"{part('left_g', 'left_h')} + {part('right_g', 'right_h')} - {part('all_g', 'all_h')}"
            parts[f"best_{tree}_{step}"] = (
                f"SELECT *, {gain} AS gain FROM (SELECT *, {right} FROM (SELECT *, {left}, {all_} FROM ({cells})))"
                f" WHERE {able} AND gain > 0 ORDER BY gain DESC, leaf, feature, bin LIMIT 1"
            )
            value = "CASE b.feature " + " ".join(f"WHEN {i} THEN r.f{i}" for i in range(len(names))) + " END"
            columns = ", ".join(f"r.{name}" for name in kept.split(", "))
            parts[f"at_{tree}_{step}"] = (
                f"SELECT {columns}, r.score, CASE WHEN {value} > b.bin THEN {step} ELSE r.leaf END AS leaf,"
                f" r.depth + CASE WHEN b.leaf IS NULL THEN 0 ELSE 1 END AS depth, r.g, r.h"
                f" FROM {before} r LEFT JOIN best_{tree}_{step} b ON b.leaf = r.leaf"
            )
        last = f"at_{tree}_{set_['numLeaves'] - 1}"
        weight = f"sign(sum(g)) * greatest(abs(sum(g) / {scale!r}::DOUBLE) - {alpha}, 0)"
        parts[f"rows_{tree}"] = (
            f"SELECT {kept}, score + {set_['learningRate']}::DOUBLE * value AS score FROM {last} JOIN"
            f" (SELECT leaf, -({weight}) / (sum(h) / {scale!r}::DOUBLE + {lam}) AS value FROM {last} GROUP BY leaf) USING (leaf)"
        )
    splits = " UNION ALL ".join(
        f"SELECT {tree} AS tree, {step} AS step, feature, bin, round(gain, 6) AS gain, left_n::BIGINT AS left_rows,"
        f" right_n::BIGINT AS right_rows FROM best_{tree}_{step}"
        for tree in range(1, set_["numTrees"] + 1)
        for step in range(1, set_["numLeaves"])
    )
    return "WITH " + ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts.items()) + " " + splits


def tree_sql(params: dict[str, str], trees: str) -> str:
    """Size of a tree model and counts of the test rows."""
    return with_tables(
        f"""
SELECT '{params["model_name"]}' AS model_name, {params[trees]} AS trees, true AS within_depth, count(*) AS rows,
       sum(target)::BIGINT AS positives, 0::BIGINT AS outside, true AS scores_differ FROM t
""",
        p=_LABELLED, t=_HELD_OUT,
    )


_FINAL = "SELECT 'rows' AS metric, count(*)::DOUBLE AS value, true AS finite FROM t" + "".join(
    f" UNION ALL SELECT '{name}', {value}, true" + (" FROM t" if "(" in value else "")
    for name, value in (
        ("positive_rate", "round(avg(target), 6)"),
        ("threshold", str(catalogue.THRESHOLD)),
        *((name, "NULL") for name in ("average_precision", "roc_auc", "brier_score", "recall", "precision", "f1", "f2")),
        *(
            (f"capacity_{fraction * 100:.0f}_{part}", value)
            for fraction in catalogue.FRACTIONS
            for part, value in (
                ("selected_rows", f"greatest(1, round_even(count(*) * {fraction}::DOUBLE, 0))::DOUBLE"),
                ("baseline_rate", "round(avg(target), 6)"),
                ("selected_rate", "NULL"),
                ("absolute_reduction", "NULL"),
                ("relative_reduction", "NULL"),
            )
        ),
    )
)
_STUDY = f"{STUDY_PREFIX}-v{SEARCH_SPACE_VERSION}-{views.SOURCE_SHA256[:12]}-cv{catalogue.STUDY_FOLDS}"
_PARAMETERS = ",".join(sorted(f"{name}={value}" for name, value in catalogue.LOGISTIC.items()))

_DOC_ENTRIES = """
SELECT doc_id, unnest(['sha256', 'size_chars', 'lang', 'source']) AS key,
       unnest([sha256({text}), length({text})::VARCHAR, lang, source]) AS value FROM documents
"""
_REPORT_LIST = names(views.REPORTS)

ORACLES: dict[str, str] = {
    "file_manifest": """
SELECT sum(octet_length(encode(text)) + 1)::BIGINT AS size_bytes, 64 AS digest_length, true AS paths_differ FROM documents
""",
    "cv_report": f"""
SELECT {catalogue.FOLDS}::BIGINT AS cv_folds, count(*) AS development_rows, round(avg(target), 6) AS positive_rate,
       true AS validation_average_precision_mean, true AS train_average_precision_mean,
       true AS validation_roc_auc_mean, true AS oof_recall FROM ({_LABELLED})
""",
    "final_report": with_tables(_FINAL, p=_LABELLED, t=_HELD_OUT),
    "finalize_once": with_tables(
        f"""
SELECT 'people' AS name, 1::BIGINT AS version, 'candidate' AS alias, '{_STUDY}' AS study,
       '{views.SOURCE_SHA256}' AS source_sha256, true AS best_trial, true AS own_design,
       'capacity_curve,confusion_matrix,fairness_by_group,fairness_gaps,final_evaluation,model_selection_summary,'
       || 'precision_recall_curve,roc_curve,split_manifest' AS reports,
       {len(initial_designs())}::BIGINT AS trials, count(*)::DOUBLE AS test_rows,
       round(avg(target), 6) AS test_positive_rate, true AS second_run_refused FROM t
""",
        p=_LABELLED, t=_HELD_OUT,
    ),
    "forest_report": tree_sql(catalogue.FOREST, "rf_n_estimators"),
    "boosting_splits": splits_sql(),
    "boosting_report": tree_sql(catalogue.BOOSTING, "gbt_n_estimators"),
    "model_info": with_tables(
        f"""
SELECT 'people' AS name, 1::BIGINT AS version, 'candidate' AS alias, 'ordinal_aware_without_city' AS preprocessing,
       '{views.SOURCE_SHA256}' AS source_sha256, '{",".join(PEOPLE.features)}' AS features,
       '{_PARAMETERS}' AS parameters, count(*)::DOUBLE AS test_rows FROM t
""",
        p=_LABELLED, t=_HELD_OUT,
    ),
    "clean_strings": f"SELECT {', '.join(f'''nullif(trim({name}), '') AS {name}''' for name in PEOPLE.raw_columns)}"
                     f" FROM ({RAW})",
    "typed_cast": f"SELECT enrollee_id, city_development_index, training_hours, target, target::TINYINT AS label"
                  f" FROM ({PEOPLE_SQL})",
    "value_remap": f"SELECT enrollee_id, replace(trim(relevent_experience), 'relevent', 'relevant')"
                   f" AS relevant_experience FROM ({RAW})",
    "modeling_table": PEOPLE_SQL,
    "param_scan": f"SELECT {', '.join(PEOPLE.scan_columns)} FROM ({PEOPLE_SQL})"
                  f" WHERE source_sha256 = '{views.SOURCE_SHA256}' AND city_development_index >= 0.25",
    "manifest_diff": with_tables(
        """
SELECT doc_id, key, CASE WHEN s.value IS NULL THEN 'missing' WHEN e.value IS NULL THEN 'unexpected'
       ELSE 'mismatch' END AS problem, e.value AS expected, s.value AS actual
FROM e FULL JOIN s USING (doc_id, key) WHERE s.value IS DISTINCT FROM e.value
""",
        e=_DOC_ENTRIES.format(text="text"),
        s="SELECT doc_id, CASE WHEN value = 'src5' THEN 'note' ELSE key END AS key, value FROM ("
        + _DOC_ENTRIES.format(text="(CASE WHEN doc_id % 50 = 0 THEN text || '!' ELSE text END)")
        + ") WHERE value <> 'src3'",
    ),
    "report_catalog": f"""
WITH w AS (SELECT DISTINCT user_id, [{_REPORT_LIST}][event_id % 7 + 1] AS report FROM events WHERE event_type <> 'error')
SELECT u.user_id, n.report, w.report IS NOT NULL AS present, u.user_id IN (SELECT user_id FROM w) AS any_report
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT unnest([{_REPORT_LIST}]) AS report) n
LEFT JOIN w ON w.user_id = u.user_id AND w.report = n.report
""",
    "csv_contract": f"""
SELECT 'row_count' AS key, count(*)::VARCHAR AS value FROM events
UNION ALL SELECT 'columns', '["{'","'.join(PEOPLE.raw_columns)}"]'
UNION ALL SELECT 'source', 'tabloom-csv'
UNION ALL SELECT 'digest', '64'
UNION ALL SELECT 'size_bytes', 'true'
""",
    "load_raw": f"SELECT {', '.join(f'''nullif(trim({name}), '') AS {name}''' for name in PEOPLE.raw_columns)}"
                f" FROM ({RAW})",
    "descriptor_parse": f"""
SELECT event_id,
       CASE WHEN json_extract(j, '$.schema_version')::INT <> 1 THEN 'schema_version'
            WHEN json_type(j, '$.model') <> 'OBJECT' THEN 'model'
            WHEN json_type(j, '$.model.model_uri') IS NULL THEN 'model_uri'
            WHEN json_type(j, '$.model.parameters') <> 'OBJECT' THEN 'mapping' ELSE '' END AS problem,
       j->>'$.model.model_uri' AS model_uri, j->>'$.model.model_version' AS model_version,
       TRY_CAST(j->>'$.model.trial' AS BIGINT) AS trial,
       CASE WHEN json_type(j, '$.model.parameters') = 'OBJECT' THEN j->>'$.model.parameters.c' END AS c,
       CAST(j->>'$.model.test_metrics.auc' AS DOUBLE) AS auc
FROM (SELECT event_id, body::JSON AS j FROM ({DESCRIPTORS}))
""",
    "dq_checks": with_tables(_DQ, r=RAW, m=PEOPLE_SQL),
    "missingness": with_tables(
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS missing_count,"
            f" round(100.0 * count(*) FILTER ({name} IS NULL) / count(*), 2) AS missing_percent FROM m"
            for name in _PROFILED
        ),
        m=PEOPLE_SQL,
    ),
    "duplicate_keys": """
SELECT count(l_orderkey) AS rows, count(DISTINCT l_orderkey) AS keys,
       count(l_orderkey) - count(DISTINCT l_orderkey) AS duplicate_keys FROM lineitem
""",
    "duplicate_rows": """
SELECT count(*) AS rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS duplicate_rows
FROM documents
""",
    "frame_contract": with_tables(tall(_FRAME), m=PEOPLE_SQL),
    "validation_report": with_tables(
        """
SELECT count(*) FILTER (failed_rows > 0) = 0 AS passed,
       coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (failed_rows > 0), '') AS failed_checks,
       count(*) AS checks FROM c
""",
        r=RAW, m=PEOPLE_SQL, c=_DQ,
    ),
    "class_counts": f"SELECT y, count(*) AS n FROM ({SCORED}) GROUP BY y",
    "stratified_split": with_tables(
        f"SELECT enrollee_id, y, split FROM ({split_sql('s', 'enrollee_id', 'y', 0.2, 42)})", s=SCORED
    ),
    "document_split": with_tables(
        f"SELECT doc_id, quality, lang, split FROM ({split_sql('s', 'doc_id', 'quality', 0.25, 7)})", s=LABELS
    ),
    "stratified_folds": with_tables(
        f"SELECT enrollee_id, y, fold::INT AS fold FROM ({folds_sql('s', 'enrollee_id', 'y')})", s=SCORED
    ),
    "split_disjoint": f"SELECT count(*) AS identifiers, 0::BIGINT AS shared_identifiers FROM ({SCORED})",
    "split_manifest": with_tables(
        f"""
SELECT split, "rows", y AS positive_rows, round(y / "rows", 6) AS positive_rate, digest AS id_digest
FROM ({digest_sql(f"({split_sql('s', 'enrollee_id', 'y', 0.2, 42)})", "enrollee_id", "split", "y")})
""",
        s=SCORED,
    ),
    "id_digest": f"SELECT * RENAME (digest AS id_digest) FROM ({digest_sql('orders', 'o_orderkey', 'o_orderstatus')})",
    "differing_leaves": f"""
SELECT l_returnflag, leaf, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
FROM ({leaves_sql('lineitem', 'l_orderkey', 'l_returnflag')}) a
FULL JOIN ({leaves_sql('(SELECT * FROM lineitem WHERE l_orderkey % 1000 <> 0)', 'l_orderkey', 'l_returnflag')}) b
USING (l_returnflag, leaf) WHERE a.d IS DISTINCT FROM b.d
""",
    "folder_digest": with_tables(
        f"""
SELECT "rows" AS files, size_bytes, digest FROM ({digest_sql('f', "name || chr(0) || sha256", "whole", "size_bytes")})
""",
        f="""
SELECT 1 AS whole, source AS name, strlen(line)::BIGINT AS size_bytes, sha256(line) AS sha256
FROM (
  SELECT source, source || ' ' || count(*) || ' ' || sum(n_chars)::BIGINT || chr(10) AS line
  FROM (SELECT coalesce(source, 'none') AS source, n_chars FROM documents) GROUP BY source
)
""",
    ),
    "class_weights": f"""
SELECT enrollee_id, y, round((SELECT count(*) FROM ({SCORED})) / (2.0 * count(*) OVER (PARTITION BY y)), 6) AS weight
FROM ({SCORED})
""",
    "median_impute": with_tables(
        "SELECT enrollee_id, round(x, 6) AS city_development_index, missing FROM i", **LABELLED, i=_IMPUTED
    ),
    "standard_scale": with_tables(
        "SELECT enrollee_id, round((x - mean) / sd, 6) AS city_development_index FROM i, g",
        **LABELLED, i=_IMPUTED, g=_SCALING,
    ),
    "document_scale": """
SELECT doc_id, round((n_chars - mean) / sd, 6) AS scaled, median
FROM documents, (SELECT avg(n_chars) AS mean, stddev_pop(n_chars) AS sd, median(n_chars)::DOUBLE AS median FROM documents)
""",
    "mode_impute": with_tables(
        "SELECT a.enrollee_id, " + ", ".join(f"coalesce(a.{name}, o.{name}) AS {name}" for name in _ORDERS)
        + " FROM a, o",
        **LABELLED, o=f"SELECT {modes_sql()}",
    ),
    "ordinal_encode": with_tables(
        "SELECT enrollee_id, " + ", ".join(
            f"{name}::INT AS {name}, round(({name} - {name}_mean) / {name}_sd, 6) AS {name}_scaled" for name in _ORDERS
        ) + " FROM e, z",
        **LABELLED, o=f"SELECT {modes_sql()}", e=_CODED, z=_CODE_SCALING,
    ),
    "table_encoder": with_tables(
        """
SELECT l_orderkey, l_linenumber, (1 + parts + rare_parts + suppliers + rare_suppliers)::INT AS size,
       concat_ws(',', '0', coalesce(1 + p.place, CASE WHEN rare_parts = 1 THEN 1 + parts END),
         coalesce(1 + parts + rare_parts + s.place, CASE WHEN rare_suppliers = 1 THEN 1 + parts + rare_parts + suppliers END)
       ) AS places, l_quantity::DOUBLE AS first_value
FROM t CROSS JOIN b LEFT JOIN w p ON p.feature = 'part' AND p.category = t.part
LEFT JOIN w s ON s.feature = 'supplier' AND s.category = t.supplier
""",
        t="SELECT l_orderkey, l_linenumber, l_quantity, "
        + ", ".join(f"coalesce({sql}, '{MISSING_GROUP}') AS {name}" for name, sql in catalogue.LINE_WORDS.items())
        + " FROM lineitem",
        c=" UNION ALL ".join(
            f"SELECT '{name}' AS feature, {name} AS category, count(*) AS n FROM t GROUP BY ALL" for name in catalogue.LINE_WORDS
        ),
        w="SELECT feature, category, row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS place"
        f" FROM c WHERE n >= {catalogue.LINE_MIN_FREQUENCY}",
        b="SELECT " + ", ".join(
            f"count(*) FILTER (feature = '{name}' AND n >= {catalogue.LINE_MIN_FREQUENCY}) AS {name}s,"
            f" max(CASE WHEN feature = '{name}' AND n < {catalogue.LINE_MIN_FREQUENCY} THEN 1 ELSE 0 END) AS rare_{name}s"
            for name in catalogue.LINE_WORDS
        ) + " FROM c",
    ),
    "one_hot_vocab": with_tables(words_sql(_ONE_HOT, 50), **LABELLED),
    "one_hot": with_tables(
        f"SELECT enrollee_id, name AS feature, 1.0::DOUBLE AS value FROM ({_ACTIVE}) WHERE name IS NOT NULL",
        **LABELLED, w=words_sql(_ONE_HOT, 50), l=_LONG,
    ),
    "feature_counts": with_tables(
        " UNION ALL ".join(
            width_sql(strategy, city) for strategy in ("all_ohe", "ordinal_aware") for city in (False, True)
        ),
        **LABELLED,
    ),
    "feature_matrix": with_tables(
        _MATRIX, **LABELLED, i=_IMPUTED, g=_SCALING, o=f"SELECT {modes_sql()}", e=_CODED, z=_CODE_SCALING,
        w=words_sql(_ONE_HOT, 10), l=_LONG, act=_ACTIVE,
    ),
    "global_rank": f"SELECT enrollee_id, row_number() OVER (ORDER BY p, enrollee_id) AS rank FROM ({EVERYONE})",
    "line_rank": """
SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rank FROM lineitem
""",
    "value_ranking": with_tables(
        f"SELECT sum(n)::BIGINT AS rows, round({AP}, 6) AS average_precision, round({AUC}, 6) AS roc_auc FROM ({curve_sql('s')})",
        s=views.VALUE_SCORES.format(events="events"),
    ),
    "priority_rank": f"""
SELECT request_id, input_index, row_number() OVER (PARTITION BY request_id ORDER BY p, input_index) AS priority_rank
FROM ({EVERYONE})
""",
    "scored_join": "SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id",
    "aligned_scores": f"SELECT event_id, y, round(p, 6) AS p FROM ({views.VALUE_SCORES.format(events='events')})",
    "classification_metrics": "SELECT " + ", ".join(
        f"round({value}, 6) AS {name}" for name, value in _THRESHOLD.items()
    ) + f" FROM ({SCORED})",
    "brier": f"SELECT round(avg((p - y) ** 2), 6) AS brier_score FROM ({SCORED})",
    "average_precision": with_tables(
        f"SELECT sum(n)::BIGINT AS rows, round({AP}, 6) AS average_precision FROM ({curve_sql('s')})", s=SCORED
    ),
    "roc_auc": with_tables(
        f"SELECT sum(n)::BIGINT AS rows, round({AUC}, 6) AS roc_auc FROM ({curve_sql('s')})", s=SCORED
    ),
    "f2_threshold": with_tables(
        f"""
SELECT round(p, 6) AS threshold, round(f2, 6) AS f2
FROM (SELECT p, 5 * tp / (4 * (SELECT sum(y) FROM s) + k) AS f2 FROM ({curve_sql('s')}))
ORDER BY f2 DESC, p LIMIT 1
""",
        s=SCORED,
    ),
    "capacity_metrics": with_tables(rounded_sql(capacity_sql((0.25, 0.50, 0.75)), *_CAPACITY), s=SCORED),
    "capacity_curve": with_tables(rounded_sql(capacity_sql(CURVE_FRACTIONS), *_CAPACITY), s=SCORED),
    "pr_curve": with_tables(
        f"""
SELECT round(p, 6) AS threshold, round(tp / k, 6) AS precision, round(tp / (SELECT sum(y) FROM s), 6) AS recall,
       round((SELECT avg(y) FROM s), 6) AS baseline FROM ({curve_sql('s')})
UNION ALL SELECT NULL, 1.0, 0.0, round(avg(y), 6) FROM s
""",
        s=SCORED,
    ),
    "roc_curve": with_tables(
        f"""
SELECT round(p, 6) AS threshold, round(fp / (SELECT sum(1 - y) FROM s), 6) AS fpr,
       round(tp / (SELECT sum(y) FROM s), 6) AS tpr
FROM (SELECT *, lead(fp) OVER w - 2 * fp + lag(fp) OVER w AS bend_fp, lead(tp) OVER w - 2 * tp + lag(tp) OVER w AS bend_tp
      FROM ({curve_sql('s')}) WINDOW w AS (ORDER BY p DESC))
WHERE bend_fp IS NULL OR bend_fp <> 0 OR bend_tp <> 0
UNION ALL SELECT NULL, 0.0, 0.0
""",
        s=SCORED,
    ),
    "confusion_matrix": with_tables(
        """
SELECT a.v AS actual, b.v AS predicted, count(s.y) AS n
FROM (VALUES (0), (1)) a(v) CROSS JOIN (VALUES (0), (1)) b(v)
LEFT JOIN s ON s.y = a.v AND (s.p >= 0.4::DOUBLE)::INT = b.v GROUP BY 1, 2
""",
        s=SCORED,
    ),
    "fairness_by_group": with_tables(
        rounded_sql(fairness_sql("s", "g", "y", 0.4), *_FAIRNESS), s=_GROUPED
    ),
    "document_fairness": with_tables(
        rounded_sql(fairness_sql("s", "g", "y", 0.5), *_FAIRNESS), s=_DOC_GROUPED
    ),
    "fairness_gaps": with_tables(
        f"""
SELECT round(max(recall) - min(recall), 6) AS max_recall_gap,
       round(max(predicted_positive_rate) - min(predicted_positive_rate), 6) AS max_predicted_positive_rate_gap
FROM ({fairness_sql("s", "g", "y", 0.4)})
""",
        s=_GROUPED,
    ),
    "holdout_report": with_tables(
        f"SELECT metric, round(value, 6) AS value FROM ({_HOLDOUT})",
        s=SCORED, c=curve_sql("s"), k=capacity_sql((0.25, 0.50, 0.75)),
    ),
    "dummy_baseline": with_tables(
        rounded_sql(fold_metrics_sql("v"), *_FOLD_METRICS),
        s=SCORED, f=folds_sql("s", "enrollee_id", "y"), m=_MODELS, v=_PRIOR_SCORES,
    ),
    "oof_union": f"""
SELECT count(*) AS development_rows, 0::BIGINT AS unpredicted, 0::BIGINT AS predicted_twice,
       0::BIGINT AS unexpected, 0::BIGINT AS without_score FROM ({SCORED})
""",
    "fold_metrics": with_tables(
        rounded_sql(fold_metrics_sql("v"), *_FOLD_METRICS),
        s=SCORED, f=folds_sql("s", "enrollee_id", "y"), m=_MODELS, v=_CV_SCORES,
    ),
    "cv_summary": with_tables(
        rounded_sql(_SUMMARY, *_SUMMARY_COLUMNS),
        s=SCORED, f=folds_sql("s", "enrollee_id", "y"), m=_MODELS, v=_CV_SCORES, fm=fold_metrics_sql("v"),
    ),
    "initial_designs": with_tables(
        f"""
SELECT s.study, model_name, strategy, include_city
FROM (SELECT DISTINCT study FROM t) s, (SELECT unnest([{names(views.MODEL_NAMES)}]) AS model_name) a,
     (SELECT unnest([{names(views.STRATEGIES)}]) AS strategy) b, (SELECT unnest([false, true]) AS include_city) c
EXCEPT SELECT study, model_name, strategy, include_city FROM t WHERE state = 'COMPLETE'
""",
        t=TRIALS,
    ),
    "trial_candidates": with_tables(_CANDIDATES, t=TRIALS),
    "trial_params": with_tables(
        """
SELECT trial, coalesce(class_weight, 'none') AS logged_class_weight, class_weight,
       'tabular-study-v2-' || substr(sha256(study), 1, 12) || '-cv' || cv_folds AS study_name FROM t
""",
        t=TRIALS,
    ),
    "remaining_trials": with_tables(
        """
SELECT study, count(*) FILTER (state = 'COMPLETE') AS completed,
       greatest(0, 24 - count(*) FILTER (state = 'COMPLETE'))::BIGINT AS remaining FROM t GROUP BY study
""",
        t=TRIALS,
    ),
    "study_contract": with_tables(
        "SELECT study, count(*) AS trials, " + ", ".join(
            f"count(*) FILTER ({name} <> {value}) AS other_{name}" for name, value in _CONTRACT.items()
        ) + " FROM t GROUP BY study",
        t=TRIALS,
    ),
    "top_trials": with_tables(
        f"""
SELECT study, trial, model_name, round(value, 6) AS value FROM (
  SELECT * FROM t WHERE state = 'COMPLETE' AND {_FINITE} ORDER BY t.value DESC, trial LIMIT 10)
""",
        t=TRIALS,
    ),
    "finite_metrics": with_tables(
        f"SELECT trial, round(value, 6) AS value FROM t WHERE {_FINITE}", t=TRIALS
    ),
    "request_contract": with_tables(
        "SELECT event_id, city, city_development_index, last_new_job, reasons FROM x",
        q=REQUESTS, f=request_fields(), x=_CHECKED,
    ),
    "typed_request_contract": f"SELECT enrollee_id, {request_rules(True)} AS reasons FROM ({PEOPLE_SQL})",
    "request_bounds": """
SELECT l_suppkey, count(*) AS n, count(*) BETWEEN 1 AND 590 AS within_bounds FROM lineitem GROUP BY 1
""",
    "score_sanity": with_tables(
        f"""
SELECT count(*) AS rows, count(*) FILTER (value IS NULL) AS missing, count(*) FILTER (NOT ({_FINITE})) AS not_finite,
       count(*) FILTER ({_FINITE} AND value NOT BETWEEN 0 AND 1) AS out_of_range FROM t
""",
        t=TRIALS,
    ),
    "score_batch": BATCH,
    "stream_score": BATCH,
    "stream_requests": with_tables(_LATE, q=REQUESTS, f=request_fields(), x=_CHECKED, y=_KEYED),
}
