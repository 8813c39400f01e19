"""SQL with the same results as the queries, for a checker with the test tables as views.

Written independently of the operators: global windows, cross joins with grids and
other forms that are fine for a small check and wrong at scale.
"""

from __future__ import annotations

from ..schema import CATEGORICAL_FEATURES, FEATURES, IDENTIFIERS, TARGET
from ..sources.testtables import CONTRACT_SQL, CORE_SQL, LABEL, SCORE, WIDE_SQL

ORACLES: dict[str, str] = {}

# Fixed values of the contract, stated here once more so that a wrong table of the library shows.
THRESHOLD = 0.24
LIMITS = [0.24, 0.40, 0.50]
BAND_TEXTS = {
    "risk_band": ["Lower Fraud Risk", "Elevated Fraud Risk", "High Review Priority", "Very High Review Priority"],
    "review_priority": ["Standard", "Elevated", "High", "Priority"],
    "recommended_action": ["Standard Claim Processing", "Additional Verification", "Fraud Analyst Review",
                           "Priority Fraud Investigation"],
    "business_interpretation": [
        "The model score is below the validated fraud-review threshold. Continue normal verification and processing.",
        "Perform enhanced standard checks, including supporting-document, policy-information, and claim-detail verification.",
        "Route the claim to the fraud team's investigation queue for analyst review.",
        "Give the claim higher priority within the fraud-investigation queue."],
}
DISCLAIMER = "This model provides a risk signal for investigation support and does not establish that a claim is fraudulent."
AGE_CASE = ("CASE WHEN {a} = 0 THEN '16 to 17' WHEN {a} < 16 THEN NULL WHEN {a} <= 17 THEN '18 to 20' WHEN {a} <= 20 THEN '21 to 25' "
            "WHEN {a} <= 25 THEN '26 to 30' WHEN {a} <= 35 THEN '31 to 35' WHEN {a} <= 45 THEN '36 to 40' WHEN {a} <= 55 THEN '41 to 50' "
            "WHEN {a} <= 65 THEN '51 to 65' WHEN {a} <= 80 THEN 'over 65' END")
CODES = {  # answers in the order of their codes, with the first code
    "VehiclePrice": (1, "less than 20000|20000 to 29000|30000 to 39000|40000 to 59000|60000 to 69000|more than 69000"),
    "Days_Policy_Accident": (0, "none|1 to 7|8 to 15|15 to 30|more than 30"),
    "Days_Policy_Claim": (0, "none|8 to 15|15 to 30|more than 30"),
    "PastNumberOfClaims": (0, "none|1|2 to 4|more than 4"),
    "AgeOfVehicle": (0, "new||2 years|3 years|4 years|5 years|6 years|7 years|more than 7"),
    "AgeOfPolicyHolder": (1, "16 to 17|18 to 20|21 to 25|26 to 30|31 to 35|36 to 40|41 to 50|51 to 65|over 65"),
    "NumberOfSuppliments": (0, "none|1 to 2|3 to 5|more than 5"),
    "AddressChange_Claim": (0, "no change|under 6 months|1 year|2 to 3 years|4 to 8 years"),
    "NumberOfCars": (1, "1 vehicle|2 vehicles|3 to 4|5 to 8|more than 8"),
}
FORM_LISTS = {c: [a for a in answers.split("|") if a and a != "18 to 20"] for c, (_, answers) in CODES.items()} | {
    c: "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec".split("|") for c in ("Month", "MonthClaimed")} | {
    c: "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday".split("|") for c in ("DayOfWeek", "DayOfWeekClaimed")}

CORE = f"core AS ({CORE_SQL})"
WIDE = f"wide AS ({WIDE_SQL})"
CONTRACT = f"contract AS ({CONTRACT_SQL})"
NUMERIC = ["age", "o_totalprice", "c_acctbal"]
CATEGORIES = ["claim_weekday", "c_mktsegment", "n_name", "o_orderpriority"]
MODEL = NUMERIC + CATEGORIES


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def union(parts) -> str:
    return " UNION ALL ".join(parts)


# ---- shared pieces -------------------------------------------------------------------

def split_parts(base: str, label: str, key: str, held: str = "0.3", second: str | None = "0.5") -> list[str]:
    """CTEs ending in ``assigned`` = base plus split."""
    parts = [
        f"sizes AS (SELECT {label} AS y, count(*) AS n FROM {base} GROUP BY 1)",
        f"whole AS (SELECT sum(n) - ceil({held}::DOUBLE * sum(n)) AS t, sum(n) AS n FROM sizes)",
        "share1 AS (SELECT y, s.n, s.n * w.t / w.n AS x, floor(s.n * w.t / w.n) AS b, w.t FROM sizes s, whole w)",
        "cut1 AS (SELECT y, n, b + CASE WHEN row_number() OVER (ORDER BY round(x - b, 9) DESC, y DESC) "
        "<= t - sum(b) OVER () THEN 1 ELSE 0 END AS c1 FROM share1)",
    ]
    if second:
        parts += [
            "rest AS (SELECT y, n, c1, n - c1 AS m, sum(n - c1) OVER () AS l FROM cut1)",
            f"share2 AS (SELECT *, m * (l - ceil({second}::DOUBLE * l)) / l AS x, "
            f"floor(m * (l - ceil({second}::DOUBLE * l)) / l) AS b, l - ceil({second}::DOUBLE * l) AS t FROM rest)",
            "cuts AS (SELECT y, c1, c1 + b + CASE WHEN row_number() OVER (ORDER BY round(x - b, 9) DESC, y DESC) "
            "<= t - sum(b) OVER () THEN 1 ELSE 0 END AS c2 FROM share2)",
        ]
        case = "CASE WHEN r <= c1 THEN 'train' WHEN r <= c2 THEN 'validation' ELSE 'test' END"
    else:
        parts.append("cuts AS (SELECT y, c1 FROM cut1)")
        case = "CASE WHEN r <= c1 THEN 'train' ELSE 'test' END"
    return parts + [
        f"hashed AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(concat('42:', {key}))) AS r FROM {base})",
        f"assigned AS (SELECT h.* EXCLUDE (r), {case} AS split FROM hashed h JOIN cuts ON h.{label} = cuts.y)",
    ]


REPAIRED = ("repaired AS (SELECT claim_id, label, age, o_totalprice, c_acctbal, CASE WHEN claim_weekday = '0' THEN 'Unknown' "
            "ELSE claim_weekday END AS claim_weekday, c_mktsegment, n_name, o_orderpriority FROM wide)")


def code_parts(source: str, fit: str, columns: list[str]) -> list[str]:
    """CTE ``coded``: source with 0-based codes along the sorted distinct values of ``fit``."""
    parts, joins, picks = [], "", []
    for c in columns:
        parts.append(f"v_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS k FROM "
                     f"(SELECT DISTINCT {c} FROM {fit} WHERE {c} IS NOT NULL))")
        joins += f" LEFT JOIN v_{c} ON b.{c} = v_{c}.v"
        picks.append(f"coalesce(v_{c}.k, -1) AS {c}")
    return parts + [f"coded AS (SELECT b.* REPLACE ({', '.join(picks)}) FROM {source} b{joins})"]


FITTED = [WIDE, REPAIRED, *split_parts("repaired", "label", "claim_id"),
          "train AS (SELECT * FROM assigned WHERE split = 'train')",
          *code_parts("assigned", "train", CATEGORIES),
          "params AS (SELECT " + ", ".join(
              f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS d_{c}" for c in MODEL)
          + " FROM coded WHERE split = 'train')"]
SCALED = FITTED + ["scaled AS (SELECT claim_id, label, split, " + ", ".join(
    f"({c} - m_{c}) / d_{c} AS {c}" for c in MODEL) + " FROM coded, params)"]


def decile_sql(base: str, score: str, label: str, key: str) -> str:
    return (f"ranked AS (SELECT {label} AS y, row_number() OVER (ORDER BY {score} DESC, {key}) AS r, "
            f"count(*) OVER () AS n FROM {base}), "
            "parts AS (SELECT CAST((r * 10 + n - 1) // n AS INTEGER) AS decile, count(*) AS claims, sum(y) AS f "
            "FROM ranked GROUP BY 1), overall AS (SELECT avg(y::DOUBLE) AS p FROM ranked) "
            "SELECT d.decile, coalesce(claims, 0)::BIGINT AS claims, coalesce(f, 0)::BIGINT AS fraud_cases, "
            "round(coalesce(f / claims::DOUBLE, 0), 9) AS fraud_rate, "
            "round(CASE WHEN p > 0 THEN coalesce(f / claims::DOUBLE, 0) / p ELSE 0 END, 9) AS lift "
            "FROM (SELECT CAST(i AS INTEGER) AS decile FROM range(1, 11) t(i)) d "
            "LEFT JOIN parts USING (decile), overall")


def capacity_sql(percentages) -> str:
    shares = union(f"SELECT {float(p)}::DOUBLE AS percentage" for p in percentages)
    return with_(
        CORE, "ranked AS (SELECT label, row_number() OVER (ORDER BY score DESC, claim_id) AS r FROM core)",
        "total AS (SELECT count(*) AS n, sum(label) AS f FROM core)", f"share AS ({shares})",
        "sized AS (SELECT percentage, n, f, least(n, greatest(1, ceil(n * percentage / 100.0::DOUBLE)))::BIGINT AS k "
        "FROM share, total)",
        "got AS (SELECT percentage, any_value(k) AS k, any_value(n) AS n, any_value(f) AS f, "
        "sum(CASE WHEN r <= k THEN label ELSE 0 END) AS s FROM sized, ranked GROUP BY percentage)")


CAPACITY_COLUMNS = (
    "SELECT percentage, k AS claims_reviewed, s::BIGINT AS fraud_selected, n::BIGINT AS total_claims, "
    "f::BIGINT AS total_fraud, round(s / f::DOUBLE, 9) AS fraud_capture, round(s / k::DOUBLE, 9) AS precision, "
    f"round((s / k::DOUBLE) / (f / n::DOUBLE), 9) AS lift, 'ceil(K% × total claims)' AS rounding FROM got")


def ranking_parts(base: str, score: str, by: str) -> list[str]:
    """CTE ``ranking`` = by, roc_auc, pr_auc."""
    return [
        f"g AS (SELECT {by}, {score} AS s, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS tp FROM {base} GROUP BY {by}, {score})",
        f"c AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY s DESC) AS cn, sum(tp) OVER (PARTITION BY {by} ORDER BY s DESC) "
        f"AS ct, sum(n) OVER (PARTITION BY {by}) AS tn_, sum(tp) OVER (PARTITION BY {by}) AS tt FROM g)",
        f"ranking AS (SELECT {by}, sum((n - tp) * (ct - tp + tp / 2)) / (max(tt) * (max(tn_) - max(tt))) AS roc_auc, "
        f"sum(tp * (ct / cn)) / max(tt) AS pr_auc FROM c GROUP BY {by})",
    ]


GRID = "grid AS (SELECT CAST(i AS INTEGER) AS grid_index, 0.1::DOUBLE + i * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS t FROM range(81) r(i))"
PLOT = ("grid AS (SELECT CAST(i AS INTEGER) AS grid_index, CASE WHEN i = 79 THEN 0.9::DOUBLE ELSE "
        "i * ((0.9::DOUBLE - 0.1::DOUBLE) / 79::DOUBLE) + 0.1::DOUBLE END AS t FROM range(80) r(i))")


def sweep_parts(base: str, score: str, by: str | None = None, grid: str = GRID) -> list[str]:
    """CTE ``swept`` = by, grid_index, t, counts and smoothed recall, precision, f1."""
    keys = (by + ", " if by else "") + "grid_index, t"
    return [
        grid,
        f"counted AS (SELECT {keys}, count(*) FILTER (WHERE {score} >= t AND label = 1) AS tp, "
        f"count(*) FILTER (WHERE {score} >= t AND label = 0) AS fp, count(*) FILTER (WHERE {score} < t AND label = 1) AS fn, "
        f"count(*) FILTER (WHERE {score} < t AND label = 0) AS tn FROM {base}, grid GROUP BY {keys})",
        "smooth AS (SELECT *, tp / (tp + fn + 1e-8::DOUBLE) AS recall, tp / (tp + fp + 1e-8::DOUBLE) AS precision, "
        "(tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy FROM counted)",
        "swept AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8::DOUBLE) AS f1 FROM smooth)",
    ]


RATIOS = ("round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy, "
          "round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 9) AS precision, "
          "round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 9) AS recall, "
          "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 9) AS f1")


def counts_sql(base: str, score: str, threshold: str, by: str = "") -> str:
    group = f" GROUP BY {by}" if by else ""
    return (f"SELECT {by + ', ' if by else ''}count(*) FILTER (WHERE {score} < {threshold} AND label = 0) AS tn, "
            f"count(*) FILTER (WHERE {score} >= {threshold} AND label = 0) AS fp, "
            f"count(*) FILTER (WHERE {score} < {threshold} AND label = 1) AS fn, "
            f"count(*) FILTER (WHERE {score} >= {threshold} AND label = 1) AS tp FROM {base}{group}")


def band_case(score: str, field: str) -> str:
    texts = BAND_TEXTS[field]
    whens = " ".join(f"WHEN {score} < {limit}::DOUBLE THEN {text(t)}" for limit, t in zip(LIMITS, texts))
    return f"CASE {whens} ELSE {text(texts[-1])} END"


# ---- sources -----------------------------------------------------------------------------

ALL = [*FEATURES, *IDENTIFIERS, TARGET]
ORACLES["claims_scan"] = with_(CONTRACT) + f"SELECT {', '.join(ALL)} FROM contract"
ORACLES["csv_roundtrip"] = ORACLES["claims_scan"]
ORACLES["claims_overview"] = with_(CORE) + (
    "SELECT count(*) AS rows, sum(label)::BIGINT AS positives, round(avg(label) * 100, 9) AS positive_rate FROM core")
ORACLES["upload_scan"] = with_(CONTRACT) + "SELECT PolicyNumber, Month, Days_Policy_Accident, Deductible FROM contract"
ORACLES["report_roundtrip"] = with_(CORE)[:-1] + ", " + decile_sql("core", "score", "label", "claim_id")
ORACLES["split_roundtrip"] = with_(CORE, *split_parts("core", "label", "claim_id")) + (
    "SELECT split, count(*) AS n, sum(claim_id)::BIGINT AS id_sum, sum(age)::BIGINT AS age_sum FROM assigned GROUP BY split")
ORACLES["stored_params"] = with_(*FITTED) + union(
    [f"SELECT '{'numeric' if c in NUMERIC else 'categorical'}' AS kind, '{c}' AS feature, {i} AS position, "
     "NULL::VARCHAR AS text, NULL::DOUBLE AS number" for i, c in enumerate(MODEL)]
    + [f"SELECT 'mean', '{c}', {i}, NULL, round(m_{c}, 4) FROM params" for i, c in enumerate(MODEL)]
    + [f"SELECT 'deviation', '{c}', {i}, NULL, round(d_{c}, 4) FROM params" for i, c in enumerate(MODEL)]
    + [f"SELECT 'category', '{c}', k::INTEGER, v, NULL FROM v_{c}" for c in CATEGORIES])

# ---- projections and cleaning --------------------------------------------------------------

ORACLES["sample_rows"] = with_(CORE) + "SELECT claim_id, label, age FROM core ORDER BY claim_id LIMIT 10"
ORACLES["class_subset"] = with_(CORE) + "SELECT claim_id, age, claim_weekday FROM core WHERE label = 1"

REQUESTS = ("requests AS (SELECT * REPLACE (CASE WHEN PolicyNumber % 101 = 0 THEN 'unknown' WHEN PolicyNumber % 103 = 0 THEN ' ' "
            "WHEN PolicyNumber % 107 = 0 THEN '99' ELSE CAST(Age AS VARCHAR) END AS Age, "
            "CASE WHEN PolicyNumber % 109 <> 0 THEN Sex END AS Sex) FROM contract)")


def problems(derive: str) -> str:
    """Problem list in feature order: blank fields, then a bad number, then an age outside all bands."""
    return ("concat_ws('; ', CASE WHEN Sex IS NULL THEN 'Sex is required' END, "
            "CASE WHEN trim(Age) = '' THEN 'Age is required' END, "
            "CASE WHEN try_cast(Age AS DOUBLE) IS NULL AND trim(Age) <> '' THEN 'Age must be numeric' END"
            + (f", CASE WHEN {derive} AND try_cast(Age AS DOUBLE) IS NOT NULL AND {AGE_CASE.format(a='try_cast(Age AS DOUBLE)')} "
               "IS NULL THEN 'Age must be between 16 and 80, or 0' END" if derive else "") + ")")


BAND = AGE_CASE.format(a="try_cast(Age AS DOUBLE)")
ORACLES["request_frame"] = with_(CONTRACT, REQUESTS) + (
    f"SELECT PolicyNumber, Make, Age, {BAND} AS AgeOfPolicyHolder, {problems('TRUE')} AS problems FROM requests")
ORACLES["positional_requests"] = with_(CONTRACT, REQUESTS) + (
    "SELECT PolicyNumber, CASE WHEN PolicyNumber % 3 < 2 THEN Make END AS Make, "
    "CASE WHEN PolicyNumber % 3 < 2 THEN BasePolicy END AS BasePolicy, "
    f"CASE PolicyNumber % 3 WHEN 0 THEN AgeOfPolicyHolder WHEN 1 THEN {BAND} END AS AgeOfPolicyHolder, "
    f"CASE WHEN PolicyNumber % 3 = 2 THEN 'Expected 28 visible claim fields' "
    "ELSE concat_ws('; ', CASE WHEN Sex IS NULL THEN 'Sex is required' END, "
    "CASE WHEN trim(Age) = '' THEN 'Age is required' END, "
    "CASE WHEN try_cast(Age AS DOUBLE) IS NULL AND trim(Age) <> '' THEN 'Age must be numeric' END, "
    f"CASE WHEN PolicyNumber % 3 = 1 AND try_cast(Age AS DOUBLE) IS NOT NULL AND {BAND} IS NULL THEN "
    "'Age must be between 16 and 80, or 0' END) END AS problems "
    "FROM requests")
ORACLES["rejects"] = with_(CONTRACT, REQUESTS) + (
    f"SELECT PolicyNumber, {problems('')} AS problems FROM requests WHERE {problems('')} <> ''")
ORACLES["scoring_rejects"] = with_(CONTRACT, "checked AS (SELECT PolicyNumber, PolicyNumber % 113 = 0 AS malformed, "
    "CASE WHEN PolicyNumber % 113 = 0 THEN 'malformed record' ELSE concat_ws('; ', CASE WHEN PolicyNumber % 107 = 0 THEN 'Sex is required' END, "
    "CASE WHEN PolicyNumber % 109 = 0 THEN 'DriverRating is required' END, "
    "CASE WHEN PolicyNumber % 103 = 0 OR PolicyNumber % 101 = 0 THEN 'Age must be numeric' END) END AS problems FROM contract)") + (
    "SELECT * FROM checked WHERE problems <> ''")
ORACLES["clean_claims"] = with_(CONTRACT) + (
    "SELECT PolicyNumber, CASE WHEN DayOfWeekClaimed = '0' THEN 'Unknown' ELSE DayOfWeekClaimed END AS DayOfWeekClaimed, "
    "CASE WHEN MonthClaimed = '0' THEN 'Unknown' ELSE MonthClaimed END AS MonthClaimed, "
    "CASE WHEN Age = 0 THEN 40.0 ELSE Age END::DOUBLE AS Age FROM contract")
ORACLES["age_fill"] = with_(CONTRACT, *split_parts("contract", TARGET, "PolicyNumber")) + (
    "SELECT median(Age)::DOUBLE AS age_fill FROM assigned WHERE split = 'train' AND Age <> 0")
ORACLES["age_band"] = with_(CORE) + f"SELECT claim_id, age, {AGE_CASE.format(a='age')} AS band FROM core"
ORACLES["alias_repair"] = with_(CONTRACT) + (
    "SELECT PolicyNumber, CASE WHEN Make = 'Porche' THEN 'Porsche' ELSE Make END AS form_make, Make AS data_make FROM contract")

# ---- profiling -------------------------------------------------------------------------------

ORACLES["class_balance"] = with_(CORE) + (
    "SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 9) AS percent, "
    "(SELECT floor(count(*) FILTER (WHERE label = 0) / (count(*) FILTER (WHERE label = 1))::DOUBLE)::BIGINT FROM core) AS ratio "
    "FROM core GROUP BY label")
_NULLS = "joined AS (SELECT d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
ORACLES["null_counts"] = with_(_NULLS) + union(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls FROM joined" for c in ("lang", "source", "quality", "toxic"))
ORACLES["distinct_values"] = with_(CONTRACT) + union(
    f"SELECT '{c}' AS feature, count(*) AS distinct_values, "
    f"array_to_string((list(v ORDER BY v))[1:8], '|') AS first_values FROM (SELECT DISTINCT {c} AS v FROM contract)"
    for c in CATEGORICAL_FEATURES)
ORACLES["anomaly_counts"] = with_(CONTRACT) + (
    "SELECT count(*) FILTER (WHERE Age = 0) AS age_zero, count(*) FILTER (WHERE DayOfWeekClaimed = '0') AS weekday_zero, "
    "count(*) FILTER (WHERE PolicyNumber % 89 = 0) AS unmapped_answers, "
    "count(*) FILTER (WHERE PolicyNumber % 89 = 0) AS nulls_after_coding FROM contract")


def rate_sql(source: str, columns: list[str], label: str) -> str:
    return union(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n, sum({label})::BIGINT AS positives, "
                 f"round(avg({label}), 9) AS rate FROM {source} GROUP BY {c}" for c in columns)


DOCS = "docs AS (SELECT l.doc_id, l.toxic, d.lang, d.source, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
ORACLES["fraud_rate_by_segment"] = with_(WIDE) + rate_sql("wide", CATEGORIES, "label")
ORACLES["document_rates"] = with_(DOCS) + rate_sql("docs", ["lang", "source"], "toxic")
ORACLES["numeric_describe"] = with_(WIDE) + union(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS std, "
    f"round(min({c})::DOUBLE, 2) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 2) AS q25, "
    f"round(quantile_cont({c}::DOUBLE, 0.5), 2) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 2) AS q75, "
    f"round(max({c})::DOUBLE, 2) AS max FROM wide" for c in NUMERIC)
ORACLES["merged_profile"] = with_(WIDE) + union([
    f"SELECT '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS missing, round(min({c})::DOUBLE, 2) AS low, "
    f"round(max({c})::DOUBLE, 2) AS high, count(DISTINCT {c}) AS distinct_exact, true AS distinct_close, true AS quartiles_close, "
    f"NULL::VARCHAR AS frequent FROM wide" for c in NUMERIC] + [
    f"SELECT '{c}', count(*), count(*) - count({c}), NULL, NULL, count(DISTINCT {c}), true, NULL, (SELECT string_agg(v || ':' || n, '|' "
    f"ORDER BY n DESC, v) FROM (SELECT {c}::VARCHAR AS v, count(*) AS n FROM wide WHERE {c} IS NOT NULL GROUP BY 1 "
    f"ORDER BY n DESC, v LIMIT 8)) FROM wide" for c in CATEGORIES])
_CORR = [*NUMERIC, "label"]
ORACLES["correlation_matrix"] = with_(WIDE) + union(
    f"SELECT '{_CORR[j]}' AS feature_a, '{_CORR[i]}' AS feature_b, round(corr({_CORR[j]}, {_CORR[i]}), 9) AS correlation FROM wide"
    for i in range(len(_CORR)) for j in range(i + 1, len(_CORR)))
ORACLES["vector_correlations"] = (
    "SELECT 'place_' || (j - 1) AS feature_a, 'place_' || (i - 1) AS feature_b, count(*) FILTER (embedding[i] IS NOT NULL AND "
    "embedding[j] IS NOT NULL) AS n, round(corr(embedding[i]::DOUBLE, embedding[j]::DOUBLE), 7) AS correlation FROM embeddings, "
    "(SELECT unnest(range(1, (SELECT max(len(embedding)) FROM embeddings) + 1)) AS i) a, "
    "(SELECT unnest(range(1, (SELECT max(len(embedding)) FROM embeddings) + 1)) AS j) b WHERE i < j GROUP BY i, j")
ORACLES["histogram_by_class"] = with_(
    WIDE,
    "long AS (" + union(f"SELECT '{c}' AS feature, label, {c}::DOUBLE AS v FROM wide" for c in NUMERIC) + ")",
    "span AS (SELECT feature, label, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2)",
    "edges AS (SELECT feature, label, CAST(i AS INTEGER) AS bin, i * ((hi - lo) / 20) + lo AS a, "
    "CASE WHEN i = 19 THEN hi ELSE (i + 1) * ((hi - lo) / 20) + lo END AS b FROM span, range(20) r(i))") + (
    "SELECT e.feature, e.label, e.bin, round(e.a, 4) AS left_edge, round(e.b, 4) AS right_edge, count(l.v) AS n "
    "FROM edges e LEFT JOIN long l ON l.feature = e.feature AND l.label = e.label AND l.v >= e.a "
    "AND (l.v < e.b OR (e.bin = 19 AND l.v <= e.b)) GROUP BY 1, 2, 3, 4, 5")

# ---- splitting and encoding ------------------------------------------------------------------------

ORACLES["stratified_split"] = with_(CORE, *split_parts("core", "label", "claim_id")) + "SELECT claim_id, label, split FROM assigned"
_COUNTS = ("SELECT split, count(*) AS n, sum(label)::BIGINT AS positives, count(*) FILTER (WHERE label = 0) AS negatives "
           "FROM assigned GROUP BY split")
ORACLES["split_counts"] = with_(CORE, *split_parts("core", "label", "claim_id")) + _COUNTS
ORACLES["split_80_20"] = with_(CORE, *split_parts("core", "label", "claim_id", "0.2", None)) + _COUNTS
ORACLES["split_hashed"] = with_(
    CORE, "placed AS (SELECT claim_id, ('0x' || substr(md5(concat('42:', claim_id)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS p FROM core)") + (
    "SELECT claim_id, CASE WHEN p < 1 - 0.15::DOUBLE - 0.15::DOUBLE THEN 'train' "
    "WHEN p < 1 - 0.15::DOUBLE - 0.15::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM placed")
_DAYS = f"days AS (SELECT o_orderkey AS claim_id, {LABEL} AS label, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"
ORACLES["category_codes"] = with_(
    _DAYS, *split_parts("days", "label", "claim_id"), "train AS (SELECT * FROM assigned WHERE split = 'train')",
    *code_parts("assigned", "train", ["day"])) + "SELECT claim_id, day::INTEGER AS code FROM coded WHERE split <> 'train'"
ORACLES["category_lists"] = with_(CONTRACT) + union(
    f"SELECT '{c}' AS feature, v AS value, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code "
    f"FROM (SELECT DISTINCT {c} AS v FROM contract)" for c in CATEGORICAL_FEATURES)
ORACLES["ordinal_codes"] = with_(CONTRACT) + "SELECT PolicyNumber, " + ", ".join(
    f"CASE {c} " + " ".join(f"WHEN {text(a)} THEN {first + k}" for k, a in enumerate(answers.split("|")) if a) + f" END AS {c}"
    for c, (first, answers) in CODES.items()) + " FROM contract"
ORACLES["label_codes"] = with_(WIDE, *code_parts("wide", "wide", CATEGORIES)) + (
    "SELECT claim_id, " + ", ".join(f"{c}::INTEGER AS {c}" for c in CATEGORIES) + " FROM coded")
_FREE = [c for c in CATEGORICAL_FEATURES if c not in FORM_LISTS]
ORACLES["category_dictionary"] = with_(CONTRACT) + union(
    [f"SELECT '{c}' AS feature, (row_number() OVER (ORDER BY v) - 1)::INTEGER AS position, "
     f"CASE WHEN v = 'Porche' THEN 'Porsche' ELSE v END AS answer FROM (SELECT DISTINCT {c} AS v FROM contract "
     f"WHERE {c} NOT IN ('Unknown', '18 to 20'))" for c in _FREE]
    + [f"SELECT '{c}', {i}, {text(v)}" for c in CATEGORICAL_FEATURES if c in FORM_LISTS
       for i, v in enumerate(FORM_LISTS[c])])
ORACLES["scaler_params"] = with_(*FITTED) + union(
    f"SELECT '{c}' AS feature, round(m_{c}, 4) AS mean, round(d_{c}, 4) AS deviation FROM params" for c in MODEL)
ORACLES["scaled_features"] = with_(*SCALED) + "SELECT claim_id, split, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in MODEL) + " FROM scaled"
ORACLES["legacy_prepared"] = with_(
    WIDE, *code_parts("wide", "wide", CATEGORIES),
    "params AS (SELECT " + ", ".join(f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS d_{c}" for c in MODEL)
    + " FROM coded)") + "SELECT claim_id, " + ", ".join(
    f"round(({c} - m_{c}) / d_{c}, 6) AS {c}" for c in MODEL) + " FROM coded, params"

# ---- resampling --------------------------------------------------------------------------------------

ORACLES["neighbours"] = with_(
    WIDE, "p AS (SELECT claim_id AS id, age / 20::DOUBLE AS a, o_totalprice / 100000 AS b, c_acctbal / 3000 AS c FROM wide WHERE label = 1)",
    "d AS (SELECT x.id, y.id AS other, round((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c), 9) AS dist "
    "FROM p x JOIN p y ON x.id <> y.id)",
    "r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, other) AS place FROM d)") + (
    "SELECT id AS claim_id, place::INTEGER AS place, other AS neighbour_id, round(dist, 6) AS distance FROM r WHERE place <= 5")
ORACLES["neighbour_index"] = ORACLES["neighbours"]
_SQUARES = " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in MODEL)
SMOTE = SCALED + [
    "minor AS (SELECT *, row_number() OVER (ORDER BY claim_id) - 1 AS j FROM scaled WHERE split = 'train' AND label = 1)",
    "goal AS (SELECT (SELECT count(*) FROM minor) AS m, floor(0.5 * (SELECT count(*) FROM scaled WHERE split = 'train' AND label = 0) "
    "- (SELECT count(*) FROM minor))::BIGINT AS g)",
    f"pairs AS (SELECT x.claim_id AS id, y.claim_id AS other, round({_SQUARES}, 9) AS dist FROM minor x JOIN minor y ON x.claim_id <> y.claim_id)",
    "placed AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, other) AS place FROM pairs)",
    "made AS (SELECT i % m AS j, i // m AS copy FROM goal, range((SELECT g FROM goal)) r(i))",
]
ORACLES["smote_rows"] = with_(*SMOTE) + (
    "SELECT b.claim_id AS base_id, n.claim_id AS neighbour_id, made.copy::INTEGER AS copy, 1 AS label, " + ", ".join(
        f"round(b.{c} + u * (n.{c} - b.{c}), 6) AS {c}" for c in MODEL)
    + " FROM (SELECT made.*, claim_id AS cid, ('0x' || substr(md5(concat('42:', claim_id, ':', copy)), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u "
      "FROM made JOIN minor USING (j)) made JOIN minor b ON b.j = made.j "
      "JOIN placed q ON q.id = b.claim_id AND q.place = made.copy % 5 + 1 JOIN minor n ON n.claim_id = q.other")
_TRAIN = with_(CORE, *split_parts("core", "label", "claim_id"),
               "k AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q FROM assigned WHERE split = 'train')")
ORACLES["smote_counts"] = _TRAIN + union(
    f"SELECT 1 AS label, {r}::DOUBLE AS ratio, floor({r}::DOUBLE * q - p)::BIGINT + p AS n, floor({r}::DOUBLE * q - p)::BIGINT AS synthetic FROM k "
    f"UNION ALL SELECT 0, {r}::DOUBLE, q, 0 FROM k" for r in (0.10, 0.15, 0.20, 0.25, 0.50))
ORACLES["prepared_training"] = _TRAIN + (
    "SELECT 'train' AS part, p + q + floor(0.5::DOUBLE * q - p)::BIGINT AS n, p + floor(0.5::DOUBLE * q - p)::BIGINT AS positives FROM k "
    "UNION ALL SELECT 'train_original', p + q, p FROM k "
    "UNION ALL SELECT split, count(*), sum(label)::BIGINT FROM assigned WHERE split <> 'train' GROUP BY split")

# ---- metrics and thresholds ------------------------------------------------------------------------------

ORACLES["confusion"] = with_(CORE) + counts_sql("core", "score", f"{THRESHOLD}::DOUBLE")
_ONE = "one AS (SELECT 0 AS m, score, label FROM core)"
ORACLES["metrics_at_threshold"] = with_(
    CORE, _ONE, *ranking_parts("one", "score", "m"), f"k AS ({counts_sql('core', 'score', '0.5::DOUBLE')})") + (
    f"SELECT {RATIOS}, round(roc_auc, 9) AS roc_auc, round(pr_auc, 9) AS pr_auc, 0.5::DOUBLE AS threshold, tn, fp, fn, tp FROM k, ranking")
ORACLES["class_report"] = with_(CORE, f"k AS ({counts_sql('core', 'score', '0.4::DOUBLE')})") + union(
    f"SELECT '{name}' AS class, round({hit} / nullif({hit} + {wrong}, 0)::DOUBLE, 9) AS precision, "
    f"round({hit} / nullif({hit} + {missed}, 0)::DOUBLE, 9) AS recall, "
    f"round(2 * {hit} / nullif(2 * {hit} + {wrong} + {missed}, 0)::DOUBLE, 9) AS f1, {hit} + {missed} AS support, "
    "round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy FROM k"
    for name, hit, wrong, missed in (("Legitimate", "tn", "fn", "fp"), ("Fraud", "tp", "fp", "fn")))
_RANKING = with_(CORE, _ONE, *ranking_parts("one", "score", "m"))
ORACLES["roc_auc"] = _RANKING + "SELECT round(roc_auc, 9) AS roc_auc FROM ranking"
ORACLES["average_precision"] = _RANKING + "SELECT round(pr_auc, 9) AS pr_auc FROM ranking"
ORACLES["roc_points"] = _RANKING + (
    "SELECT round((cn - ct) / (tn_ - tt), 9) AS fpr, round(ct / tt, 9) AS tpr, round(s, 9) AS threshold FROM c")
ORACLES["pr_points"] = _RANKING + (
    "SELECT round(ct / cn, 9) AS precision, round(ct / tt, 9) AS recall, round(s, 9) AS threshold FROM c")
ORACLES["threshold_sweep"] = with_(CORE, *sweep_parts("core", "score")) + (
    "SELECT grid_index, round(t, 9) AS threshold, tn, fp, fn, tp, round(recall, 9) AS recall, round(precision, 9) AS precision, "
    "round(accuracy, 9) AS accuracy, round(f1, 9) AS f1 FROM swept")
_BEST = "(SELECT t, {v} FROM swept ORDER BY {v} DESC, grid_index LIMIT 1)"
ORACLES["best_threshold"] = with_(CORE, *sweep_parts("core", "score")) + union(
    f"SELECT round(t, 9) AS threshold, round({v}, 9) AS best_score, '{v}' AS goal FROM {_BEST.format(v=v)}" for v in ("f1", "recall"))
ORACLES["threshold_sensitivity"] = with_(CORE, *sweep_parts("core", "score", None, PLOT)) + (
    "SELECT grid_index, round(t, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM swept")
ORACLES["threshold_table"] = with_(CORE) + union(
    f"SELECT {t}::DOUBLE AS threshold, {RATIOS} FROM ({counts_sql('core', 'score', f'{t}::DOUBLE')})" for t in (0.20, 0.25, 0.30, 0.35, 0.40, 0.50))
ORACLES["frozen_threshold"] = with_(
    CORE, *split_parts("core", "label", "claim_id"), "valid AS (SELECT * FROM assigned WHERE split = 'validation')",
    "one AS (SELECT 0 AS m, score, label FROM assigned WHERE split = 'test')", *sweep_parts("valid", "score"),
    *ranking_parts("one", "score", "m"), "best AS (SELECT t AS threshold FROM swept ORDER BY f1 DESC, grid_index LIMIT 1)",
    "frozen AS (SELECT one.*, threshold FROM one, best)", f"k AS ({counts_sql('frozen', 'score', 'threshold')})") + (
    f"SELECT {RATIOS}, round(roc_auc, 9) AS roc_auc, round(pr_auc, 9) AS pr_auc, round(threshold, 9) AS threshold, tn, fp, fn, tp "
    "FROM k, ranking, best")

# ---- portfolio ------------------------------------------------------------------------------------------------

ORACLES["top_k"] = capacity_sql((2.5,)) + CAPACITY_COLUMNS
ORACLES["capacity_summary"] = capacity_sql((1, 5, 10, 20)) + CAPACITY_COLUMNS
ORACLES["cumulative_gains"] = capacity_sql((1, 5, 10, 20, 30, 50, 100)) + (
    "SELECT percentage, k AS claims_reviewed, s::BIGINT AS fraud_selected, f::BIGINT AS total_fraud, "
    "round(s / f::DOUBLE, 9) AS fraud_captured_percentage FROM got")
ORACLES["lift_by_decile"] = ORACLES["report_roundtrip"]
ORACLES["document_lift"] = with_(DOCS, "graded AS (SELECT doc_id, toxic, floor(n_chars / 100) AS s FROM docs)")[:-1] + ", " + decile_sql(
    "graded", "s", "toxic", "doc_id")
ORACLES["top_k_rows"] = with_(
    CORE, "ranked AS (SELECT claim_id, score, row_number() OVER (ORDER BY score DESC, claim_id) AS rank, count(*) OVER () AS n FROM core)") + (
    "SELECT rank, claim_id, round(score, 9) AS score FROM ranked WHERE rank <= ceil(n * 10 / 100.0::DOUBLE)")
ORACLES["row_position"] = with_(CORE) + "SELECT claim_id, row_number() OVER (ORDER BY o_totalprice, claim_id) AS position FROM core"
ORACLES["scored_label_join"] = with_(CORE) + "SELECT claim_id, label, round(score, 9) AS score FROM core"
ORACLES["colocated_label_join"] = ORACLES["scored_label_join"]

# ---- policy and queue ---------------------------------------------------------------------------------------------

ORACLES["risk_decisions"] = with_(CORE) + (
    f"SELECT claim_id, round(score, 9) AS fraud_probability, {THRESHOLD}::DOUBLE AS operating_threshold, "
    f"score >= {THRESHOLD}::DOUBLE AS above_operating_threshold, {band_case('score', 'risk_band')} AS risk_band, "
    f"{band_case('score', 'review_priority')} AS review_priority, {band_case('score', 'recommended_action')} AS recommended_action, "
    f"{band_case('score', 'business_interpretation')} AS business_interpretation, {text(DISCLAIMER)} AS disclaimer FROM core")
ORACLES["invalid_scores"] = with_(CORE) + (
    "SELECT claim_id FROM core WHERE claim_id % 50 = 0 OR score * 1.4::DOUBLE - 0.2::DOUBLE < 0 OR score * 1.4::DOUBLE - 0.2::DOUBLE > 1")
ORACLES["context_cues"] = with_(CONTRACT) + (
    "SELECT PolicyNumber, concat_ws('|', CASE WHEN PoliceReportFiled = 'Yes' THEN 'Police report filed' ELSE 'No police report filed' END, "
    "CASE WHEN WitnessPresent = 'Yes' THEN 'Witness present' ELSE 'No witness recorded' END, "
    "CASE WHEN Days_Policy_Accident = 'more than 30' THEN 'Long policy-to-accident interval' END, "
    "CASE WHEN PastNumberOfClaims IN ('2 to 4', 'more than 4') THEN 'Multiple past claims' END, "
    "CASE WHEN NumberOfSuppliments IN ('3 to 5', 'more than 5') THEN 'Several supplements' END, "
    "CASE WHEN AddressChange_Claim IN ('under 6 months', '1 year') THEN 'Recent address change' END, "
    "CASE WHEN DriverRating = 1 THEN 'Lowest driver rating' END, "
    "CASE WHEN Fault = 'Third Party' THEN 'Third-party fault recorded' END) AS cues FROM contract")


def factor(test: str, yes: str, no: str) -> str:
    return f"CASE WHEN {test} THEN '{yes}' ELSE '{no}' END"


ORACLES["three_tier"] = with_(CONTRACT) + (
    "SELECT PolicyNumber, round(score * 100, 1) AS score_percent, CASE WHEN score >= 0.6::DOUBLE THEN '🚨 HIGH RISK' "
    "WHEN score >= 0.4::DOUBLE THEN '⚠️ MEDIUM RISK' ELSE '✅ LOW RISK' END AS tier, "
    "CASE WHEN score >= 0.6::DOUBLE THEN 'Flag for investigation immediately' WHEN score >= 0.4::DOUBLE "
    "THEN 'Request supporting documents' ELSE 'Proceed with standard processing' END AS tier_action, concat_ws('|', "
    + ", ".join([
        factor("PoliceReportFiled = 'Yes'", "✅ Police report filed (reduces risk)", "❌ No police report filed (increases risk)"),
        factor("WitnessPresent = 'Yes'", "✅ Witness present (reduces risk)", "❌ No witness present (increases risk)"),
        factor("Days_Policy_Accident = 'more than 30'", "⚠️ Claim filed 30+ days after accident (increases risk)",
               "✅ Claim filed promptly (reduces risk)"),
        factor("PastNumberOfClaims IN ('2 to 4', 'more than 4')", "⚠️ Multiple past claims on record (increases risk)",
               "✅ Clean claims history (reduces risk)"),
        factor("NumberOfSuppliments IN ('3 to 5', 'more than 5')", "⚠️ High number of supplements (increases risk)",
               "✅ Normal supplement count (reduces risk)"),
        factor("AddressChange_Claim IN ('under 6 months', '1 year')", "⚠️ Recent address change before claim (increases risk)",
               "✅ Stable address (reduces risk)"),
        factor("DriverRating = 1", "⚠️ Poor driver rating (increases risk)", "✅ Good driver rating (reduces risk)"),
        factor("Fault = 'Third Party'", "⚠️ Third party fault claim (check carefully)", "ℹ️ Policy holder at fault"),
    ]) + ") AS factors FROM contract")
ORACLES["four_tier"] = with_(CORE) + (
    "SELECT claim_id, round(score, 4) AS probability, CASE WHEN score >= 0.4::DOUBLE THEN 'FLAG' ELSE 'APPROVE' END AS decision, "
    "CASE WHEN score >= 0.6::DOUBLE THEN 'HIGH RISK' WHEN score >= 0.4::DOUBLE THEN 'MEDIUM RISK' "
    "WHEN score >= 0.2::DOUBLE THEN 'LOW RISK' ELSE 'VERY LOW RISK' END AS risk_tier FROM core")
_REFERENCE = ("referenced AS (SELECT claim_id AS source_row, score, CASE WHEN claim_id % 13 = 0 THEN ' ' ELSE CAST(claim_id AS VARCHAR) END AS reference_id FROM core)")
_NAMED = ("named AS (SELECT *, CASE WHEN trim(reference_id) <> '' THEN reference_id ELSE printf('CLM-%05d', source_row + 1) END AS claim_id FROM referenced)")
_QUEUE = with_(CORE, _REFERENCE, _NAMED, "queued AS (SELECT *, row_number() OVER (ORDER BY score DESC, claim_id, source_row) AS investigation_rank FROM named)")
ORACLES["investigation_queue"] = _QUEUE + (
    "SELECT investigation_rank, claim_id, source_row, reference_id, round(score, 9) AS fraud_probability, "
    f"score >= {THRESHOLD}::DOUBLE AS above_operating_threshold, {band_case('score', 'risk_band')} AS risk_band FROM queued")
ORACLES["queue_view"] = _QUEUE + (
    'SELECT investigation_rank AS "Rank", claim_id AS "Claim Reference", round(score, 9) AS "Fraud Probability", '
    f'{band_case("score", "risk_band")} AS "Risk Band", {band_case("score", "review_priority")} AS "Review Priority", '
    f'{band_case("score", "recommended_action")} AS "Recommended Action" FROM queued')
ORACLES["batch_summary"] = with_(CORE) + (
    f"SELECT count(*) AS scored, count(*) FILTER (WHERE score >= {THRESHOLD}::DOUBLE) AS above, "
    f"concat(count(*), ' claims scored. ', count(*) FILTER (WHERE score >= {THRESHOLD}::DOUBLE), "
    "' claims are at or above the validated operating threshold of 0.24. Rows are ranked by model score descending; "
    "this is an advisory queue for human investigation.') AS message FROM core")
ORACLES["prediction_check"] = with_(CORE) + (
    "SELECT claim_id, CASE WHEN score >= 0.4::DOUBLE THEN 'FRAUD' ELSE 'LEGIT' END AS decision, "
    "CASE WHEN label = 1 THEN 'FRAUD' ELSE 'LEGIT' END AS actual, (score >= 0.4::DOUBLE) = (label = 1) AS correct FROM core")
ORACLES["streamed_decisions"] = (
    f"SELECT o_orderkey AS claim_id, round({SCORE}, 9) AS fraud_probability, {band_case(f'({SCORE})', 'risk_band')} AS risk_band FROM orders")

ORACLES["policy_bands"] = with_(CORE, "v AS (SELECT claim_id, score, CASE WHEN claim_id % 7 = 0 THEN 2 ELSE 1 END AS version, score * CASE WHEN claim_id % 7 = 0 THEN 2 ELSE 1 END AS s FROM core)") + (
    "SELECT claim_id, round(score, 9) AS score, 'standard' AS model, version, "
    + ", ".join(f"{band_case('s', c)} AS {c}" for c in BAND_TEXTS) + " FROM v")
ORACLES["streamed_sweep"] = ORACLES["threshold_sweep"]
ORACLES["encoder_stage"] = ORACLES["scaled_features"]

# ---- selection among candidate scores ------------------------------------------------------------------------------------

_RULES = ("cand AS (" + union([
    "SELECT claim_id, label, 0 AS order_in_search, 's1' AS stage, 'plain' AS candidate_id, score AS s FROM core",
    "SELECT claim_id, label, 1, 's1', 'price', o_totalprice / 500000 FROM core",
    "SELECT claim_id, label, 2, 's2', 'age', age / 100.0::DOUBLE FROM core",
    "SELECT claim_id, label, 3, 's2', 'urgent', score * 0.7::DOUBLE + CASE o_orderpriority WHEN '1-URGENT' THEN 0.3::DOUBLE "
    "WHEN '2-HIGH' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END FROM core"]) + ")")
_KEYS = "order_in_search, stage, candidate_id"
RECORDS = [
    CORE, _RULES, *ranking_parts("(SELECT order_in_search, stage, candidate_id, s AS v, label FROM cand)", "v", _KEYS),
    *sweep_parts("cand", "s", _KEYS),
    f"best AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY f1 DESC, grid_index) AS o FROM swept)",
    f"records AS (SELECT {_KEYS}, pr_auc AS validation_pr_auc, roc_auc AS validation_roc_auc, "
    "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS validation_precision, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS validation_recall, "
    "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS validation_f1, t AS validation_threshold "
    f"FROM best JOIN ranking USING ({_KEYS}) WHERE o = 1)",
    "ordered AS (SELECT *, row_number() OVER (ORDER BY validation_pr_auc DESC, validation_f1 DESC, validation_roc_auc DESC, order_in_search) AS w, "
    "row_number() OVER (PARTITION BY stage ORDER BY validation_pr_auc DESC, validation_f1 DESC, validation_roc_auc DESC, order_in_search) AS ws FROM records)",
]
_RECORD = f"{_KEYS}, " + ", ".join(f"round(validation_{c}, 9) AS validation_{c}" for c in (
    "pr_auc", "roc_auc", "precision", "recall", "f1", "threshold"))
ORACLES["validation_records"] = with_(*RECORDS) + f"SELECT {_RECORD} FROM records"
ORACLES["model_winner"] = with_(*RECORDS) + f"SELECT {_RECORD} FROM ordered WHERE w = 1"
ORACLES["staged_winner"] = with_(*RECORDS) + (
    "SELECT stage AS scope, candidate_id, round(validation_pr_auc, 9) AS validation_pr_auc, round(validation_f1, 9) AS validation_f1 "
    "FROM ordered WHERE ws = 1 UNION ALL SELECT 'all', candidate_id, round(validation_pr_auc, 9), round(validation_f1, 9) FROM ordered WHERE w = 1")
ORACLES["winner_configuration"] = with_(*RECORDS) + (
    "SELECT c.candidate_id, round(min(s), 9) AS low, round(max(s), 9) AS high, count(*) AS rows FROM cand c "
    "JOIN ordered o ON o.candidate_id = c.candidate_id AND o.w = 1 GROUP BY c.candidate_id")
RESULTS = [
    CORE, _RULES, *ranking_parts("(SELECT order_in_search, stage, candidate_id, s AS v, label FROM cand)", "v", _KEYS),
    f"k AS ({counts_sql('cand', 's', '0.5::DOUBLE', _KEYS)})",
    f"results AS (SELECT candidate_id AS model, {RATIOS}, round(roc_auc, 9) AS roc_auc, round(pr_auc, 9) AS pr_auc, "
    f"0.5::DOUBLE AS threshold, tn, fp, fn, tp, 0.0::DOUBLE AS fit_seconds, stage FROM k JOIN ranking USING ({_KEYS}))",
]
ORACLES["results_projection"] = with_(*RESULTS) + "SELECT * EXCLUDE (stage) FROM results"
ORACLES["comparison_append"] = with_(*RESULTS) + (
    "SELECT * EXCLUDE (stage) FROM results WHERE stage = 's1' UNION ALL SELECT model, accuracy, NULL, NULL, NULL, NULL, NULL, NULL, "
    "NULL, NULL, NULL, tp, NULL FROM results WHERE model = 'urgent'")
ORACLES["best_markers"] = with_(*RESULTS) + (
    "SELECT model, " + ", ".join(f"{m} = max({m}) OVER () AS best_{m}" for m in ("roc_auc", "recall", "f1"))
    + ", round(tp / nullif(tp + fn, 0)::DOUBLE, 9) AS caught_share, round(fn / nullif(tp + fn, 0)::DOUBLE, 9) AS missed_share FROM results")
ORACLES["model_comparison"] = with_(*RESULTS) + union(
    f"SELECT '{m}' AS metric, " + ", ".join(f"max({m}) FILTER (WHERE model = '{c}') AS {c}" for c in ("age", "plain", "price", "urgent"))
    + " FROM results" for m in ("accuracy", "recall", "roc_auc", "f1"))
