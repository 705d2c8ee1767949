"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

from ..fixed_values import (
    AGE_BUCKETS,
    AGE_DESCRIPTORS,
    CITATION_URL_PREFIX,
    COHORT_CODES,
    DIAGNOSIS_NAMES,
    DIAGNOSIS_VALUES,
    EMBEDDING_DIM,
    SEX_VALUES,
    STAY_DESCRIPTORS,
    UNSPECIFIED_DIAGNOSIS,
)
from ..operators.features import feature_names
from .catalog import AS_OF, PROBED_SHARE, RULES
from .encounters import ENCOUNTERS_SQL

SILVER_TEXT = """mrn, age, sex, CAST(admission_date AS VARCHAR) AS admission_date,
 CAST(discharge_date AS VARCHAR) AS discharge_date, primary_diagnosis, readmitted_30d"""
LATEST_ADMISSION = """ROW_NUMBER() OVER (PARTITION BY mrn ORDER BY admission_date DESC, age DESC,
 discharge_date DESC, primary_diagnosis DESC, readmitted_30d DESC, sex DESC)"""
PATIENT = "mrn, age, sex, admission_date, discharge_date, primary_diagnosis, readmitted_30d"
SUMMARY = """CAST(count(*) AS BIGINT) AS n_patients,
 CAST(count(*) FILTER (WHERE readmitted_30d) AS BIGINT) AS n_readmitted,
 round(coalesce(avg(CASE WHEN readmitted_30d THEN 1.0 ELSE 0.0 END), 0.0), 6) AS readmit_rate"""


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(operator: str, column: str, cases) -> str:
    *bounded, (_, last) = cases
    whens = " ".join(f"WHEN {column} {operator} {b} THEN '{d}'" for b, d in bounded)
    return f"CASE {whens} ELSE '{last}' END"


# Tables derived step by step; a query takes those it needs.
STEPS = {
    "enc": ENCOUNTERS_SQL.format(orders="orders"),
    "clean": """SELECT mrn, CASE WHEN age BETWEEN 0 AND 120 THEN age END AS age,
 CASE WHEN upper(sex) IN ('F', 'M', 'O') THEN upper(sex) END AS sex, admission_date, discharge_date,
 primary_diagnosis, readmitted_30d, ingested_at, source_file FROM enc WHERE mrn IS NOT NULL AND mrn <> ''""",
    "silver": """SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY mrn
 ORDER BY ingested_at DESC, source_file DESC) AS rn FROM clean) WHERE rn = 1""",
    "gold": f"SELECT {PATIENT} FROM silver WHERE age IS NOT NULL AND sex IS NOT NULL",
    "patient": "SELECT ROW_NUMBER() OVER (ORDER BY md5(mrn)) AS id, * FROM gold",
    "valid": f"SELECT {PATIENT} FROM clean WHERE age IS NOT NULL AND sex IS NOT NULL",
    "stored": """SELECT ROW_NUMBER() OVER (ORDER BY md5(mrn)) AS id, * FROM gold
 WHERE admission_date < DATE '2001-01-01'""",
    "batch": "SELECT * FROM gold WHERE admission_date >= DATE '2000-01-01'",
    "found": """SELECT CAST(doc_id // 3 AS VARCHAR) AS pmid, 'Document ' || doc_id AS title, text AS abstract,
 lang AS journal, CAST(1990 + doc_id % 30 AS VARCHAR) AS year, concat_ws('|', source, lang) AS authors,
 source AS query, TRY_CAST(regexp_replace(source, '[^0-9]', '', 'g') AS INT) AS query_no, doc_id AS position
 FROM documents""",
    "once": """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pmid ORDER BY query_no NULLS LAST, position NULLS LAST) AS rn
 FROM found) WHERE rn = 1""",
    "corpus": "SELECT * EXCLUDE (pmid), CAST(position AS VARCHAR) AS pmid FROM found",
    "feature": "SELECT mrn, readmitted_30d, "
    + ", ".join(
        ["age", "CAST(discharge_date - admission_date AS INT) AS length_of_stay_days"]
        + [f"CAST(sex = '{v}' AS INT) AS sex_{v}" for v in SEX_VALUES]
        + [
            f"CAST(primary_diagnosis IS NOT NULL AND primary_diagnosis = '{v}' AS INT) AS \"dx_{v}\""
            for v in DIAGNOSIS_VALUES[:-1]
        ]
        + [
            f"CAST(primary_diagnosis IS NULL OR primary_diagnosis NOT IN ({_sql_list(DIAGNOSIS_VALUES[:-1])})"
            " AS INT) AS \"dx_UNKNOWN\"",
            f"CAST(age < 50 AS INT) AS age_bucket_{AGE_BUCKETS[0]}",
            f"CAST(age >= 50 AND age < 70 AS INT) AS age_bucket_{AGE_BUCKETS[1]}",
            f"CAST(age >= 70 AS INT) AS age_bucket_{AGE_BUCKETS[2]}",
        ]
    )
    + " FROM gold",
    "made": "SELECT mrn, i, feature_name, feature_value, ((feature_value * 37 + i * 11) % 23 - 11) / 10.0 AS shap_value FROM ("
    + " UNION ALL ".join(
        f"SELECT mrn, {i} AS i, '{n}' AS feature_name, CAST(\"{n}\" AS DOUBLE) AS feature_value FROM feature"
        for i, n in enumerate(feature_names())
    )
    + ")",
    "query": f"""SELECT mrn, '30-day hospital readmission risk in ' || {_case("<", "age", AGE_DESCRIPTORS)} || ' patient with ' ||
 CASE WHEN coalesce(primary_diagnosis, '') = '' THEN '{UNSPECIFIED_DIAGNOSIS}' {" ".join(f"WHEN primary_diagnosis = '{c}' THEN '{n}'" for c, n in DIAGNOSIS_NAMES.items())}
 ELSE primary_diagnosis END || ' after ' || {_case("<=", "days", STAY_DESCRIPTORS)} || ' (' || days || ' days)' AS query
 FROM (SELECT *, discharge_date - admission_date AS days FROM gold)""",
}
_NAMES = feature_names()
# The forest of RULES: its weights, the leaf of each patient, and its exact Shapley
# values as sums over all coalitions of the features on the way to each leaf.
STEPS |= {
    "rule": 'SELECT * FROM (VALUES '
    + ", ".join(
        f"({t}, {n}, {left}, {right}, {_NAMES.index(f) if f else -1}, {f'{x}::DOUBLE' if f else 'NULL'})"
        for t, n, left, right, f, x in RULES
    )
    + ') AS r(tree, node, "left", "right", feature, threshold)',
    "vec": "SELECT mrn, readmitted_30d, ["
    + ", ".join(f'CAST("{n}" AS DOUBLE)' for n in _NAMES)
    + "] AS v FROM feature",
    "visit": """SELECT mrn, readmitted_30d, v, tree, 0 AS node FROM vec, (SELECT DISTINCT tree FROM rule)
 UNION ALL SELECT mrn, readmitted_30d, v, tree, CASE WHEN v[feature + 1] <= threshold THEN "left" ELSE "right" END
 FROM visit JOIN rule USING (tree, node) WHERE "left" >= 0""",
    "label_weight": """SELECT readmitted_30d, (SELECT count(*) FROM gold) / (2.0 * count(*)) AS w FROM gold GROUP BY 1""",
    "stat": """SELECT tree, node, "left", "right", feature, threshold, coalesce(s0, 0) AS s0, coalesce(s1, 0) AS s1 FROM rule LEFT JOIN
 (SELECT tree, node, sum(c * w) FILTER (NOT readmitted_30d) AS s0, sum(c * w) FILTER (readmitted_30d) AS s1
 FROM (SELECT tree, node, readmitted_30d, count(*) AS c FROM visit GROUP BY ALL) JOIN label_weight USING (readmitted_30d)
 GROUP BY tree, node) USING (tree, node)""",
    "score": """SELECT mrn, avg(s1 / (s0 + s1)) AS p FROM visit JOIN stat USING (tree, node) WHERE "left" < 0 GROUP BY mrn""",
    "base": "SELECT avg(s1 / (s0 + s1)) AS b FROM stat WHERE node = 0",
    "importance": """SELECT feature, sum(gain / whole) / sum(sum(gain / whole)) OVER () AS importance FROM
 (SELECT tree, feature, sum(gain) AS gain, sum(sum(gain)) OVER (PARTITION BY tree) AS whole FROM
 (SELECT p.tree, p.feature, 2 * p.s0 * p.s1 / (p.s0 + p.s1) - sum(2 * k.s0 * k.s1 / (k.s0 + k.s1)) AS gain
 FROM stat p JOIN stat k ON k.tree = p.tree AND k.node IN (p."left", p."right") WHERE p."left" >= 0
 GROUP BY p.tree, p.node, p.feature, p.s0, p.s1) GROUP BY tree, feature) GROUP BY feature""",
    "way": """SELECT tree, node AS leaf, node, NULL::INT AS feature, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi, NULL::DOUBLE AS share,
 s1 / (s0 + s1) AS value FROM stat WHERE "left" < 0
 UNION ALL SELECT w.tree, w.leaf, p.node, p.feature, CASE WHEN p."right" = w.node THEN p.threshold END,
 CASE WHEN p."left" = w.node THEN p.threshold END, (k.s0 + k.s1) / (p.s0 + p.s1), w.value
 FROM way w JOIN stat p ON p.tree = w.tree AND w.node IN (p."left", p."right") JOIN stat k ON k.tree = w.tree AND k.node = w.node""",
    "player": """SELECT *, row_number() OVER (PARTITION BY tree, leaf ORDER BY feature) - 1 AS bit, count(*) OVER (PARTITION BY tree, leaf) AS m
 FROM (SELECT tree, leaf, feature, max(lo) AS lo, min(hi) AS hi, product(share) AS z, any_value(value) AS value
 FROM way WHERE feature IS NOT NULL GROUP BY tree, leaf, feature)""",
    "met": """SELECT d.v, p.*, CAST((lo IS NULL OR v[feature + 1] > lo) AND (hi IS NULL OR v[feature + 1] <= hi) AS DOUBLE) AS o
 FROM (SELECT DISTINCT v FROM vec) d, player p""",
    "coalition": """SELECT j.v, j.tree, j.leaf, j.feature, mask, any_value(j.value * (j.o - j.z)
 * factorial(bit_count(mask)::INT) * factorial((j.m - bit_count(mask) - 1)::INT) / factorial(j.m::INT))
 * coalesce(product(CASE WHEN (mask >> i.bit) & 1 = 1 THEN i.o ELSE i.z END), 1) AS part
 FROM met j JOIN range(64) AS masks(mask) ON mask < (1 << j.m) AND (mask >> j.bit) & 1 = 0
 LEFT JOIN met i ON i.v = j.v AND i.tree = j.tree AND i.leaf = j.leaf AND i.feature <> j.feature
 GROUP BY j.v, j.tree, j.leaf, j.feature, mask""",
    "shapley": """SELECT v, feature, sum(part) / (SELECT count(DISTINCT tree) FROM rule) AS shap FROM coalition GROUP BY v, feature""",
}


# The same walk for scoring requests, by their place in the input.
STEPS["request"] = """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY source_file) - 1 AS position FROM enc)
 WHERE length(mrn) BETWEEN 1 AND 64 AND age BETWEEN 0 AND 120 AND sex IN ('F', 'M', 'O')"""
STEPS["request_feature"] = STEPS["feature"].replace("SELECT mrn,", "SELECT mrn, position,").replace("FROM gold", "FROM request")
STEPS["request_vec"] = STEPS["vec"].replace("SELECT mrn,", "SELECT mrn, position,").replace("FROM feature", "FROM request_feature")
STEPS["request_visit"] = (
    STEPS["visit"].replace("SELECT mrn,", "SELECT mrn, position,").replace("FROM vec", "FROM request_vec").replace("FROM visit", "FROM request_visit")
)


def _words_of(source: str, key: str, text: str) -> str:
    """Places and millionths-exact values of the digest embedder, one row per number."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""SELECT key, place, CAST(c / sqrt(sum(c * c) OVER (PARTITION BY key)) AS FLOAT)::DOUBLE AS x FROM
 (SELECT key, ('0x' || substr(md5(word), 1, 8))::BIGINT % {EMBEDDING_DIM} AS place,
 sum(CASE WHEN ('0x' || substr(md5(word), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS c FROM
 (SELECT {key} AS key, unnest(regexp_split_to_array({lower}, '[^a-z0-9]+')) AS word FROM {source})
 WHERE word <> '' GROUP BY 1, 2) WHERE c <> 0"""


STEPS |= {
    "asked": _words_of("(SELECT DISTINCT query FROM query)", "query", "query"),
    "held": _words_of("corpus", "pmid", "title || chr(10) || chr(10) || coalesce(abstract, '')"),
    "hit": """SELECT * FROM (SELECT query, pmid, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, pmid::BIGINT) AS rank FROM
 (SELECT q.query, c.pmid, round(coalesce(s.dot, 0), 12) AS score FROM (SELECT DISTINCT query FROM query) q CROSS JOIN corpus c
 LEFT JOIN (SELECT a.key AS query, h.key AS pmid, sum(a.x * h.x) / any_value(a.norm * h.norm) AS dot FROM
 (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY key)) AS norm FROM asked) a JOIN
 (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY key)) AS norm FROM held) h USING (place) GROUP BY 1, 2) s
 ON s.query = q.query AND s.pmid = c.pmid)) WHERE rank <= 3""",
    "vector": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "centroid": """SELECT * FROM (SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) - 1 AS list_no, v FROM vector)
 WHERE list_no < (SELECT ceil(sqrt(count(*))) FROM vector)""",
    "turned": """SELECT vec_id, d.v, list_no, row_number() OVER (PARTITION BY vec_id ORDER BY
 round(list_cosine_similarity(d.v, c.v), 12) DESC, list_no) AS nth FROM vector d CROSS JOIN centroid c""",
    "near_rows": f"""SELECT * FROM (SELECT query_key, document_key, score,
 CAST(row_number() OVER (PARTITION BY query_key ORDER BY score DESC, document_key) AS INT) AS rank FROM
 (SELECT q.vec_id AS query_key, h.vec_id AS document_key, round(list_cosine_similarity(q.v, h.v), 12) AS score
 FROM turned q JOIN turned h USING (list_no) WHERE h.nth = 1
 AND q.nth <= ceil({PROBED_SHARE} * (SELECT count(*) FROM centroid)))) WHERE rank <= 3""",
    "near_all": """SELECT * FROM (SELECT query_key, document_key, score,
 CAST(row_number() OVER (PARTITION BY query_key ORDER BY score DESC, document_key) AS INT) AS rank FROM
 (SELECT q.vec_id AS query_key, d.vec_id AS document_key, round(list_cosine_similarity(q.v, d.v), 12) AS score
 FROM vector q CROSS JOIN vector d)) WHERE rank <= 3""",
}
NEEDS = {
    "vec": ["feature"],
    "visit": ["rule", "vec"],
    "label_weight": ["gold"],
    "stat": ["rule", "visit", "label_weight"],
    "score": ["visit", "stat"],
    "base": ["stat"],
    "importance": ["stat"],
    "way": ["stat"],
    "player": ["way"],
    "met": ["player", "vec"],
    "coalition": ["met"],
    "shapley": ["coalition", "rule"],
    "request": ["enc"],
    "request_feature": ["request"],
    "request_vec": ["request_feature"],
    "request_visit": ["rule", "request_vec"],
    "asked": ["query"],
    "held": ["corpus"],
    "hit": ["asked", "held", "query", "corpus"],
    "centroid": ["vector"],
    "turned": ["vector", "centroid"],
    "near_rows": ["turned", "centroid"],
    "near_all": ["vector"],
    "clean": ["enc"],
    "silver": ["clean"],
    "gold": ["silver"],
    "patient": ["gold"],
    "valid": ["clean"],
    "stored": ["gold"],
    "batch": ["gold"],
    "once": ["found"],
    "corpus": ["found"],
    "feature": ["gold"],
    "made": ["feature"],
    "query": ["gold"],
}


def _with(steps: str, select: str) -> str:
    ordered: list[str] = []

    def need(step: str) -> None:
        for before in NEEDS.get(step, []):
            need(before)
        if step not in ordered:
            ordered.append(step)

    for step in steps.split():
        need(step)
    ctes = ", ".join(f"{s} AS ({STEPS[s]})" for s in ordered)
    return f"WITH RECURSIVE {ctes}{select}" if select.startswith(",") else f"WITH RECURSIVE {ctes} {select}"


def _fingerprint(source: str, extra: str = "") -> str:
    return f"""SELECT pmid, title, CAST(length(abstract) AS BIGINT) AS abstract_chars,
 md5(abstract) AS abstract_md5, journal, year, authors{extra} FROM {source}"""


def _cohort_summaries() -> str:
    members = {
        name: f"primary_diagnosis IN ({_sql_list(codes)})"
        for name, codes in COHORT_CODES.items()
    }
    members["recent"] = (
        f"admission_date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}'"
    )
    members["elderly"] = (
        f"age >= 65 AND admission_date BETWEEN DATE '1900-01-01' AND DATE '{AS_OF}'"
    )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, {SUMMARY} FROM silver WHERE {rule}"
        for name, rule in members.items()
    )


def _patients_where(rule: str) -> str:
    return _with("patient", f"SELECT id, {SILVER_TEXT} FROM patient WHERE {rule}")


RAW_ROWS = """SELECT nullif(mrn, '') AS mrn, age, sex, CAST(admission_date AS VARCHAR) AS admission_date,
 CAST(discharge_date AS VARCHAR) AS discharge_date, nullif(primary_diagnosis, '') AS primary_diagnosis,
 readmitted_30d, TRUE AS from_csv, TRUE AS has_time FROM enc"""
REQUEST_CHECKS = """SELECT *, concat_ws(',', CASE WHEN coalesce(length(mrn), 0) NOT BETWEEN 1 AND 64 THEN 'mrn' END,
 CASE WHEN age IS NULL OR age NOT BETWEEN 0 AND 120 THEN 'age' END,
 CASE WHEN sex IS NULL OR sex NOT IN ('F', 'M', 'O') THEN 'sex' END,
 CASE WHEN length(primary_diagnosis) > 10 THEN 'primary_diagnosis' END) AS reasons FROM enc"""
GOLD_REASONS = """concat_ws(',', CASE WHEN age IS NULL THEN 'age_missing' END,
 CASE WHEN sex IS NULL THEN 'sex_missing' END)"""
XML_TEXT = r"regexp_replace(text, '[\x00-\x1f\x7f]', ' ', 'g')"

ORACLE = {
    "bronze_roundtrip": _with("enc", RAW_ROWS),
    "bronze_append_twice": _with(
        "enc", "SELECT CAST(2 * count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS ignored FROM enc"
    ),
    "bronze_incremental": _with("enc", RAW_ROWS),
    "csv_inferred": _with(
        "enc",
        """SELECT sex, count(*) AS n_rows, CAST(sum(age) AS BIGINT) AS total_age,
 count(*) FILTER (WHERE readmitted_30d) AS n_readmitted, count(nullif(primary_diagnosis, '')) AS n_diagnosed,
 CAST(max(admission_date) AS VARCHAR) AS last_admission FROM enc GROUP BY sex""",
    ),
    "medallion_run": _with(
        "enc silver",
        """SELECT (SELECT count(*) FROM enc) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
 (SELECT count(*) FROM enc) - (SELECT count(*) FROM silver) AS silver_dropped,
 (SELECT count(*) FROM silver) AS gold_and_quarantine""",
    ),
    "silver_clean": _with(
        "silver",
        f"SELECT {SILVER_TEXT}, CAST(ingested_at AS VARCHAR) AS ingested_at, source_file FROM silver",
    ),
    "silver_incremental": _with(
        "silver",
        f"SELECT {SILVER_TEXT}, CAST(ingested_at AS VARCHAR) AS ingested_at, source_file FROM silver",
    ),
    "redacted_urls": """SELECT page_id, 'postgresql://' || CASE WHEN page_id % 3 = 0 THEN 'app@' ELSE 'app:***@' END
 || 'db/care' || page_id AS shown FROM pages""",
    "silver_drop_counts": _with(
        "enc silver",
        """SELECT (SELECT count(*) FROM enc) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
 (SELECT count(*) FROM enc) - (SELECT count(*) FROM silver) AS dropped""",
    ),
    "gold_accept": _with("gold", f"SELECT {SILVER_TEXT} FROM gold"),
    "gold_reject": _with(
        "silver",
        f"""SELECT {SILVER_TEXT}, {GOLD_REASONS} AS reasons, CAST(1 AS BIGINT) AS copies
 FROM silver WHERE age IS NULL OR sex IS NULL""",
    ),
    "gold_accept_repeated": _with(
        "valid",
        f"""SELECT {SILVER_TEXT} FROM (SELECT *, {LATEST_ADMISSION} AS rn FROM valid) WHERE rn = 1""",
    ),
    "gold_reject_repeated": _with(
        "clean valid",
        f"""SELECT {GOLD_REASONS} AS reasons, CAST(count(*) AS BIGINT) AS n_rows FROM clean
 WHERE age IS NULL OR sex IS NULL GROUP BY 1 UNION ALL
 SELECT 'mrn_duplicate', CAST(count(*) - count(DISTINCT mrn) AS BIGINT) FROM valid""",
    ),
    "lineage": _with(
        "silver", "SELECT mrn, CAST(ingested_at AS VARCHAR) AS ingested_at, source_file FROM silver"
    ),
    "patient_table": _patients_where("TRUE"),
    "patient_count": _with("gold", "SELECT CAST(count(*) AS BIGINT) AS n_patients FROM gold"),
    "id_lookup": _patients_where("id = 7"),
    "mrn_lookup": _with("gold", f"SELECT {SILVER_TEXT} FROM gold WHERE mrn = 'MRN-00000042'"),
    "admissions_between": _patients_where(
        "admission_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"
    ),
    "admissions_by_month": _with(
        "patient",
        f"""SELECT id, {SILVER_TEXT}, strftime(admission_date, '%Y-%m') AS admission_month FROM
 (SELECT * FROM patient) AS g WHERE g.admission_date BETWEEN DATE '1999-03-10' AND DATE '1999-04-20'""",
    ),
    "diagnosis_filter": _patients_where(
        """primary_diagnosis IN ('A41.9', 'N17.9')
 AND admission_date >= DATE '1996-01-01' AND admission_date <= DATE '2001-03-31'"""
    ),
    "heart_failure": _patients_where("primary_diagnosis = 'I50.9'"),
    "cardiovascular": _patients_where(
        "primary_diagnosis IN ('I50.9', 'I21.9', 'I63.9') AND admission_date >= DATE '1998-01-01'"
    ),
    "recent": _patients_where(
        f"admission_date BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}'"
    ),
    "elderly": _patients_where(f"age >= 65 AND admission_date <= DATE '{AS_OF}'"),
    "cohort_summary": _with("silver", _cohort_summaries()),
    "single_cohort_summary": _with(
        "gold", f"SELECT 'copd' AS name, {SUMMARY} FROM gold WHERE primary_diagnosis = 'J44.9'"
    ),
    "readmit_rate": _with(
        "gold",
        "SELECT round(coalesce(avg(CASE WHEN readmitted_30d THEN 1.0 ELSE 0.0 END), 0.0), 6) AS readmit_rate FROM gold",
    ),
    "insert_unique": _with(
        "stored batch",
        f"""SELECT (SELECT max(id) FROM stored) + ROW_NUMBER() OVER (ORDER BY md5(mrn)) AS id, {SILVER_TEXT}
 FROM batch WHERE mrn NOT IN (SELECT mrn FROM stored)""",
    ),
    "gold_append": _with(
        "stored batch",
        f"""SELECT id, {SILVER_TEXT}, TRUE AS has_time FROM stored UNION ALL
 SELECT (SELECT max(id) FROM stored) + ROW_NUMBER() OVER (ORDER BY md5(mrn)) AS id, {SILVER_TEXT}, TRUE
 FROM batch WHERE mrn NOT IN (SELECT mrn FROM stored)""",
    ),
    "truncated_table": _with(
        "gold",
        """SELECT CAST(0 AS BIGINT) AS n_after_truncate, count(*) AS n_loaded, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM gold""",
    ),
    "insert_conflicts": _with(
        "stored batch", "SELECT mrn FROM batch WHERE mrn IN (SELECT mrn FROM stored)"
    ),
    "delete_ids": _patients_where("primary_diagnosis IS NULL OR primary_diagnosis <> 'Z51.5'"),
    "feature_matrix": _with(
        "feature",
        "SELECT mrn, readmitted_30d, "
        + ", ".join(f'"{n}" AS {n.replace(".", "_")}' for n in feature_names())
        + " FROM feature",
    ),
    "unknown_diagnosis_counts": _with(
        "gold",
        f"""SELECT coalesce(primary_diagnosis, '(null)') AS diagnosis, CAST(count(*) AS BIGINT) AS n_patients
 FROM gold WHERE primary_diagnosis IS NULL OR primary_diagnosis NOT IN ({_sql_list(DIAGNOSIS_VALUES[:-1])}) GROUP BY 1""",
    ),
    "request_accept": _with(
        "enc",
        f"""SELECT mrn, age, sex, CAST(admission_date AS VARCHAR) AS admission_date,
 CAST(discharge_date AS VARCHAR) AS discharge_date, primary_diagnosis FROM ({REQUEST_CHECKS}) WHERE reasons = ''""",
    ),
    "request_reject": _with(
        "enc",
        f"""SELECT reasons, CAST(count(*) AS BIGINT) AS n_rows FROM ({REQUEST_CHECKS})
 WHERE reasons <> '' GROUP BY 1""",
    ),
    "label_split": _with(
        "gold", "SELECT CAST(readmitted_30d AS INT) AS readmitted_30d, count(*) AS n_rows FROM gold GROUP BY 1"
    ),
    "request_positions": _with(
        "request_visit stat",
        """SELECT mrn, position, round(p, 6) AS readmission_probability,
 CASE WHEN p < 0.15 THEN 'low' WHEN p < 0.30 THEN 'medium' ELSE 'high' END AS risk_band FROM
 (SELECT mrn, position, avg(s1 / (s0 + s1)) AS p FROM request_visit JOIN stat USING (tree, node) WHERE "left" < 0 GROUP BY mrn, position)""",
    ),
    "batch_mean": _with(
        "score",
        """SELECT CASE WHEN p < 0.15 THEN 'low' WHEN p < 0.30 THEN 'medium' ELSE 'high' END AS risk_band, count(*) AS n_in_band,
 (SELECT count(*) FROM score) AS n_scored, (SELECT round(avg(p), 6) FROM score) AS mean_probability FROM score GROUP BY 1""",
    ),
    "split_rows": _with(
        "gold",
        """SELECT mrn, readmitted_30d, ROW_NUMBER() OVER (PARTITION BY readmitted_30d ORDER BY md5('42' || mrn))
 <= round(count(*) OVER (PARTITION BY readmitted_30d) * 0.2) AS is_test FROM gold""",
    ),
    "weights": _with(
        "gold",
        """SELECT readmitted_30d, CAST(count(*) AS BIGINT) AS n_class,
 round((SELECT count(*) FROM gold) / (2.0 * count(*)), 6) AS class_weight FROM gold GROUP BY 1""",
    ),
    "label_rate": _with(
        "gold", "SELECT round(avg(CASE WHEN readmitted_30d THEN 1.0 ELSE 0.0 END), 6) AS positive_rate FROM gold"
    ),
    "metrics_of_age": _with(
        "gold",
        """, s AS (SELECT CAST(age AS DOUBLE) AS score, CAST(count(*) FILTER (WHERE readmitted_30d) AS DOUBLE) AS pos,
 CAST(count(*) FILTER (WHERE NOT readmitted_30d) AS DOUBLE) AS neg FROM gold GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
 sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM s)
SELECT CAST(max(p) + max(n) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS n_positive,
 round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS auc,
 round(sum(pos) FILTER (WHERE score >= 65) / sum(pos + neg) FILTER (WHERE score >= 65), 6) AS "precision",
 round(sum(pos) FILTER (WHERE score >= 65) / max(p), 6) AS recall,
 round(sum(pos / p * tp / (tp + fp)), 6) AS average_precision FROM c""",
    ),
    "risk_bands": _with(
        "gold",
        """SELECT mrn, CASE WHEN age / 200.0 < 0.15 THEN 'low' WHEN age / 200.0 < 0.30 THEN 'medium' ELSE 'high' END AS risk_band,
 CAST(age / 200.0 >= 0.3 AS INT) AS predicted_label, CAST(round(age / 200.0 * 100, 1) AS DOUBLE) AS "percent" FROM gold""",
    ),
    "ranked_contributions": _with(
        "made",
        """SELECT mrn, CAST(rank AS INT) AS rank, feature_name, feature_value, CAST(shap_value AS DOUBLE) AS shap_value FROM
 (SELECT *, ROW_NUMBER() OVER (PARTITION BY mrn ORDER BY abs(shap_value) DESC, i) AS rank FROM made) WHERE rank <= 5""",
    ),
    "contribution_signs": _with(
        "made",
        """SELECT mrn, CAST(count(*) FILTER (WHERE shap_value > 0) AS INT) AS n_positive,
 CAST(count(*) FILTER (WHERE shap_value < 0) AS INT) AS n_negative FROM made GROUP BY mrn""",
    ),
    "training_report": _with(
        "gold",
        """SELECT CAST(sum(c) AS BIGINT) AS n_patients, CAST(sum(c - t) AS BIGINT) AS n_train,
 CAST(sum(t) AS BIGINT) AS n_test, TRUE AS auc_agrees, TRUE AS importances_agree
 FROM (SELECT count(*) AS c, round(count(*) * 0.2) AS t FROM gold GROUP BY readmitted_30d)""",
    ),
    "top_features": _with(
        "importance feature",
        ", mean AS ("
        + " UNION ALL ".join(f"SELECT {i} AS feature, '{n}' AS name, avg(\"{n}\") AS m FROM feature" for i, n in enumerate(_NAMES))
        + """) SELECT CAST(row_number() OVER (ORDER BY coalesce(importance, 0) DESC, feature) AS INT) AS rank, name AS feature_name,
 round(coalesce(importance, 0), 6) AS importance, round(m, 6) AS mean_value FROM mean LEFT JOIN importance USING (feature)
 ORDER BY rank LIMIT 5""",
    ),
    "forest_scores": _with(
        "score",
        """SELECT mrn, round(p, 6) AS readmission_probability,
 CASE WHEN p < 0.15 THEN 'low' WHEN p < 0.30 THEN 'medium' ELSE 'high' END AS risk_band FROM score""",
    ),
    "score_checks": _with(
        "gold",
        "SELECT count(*) AS n_scored, count(*) AS n_same_score, count(*) AS n_same_band FROM gold",
    ),
    "label_checks": _with(
        "gold", "SELECT count(*) AS n_labelled, count(*) AS n_at_threshold FROM gold"
    ),
    "tree_shap": _with(
        "shapley score base vec",
        ", named AS (SELECT * FROM (VALUES "
        + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_NAMES))
        + """) AS n(feature, feature_name)) SELECT mrn, round(p, 6) AS predicted_probability, round(b, 6) AS baseline_probability,
 feature_name, v[feature + 1] AS feature_value, round(coalesce(shap, 0), 6) AS shap_value
 FROM vec JOIN score USING (mrn) CROSS JOIN base CROSS JOIN named LEFT JOIN shapley USING (v, feature)""",
    ),
    "shap_checks": _with(
        "gold",
        f"""SELECT count(*) AS n_explained, count(*) AS n_additive, count(*) AS n_same_score,
 {len(_NAMES)} * count(*) AS n_contributions FROM gold""",
    ),
    "cited_explanations": _with(
        "hit score query corpus",
        f"""SELECT mrn, round(p, 6) AS predicted_probability,
 CASE WHEN p < 0.15 THEN 'low' WHEN p < 0.30 THEN 'medium' ELSE 'high' END AS risk_band, query,
 CAST(rank - 1 AS INT) AS position, pmid, title, journal, year, round(hit.score, 6) AS score,
 '{CITATION_URL_PREFIX}' || pmid || '/' AS pubmed_url
 FROM query JOIN score USING (mrn) JOIN hit USING (query) JOIN (SELECT pmid, title, journal, year FROM corpus) USING (pmid)""",
    ),
    "citation_checks": _with(
        "query",
        """SELECT count(*) AS n_explained, count(DISTINCT query) AS n_queries,
 count(*) * least(3, (SELECT count(*) FROM documents)) AS n_citations, count(*) AS n_in_score_order FROM query""",
    ),
    "retrieved_documents": _with(
        "hit corpus",
        f"""SELECT query, CAST(rank AS INT) AS rank, pmid, title, journal, year, round(score, 6) AS score,
 '{CITATION_URL_PREFIX}' || pmid || '/' AS pubmed_url FROM hit JOIN (SELECT pmid, title, journal, year FROM corpus) USING (pmid)""",
    ),
    "text_embedding": f"""SELECT key AS doc_id, CAST(place AS INT) AS place, CAST(round(x * 1e6) AS BIGINT) AS millionths
 FROM ({_words_of("documents", "doc_id", "text")})""",
    "indexed_top3": _with("near_rows", "SELECT query_key, document_key, round(score, 6) AS score, rank FROM near_rows"),
    "indexed_top3_exact": _with("near_all", "SELECT query_key, document_key, round(score, 4) AS score, rank FROM near_all"),
    "index_recall": _with(
        "near_rows near_all",
        """SELECT count(*) AS n_exact, count(r.rank) AS n_found, round(count(r.rank) / count(*), 6) AS recall
 FROM near_all a LEFT JOIN near_rows r USING (query_key, document_key)""",
    ),
    "clinical_queries": _with("query", "SELECT mrn, query FROM query"),
    "article_xml": f"""SELECT pmid, title, CAST(length(abstract) AS BIGINT) AS abstract_chars, md5(abstract) AS abstract_md5,
 journal, year, authors FROM (SELECT CAST(doc_id AS VARCHAR) AS pmid, 'Document ' || doc_id AS title,
 'TEXT: ' || trim({XML_TEXT}) || ' from' AS abstract, 'Journal ' || lang AS journal,
 CAST(1990 + doc_id % 30 AS VARCHAR) AS year, source || ' ' || upper(lang) AS authors FROM documents WHERE lang <> 'fr')""",
    "corpus_json": _with("corpus", _fingerprint("corpus")),
    "corpus_array": _with("corpus", _fingerprint("corpus")),
    "corpus_first_wins": _with("once", _fingerprint("once", ", query")),
    "corpus_new": _with(
        "found once",
        _fingerprint("once") + " WHERE pmid NOT IN (SELECT pmid FROM found WHERE journal = 'en')",
    ),
    "distinct_pmids": _with(
        "found", "SELECT CAST(count(DISTINCT pmid) AS BIGINT) AS n_pmids FROM found"
    ),
    "corpus_upsert": _with(
        "found",
        f""", stored AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pmid ORDER BY query_no, position) AS rn
 FROM found WHERE query_no < 10),
batch AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pmid ORDER BY query_no DESC, position DESC) AS rn
 FROM found WHERE query_no >= 5),
merged AS (SELECT * FROM batch WHERE rn = 1 UNION ALL
 SELECT * FROM stored WHERE rn = 1 AND pmid NOT IN (SELECT pmid FROM batch))
{_fingerprint("merged")}""",
    ),
    "index_snapshots": f"""SELECT (position // 3) AS point_id, CAST(position // 3 AS VARCHAR) AS pmid,
 md5(CASE WHEN loaded = 2 THEN 'New ' ELSE '' END || 'Document ' || position) AS title_md5, md5(text) AS abstract_md5,
 CAST({EMBEDDING_DIM} AS BIGINT) AS dim FROM (SELECT doc_id AS position, text, loaded, row_number() OVER
 (PARTITION BY doc_id // 3 ORDER BY loaded DESC, doc_id DESC) AS rn FROM
 (SELECT *, 1 AS loaded FROM documents UNION ALL SELECT *, 2 FROM documents WHERE lang = 'en')) WHERE rn = 1""",
    "index_created": "SELECT CAST(1 AS BIGINT) AS n_created, count(*) AS n_points FROM documents",
    "index_loads": """SELECT count(*) AS n_first, count(*) FILTER (lang = 'en') AS n_second,
 count(DISTINCT doc_id // 3) AS n_points, count(DISTINCT doc_id // 3) AS n_ids FROM documents""",
    "point_ids": "SELECT doc_id, CASE WHEN lang = 'de' THEN -1 ELSE doc_id END AS point_id FROM documents",
    "embedding_texts": _with(
        "corpus",
        """SELECT pmid, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM
 (SELECT pmid, title || chr(10) || chr(10) || CASE WHEN journal <> 'es' THEN abstract ELSE '' END AS t FROM corpus)""",
    ),
    "payload_defaults": _with(
        "corpus",
        f"""SELECT pmid, CASE WHEN journal <> 'en' THEN title ELSE '' END AS title,
 CAST(length(abstract) AS BIGINT) AS abstract_chars, md5(abstract) AS abstract_md5, '' AS journal, '' AS year,
 CASE WHEN journal <> 'de' THEN authors ELSE '' END AS authors, CAST(0 AS DOUBLE) AS score,
 '{CITATION_URL_PREFIX}' || pmid || '/' AS pubmed_url FROM corpus""",
    ),
    "embedding_checks": f"SELECT doc_id, {EMBEDDING_DIM} AS dim, CAST(1 AS DOUBLE) AS norm FROM documents",
    "normalized_vectors": """SELECT vec_id, CAST(1 AS DOUBLE) AS norm, round(list_sum(v) / sqrt(list_dot_product(v, v)), 4) AS total FROM
 (SELECT vec_id, list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * 3 + (i - 1)) AS v FROM embeddings)""",
    "cosine_to_first_of_label": """WITH d AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
f AS (SELECT label, arg_min(v, vec_id) AS first_v FROM d GROUP BY label)
SELECT vec_id, round(list_cosine_similarity(v, first_v), 4) AS score FROM d JOIN f USING (label)""",
    "knn_top3": """WITH d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_key, d.vec_id AS document_key, round(list_cosine_similarity(q.v, d.v), 12) AS score
 FROM d AS q CROSS JOIN d),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_key ORDER BY score DESC, document_key) AS rank FROM p)
SELECT query_key, document_key, round(score, 4) AS score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 3""",
}
