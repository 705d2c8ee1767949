"""Code lists, thresholds and formats that results depend on."""

# Contract of the patient table.
PATIENT_COLUMNS = [
    "mrn",
    "age",
    "sex",
    "admission_date",
    "discharge_date",
    "primary_diagnosis",
    "readmitted_30d",
]
LABEL = "readmitted_30d"
MAX_MRN_LENGTH = 64
MAX_SEX_LENGTH = 1
MAX_DIAGNOSIS_LENGTH = 10
MIN_AGE = 0
MAX_AGE = 120

# Categories that expand into model features.
SEX_VALUES = ["F", "M", "O"]
DIAGNOSIS_VALUES = [
    "I50.9",
    "J44.9",
    "J18.9",
    "E11.9",
    "N17.9",
    "I63.9",
    "I21.9",
    "K92.2",
    "A41.9",
    "Z51.5",
    "UNKNOWN",
]
AGE_BUCKETS = ["under_50", "age_50_69", "age_70_plus"]

# Cohort definitions.
COHORT_CODES = {
    "heart_failure": ["I50.9"],
    "copd": ["J44.9"],
    "pneumonia": ["J18.9"],
    "diabetes": ["E11.9"],
    "cardiovascular": ["I50.9", "I21.9", "I63.9"],
}
ELDERLY_AGE = 65
RECENT_DAYS = 90

# Wording of clinical search queries.
DIAGNOSIS_NAMES = {
    "I50.9": "heart failure",
    "I21.9": "acute myocardial infarction",
    "I63.9": "ischemic stroke",
    "J18.9": "pneumonia",
    "J44.9": "chronic obstructive pulmonary disease (COPD)",
    "E11.9": "type 2 diabetes mellitus",
    "A41.9": "sepsis",
    "N17.9": "acute kidney injury",
    "I10": "essential hypertension",
}
UNSPECIFIED_DIAGNOSIS = "unspecified diagnosis"
# (exclusive upper bound, descriptor); the last entry has no bound
AGE_DESCRIPTORS = [
    (18, "pediatric"),
    (40, "young adult"),
    (65, "middle-aged"),
    (80, "older adult"),
    (None, "very elderly"),
]
# (inclusive upper bound in days, descriptor); the last entry has no bound
STAY_DESCRIPTORS = [
    (0, "same-day discharge"),
    (3, "short stay"),
    (7, "typical stay"),
    (14, "extended stay"),
    (None, "prolonged hospitalization"),
]
CLINICAL_QUERY_FORMAT = (
    "30-day hospital readmission risk in %s patient with %s after %s (%d days)"
)

# Scoring and retrieval.
MEDIUM_RISK_FROM = 0.15
HIGH_RISK_FROM = 0.30
MIN_TRAINING_ROWS = 30
EMBEDDING_DIM = 384
CITATION_URL_PREFIX = "https://pubmed.ncbi.nlm.nih.gov/"
