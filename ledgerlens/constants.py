"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the original
ticket-compliance analysis for results to agree: column lists, the sentinel
strings, the organisation-name patterns, the city spelling rules and alias
tables, the disposition rules and the model settings.  They are stated here
once, as plain text in their natural order, and every operator takes them as
default arguments so a caller can pass other values (the driver-table queries
do, because the driver data has other categories).
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES — column groups
# --------------------------------------------------------------------------

# Columns only the training table has, known after the fact (leakage).
LEAKAGE_COLUMNS = [
    "payment_amount",
    "payment_date",
    "payment_status",
    "balance_due",
    "collection_status",
    "compliance_detail",
]

# Columns dropped because they are mostly empty.
SPARSE_COLUMNS = ["violation_zip_code", "non_us_str_code", "grafitti_status"]

# Nullable text columns whose nulls become the sentinel text below.
SENTINEL_COLUMNS = [
    "violator_name",
    "mailing_address_str_number",
    "mailing_address_str_name",
    "state",
    "zip_code",
]
NULL_SENTINEL = "NaN"

# Number-like columns turned into text.
STRING_CAST_COLUMNS = ["violation_street_number", "mailing_address_str_number", "zip_code"]

# Default city for a scoring ticket without one.
DEFAULT_CITY = "DETROIT"

# Attributes profiled by compliance rate (mean and count per value).
RATE_ATTRIBUTES = [
    "agency_name",
    "inspector_name",
    "violation_street_number",
    "violation_street_name",
    "mailing_address_str_number",
    "city",
    "state",
    "zip_code",
    "country",
    "violation_code",
    "violation_description",
    "disposition",
    "people",
    "address_BOX",
    "address_MILE",
]

# Attributes whose category drift between the two tables is measured.
DRIFT_ATTRIBUTES = [
    "inspector_name",
    "city",
    "violation_code",
    "violator_name",
    "mailing_address_str_name",
    "violation_street_name",
    "violation_description",
    "zip_code",
    "mailing_address_str_number",
    "violation_street_number",
]

# Attributes whose values not shared by both tables are folded to the sentinel.
FOLD_ATTRIBUTES = [
    "city",
    "violation_code",
    "violation_street_name",
    "violation_description",
    "zip_code",
    "violation_street_number",
]

# Attributes label-encoded with a vocabulary fitted on the training table.
ENCODED_ATTRIBUTES = [
    "disposition",
    "city",
    "violation_code",
    "violation_street_name",
    "violation_description",
    "zip_code",
    "violation_street_number",
]

# Amount columns that are plotted / described.
AMOUNT_COLUMNS = [
    "fine_amount",
    "admin_fee",
    "state_fee",
    "late_fee",
    "discount_amount",
    "clean_up_cost",
    "judgment_amount",
]

# Features kept for the dated segment (hearing date known).
DATED_FEATURES = [
    "violation_street_number",
    "violation_street_name",
    "city",
    "zip_code",
    "violation_code",
    "violation_description",
    "disposition",
    "late_fee",
    "discount_amount",
    "judgment_amount",
    "time_to_hearing",
]

# Features kept for the undated segment (no hearing date).
UNDATED_FEATURES = [
    "violation_street_number",
    "violation_street_name",
    "city",
    "zip_code",
    "violation_code",
    "violation_description",
    "disposition",
    "fine_amount",
    "late_fee",
    "discount_amount",
    "judgment_amount",
]

# --------------------------------------------------------------------------
# FIXED VALUES — organisation / address patterns (Java-regex, case-sensitive,
# matched anywhere in the text, any one of them marks an organisation)
# --------------------------------------------------------------------------

ORGANISATION_PATTERNS = [
    "INC",
    "[Ii]nc.",
    "GROUP",
    "LLC",
    "MANAGEMENT",
    "RESTAURANT",
    "LIMITED",
    "CORP",
    "ASSOC",
    "INDUSTRIAL",
    "CO.",
    "COMMERCIAL",
    "HOSPITAL",
    "CLEANER",
    "[Cc][Hh][Uu][Rr][Cc][Hh]",
    "INTERNATIONAL",
    "[Ss]ervices",
    "[Cc]ommunity",
    "[Cc]enter",
    "CENTER",
    "ISLAND",
    "[Pp]artnership",
    "L.L.C.",
    "[!@#$%^&*()'\"/?<>~+=]",
    "[0123456789]",
    "[Bb][Aa][Nn][Kk]",
]

PO_BOX_PATTERN = "[Bb][Oo][Xx]"
MILE_PATTERN = "[Mm][Ii][Ll][Ee]"

# --------------------------------------------------------------------------
# FIXED VALUES — city spelling rules, applied in this order as literal
# substring replacements after upper-casing
# --------------------------------------------------------------------------

TRAIN_CITY_REPLACEMENTS = [
    (" ", ""),
    (".", ""),
    ("`", ""),
    (";", "L"),
    (",", ""),
    ("SUOTH", "SOUTH"),
    ("SOUTFIELD", "SOUTHFIELD"),
    ("SOTUHFIELD", "SOUTHFIELD"),
    ("SOUTJFIELD", "SOUTHFIELD"),
    ("BUFFLAO", "BUFFALO"),
]

SCORING_CITY_REPLACEMENTS = [
    ("[0123456789]", ""),
    ("[-_]", ""),
    (" ", ""),
    (".", ""),
    ("`", ""),
    (";", "L"),
    (",", ""),
    ("SUOTH", "SOUTH"),
    ("SOUTFIELD", "SOUTHFIELD"),
    ("SOTUHFIELD", "SOUTHFIELD"),
    ("SOUTJFIELD", "SOUTHFIELD"),
    ("SIOUTHFIELD", "SOUTHFIELD"),
    ("SOOTHFIELD", "SOUTHFIELD"),
    ("SOUTHFILELD", "SOUTHFIELD"),
    ("SUTHFIELD", "SOUTHFIELD"),
    ("SOOUTHFIELD", "SOUTHFIELD"),
    ("BUFFLAO", "BUFFALO"),
]

# --------------------------------------------------------------------------
# FIXED VALUES — whole-value city aliases (misspelling -> canonical)
# --------------------------------------------------------------------------

TRAIN_CITY_ALIASES = {
    "DEROIT": "DETROIT",
    "DERTOIT": "DETROIT",
    "DETRIUT": "DETROIT",
    "DETROITDETROIT": "DETROIT",
    "DTEROIT": "DETROIT",
    "DETROIOT": "DETROIT",
    "DTROIT": "DETROIT",
    "ETROIT": "DETROIT",
    "DETRIOT": "DETROIT",
    "DETROTI": "DETROIT",
    "DETEROIT": "DETROIT",
    "DETROI": "DETROIT",
    "CETROIT": "DETROIT",
    "DETROITF": "DETROIT",
    "DETROOIT": "DETROIT",
    "DETORIT": "DETROIT",
    "DETRORIT": "DETROIT",
    "DETROIT1": "DETROIT",
    "DETROITQ": "DETROIT",
    "DETRROIT": "DETROIT",
    "DETEOIT": "DETROIT",
    "DERTROIT": "DETROIT",
    "DETRTOIT": "DETROIT",
    "LOSANGLES": "LOSANGELES",
    "LASVAGAS": "LASVEGAS",
}

SCORING_CITY_ALIASES = {
    "DEROIT": "DETROIT",
    "DERTOIT": "DETROIT",
    "DETRIUT": "DETROIT",
    "DETROITDETROIT": "DETROIT",
    "DTEROIT": "DETROIT",
    "DETROIOT": "DETROIT",
    "DTROIT": "DETROIT",
    "ETROIT": "DETROIT",
    "DETRIOT": "DETROIT",
    "DETROTI": "DETROIT",
    "DETEROIT": "DETROIT",
    "DETROI": "DETROIT",
    "CETROIT": "DETROIT",
    "DETROITF": "DETROIT",
    "DETROOIT": "DETROIT",
    "DETORIT": "DETROIT",
    "DETRORIT": "DETROIT",
    "DETROIT1": "DETROIT",
    "DETROITQ": "DETROIT",
    "DETRROIT": "DETROIT",
    "DETEOIT": "DETROIT",
    "DERTROIT": "DETROIT",
    "DETRTOIT": "DETROIT",
    "DETR": "DETROIT",
    "DETROTIT": "DETROIT",
    "DETROIY": "DETROIT",
    "FETROIT": "DETROIT",
    "DERROIT": "DETROIT",
    "LASANGELAS": "LOSANGELES",
    "LOSANGLES": "LOSANGELES",
    "LASVAGAS": "LASVEGAS",
    "SANDIEEGO": "SANDIEGO",
    "BERLKEY": "BERKLEY",
    "SINGAPROE": "SINGAPORE",
    "SANFRANICISCO": "SANFRANCISCO",
    "STERINGHEIGHTS": "STERLINGHEIGHTS",
    "CLEVLAND": "CLEVELAND",
    "BLOOOMFIELDHILLS": "BLOOMFIELDHILLS",
    "BLOOMFIELDSHILLS": "BLOOMFIELDHILLS",
    "COLWNBIA": "COLUMBIA",
    "NEYYORK": "NEWYORK",
    "NEWYOUR": "NEWYORK",
}

# Country read from city text: substring -> country; a later rule wins.
COUNTRY_FROM_CITY = [
    ("CANA", "Cana"),
    ("AUSTR", "Aust"),
    ("ENGLAND", "England"),
    ("TAIWAN", "Taiwan"),
    ("SINGAPORE", "Singapore"),
]

# --------------------------------------------------------------------------
# FIXED VALUES — dispositions
# --------------------------------------------------------------------------

# Substrings marking the "fine waived" segment in each table.
TRAIN_WAIVED_PATTERNS = ["Fine Waived"]
SCORING_WAIVED_PATTERNS = ["Fine Waived", "Dismissal"]

# Disposition collapse rules: substring -> value; a later rule wins.
DISPOSITION_COLLAPSE = [
    ("Default", "Responsible by Default"),
    ("Determi", "Responsible by Determination"),
]

# --------------------------------------------------------------------------
# FIXED VALUES — dates, day parts, splits, models
# --------------------------------------------------------------------------

SENTINEL_DATE = "1900-01-01 00:00:00"

# Day parts by hour of issue: name, first hour, hour after the last.
DAY_PARTS = [
    ("ticket_issued_deadofnight", 0, 6),
    ("ticket_issued_morning", 6, 12),
    ("ticket_issued_afternoon", 12, 18),
    ("ticket_issued_night", 18, 24),
]

HOLDOUT_FRACTION = 0.25
SPLIT_SEED = 0
CV_FOLDS = 5
HISTOGRAM_BINS = 10

# Final boosted-tree settings.
GBT_PARAMS = dict(
    n_trees=100,
    learning_rate=0.05,
    min_samples_leaf=85,
    max_depth=5,
    max_features="sqrt",
    subsample=0.9,
    seed=0,
)

# Final logistic regression: L1 penalty, inverse strength C.
LOGREG_L1_C = 0.1

# Changes tried to the regularised boosting, one at a time.
BOOSTING_GRID = [
    {},
    {"max_depth": 3},
    {"max_depth": 6},
    {"min_child_weight": 5.0},
    {"gamma": 0.2},
    {"subsample": 0.6},
    {"colsample": 0.7},
    {"reg_alpha": 0.1},
    {"reg_alpha": 1.0},
]

# Tree counts tried for the boosted trees.
GBT_TREE_GRID = [90, 100, 110, 120, 130, 140, 150, 160, 170, 180, 190]

# Inverse strengths tried for the tickets with and without a hearing date.
LOGREG_C_GRID = [0.001, 0.01, 0.05, 0.1, 1, 10, 100]
LOGREG_C_GRID_UNDATED = [0.001, 0.01, 0.05, 0.1, 1, 10, 100, 500, 1000]

# Random forest used for feature importance and the depth grid.
FOREST_TREES_IMPORTANCE = 100
FOREST_TREES_GRID = 50
FOREST_DEPTH_GRID = [5, 10, 15, 20, None]
