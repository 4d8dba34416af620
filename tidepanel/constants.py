"""Results depend on them, so they are listed together and never derived."""

# Churn classes stored in the label column.
GONE_IN_TWO = "BAJA+2"
GONE_IN_ONE = "BAJA+1"
STAYS = "CONTINUA"

# Training weight per churn class.
WEIGHTS = {GONE_IN_TWO: 1.00002, GONE_IN_ONE: 1.00001, STAYS: 1.0}

# Campaign economics: profit per true GONE_IN_TWO, cost per wasted contact.
HIT_PROFIT = 780_000
CONTACT_COST = 20_000

# Score above which a row counts as predicted positive in the threshold profit.
SCORE_THRESHOLD = 0.025

# Curve range (0-based positions, end exclusive), plateau half-width, final number of contacts.
CURVE_FLOOR = 4_000
CURVE_CEILING = 20_000
PLATEAU_HALF_WIDTH = 500
FINAL_CONTACTS = 11_000

# Months with broken source data.
BAD_PERIODS = (201905, 201910, 202006)

# First month used for training, by class.
FIRST_CHURN_PERIOD = 201901
FIRST_STAY_PERIOD = 202001

# First months without a known outcome in the row-number labelling.
ROWNUM_GONE_IN_ONE_BEFORE = 202108
ROWNUM_GONE_IN_TWO_BEFORE = 202107

# Quarterly-count scaling by tenure in months.
TENURE_FACTORS = {1: 5.0, 2: 2.0, 3: 1.2}

# Text that stands for NULL.
NULL_TOKENS = ("", "None", "NULL", "NaN")

# Text that stands for yes / no, compared in upper case.
YES_TOKENS = ("S", "SI", "Y", "YES", "TRUE", "1")
NO_TOKENS = ("N", "NO", "N0", "FALSE", "0")
MISTYPED_NO = "N0"

# Column names that hold dates, lower case.
DATE_NAME_PATTERN = "fecha|finiciomora|date|fec|f_ini|fini"

# Target columns that never enter a feature matrix.
TARGET_COLUMNS = ("label", "w", "y", "y1", "y2", "weight", "class_weight")

# Name fragment of the random probe columns.
CANARY = "canary"
