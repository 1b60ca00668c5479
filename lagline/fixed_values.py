"""Names, grids, costs and limits that results depend on.

Everything here is a value that has to be equal for results to be equal; all
other modules take these as default parameters.
"""

# --- File probing -----------------------------------------------------------
ENCODINGS = ["utf-8", "latin-1", "iso-8859-1", "cp1252", "utf-16"]
DELIMITERS = [";", ",", "\t"]

# --- Target and dates -------------------------------------------------------
REAL_DAYS = "Days for shipping (real)"
SCHEDULED_DAYS = "Days for shipment (scheduled)"
ORDER_DATE = "order date (DateOrders)"
LABEL = "demora"
DATE_PART_PREFIX = "order_"

# --- Columns dropped before learning ----------------------------------------
LEAKAGE_COLUMNS = [
    "Days for shipping (real)",
    "Late_delivery_risk",
    "Order Status",
    "Delivery Status",
    "shipping date (DateOrders)",
]
PERSONAL_COLUMNS = [
    "Customer Password",
    "Customer Email",
    "Customer Fname",
    "Customer Lname",
    "Customer Street",
]
ID_COLUMNS = [
    "Order Id",
    "Order Item Id",
    "Order Item Cardprod Id",
    "Product Card Id",
    "Product Category Id",
    "Category Id",
    "Department Id",
    "Customer Id",
    "Order Customer Id",
]
FREE_TEXT_COLUMNS = ["Product Description", "Product Image"]
INDEX_COLUMNS = ["Unnamed: 0", "_c0"]
GEOGRAPHY_COLUMNS = [
    "Customer City",
    "Customer Zipcode",
    "Order City",
    "Order State",
    "Order Zipcode",
]

# --- Columns studied by the exploratory profile -----------------------------
PROFILE_NUMERIC_COLUMNS = [
    "Sales",
    "Order Item Quantity",
    "Benefit per order",
    "Days for shipping (real)",
    "Days for shipment (scheduled)",
    "Order Item Product Price",
    "Order Item Total",
]
PROFILE_CATEGORY_COLUMNS = [
    "Shipping Mode",
    "Market",
    "Order Region",
    "Category Name",
    "Customer Segment",
    "Type",
    "Delivery Status",
]

# --- Preparation limits -----------------------------------------------------
IQR_FACTOR = 1.5
MAX_CATEGORIES = 15
OTHER = "Other"
UNKNOWN = "Unknown"
VARIANCE_THRESHOLD = 0.01
CORRELATION_THRESHOLD = 0.90
CORRELATION_DEFAULT = 0.95
TEST_SIZE = 0.2
SEED = 42

# --- Profile limits ---------------------------------------------------------
HISTOGRAM_BINS = 30
LIST_ALL_UP_TO = 10
LIST_SOME_UP_TO = 20
BALANCE_TOLERANCE = 0.1
SIGNIFICANCE = 0.05
HIGH_CORRELATION = 0.7
MEDIUM_CORRELATION = 0.5
LOW_CORRELATION = 0.3

# --- Hyper-parameter grids --------------------------------------------------
KNN_GRID = {
    "n_neighbors": [3, 5, 7, 9, 11, 15, 20],
    "weights": ["uniform", "distance"],
    "metric": ["euclidean", "manhattan"],
}
KNN_FOLDS = 5
LOGISTIC_GRID = {
    "C": [0.001, 0.01, 0.1, 1, 10, 100],
    "penalty": ["l1", "l2"],
    "max_iter": [200, 500, 1000],
}
BOOSTED_GRID = {
    "n_estimators": [200],
    "max_depth": [5, 7],
    "learning_rate": [0.1],
    "subsample": [0.8],
    "colsample_bytree": [0.8],
}
OTHER_FOLDS = 3

# --- Evaluation -------------------------------------------------------------
CALIBRATION_BINS = 10
COST_FALSE_POSITIVE = 100
COST_FALSE_NEGATIVE = 500
BENEFIT_TRUE_POSITIVE = 200
CLASS_NAMES = {0: "A Tiempo", 1: "Con Demora"}
