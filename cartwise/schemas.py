"""Table schemas, column lists and fixed labels shared by all operators."""
from pyspark.sql import types as T

# One row per invoice line, under the names used everywhere after loading.
RAW_TRANSACTIONS = T.StructType([
    T.StructField("invoice", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
])

# Source files carry ids as floats ("1234.0") because of the empty values. They are read as
# decimals: a double cannot hold every id.
SOURCE_FILE = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Customer ID", T.DecimalType(38, 6)),
    T.StructField("Country", T.StringType()),
])

# Source column -> table column.
COLUMN_NAMES = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Texts that pandas reads as "missing".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Stock codes that are postage, fees, discounts or adjustments.
EXCLUDED_CODES = (
    "POST", "DOT", "M", "m", "C2", "D", "S", "B", "PADS",
    "CRUK", "BANK CHARGES", "ADJUST", "AMAZONFEE", "TEST001",
)

# The home country, and the limits in days of label, recent orders and eligibility.
HOME_COUNTRY = "United Kingdom"
LABEL_DAYS = 90
RECENT_DAYS = 90
MAX_RECENCY_DAYS = 365

# Names and order of the features.
FEATURE_COLUMNS = (
    "recency_days",
    "frequency",
    "monetary",
    "avg_order_value",
    "tenure_days",
    "distinct_products",
    "orders_last_90d",
    "cancel_rate",
    "is_uk",
)

FEATURES = T.StructType(
    [T.StructField("customer_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS]
)

# Smallest and largest accepted value of each field of a scoring row.
FEATURE_RANGES = {
    "recency_days": (0, None),
    "frequency": (1, None),
    "monetary": (0, None),
    "avg_order_value": (0, None),
    "tenure_days": (0, None),
    "distinct_products": (1, None),
    "orders_last_90d": (0, None),
    "cancel_rate": (0, None),
    "is_uk": (0, 1),
}

# Columns of the customer profile.
RFM_COLUMNS = ("recency_days", "frequency", "monetary")

# Business order of the categories (fixed values).
SEGMENTS = ("Champions", "Promising", "At risk", "Lost")
RISK_LEVELS = ("High", "Medium", "Low")
# Lower ends of the risk levels, and the probability from which churn is predicted.
HIGH_RISK = 0.7
MEDIUM_RISK = 0.4
DECISION_THRESHOLD = 0.5

# Display names of models and metrics, metrics in display order.
MODEL_LABELS = {"logistic_regression": "Logistic regression", "boosted_trees": "Boosted trees"}
METRIC_LABELS = {
    "cv_roc_auc": "CV ROC-AUC",
    "test_roc_auc": "Test ROC-AUC",
    "test_pr_auc": "Test PR-AUC",
    "test_precision": "Precision",
    "test_recall": "Recall",
    "test_f1": "F1",
}

# Labels of the confusion matrix, "stay" before "churn".
ACTUAL_LABELS = ("Stayed", "Churned")
PREDICTED_LABELS = ("Predicted stay", "Predicted churn")

# Business names of the features.
FEATURE_LABELS = {
    "recency_days": "Days since last order",
    "frequency": "Orders",
    "monetary": "Total spend",
    "avg_order_value": "Avg order value",
    "tenure_days": "Days as customer",
    "distinct_products": "Distinct products",
    "orders_last_90d": "Orders last 90 days",
    "cancel_rate": "Cancellation rate",
    "is_uk": "Based in the UK",
}

# Spanish labels, one table per labelled column.
SPANISH = {
    "segment": {
        "Champions": "Campeones",
        "Promising": "Prometedores",
        "At risk": "En riesgo",
        "Lost": "Perdidos",
    },
    "risk_level": {"High": "Alto", "Medium": "Medio", "Low": "Bajo"},
    "model": {"Logistic regression": "Regresión logística", "Boosted trees": "Árboles potenciados"},
    "metric": {
        "CV ROC-AUC": "ROC-AUC (CV)",
        "Test ROC-AUC": "ROC-AUC (prueba)",
        "Test PR-AUC": "PR-AUC (prueba)",
        "Precision": "Precisión",
        "Recall": "Recall",
        "F1": "F1",
    },
    "actual": {"Stayed": "Se quedó", "Churned": "Se fue"},
    "predicted": {
        "Predicted stay": "Predijo: se queda",
        "Predicted churn": "Predijo: se va",
    },
    "feature": {
        "recency_days": "Días sin comprar",
        "frequency": "Pedidos",
        "monetary": "Gasto total",
        "avg_order_value": "Ticket promedio",
        "tenure_days": "Días como cliente",
        "distinct_products": "Productos distintos",
        "orders_last_90d": "Pedidos 90 días",
        "cancel_rate": "Tasa de cancelación",
        "is_uk": "Está en Reino Unido",
    },
}
