"""Business cuts, weights, labels and texts that results must agree on.

Everything here is data. The code that applies it lives in ``functions`` and ``operators``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- risk and VIP bands (fixed values)
RISK_CUTS = (0.20, 0.40, 0.70)
RISK_LABELS = ("SIN_RIESGO", "BAJO", "MEDIO", "ALTO")
RISK_ACTIONS = ("MONITOREO", "OFERTA_DIGITAL", "CAMPAÑA_RETENCIÓN", "LLAMADA_EJECUTIVO")

VIP_CUTS = (0.3, 0.5, 0.7)
VIP_LABELS = ("STANDARD", "SILVER", "GOLD", "PLATINUM")

NETWORK_CUTS = (0.4, 0.7)
NETWORK_LABELS = ("BAJO RIESGO", "RIESGO MEDIO", "ALTO RIESGO")
NETWORK_ACTIONS = (
    "Monitoreo estándar",
    "Campaña preventiva digital",
    "Activar retención VIP inmediata",
)

HYBRID_CUTS = (0.40, 0.75)
HYBRID_LABELS = ("BAJO", "MEDIO", "ALTO")
HYBRID_ACTIONS = ("Monitoreo estándar", "Campaña preventiva", "Retención VIP inmediata")

SIMILARITY_CUTS = (0.45, 0.70)
SIMILARITY_LABELS = ("BAJO", "MEDIO", "ALTO")

# ---------------------------------------------------------------- derived features (fixed values)
ENGAGEMENT_WEIGHTS = (("app_logins_30d", 0.6), ("monthly_transactions", 0.4))
NPS_CUTS = (6, 8)
NPS_BUCKETS = (0, 1, 2)
RECENCY_CUTS = (14, 30, 90)
RECENCY_LEVELS = (0, 1, 2, 3)
HIGH_VALUE_TEST = "avg_balance_6m > 5000000 OR n_products >= 4 OR clv_score > 1000000"
NULL_DEFAULTS = {"n_complaints_3m": 0, "app_logins_30d": 0, "nps_score": 5}

NUMERIC_FEATURES = (
    "age",
    "tenure_months",
    "avg_balance_6m",
    "monthly_transactions",
    "app_logins_30d",
    "n_products",
    "clv_score",
    "n_complaints_3m",
    "nps_score",
    "days_since_last_contact",
    "balance_per_tenure",
    "txn_per_product",
    "digital_engagement_score",
    "complaint_intensity",
    "nps_bucket",
)
CATEGORICAL_FEATURES = ("region", "segment")

EXPORT_COLUMNS = (
    "customer_id",
    "segment",
    "region",
    "churn_probability",
    "churn_risk_level",
    "recommended_action",
    "vip_score",
    "vip_classification",
    "avg_balance_6m",
    "clv_score",
    "n_products",
    "monthly_transactions",
    "gold_ts",
)

# ---------------------------------------------------------------- VIP formulas (fixed values)
# (column, weight, divisor)
VIP_LINEAR_TERMS = (
    ("avg_balance_6m", 0.30, 1_000_000.0),
    ("clv_score", 0.25, 1_000_000.0),
    ("n_products", 0.20, 8.0),
    ("tenure_months", 0.15, 360.0),
    ("monthly_transactions", 0.10, 50.0),
)
# (column, full-score level, weight)
VIP_CAPPED_TERMS = (
    ("avg_balance_6m", 10_000_000.0, 0.35),
    ("clv_score", 2_000_000.0, 0.30),
    ("n_products", 8.0, 0.20),
    ("tenure_months", 240.0, 0.15),
)

# ---------------------------------------------------------------- additive rule scores (fixed values)
# (name, weight, predicate) in evaluation order: the order decides float ties and the reported factors
CHURN_SIGNALS = (
    ("Saldo bajo", 0.15, "avg_balance_6m < 100000"),
    ("Baja actividad transaccional", 0.20, "monthly_transactions < 5"),
    ("Baja interacción digital", 0.15, "app_logins_30d < 3"),
    ("Múltiples reclamos recientes", 0.25, "n_complaints_3m >= 2"),
    ("NPS crítico (Detractor)", 0.20, "nps_score <= 4"),
    ("Sin contacto reciente", 0.10, "days_since_last_contact > 60"),
    ("Producto único (baja vinculación)", 0.10, "n_products = 1"),
)
TEXT_PROXY_SLOPE, TEXT_PROXY_SHIFT = 1.1, 0.05

DEMOGRAPHIC_BASE = 0.15
DEMOGRAPHIC_SIGNALS = (
    ("quejas", 0.35, "quejas_recibidas >= 2"),
    ("inactivo", 0.20, "miembro_activo = 0"),
    ("muchos productos", 0.15, "num_productos >= 3"),
    ("sin saldo", 0.10, "saldo = 0"),
    ("edad", 0.10, "edad > 55"),
    ("pais", 0.08, "pais = 'Alemania'"),
    ("cliente nuevo", 0.08, "`antiguedad_años` <= 1"),
    ("score bajo", 0.12, "score_credito < 450"),
    ("usa app", -0.10, "uso_app_movil = 1"),
    ("tarjeta", -0.05, "tiene_tarjeta = 1"),
    ("salario alto", -0.05, "salario_estimado > 80000"),
)
DEMOGRAPHIC_RANGE = (0.02, 0.97)

CLV_TERMS = (("avg_balance_6m", 0.015), ("monthly_transactions", 500.0), ("n_products", 2000.0))

# ---------------------------------------------------------------- request checks (fixed values)
SEGMENT_DOMAIN = ("Retail", "PyME", "Premium", "Universitario", "Jubilado")
# (column, smallest allowed, largest allowed or None)
REQUEST_RANGES = (
    ("age", 18, 100),
    ("tenure_months", 0, None),
    ("avg_balance_6m", 0, None),
    ("monthly_transactions", 0, None),
    ("app_logins_30d", 0, None),
    ("n_products", 1, 20),
    ("clv_score", 0, None),
    ("n_complaints_3m", 0, None),
    ("nps_score", 0, 10),
    ("days_since_last_contact", 0, None),
)

# ---------------------------------------------------------------- row-to-text bands (fixed values)
BALANCE_CUTS = (50_000, 120_000, 200_000)
SALARY_CUTS = (30_000, 60_000, 90_000)
LEVEL_LABELS = ("bajo", "medio", "alto", "muy alto")
CREDIT_CUTS = (450, 600, 750)
CREDIT_LABELS = ("muy bajo", "bajo", "medio", "alto")

BEHAVIOUR_FEATURES = (
    "dias_sin_app",
    "var_saldo_pct",
    "var_transacciones_pct",
    "num_productos",
    "reclamos_6m",
    "antiguedad_anos",
    "uso_tarjeta_credito",
    "score_satisfaccion",
)
# (column, smallest, largest)
BEHAVIOUR_CLIPS = (
    ("dias_sin_app", 0.0, 180.0),
    ("var_saldo_pct", -80.0, 50.0),
    ("var_transacciones_pct", -90.0, 40.0),
    ("antiguedad_anos", 0.5, 20.0),
    ("uso_tarjeta_credito", 0.0, 100.0),
    ("score_satisfaccion", 1.0, 10.0),
)

# (number shown, ((predicate, sentence), ...) in order of precedence, sentence otherwise or None)
NARRATIVE_SENTENCES = (
    ("antiguedad_anos", (), "Cliente con %.1f años de antigüedad."),
    (
        "dias_sin_app",
        (
            ("dias_sin_app > 45", "Sin uso de app móvil hace %.0f días (inactividad severa)."),
            ("dias_sin_app > 20", "Baja actividad digital, sin app hace %.0f días."),
        ),
        "Activo en app móvil (último acceso hace %.0f días).",
    ),
    (
        "var_saldo_pct",
        (
            ("var_saldo_pct < -30", "Reducción severa de saldo (%.0f%% en 3 meses)."),
            ("var_saldo_pct < -10", "Disminución moderada de saldo (%.0f%%)."),
            ("var_saldo_pct > 10", "Saldo en crecimiento positivo (%.0f%%)."),
        ),
        "Saldo estable (%.0f%%).",
    ),
    (
        "abs(var_transacciones_pct)",
        (
            ("var_transacciones_pct < -30", "Frecuencia transaccional cayó %.0f%% vs histórico."),
            ("var_transacciones_pct > 10", "Alta actividad transaccional, creció %.0f%%."),
        ),
        "Frecuencia transaccional estable.",
    ),
    (
        "int(num_productos)",
        (
            ("int(num_productos) = 1", "Cliente con un único producto activo (baja vinculación)."),
            ("int(num_productos) >= 4", "Alta vinculación: %d productos activos."),
        ),
        "Vinculación media: %d productos activos.",
    ),
    (
        "int(reclamos_6m)",
        (
            ("int(reclamos_6m) > 2", "Registra %d reclamos en los últimos 6 meses."),
            ("int(reclamos_6m) = 0", "Sin reclamos recientes."),
        ),
        None,
    ),
    (
        "score_satisfaccion",
        (
            ("score_satisfaccion < 4", "Score de satisfacción bajo: %.1f/10."),
            ("score_satisfaccion > 7", "Alta satisfacción declarada: %.1f/10."),
        ),
        None,
    ),
)
# names of the twelve values of a labelled row
ROW_TEXT_NAMES = (
    "edad",
    "genero",
    "pais",
    "antiguedad",
    "saldo",
    "productos",
    "tarjeta credito",
    "miembro activo",
    "salario",
    "quejas",
    "usa app movil",
    "score credito",
)

# ---------------------------------------------------------------- text (fixed values)
CHURN_ANCHORS = (
    "quiero cerrar mi cuenta",
    "me voy a cambiar de banco",
    "estoy muy insatisfecho con el servicio",
    "voy a cancelar todos mis productos",
    "el banco me ha decepcionado completamente",
    "buscaré mejores condiciones en otro banco",
    "no recomendaría este banco a nadie",
    "quiero hablar con alguien para retirar mi dinero",
)
RETENTION_ANCHORS = (
    "muy satisfecho con el servicio",
    "excelente atención al cliente",
    "recomendaría el banco a mis conocidos",
    "el banco resolvió mi problema rápidamente",
    "estoy muy contento con mis productos",
)
LEAVING_KEYWORDS = ("cerrar", "cambiarme", "terrible", "problema", "no funciona")
COMPLAINT_CHANNELS = ("app", "call_center", "email", "sucursal")
RETENTION_DISCOUNT = 0.5
TOKEN_WINDOW = 128

# ---------------------------------------------------------------- evaluation (fixed values)
METRIC_GOALS = (("auc_roc", 0.85), ("recall", 0.75), ("precision", 0.65), ("f1", 0.70))
PORTFOLIO_CUSTOMERS = 50_000
RETAINED_SHARE = 0.25
CUSTOMER_VALUE = 3_000_000
SYSTEM_COST = 200_000_000
