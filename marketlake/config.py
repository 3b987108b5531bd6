"""Central parameters (layer names, bounds, thresholds) as a frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field

from .schemas import RAW_FILES


@dataclass(frozen=True)
class Settings:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    # geographic outlier bounds (inclusive); latitude upper bound follows the code, not the docs
    lat_min: float = -34.0
    lat_max: float = 5.5
    lng_min: float = -74.0
    lng_max: float = -34.0

    # expected period of purchases (range check is logged, not blocking)
    data_min_date: str = "2016-01-01"
    data_max_date: str = "2018-12-31"

    # calendar fallback when there are no orders
    calendar_fallback_start: str = "2016-01-01"
    calendar_fallback_end: str = "2019-12-31"

    unknown_key: int = -1
    unknown_text: str = "Desconhecido"

    max_null_rate: float = 0.05
    max_quarantine_rate: float = 0.05
    sentiment_min_coverage: float = 0.95
    order_total_min: float = 0.0
    order_total_max: float = 9999999.0
    review_score_min: int = 1
    review_score_max: int = 5

    # a side is broadcast only when a count proves it is below this many rows and the rows
    # times a conservative per-row width (schema-based) stay below this many bytes
    broadcast_max_rows: int = 1_000_000
    broadcast_max_bytes: int = 64 * 1024 * 1024

    # surrogate keys: hex characters of md5(key) used as the ordering bucket
    surrogate_bucket_hex: int = 4

    # the raw datasets, in the order of the declared source files
    bronze_tables: tuple = field(default=tuple(RAW_FILES))


DEFAULT = Settings()

# Brazilian state (UF) -> macro-region. Unlisted or NULL -> unknown_text.
REGION_OF_STATE = {
    "Norte": ["AM", "RR", "AP", "PA", "TO", "RO", "AC"],
    "Nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "Centro-Oeste": ["MT", "MS", "GO", "DF"],
    "Sudeste": ["SP", "RJ", "MG", "ES"],
    "Sul": ["PR", "SC", "RS"],
}

# Portuguese month names (1..12) and weekday names (1 = Sunday .. 7 = Saturday).
MONTHS_PT = ["Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho", "Julho",
             "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]
WEEKDAYS_PT = ["Domingo", "Segunda-feira", "Terca-feira", "Quarta-feira",
               "Quinta-feira", "Sexta-feira", "Sabado"]

# SLA traffic light thresholds on the on-time share.
SLA_GREEN_MIN = 0.90
SLA_YELLOW_MIN = 0.80

# Documented raw volumes of the original marketplace dataset (expected-volume check).
EXPECTED_COUNTS = {
    "olist_orders": 99441,
    "olist_order_items": 112650,
    "olist_sellers": 3095,
    "product_category_names": 71,
}
