"""Pure Column expressions: SLA fields, region, date keys, ratios, NPS.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, REGION_OF_STATE, SLA_GREEN_MIN, SLA_YELLOW_MIN


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------- dates (F1, F2, F4, F8) ----------

def date_key(ts) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(col(ts), "yyyyMMdd").cast("int")


def month_key(dk) -> Column:
    """yyyyMM from a yyyyMMdd key (F8), integer division."""
    return (col(dk) / 100).cast("int")


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` by calendar date (F2)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


# ---------- SLA (L1) ----------

def sla_columns(purchase="order_purchase_timestamp",
                delivered="order_delivered_customer_date",
                estimated="order_estimated_delivery_date") -> dict[str, Column]:
    """The four SLA fields. On-time compares timestamps, delay compares dates (kept as coded)."""
    both = col(delivered).isNotNull() & col(estimated).isNotNull()
    return {
        "dias_para_entrega": days_between(delivered, purchase),
        "dias_estimados": days_between(estimated, purchase),
        "entregue_no_prazo": F.when(both, col(delivered) <= col(estimated)),
        "dias_atraso": F.when(both, days_between(delivered, estimated)),
    }


def with_sla(df: DataFrame, **names) -> DataFrame:
    return df.withColumns(sla_columns(**names))


# ---------- geography (F15) ----------

def region_of_state(state, unknown: str = DEFAULT.unknown_text) -> Column:
    expr = None
    for region, states in REGION_OF_STATE.items():
        cond = col(state).isin(states)
        expr = F.when(cond, region) if expr is None else expr.when(cond, region)
    return expr.otherwise(unknown)


# ---------- ratios and scores (F13, A6, A7, A9) ----------

def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, NULL when den is 0 (ANSI-safe)."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def nps(score, review_id=None) -> Column:
    """(promoters - detractors) / reviews * 100; promoters score >= 4, detractors <= 2."""
    s = col(score)
    total = F.count(col(review_id)) if review_id is not None else F.count(s)
    return safe_ratio(count_if(s >= 4) - count_if(s <= 2), total) * 100.0


def non_blank(c) -> Column:
    """NOT NULL and not only spaces (P5). Tabs and newlines count as text."""
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def money_out(c) -> Column:
    """Exact decimal money presented as DOUBLE."""
    return col(c).cast("double")


def sla_light(rate) -> Column:
    """SLA traffic light of an on-time share: verde >= 90%, amarelo 80-89%, vermelho < 80%, NULL stays NULL."""
    r = col(rate)
    return (F.when(r >= SLA_GREEN_MIN, "verde").when(r >= SLA_YELLOW_MIN, "amarelo")
            .when(r.isNotNull(), "vermelho"))
