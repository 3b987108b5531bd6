"""Oracle SQL for check results (one SELECT per check row, UNION ALL)."""

from marketlake.config import DEFAULT as S


def row(layer, table, name, passed, count, detail, src, blocking=True) -> str:
    b = "true" if blocking else "false"
    det = "CAST(NULL AS VARCHAR)" if detail is None else f"CAST({detail} AS VARCHAR)"
    return (f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS check_name, "
            f"COALESCE({passed}, false) AS passed, CAST({count} AS BIGINT) AS record_count, {det} AS detail, "
            f"{b} AS blocking FROM {src}")


def union(rows) -> str:
    return "\nUNION ALL\n".join(rows)


def non_empty(layer, table, src=None):
    src = src or table
    return row(layer, table, "non_empty", "COUNT(*) > 0", "COUNT(*)", None, src)


def not_null(layer, table, col, src=None, blocking=True):
    src = src or table
    return row(layer, table, f"not_null({col})", f"count_if({col} IS NULL) = 0", "COUNT(*)",
               f"'nulls=' || CAST(count_if({col} IS NULL) AS VARCHAR)", src, blocking)


def null_rate(layer, table, col, max_rate, src=None, blocking=True):
    src = src or table
    rate = f"(CASE WHEN COUNT(*) > 0 THEN CAST(count_if({col} IS NULL) AS DOUBLE) / COUNT(*) ELSE 0.0 END)"
    return row(layer, table, f"null_rate({col})", f"{rate} <= {max_rate}", "COUNT(*)",
               f"'nulls=' || CAST(count_if({col} IS NULL) AS VARCHAR) || ' of=' || CAST(COUNT(*) AS VARCHAR)",
               src, blocking)


def date_range(layer, table, col, lo, hi, src=None, blocking=True):
    src = src or table
    out = f"count_if({col} < TIMESTAMP '{lo}' OR {col} > TIMESTAMP '{hi}')"
    return row(layer, table, f"date_range({col} in [{lo}, {hi}])", f"{out} = 0", f"COUNT({col})",
               f"'out_of_range=' || CAST({out} AS VARCHAR)", src, blocking)


def value_range(layer, table, col, lo, hi, src=None, blocking=True):
    src = src or table
    out = f"count_if({col} < {lo} OR {col} > {hi})"
    return row(layer, table, f"value_range({col} in [{lo}, {hi}])", f"{out} = 0", "COUNT(*)",
               f"'out_of_range=' || CAST({out} AS VARCHAR)", src, blocking)


def no_duplicates(layer, table, keys, src=None, blocking=True):
    src = src or table
    k = ", ".join(keys)
    sub = f"(SELECT COUNT(*) AS n FROM {src} GROUP BY {k})"
    return row(layer, table, f"no_duplicates({k})", "COALESCE(SUM(n - 1), 0) = 0", "COALESCE(SUM(n - 1), 0)",
               "'total=' || CAST(COALESCE(SUM(n), 0) AS VARCHAR)", sub, blocking)


def fk_integrity(layer, table, fact, fk, dim, pk, string_key=True, blocking=True):
    unk = "'-1'" if string_key else "-1"
    sub = (f"(SELECT COUNT(*) AS o FROM {fact} f WHERE f.{fk} <> {unk} "
           f"AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk}))")
    return row(layer, table, f"fk_integrity({fk} -> {pk})", "o = 0", "o", "'orphans=' || CAST(o AS VARCHAR)",
               sub, blocking)


def reconciliation(layer, table, a, a_col, b, b_col, blocking=True):
    sub = (f"(SELECT round(CAST((SELECT SUM({a_col}) FROM {a}) AS DECIMAL(38,4)), 2) AS ra, "
           f"round(CAST((SELECT SUM({b_col}) FROM {b}) AS DECIMAL(38,4)), 2) AS rb)")
    return row(layer, table, f"reconciliation(sum({a_col}) = sum({b_col}))",
               "ra IS NOT NULL AND rb IS NOT NULL AND ra = rb", "1",
               "'difference_cents=' || COALESCE(CAST(CAST((ra - rb) * 100 AS BIGINT) AS VARCHAR), 'null')",
               sub, blocking)


def ratio(layer, table, name, num, den, src, max_rate=None, min_rate=None, blocking=True):
    rate = f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0.0 END)"
    conds = ["true"]
    if max_rate is not None:
        conds.append(f"{rate} <= {max_rate}")
    if min_rate is not None:
        conds.append(f"({den} = 0 OR {rate} >= {min_rate})")
    return row(layer, table, name, " AND ".join(conds), num,
               f"'count=' || CAST({num} AS VARCHAR) || ' of=' || CAST({den} AS VARCHAR)", src, blocking)


def unknown_present(layer, table, key, src=None):
    src = src or table
    return row(layer, table, f"unknown_member({key})", f"count_if({key} = -1) = 1", f"count_if({key} = -1)",
               f"'unknown_rows=' || CAST(count_if({key} = -1) AS VARCHAR)", src)


def bronze_suite() -> str:
    rows = []
    for t in S.bronze_tables:
        rows.append(non_empty("bronze", t))
        if t == "olist_orders":
            rows.append(not_null("bronze", t, "order_id"))
            rows.append(date_range("bronze", t, "order_purchase_timestamp", S.data_min_date, S.data_max_date,
                                   blocking=False))
        if t == "olist_order_reviews":
            rows.append(value_range("bronze", t, "review_score", S.review_score_min, S.review_score_max))
    return union(rows)


NON_BLANK = "(review_comment_message IS NOT NULL AND trim(review_comment_message) <> '')"


def silver_suite() -> str:
    L = "silver"
    g, o, r = "geolocation_aggregated", "orders_enriched", "reviews_enriched"
    return union([
        non_empty(L, g), not_null(L, g, "zip_code_prefix"),
        value_range(L, g, "lat", S.lat_min, S.lat_max), value_range(L, g, "lng", S.lng_min, S.lng_max),
        non_empty(L, o), not_null(L, o, "order_id"),
        value_range(L, o, "valor_total_pedido", S.order_total_min, S.order_total_max),
        non_empty(L, r), not_null(L, r, "review_id"),
        value_range(L, r, "review_score", S.review_score_min, S.review_score_max),
        ratio(L, "quarantine", "quarantine_rate", "count_if(order_id IS NULL)", "COUNT(*)", "olist_orders",
              max_rate=S.max_quarantine_rate),
        no_duplicates(L, o, ["order_id"]),
        ratio(L, r, "sentiment_coverage", f"count_if({NON_BLANK} AND review_sentiment IS NOT NULL)",
              f"count_if({NON_BLANK})", r, min_rate=S.sentiment_min_coverage),
    ])


GOLD_TABLES = ["dim_customers", "dim_sellers", "dim_products", "dim_calendar", "fact_sales",
               "fact_order_items", "fact_reviews", "kpi_marketplace_monthly"]


def gold_suite() -> str:
    rows = []
    for t in GOLD_TABLES:
        rows.append(non_empty("gold", t))
        if t in ("fact_sales", "fact_reviews"):
            rows.append(not_null("gold", t, "date_key"))
    rows.append(reconciliation("gold", "kpi_marketplace_monthly", "fact_sales", "valor_total_pedido",
                               "kpi_marketplace_monthly", "receita_total"))
    return union(rows)
