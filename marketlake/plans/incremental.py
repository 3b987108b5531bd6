"""Incremental maintenance of the sales fact and the monthly KPIs from signed changes.

A change set holds signed rows of the raw datasets: +1 adds a row, -1 takes one back (a corrected row is both).
The orders they touch are looked up, their rows before and after are built from the touched month partitions
only, and the difference of the two facts, again as signed rows, goes into the states behind the KPIs:

* sums and counts of each month are added up (decimal, so exact);
* distinct customers and sellers are kept as (month, id, rows), so a retraction that takes the last row of an id
  lowers the count, which no plain distinct count or sketch could do;
* review counts and sums of each month, which need no join.

Only months that a change touches are written again, as partitions of a new version; all tables of the lake are
switched to it at once (``sources/snapshots``). A load that dies before changes nothing and is repeated. The first
load is a change set like any other, over empty tables.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import date_key, month_key, safe_ratio
from ..session import remove_staged, stage
from ..sources.files import write_small_text
from ..sources.snapshots import VERSION, current, leaves, partition_of, publish, read_folders, read_small_text
from . import gold, silver

SIGN = "_sign"
MONTH = "ano_mes"
NO_MONTH = 0  # orders without a purchase date, items and payments without an order
MAX_MONTHS = 10_000
SALTS = 8  # tasks that write a month at most

RAW = {"orders": "olist_orders", "items": "olist_order_items", "payments": "olist_order_payments"}
WIDE = "decimal(38,2)"

# state -> the signed fact rows' measure; all are added up per month
SALES = {
    "linhas": lambda: F.lit(1),
    "receita_total": lambda: F.col("valor_total_pedido").cast(WIDE),
    "qtd_pedidos": lambda: F.col("order_id").isNotNull().cast("int"),
    "canceladas": lambda: (F.col("order_status") == "canceled").cast("int"),
    "no_prazo": lambda: F.col("entregue_no_prazo").cast("int"),
    "com_prazo": lambda: F.col("entregue_no_prazo").isNotNull().cast("int"),
    "dias": lambda: F.col("dias_para_entrega"),
    "com_dias": lambda: F.col("dias_para_entrega").isNotNull().cast("int"),
}
REVIEWS = {
    "avaliacoes_linhas": lambda: F.lit(1),
    "avaliacoes": lambda: F.col("review_id").isNotNull().cast("int"),
    "promotores": lambda: (F.col("review_score") >= 4).cast("int"),
    "detratores": lambda: (F.col("review_score") <= 2).cast("int"),
    "notas": lambda: F.col("review_score"),
    "com_nota": lambda: F.col("review_score").isNotNull().cast("int"),
}


def signed(df: DataFrame, sign: int) -> DataFrame:
    return df.withColumn(SIGN, F.lit(sign))


def consolidated(rows: DataFrame) -> DataFrame:
    """Signed rows added up: each row as often as its signs say. A row taken back that isn't there is an error."""
    columns = [c for c in rows.columns if c != SIGN]
    n = F.sum(SIGN)
    left = rows.groupBy(*columns).agg(n.alias("_n")).where("_n <> 0")
    times = F.when(F.col("_n") > 0, F.col("_n")).otherwise(
        F.raise_error(F.concat(F.lit("a change takes back a row that is not stored: "), F.to_json(F.struct(*columns)))).cast("bigint"))
    return left.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("_copy")).drop("_copy")


def _added(measures: Mapping) -> list[Column]:
    return [F.coalesce(F.sum(F.col(SIGN) * m()), F.lit(0)).cast(WIDE if c == "receita_total" else "bigint").alias(c) for c, m in measures.items()]


def _month(purchase: str = "order_purchase_timestamp") -> Column:
    return F.coalesce(month_key(date_key(purchase)), F.lit(NO_MONTH))


def _salt(key: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(salts))


class IncrementalLake:
    """The stored tables ``orders items payments fact_sales sales customers sellers reviews kpi``, by month."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- stored tables

    def _schemas(self) -> dict[str, T.StructType]:
        text = read_small_text(self.spark, f"{self.root}/schemas.json")
        return {t: T.StructType.fromJson(x) for t, x in json.loads(text).items()} if text else {}

    def folders(self, table: str, months: set[int] | None = None) -> list[str]:
        """Partition folders of a table in the version that holds, relative to the table's own folder."""
        own = [f.partition("/")[2] for f in current(self.spark, self.root)[1] if f.startswith(f"{table}/")]
        return own if months is None else [f for f in own if int(partition_of(f).partition("=")[2]) in months]

    def read(self, table: str, months: set[int] | None = None) -> DataFrame:
        """A stored table, or only its partitions of some months: no other folder is listed or read."""
        return read_folders(self.spark, f"{self.root}/{table}", self.folders(table, months), self._schemas()[table])

    # ---- one load

    def apply(self, changes: Mapping[str, DataFrame], customers: DataFrame) -> set[int]:
        """Carry signed rows (column ``_sign``) of ``olist_orders``, ``olist_order_items``, ``olist_order_payments``
        and ``olist_order_reviews`` into all stored tables; the months written again. ``customers`` gives the person
        of each customer id. Rows without an order id are stored, and are in no fact, as in the full refresh."""
        number = current(self.spark, self.root)[0] + 1
        if not self._schemas():
            self._begin(changes, customers)
        stored_any = any(self.folders(t) for t in RAW)
        touched = stage(self._touched(changes if stored_any else {}), "touched")
        months = self._months(touched, changes)
        staged = [touched]
        before, after, folders = {}, {}, []
        for t in RAW:
            before[t] = self._of(self.read(t, months), touched)
            after[t] = self._carry(t, number, months, touched, self._after(t, before[t], changes, after.get("orders")), staged, folders)
        new_fact = self._carry("fact_sales", number, months, touched, self._fact({RAW[t]: after[t].drop(MONTH) for t in RAW}, customers), staged, folders)
        stored = self.read("fact_sales", months)
        old_fact = self._of(stored, touched)
        facts = signed(new_fact, 1).unionByName(signed(old_fact, -1))
        sold = (new_fact.select("order_id", MONTH).join(after["items"].select("order_id", "seller_id"), "order_id").withColumn(SIGN, F.lit(1))
                .unionByName(old_fact.select("order_id", MONTH).join(before["items"].select("order_id", "seller_id"), "order_id").withColumn(SIGN, F.lit(-1))))
        rated = self._changed(changes, "olist_order_reviews")
        review_months: set[int] = set()
        if rated is not None:
            rated = rated.withColumn(MONTH, month_key(date_key("review_creation_date"))).where(F.col(MONTH).isNotNull())
            review_months = {r[0] for r in rated.select(MONTH).distinct().limit(MAX_MONTHS).collect()}
            folders += self._state("reviews", number, review_months, rated.groupBy(MONTH).agg(*_added(REVIEWS)), [], list(REVIEWS), "avaliacoes_linhas")
        folders += self._state("sales", number, months, facts.groupBy(MONTH).agg(*_added(SALES)), [], list(SALES), "linhas")
        for t, rows, key in (("customers", facts, "customer_unique_id"), ("sellers", sold, "seller_id")):
            folders += self._state(t, number, months, rows.groupBy(MONTH, key).agg(F.sum(SIGN).cast("bigint").alias("linhas")), [key], ["linhas"], "linhas")
        written = months | review_months
        folders += self._kpi(number, written, {t: [f for f in folders if f.startswith(f"{t}/")] for t in ("sales", "customers", "sellers", "reviews")},
                             {"sales": months, "customers": months, "sellers": months, "reviews": review_months})
        rewritten = {**{t: months for t in (*RAW, "fact_sales", "sales", "customers", "sellers")}, "reviews": review_months, "kpi": written}
        kept = [f"{t}/{f}" for t, gone in rewritten.items() for f in self.folders(t) if int(partition_of(f).partition("=")[2]) not in gone]
        publish(self.spark, self.root, number, kept + folders)
        for df in staged:
            remove_staged(df)
        return written

    def kpi(self) -> DataFrame:
        """The monthly KPIs (B12), as of the last load."""
        return self.read("kpi").select(F.nullif(F.col(MONTH), F.lit(NO_MONTH)).alias(MONTH), *gold.KPI_COLUMNS[1:])

    # ---- parts of a load

    def _begin(self, changes: Mapping[str, DataFrame], customers: DataFrame) -> None:
        """Record the schemas of all tables, from the raw ones."""
        raw = {name: changes[name].drop(SIGN) for name in RAW.values()}
        of = {t: T.StructType([*raw[name].schema.fields, T.StructField(MONTH, T.IntegerType())]) for t, name in RAW.items()}
        of["fact_sales"] = self._fact({n: df.limit(0) for n, df in raw.items()}, customers.limit(0)).schema
        sums = lambda m: "".join(f", {c} {WIDE if c == 'receita_total' else 'bigint'}" for c in m)
        of["sales"] = T.StructType.fromDDL(f"{sums(SALES)[2:]}, {MONTH} int")
        of["reviews"] = T.StructType.fromDDL(f"{sums(REVIEWS)[2:]}, {MONTH} int")
        of["customers"] = T.StructType.fromDDL(f"customer_unique_id string, linhas bigint, {MONTH} int")
        of["sellers"] = T.StructType.fromDDL(f"seller_id string, linhas bigint, {MONTH} int")
        kinds = {"receita_total": WIDE, "qtd_pedidos": "bigint", "qtd_clientes_unicos": "bigint", "qtd_sellers_ativos": "bigint"}
        of["kpi"] = T.StructType.fromDDL(", ".join(f"{c} {kinds.get(c, 'double')}" for c in gold.KPI_COLUMNS[1:]) + f", {MONTH} int")
        write_small_text(self.spark, f"{self.root}/schemas.json", json.dumps({t: s.jsonValue() for t, s in of.items()}))

    @staticmethod
    def _changed(changes: Mapping[str, DataFrame], name: str) -> DataFrame | None:
        return changes.get(name)

    def _touched(self, changes: Mapping[str, DataFrame]) -> DataFrame:
        """The orders that any change is about; NULL stands for rows without an order."""
        out = None
        for name in RAW.values():
            if (rows := self._changed(changes, name)) is not None:
                ids = rows.select("order_id")
                out = ids if out is None else out.unionByName(ids)
        if out is None:
            out = self.spark.createDataFrame([], "order_id string")
        return out.distinct().withColumnRenamed("order_id", "_touched")

    @staticmethod
    def _of(rows: DataFrame, touched: DataFrame, how: str = "left_semi") -> DataFrame:
        return rows.join(touched, rows["order_id"].eqNullSafe(touched["_touched"]), how)

    def _months(self, touched: DataFrame, changes: Mapping[str, DataFrame]) -> set[int]:
        """Months of the touched orders, as stored (a scan of ids and partition values alone) and as they will be.
        Rows without an order id are in no fact: a change to one concerns the month it names, not those of all others."""
        known = self.read("orders").where(F.col("order_id").isNotNull()).select("order_id", MONTH)
        found = self._of(known, touched).select(MONTH)
        if (orders := self._changed(changes, "olist_orders")) is not None:
            found = found.unionByName(orders.select(_month().alias(MONTH)))
        rows = found.distinct().limit(MAX_MONTHS + 1).collect()
        if len(rows) > MAX_MONTHS:
            raise ValueError(f"the changes touch more than {MAX_MONTHS} months")
        # items and payments that came before their order wait without a month
        return {r[0] for r in rows} | {NO_MONTH}

    def _after(self, t: str, old: DataFrame, changes: Mapping[str, DataFrame], orders: DataFrame | None) -> DataFrame:
        """The touched orders' rows of a dataset once the changes are in, with the month of their order."""
        rows = signed(old.drop(MONTH), 1)
        if (change := self._changed(changes, RAW[t])) is not None:
            rows = rows.unionByName(change.select(*rows.columns))
        columns = [c for c in rows.columns if c != SIGN]
        if orders is None:
            # dealt as the month will be written, so adding up needs no shuffle of its own
            dealt = rows.withColumns({MONTH: _month(), "_salt": _salt("order_id")}).repartition(MONTH, "_salt")
            return consolidated(dealt).select(*columns, MONTH)
        of_order = orders.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.min(MONTH).alias(MONTH))
        # one shuffle by order both adds rows up and finds their month; rows without an order have no place in it
        named = consolidated(rows.where(F.col("order_id").isNotNull()).repartition("order_id"))
        named = named.join(of_order, "order_id", "left").select(*columns, F.coalesce(MONTH, F.lit(NO_MONTH)).alias(MONTH))
        return named.unionByName(consolidated(rows.where(F.col("order_id").isNull())).withColumn(MONTH, F.lit(NO_MONTH)))

    def _carry(self, t: str, number: int, months: set[int], touched: DataFrame, rows: DataFrame, staged: list[DataFrame], folders: list[str]) -> DataFrame:
        """Write a table's touched months with the touched orders' rows as they are now; a frame of those rows. Where
        nothing is stored of these months, it reads what was written, else a staged copy. Adds to ``staged`` and ``folders``."""
        if not self.folders(t, months):
            written = self._rewrite(t, number, rows, "order_id", dealt=t == "orders")
            folders += written
            return read_folders(self.spark, f"{self.root}/{t}", [f.partition("/")[2] for f in written], self._schemas()[t]).select(*rows.columns)
        staged.append(stage(rows, t))
        folders += self._rewrite(t, number, self._of(self.read(t, months), touched, "left_anti").unionByName(staged[-1]), "order_id")
        return staged[-1]

    @staticmethod
    def _fact(raw: Mapping[str, DataFrame], customers: DataFrame) -> DataFrame:
        fact = gold.fact_sales(silver.orders_enriched({**raw, "olist_customers": customers}))
        return fact.withColumn(MONTH, F.coalesce(month_key("date_key"), F.lit(NO_MONTH)))

    def _rewrite(self, t: str, number: int, rows: DataFrame, spread: str | None = None, salts: int = SALTS, dealt: bool = False) -> list[str]:
        """Write a table's touched months for the next version; its folders. A month is written by at most ``salts`` tasks;
        ``dealt`` rows are by month and salt already."""
        keys = [F.col(MONTH)] + ([_salt(spread, salts)] if spread else [])
        path = f"{t}/{VERSION}={number}"
        (rows if dealt else rows.repartition(*keys)).write.mode("overwrite").partitionBy(MONTH).parquet(f"{self.root}/{path}")
        return leaves(self.spark, self.root, path, 1)

    def _state(self, t: str, number: int, months: set[int], delta: DataFrame, key: list[str], sums: list[str], rows: str) -> list[str]:
        """Add signed sums to a state's touched months; groups that are left without rows go."""
        both = self.read(t, months).unionByName(delta)
        now = both.groupBy(MONTH, *key).agg(*[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in sums]).where(F.col(rows) != 0)
        return self._rewrite(t, number, now, key[0] if key else None)

    def _kpi(self, number: int, months: set[int], fresh: dict[str, list[str]], rewritten: dict[str, set[int]]) -> list[str]:
        """KPIs of the touched months, from the states as they are after this load."""
        schemas = self._schemas()

        def state(t: str) -> DataFrame:
            folders = [f.partition("/")[2] for f in fresh[t]] + self.folders(t, months - rewritten[t])
            return read_folders(self.spark, f"{self.root}/{t}", folders, schemas[t])

        customers = state("customers").groupBy(MONTH).agg(F.count("customer_unique_id").alias("qtd_clientes_unicos"))
        sellers = state("sellers").groupBy(MONTH).agg(F.count("seller_id").alias("qtd_sellers_ativos"))
        joined = state("sales").join(customers, MONTH, "left").join(sellers, MONTH, "left").join(state("reviews"), MONTH, "left")
        n = F.col("qtd_pedidos")
        value = {
            "ticket_medio": safe_ratio(F.col("receita_total"), n),
            "taxa_cancelamento": safe_ratio(F.col("canceladas"), n),
            "taxa_entrega_no_prazo": safe_ratio(F.col("no_prazo"), F.col("com_prazo")),
            "prazo_medio_entrega_dias": safe_ratio(F.col("dias"), F.col("com_dias")),
            "nps_score": safe_ratio(F.col("promotores") - F.col("detratores"), F.col("avaliacoes")) * 100.0,
            "nota_media_reviews": safe_ratio(F.col("notas"), F.col("com_nota")),
        }
        rows = joined.select(*[value[c].alias(c) if c in value else F.col(c) for c in gold.KPI_COLUMNS[1:]], MONTH)
        return self._rewrite("kpi", number, rows)
