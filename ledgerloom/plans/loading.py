"""Loading the star schema from staging, incrementally and repeatably."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, functions as F

from ..operators import dims, facts, seeds
from ..operators.dates import FIRST_DAY, LAST_DAY, build_dim_date
from ..session import materialize, run_together
from .staging import CLIENT_A, CLIENT_A_ITEMS, CLIENT_C, CLIENT_C_ITEMS
from .store import TableStore

DIM_CUSTOMER, DIM_PRODUCT, DIM_DATE = "canonical.dim_customer", "canonical.dim_product", "canonical.dim_date"
DIM_METHOD, DIM_STATUS, DIM_CURRENCY = "canonical.dim_payment_method", "canonical.dim_order_status", "canonical.dim_currency"
FACT_TRANSACTION, FACT_ITEM = "canonical.fact_transaction", "canonical.fact_transaction_item"
FACT_ORDER, FACT_PAYMENT = "canonical.fact_order", "canonical.fact_payment"

FACT_COLUMNS = {
    FACT_TRANSACTION: facts.FACT_TRANSACTION,
    FACT_ITEM: facts.FACT_ITEM,
    FACT_ORDER: facts.FACT_ORDER,
    FACT_PAYMENT: facts.FACT_PAYMENT,
}


def create_dimensions(store: TableStore, as_of: str, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> None:
    """Seed the dimensions that do not exist yet."""
    spark = store.spark
    makers = {
        DIM_CUSTOMER: lambda: dims.new_dimension(spark, dims.CUSTOMER, as_of),
        DIM_PRODUCT: lambda: dims.new_dimension(spark, dims.PRODUCT, as_of),
        DIM_DATE: lambda: build_dim_date(spark, first_day, last_day).coalesce(1),
        DIM_METHOD: lambda: seeds.seed_dim_payment_method(spark).coalesce(1),
        DIM_STATUS: lambda: seeds.seed_dim_order_status(spark).coalesce(1),
        DIM_CURRENCY: lambda: seeds.seed_dim_currency(spark).coalesce(1),
    }
    missing = [partial(store.overwrite, name, make()) for name, make in makers.items() if not store.exists(name)]
    if missing:
        run_together(*missing)


def read_fact(store: TableStore, name: str, batches: list[str] | None = None) -> DataFrame:
    return store.read(name, facts.empty_fact(store.spark, FACT_COLUMNS[name]), parts=batches)


@dataclass
class Step:
    name: str
    result: str
    completed_at: str


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def refresh_transaction_aggregates(store: TableStore, new_lines: DataFrame) -> int:
    """Add the figures of new lines to their headers; returns the number of headers.

    Earlier lines are not read again. Keys rise from load to load, so the range of the
    headers' keys lets the scan for their batches skip files of older ones; only those
    batches are rewritten. Lines and figures are committed together by the caller's transaction.
    """
    sums = materialize(facts.aggregate_items_per_transaction(new_lines), "line-sums")
    n, low, high = sums.agg(F.count(F.lit(1)), F.min("transaction_sk"), F.max("transaction_sk")).first()
    if not n:
        return 0
    headers = read_fact(store, FACT_TRANSACTION).filter(F.col("transaction_sk").between(low, high))
    # a handful of names, not rows
    batches = [r[0] for r in headers.join(sums, "transaction_sk", "left_semi").select("batch_id").distinct().collect()]
    store.replace_batches(FACT_TRANSACTION, facts.add_to_aggregates(read_fact(store, FACT_TRANSACTION, batches), sums), batches)
    return n


def load_all(store: TableStore, staged: dict[str, DataFrame], as_of: str) -> DataFrame:
    """Dimensions, then facts, then figures derived from lines; returns (step, result, completed_at).

    Keys already loaded are skipped, so a repeated run adds nothing twice. All tables change
    in one commit: a load that breaks off leaves none of it behind.
    """
    with store.transaction():
        return _load_all(store, staged, as_of)


def _load_all(store: TableStore, staged: dict[str, DataFrame], as_of: str) -> DataFrame:
    spark = store.spark
    create_dimensions(store, as_of)
    a, c, items_a, items_c = (staged[n] for n in (CLIENT_A, CLIENT_C, CLIENT_A_ITEMS, CLIENT_C_ITEMS))

    def step(name: str, work: Callable[[], str]) -> Step:
        return Step(name, work(), _now())

    def dimension(name: str, dim: dims.Dimension, candidates: DataFrame) -> str:
        # only members that change are merged and written, as a segment; without any, nothing is
        changes = materialize(dims.changed_members(store.read(name), dims.one_per_key(candidates, dim), dim), f"{dim.name}-changes")
        if not changes.isEmpty():
            store.upsert(name, dims.change_segment(store.read(name), changes, dim, as_of), dim.sk)
        return "Completed"

    def customers() -> str:
        return dimension(DIM_CUSTOMER, dims.CUSTOMER, dims.customer_candidates(staged["staging.stg_customers"], a, c))

    def products() -> str:
        return dimension(DIM_PRODUCT, dims.PRODUCT, dims.product_candidates(staged["staging.stg_products"], items_a, items_c))

    steps = run_together(lambda: step("dim_customer", customers), lambda: step("dim_product", products))
    dim_customer, dim_product, dim_date = store.read(DIM_CUSTOMER), store.read(DIM_PRODUCT), store.read(DIM_DATE)
    methods, statuses = store.read(DIM_METHOD), store.read(DIM_STATUS)

    def transactions(load, rows: DataFrame, client: str) -> str:
        new = load(rows, dim_customer, dim_date, methods, read_fact(store, FACT_TRANSACTION), as_of)
        return f"{client} transactions loaded: {store.append(FACT_TRANSACTION, new)} rows"

    new_lines: list[DataFrame] = []

    def lines() -> str:
        new = facts.load_fact_transaction_item(
            items_a, items_c, read_fact(store, FACT_TRANSACTION), dim_product, read_fact(store, FACT_ITEM), as_of
        )
        new_lines.append(new)  # at rest with its keys
        return f"Transaction items loaded: {store.append(FACT_ITEM, new_lines[0])} rows"

    def orders() -> str:
        new = facts.load_fact_order(staged["staging.stg_orders"], dim_customer, dim_date, statuses, read_fact(store, FACT_ORDER), as_of)
        return f"Orders loaded: {store.append(FACT_ORDER, new)} rows"

    def payments() -> str:
        new = facts.load_fact_payment(staged["staging.stg_payments"], dim_date, methods, read_fact(store, FACT_PAYMENT), as_of)
        return f"Payments loaded: {store.append(FACT_PAYMENT, new)} rows"

    def transaction_chain() -> list[Step]:
        return [
            step("fact_transaction_client_a", lambda: transactions(facts.load_fact_transaction_client_a, a, "ClientA")),
            step("fact_transaction_client_c", lambda: transactions(facts.load_fact_transaction_client_c, c, "ClientC")),
            step("fact_transaction_item", lines),
            step("transaction_aggregates", lambda: f"Transaction aggregates updated: {refresh_transaction_aggregates(store, new_lines[0])} rows"),
        ]

    chain, of_orders, of_payments = run_together(
        transaction_chain, lambda: step("fact_order", orders), lambda: step("fact_payment", payments)
    )
    steps += [*chain, of_orders, of_payments]
    return spark.createDataFrame([(s.name, s.result, s.completed_at) for s in steps], "step string, result string, completed_at string").withColumn(
        "completed_at", F.col("completed_at").cast("timestamp")
    )
