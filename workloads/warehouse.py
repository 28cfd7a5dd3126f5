"""Tables at rest for the registered queries, each built once per session from the landing data."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators import dims, facts, quality, seeds, staging_csv, staging_json, staging_xml, unify
from ledgerloom.operators.dates import build_dim_date
from ledgerloom.session import materialize
from ledgerloom.sources.audit import write_audit_log

from .landing import Landing, landing
from .truth import AS_OF, BATCH


class Warehouse:
    def __init__(self, spark: SparkSession, inputs: Landing):
        self.spark, self.inputs = spark, inputs

    # ---- staging ----

    @cached_property
    def stg_a(self) -> DataFrame:
        return materialize(staging_xml.stage_client_a_transactions(self.inputs.xml_docs, self.inputs.parsed_txt_docs), "stg-a")

    @cached_property
    def stg_a_items(self) -> DataFrame:
        return materialize(staging_xml.stage_client_a_items(self.stg_a), "stg-a-items")

    @cached_property
    def stg_c(self) -> DataFrame:
        return materialize(staging_json.stage_client_c_transactions(self.inputs.json_docs), "stg-c")

    @cached_property
    def stg_c_items(self) -> DataFrame:
        return materialize(staging_json.stage_client_c_items(self.stg_c), "stg-c-items")

    @cached_property
    def stg_customers(self) -> DataFrame:
        return materialize(staging_csv.stage_customers(self.inputs.customers), "stg-customers")

    @cached_property
    def stg_orders(self) -> DataFrame:
        return materialize(staging_csv.stage_orders(self.inputs.orders), "stg-orders")

    @cached_property
    def stg_products(self) -> DataFrame:
        return materialize(staging_csv.stage_products(self.inputs.products), "stg-products")

    @cached_property
    def stg_payments(self) -> DataFrame:
        return materialize(staging_csv.stage_payments(self.inputs.payments), "stg-payments")

    @cached_property
    def unified(self) -> DataFrame:
        return unify.unify_transactions(self.stg_a, self.stg_c)

    @cached_property
    def unified_items(self) -> DataFrame:
        return unify.unify_transaction_items(self.stg_a_items, self.stg_c_items)

    # ---- canonical ----

    @cached_property
    def dim_date(self) -> DataFrame:
        return build_dim_date(self.spark, "1995-01-01", "2002-12-31")

    @cached_property
    def methods(self) -> DataFrame:
        return seeds.seed_dim_payment_method(self.spark)

    @cached_property
    def statuses(self) -> DataFrame:
        return seeds.seed_dim_order_status(self.spark)

    def new_customers(self) -> DataFrame:
        return dims.new_dimension(self.spark, dims.CUSTOMER, AS_OF)

    def load_dim_customer(self) -> DataFrame:
        return dims.load_dim_customer(self.new_customers(), self.stg_customers, self.stg_a, self.stg_c, AS_OF)

    def load_dim_product(self) -> DataFrame:
        target = dims.new_dimension(self.spark, dims.PRODUCT, AS_OF)
        return dims.load_dim_product(target, self.stg_products, self.stg_a_items, self.stg_c_items, AS_OF)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.load_dim_customer()

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.load_dim_product()

    def no_facts(self, columns: list[str]) -> DataFrame:
        return facts.empty_fact(self.spark, columns)

    def load_fact_a(self) -> DataFrame:
        none = self.no_facts(facts.FACT_TRANSACTION)
        return facts.load_fact_transaction_client_a(self.stg_a, self.dim_customer, self.dim_date, self.methods, none, AS_OF)

    @cached_property
    def fact_a(self) -> DataFrame:
        return self.load_fact_a()  # at rest with its keys

    def load_fact_c(self) -> DataFrame:
        return facts.load_fact_transaction_client_c(self.stg_c, self.dim_customer, self.dim_date, self.methods, self.fact_a, AS_OF)

    @cached_property
    def fact_ac(self) -> DataFrame:
        return self.fact_a.unionByName(self.load_fact_c())

    def load_fact_item(self) -> DataFrame:
        none = self.no_facts(facts.FACT_ITEM)
        return facts.load_fact_transaction_item(self.stg_a_items, self.stg_c_items, self.fact_ac, self.dim_product, none, AS_OF)

    @cached_property
    def fact_item(self) -> DataFrame:
        return self.load_fact_item()

    def update_aggregates(self) -> DataFrame:
        return facts.update_transaction_aggregates(self.fact_ac, self.fact_item)

    @cached_property
    def fact(self) -> DataFrame:
        return materialize(self.update_aggregates(), "fact")

    def load_fact_order(self) -> DataFrame:
        none = self.no_facts(facts.FACT_ORDER)
        return facts.load_fact_order(self.stg_orders, self.dim_customer, self.dim_date, self.statuses, none, AS_OF)

    @cached_property
    def fact_order(self) -> DataFrame:
        return self.load_fact_order()

    def load_fact_payment(self) -> DataFrame:
        none = self.no_facts(facts.FACT_PAYMENT)
        return facts.load_fact_payment(self.stg_payments, self.dim_date, self.methods, none, AS_OF)

    @cached_property
    def fact_payment(self) -> DataFrame:
        return self.load_fact_payment()

    # ---- data quality ----

    def detect_duplicates(self) -> DataFrame:
        return quality.detect_duplicate_transactions(self.stg_a, self.stg_c, BATCH, AS_OF)

    @cached_property
    def tracker(self) -> DataFrame:
        return materialize(self.detect_duplicates(), "tracker")

    def log_issues(self) -> DataFrame:
        return (
            quality.duplicate_issues(self.tracker, BATCH, AS_OF)
            .unionByName(quality.log_issues_client_a(self.stg_a, self.stg_a_items, BATCH, AS_OF))
            .unionByName(quality.log_issues_client_c(self.stg_c, self.stg_c_items, BATCH, AS_OF))
            .unionByName(quality.detect_amount_mismatches(self.fact, BATCH, AS_OF))
        )

    @cached_property
    def issues(self) -> DataFrame:
        return materialize(self.log_issues(), "issues")

    def calculate_metrics(self) -> DataFrame:
        return quality.calculate_dq_metrics(self.stg_a, self.stg_c, self.fact, self.issues, self.tracker, BATCH, AS_OF)

    @cached_property
    def metrics(self) -> DataFrame:
        return materialize(self.calculate_metrics(), "metrics")

    @cached_property
    def audit(self) -> DataFrame:
        """Audit rows of three loads, an hour apart."""
        ended = ["2025-01-15 10:05:00", "2025-01-15 11:05:00", "2025-01-15 12:05:00"]
        loads = [
            write_audit_log(self.inputs.customers, "raw.raw_csv_customers", ".*", AS_OF, ended[0]),
            write_audit_log(self.inputs.xml_docs, "raw.raw_xml_transactions", ".*", AS_OF, ended[1]),
            write_audit_log(self.inputs.json_docs, "raw.raw_json_transactions", ".*", AS_OF, ended[2]),
        ]
        return materialize(loads[0].unionByName(loads[1]).unionByName(loads[2]), "audit")

    def with_test_batches(self, df: DataFrame) -> DataFrame:
        """The rows spread over four batches by raw record id."""
        return df.withColumn("batch_id", F.concat(F.lit("BATCH_"), (F.col("raw_record_id") % 4).cast("string")))


_SHARED: dict = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = Warehouse(spark, landing(spark, sf_dir))
    return _SHARED[key]
