"""History-keeping customer and product dimensions (SCD type 2)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import functions as x
from ..session import materialize
from .keys import assign_surrogate_keys, keep_first, max_key
from .lookups import not_in_current

FOREVER = "9999-12-31 23:59:59"

_HISTORY = [
    ("record_hash", "string"), ("effective_from", "timestamp"), ("effective_to", "timestamp"),
    ("is_current", "boolean"), ("version_number", "bigint"), ("created_at", "timestamp"), ("updated_at", "timestamp"),
]


@dataclass(frozen=True)
class Dimension:
    name: str
    sk: str
    key: str
    attributes: list = field(default_factory=list)  # (name, type)
    unknown: dict = field(default_factory=dict)

    @property
    def columns(self) -> list:
        return [(self.sk, "bigint"), (self.key, "string"), *self.attributes, *_HISTORY]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.columns]


CUSTOMER = Dimension(
    "dim_customer", "customer_sk", "customer_id",
    [
        ("first_name", "string"), ("last_name", "string"), ("full_name", "string"), ("email", "string"),
        ("email_domain", "string"), ("email_validation_status", "string"), ("loyalty_tier", "string"),
        ("signup_source", "string"), ("is_active", "boolean"), ("source_client", "string"),
        ("source_file_name", "string"),
    ],
    {
        "customer_id": "UNKNOWN", "first_name": "Unknown", "last_name": "Customer", "full_name": "Unknown Customer",
        "email": "unknown@unknown.com", "email_validation_status": "UNKNOWN", "loyalty_tier": "UNKNOWN",
        "source_client": "SYSTEM",
    },
)
PRODUCT = Dimension(
    "dim_product", "product_sk", "sku",
    [
        ("product_id", "string"), ("product_name", "string"), ("description", "string"), ("category", "string"),
        ("subcategory", "string"), ("price", "decimal(18,4)"), ("currency", "string"), ("source_client", "string"),
        ("source_file_name", "string"),
    ],
    {
        "sku": "UNKNOWN", "product_name": "Unknown Product", "description": "Unknown product placeholder",
        "category": "Unknown", "currency": "USD", "source_client": "SYSTEM",
    },
)


def new_dimension(spark: SparkSession, dim: Dimension, as_of: str) -> DataFrame:
    """A dimension holding only its unknown member."""
    now = F.lit(as_of).cast("timestamp")
    values = {
        **{k: F.lit(v) for k, v in dim.unknown.items()}, dim.sk: F.lit(-1),
        "effective_from": now, "effective_to": F.lit(FOREVER), "is_current": F.lit(True),
        "version_number": F.lit(1), "created_at": now, "updated_at": now,
    }
    return spark.range(1).select(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in dim.columns])


# ---- candidates -----------------------------------------------------------


def _shape(rows: DataFrame, dim: Dimension, values: dict[str, Column]) -> DataFrame:
    columns = [(dim.key, "string"), *dim.attributes, ("record_hash", "string")]
    return rows.select(
        *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in columns],
        *[F.col(c) for c in ("_priority", "_seen", "_record", "_position") if c in rows.columns],
    )


def _ranked(rows: DataFrame, priority: int) -> DataFrame:
    """Add the columns that decide which of several rows per key comes first."""
    position = "transaction_index" if "transaction_index" in rows.columns else "file_row_number"
    line = F.col("line_number") if "line_number" in rows.columns else F.lit(0)
    return rows.withColumns({
        "_priority": F.lit(priority),
        "_seen": F.col("ingestion_timestamp"),
        "_record": F.col("raw_record_id"),
        "_position": F.struct(F.col(position).cast("bigint").alias("p"), line.cast("bigint").alias("l")),
    })


_FIRST = ["_priority", "_seen", "source_file_name", "_record", "_position"]


def _person(tier: str) -> dict[str, Column]:
    c = F.col
    return {
        "customer_id": c("customer_id"), "first_name": c("first_name"), "last_name": c("last_name"),
        "full_name": F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit(""))),
        "email": c("email"), "email_domain": x.email_domain(c("email")),
        "email_validation_status": c("email_validation_status"),
        "loyalty_tier": x.loyalty_tier_code(c(tier)), "source_file_name": c("source_file_name"),
    }


def customers_from_csv(staged: DataFrame) -> DataFrame:
    rows = _ranked(staged.filter("customer_id IS NOT NULL AND NOT is_missing_customer_id"), 0)
    values = {
        **_person("loyalty_tier"), "source_client": F.lit("CSV"), "signup_source": F.col("signup_source"),
        "is_active": F.col("is_active"), "record_hash": F.col("record_hash"),
    }
    return _shape(rows, CUSTOMER, values)


def _customers_from_client(staged: DataFrame, client: str, tier: str, priority: int) -> DataFrame:
    rows = _ranked(staged.filter("customer_id IS NOT NULL AND NOT is_missing_customer_id"), priority)
    return _shape(rows, CUSTOMER, {**_person(tier), "source_client": F.lit(client)})


def customers_from_client_a(staged: DataFrame) -> DataFrame:
    return _customers_from_client(staged, "ClientA", "loyalty_tier_extra", 1)


def customers_from_client_c(staged: DataFrame) -> DataFrame:
    return _customers_from_client(staged, "ClientC", "loyalty_tier", 2)


def products_from_csv(staged: DataFrame) -> DataFrame:
    rows = _ranked(staged.filter("sku IS NOT NULL AND NOT is_missing_sku"), 0)
    c = F.col
    return _shape(rows, PRODUCT, {
        **{n: c(n) for n in ("sku", "product_id", "product_name", "description", "category", "price", "currency",
                             "source_file_name", "record_hash")},
        "source_client": F.lit("CSV"),
    })


def products_from_items(items: DataFrame, client: str, priority: int) -> DataFrame:
    """Products seen only in baskets; the description doubles as the name."""
    rows = _ranked(items.filter("sku IS NOT NULL AND NOT is_missing_sku"), priority)
    c = F.col
    return _shape(rows, PRODUCT, {
        "sku": c("sku"), "product_name": c("description"), "description": c("description"),
        "currency": F.lit("USD"), "source_client": F.lit(client), "source_file_name": c("source_file_name"),
    })


def one_per_key(candidates: DataFrame, dim: Dimension) -> DataFrame:
    return keep_first(candidates, [dim.key], _FIRST).drop("_seen", "_record", "_position")


# ---- history --------------------------------------------------------------


def _merge(target: DataFrame, source: DataFrame, dim: Dimension, as_of: str, new_versions: bool) -> DataFrame:
    """Rows after merging at most one source row per key; new rows have no surrogate key yet.

    One full outer join on the business key yields for each key the kept or
    expired current row and, where due, the new row. Only rows of the reference
    file (priority 0) may change a known member; others only add members.
    """
    now = F.lit(as_of).cast("timestamp")
    current = F.col("is_current") & (F.col(dim.sk) != -1)
    known = target.filter(current).select(F.col(dim.key).alias("_known"), F.struct(*dim.names).alias("t"))
    given = source.select(F.col(dim.key).alias("_given"), F.struct("*").alias("s"))
    t, s = F.col("t"), F.col("s")
    changed = F.coalesce(
        t.isNotNull() & s.isNotNull() & (s["_priority"] == 0) & ~t["record_hash"].eqNullSafe(s["record_hash"]), F.lit(False)
    )
    added = t.isNull() | changed if new_versions else t.isNull()

    def old(n: str) -> Column:
        replaced = {"effective_to": now, "is_current": F.lit(False), "updated_at": now}.get(n)
        return t[n] if replaced is None else F.when(changed, replaced).otherwise(t[n])

    fresh = {
        dim.sk: F.lit(None), "effective_from": now, "effective_to": F.lit(FOREVER), "is_current": F.lit(True),
        "version_number": F.coalesce(t["version_number"], F.lit(0)) + 1, "created_at": now, "updated_at": now,
    }
    kept_row = F.when(t.isNotNull(), F.struct(*[old(n).cast(ty).alias(n) for n, ty in dim.columns]))
    new_row = F.when(added, F.struct(*[(fresh[n] if n in fresh else s[n]).cast(ty).alias(n) for n, ty in dim.columns]))
    both = known.join(given, F.col("_known") == F.col("_given"), "full")
    rows = both.select(F.explode(F.array(kept_row, new_row)).alias("r")).filter("r IS NOT NULL").select("r.*")
    return target.filter(~current).select(*dim.names).unionByName(rows)


def _with_keys(merged: DataFrame, target: DataFrame, dim: Dimension) -> DataFrame:
    merged = materialize(merged, f"{dim.name}-merge")
    fresh = merged.filter(F.col(dim.sk).isNull()).drop(dim.sk)
    new = assign_surrogate_keys(fresh, dim.sk, [dim.key], max_key(target, dim.sk), fresh.count())
    return merged.filter(F.col(dim.sk).isNotNull()).unionByName(new)


def changed_members(target: DataFrame, source: DataFrame, dim: Dimension) -> DataFrame:
    """The source rows, at most one per key, that a merge would act on: unknown keys, and known members the reference file changes."""
    current = target.filter(F.col("is_current") & (F.col(dim.sk) != -1)).select(F.col(dim.key).alias("_known"), F.col("record_hash").alias("_hash"))
    joined = source.join(current, F.col(dim.key) == F.col("_known"), "left")
    changed = (F.col("_priority") == 0) & ~F.col("record_hash").eqNullSafe(F.col("_hash"))
    return joined.filter(F.col("_known").isNull() | changed).drop("_known", "_hash")


def apply_changes(target: DataFrame, changes: DataFrame, dim: Dimension, as_of: str) -> DataFrame:
    """``scd2_apply`` for rows found by ``changed_members``."""
    return _with_keys(_merge(target, changes, dim, as_of, new_versions=True), target, dim)


def change_segment(target: DataFrame, changes: DataFrame, dim: Dimension, as_of: str) -> DataFrame:
    """Only the rows that ``apply_changes`` would change or add: expired versions under their keys, and new ones."""
    current = target.filter(F.col("is_current") & (F.col(dim.sk) != -1)).join(changes.select(dim.key), dim.key, "left_semi")
    return _with_keys(_merge(current.select(*dim.names), changes, dim, as_of, new_versions=True), target, dim)


def scd2_apply(target: DataFrame, source: DataFrame, dim: Dimension, as_of: str) -> DataFrame:
    """Expire changed members and add their next version; add unknown keys; keep the rest."""
    return _with_keys(_merge(target, one_per_key(source, dim), dim, as_of, new_versions=True), target, dim)


def scd2_merge_dim_customer(target: DataFrame, staged_customers: DataFrame, as_of: str) -> DataFrame:
    """The plain merge: a changed member is expired only, its next version waits for the next run."""
    source = one_per_key(customers_from_csv(staged_customers), CUSTOMER)
    return _with_keys(_merge(target, source, CUSTOMER, as_of, new_versions=False), target, CUSTOMER)


def _insert_new(target: DataFrame, candidates: DataFrame, dim: Dimension, as_of: str) -> DataFrame:
    new = one_per_key(not_in_current(candidates, target, dim.key), dim)
    now = F.lit(as_of).cast("timestamp")
    rows = new.withColumns({
        "effective_from": now, "effective_to": F.lit(FOREVER).cast("timestamp"), "is_current": F.lit(True),
        "version_number": F.lit(1).cast("bigint"), "created_at": now, "updated_at": now,
    })
    return assign_surrogate_keys(rows, dim.sk, [dim.key], max_key(target, dim.sk)).select(*dim.names)


def insert_customers_from_client_a(target: DataFrame, staged: DataFrame, as_of: str) -> DataFrame:
    """New dimension rows for customers known only from client-A transactions."""
    return _insert_new(target, customers_from_client_a(staged), CUSTOMER, as_of)


def insert_customers_from_client_c(target: DataFrame, staged: DataFrame, as_of: str) -> DataFrame:
    return _insert_new(target, customers_from_client_c(staged), CUSTOMER, as_of)


def customer_candidates(customers: DataFrame, client_a: DataFrame, client_c: DataFrame) -> DataFrame:
    """Reference file first, then client A, then client C."""
    candidates = customers_from_csv(customers).unionByName(customers_from_client_a(client_a))
    return candidates.unionByName(customers_from_client_c(client_c))


def product_candidates(products: DataFrame, items_a: DataFrame, items_c: DataFrame) -> DataFrame:
    candidates = products_from_csv(products).unionByName(products_from_items(items_a, "ClientA", 1))
    return candidates.unionByName(products_from_items(items_c, "ClientC", 2))


def load_dim_customer(target: DataFrame, customers: DataFrame, client_a: DataFrame, client_c: DataFrame, as_of: str) -> DataFrame:
    """All sources in a single merge."""
    return scd2_apply(target, customer_candidates(customers, client_a, client_c), CUSTOMER, as_of)


def load_dim_product(target: DataFrame, products: DataFrame, items_a: DataFrame, items_c: DataFrame, as_of: str) -> DataFrame:
    return scd2_apply(target, product_candidates(products, items_a, items_c), PRODUCT, as_of)


def dimension_load_counts(dim_after: DataFrame, as_of: str) -> DataFrame:
    """(action, row_count): rows the reference file touched, and members added from transactions."""
    now = F.lit(as_of).cast("timestamp")
    from_file = F.col("source_client") == "CSV"
    started, ended = F.col("effective_from") == now, F.col("effective_to") == now
    counted = dim_after.filter("source_client != 'SYSTEM'").agg(
        F.count_if((from_file & started) | ended).alias("merged"),
        F.count_if(~from_file & started).alias("inserted"),
    )
    return counted.select(F.explode(F.array(
        F.struct(F.lit("MERGED").alias("action"), F.col("merged").alias("row_count")),
        F.struct(F.lit("INSERTED").alias("action"), F.col("inserted").alias("row_count")),
    )).alias("r")).select("r.*")
