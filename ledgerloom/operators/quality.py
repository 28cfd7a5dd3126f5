"""Issue detection, duplicate tracking, metrics, validation rules, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import EMAIL_PATTERN
from ..session import materialize
from .facts import FIRST_SEEN
from .keys import check_unique, keep_first

ISSUE_FIELDS = [
    ("batch_id", "string"), ("source_client", "string"), ("source_file_name", "string"), ("source_table", "string"),
    ("target_table", "string"), ("issue_type", "string"), ("issue_category", "string"), ("issue_severity", "string"),
    ("issue_description", "string"), ("record_identifier", "string"), ("field_name", "string"),
    ("field_value_raw", "string"), ("field_value_expected", "string"), ("resolution_action", "string"),
    ("resolution_notes", "string"), ("is_resolved", "boolean"), ("resolved_at", "timestamp"),
    ("resolved_by", "string"), ("detected_at", "timestamp"),
]


def _issue_log(rows: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """Fill the columns a check does not set."""
    known = {"batch_id": F.lit(batch_id), "is_resolved": F.lit(False), "detected_at": F.lit(as_of).cast("timestamp")}
    columns = []
    for name, kind in ISSUE_FIELDS:
        source = known.get(name, F.col(name) if name in rows.columns else F.lit(None))
        columns.append(source.cast(kind).alias(name))
    return rows.select(*columns)


# ---- duplicates -----------------------------------------------------------


def detect_duplicate_keys(rows: DataFrame, key: str, label: str, resolution: str, client: str) -> DataFrame:
    """Groups of rows sharing a key, with the files they occur in.

    Counted per key and file first: however many copies a key has, what is
    shuffled and collected for it is one entry per file. Rows whose key is missing
    or blank share no key; they have an issue of their own.
    """
    per_file = rows.filter(F.trim(key) != "").groupBy(F.col(key).alias("duplicate_key"), "source_file_name").agg(
        F.count(F.lit(1)).alias("_n")
    )
    groups = per_file.groupBy("duplicate_key").agg(
        F.sum("_n").alias("occurrence_count"),
        F.min("source_file_name").alias("first_occurrence_file"),
        F.array_sort(F.collect_list("source_file_name")).alias("all_occurrence_files"),
    )
    return groups.filter("occurrence_count > 1").select(
        F.lit(client).alias("source_client"), F.lit(label).alias("duplicate_type"), "duplicate_key",
        F.sha2("duplicate_key", 256).alias("duplicate_key_hash"), "occurrence_count", "first_occurrence_file",
        "all_occurrence_files", F.lit(resolution).alias("resolution_method"),
    )


def detect_duplicate_transactions(client_a: DataFrame, client_c: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """Duplicate tracker rows: transaction ids of both clients, order ids of client A."""
    found = (
        detect_duplicate_keys(client_a, "transaction_id", "TRANSACTION_ID", "KEEP_FIRST", "ClientA")
        .unionByName(detect_duplicate_keys(client_c, "transaction_id", "TRANSACTION_ID", "KEEP_FIRST", "ClientC"))
        .unionByName(detect_duplicate_keys(client_a, "order_id", "ORDER_ID", "ALLOW_MULTIPLE", "ClientA"))
    )
    return found.withColumns({"batch_id": F.lit(batch_id), "detected_at": F.lit(as_of).cast("timestamp")})


def duplicate_issues(tracker: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """One issue per duplicate group."""
    c = F.col
    text = F.concat(
        F.lit("Found "), c("occurrence_count").cast("string"), F.lit(" occurrences of "), c("duplicate_type"),
        F.lit(" = "), c("duplicate_key"),
    )
    table = F.when(c("source_client") == "ClientA", "staging.stg_client_a_transactions").otherwise(
        "staging.stg_client_c_transactions"
    )
    rows = tracker.select(
        "source_client", table.alias("source_table"),
        F.concat(F.lit("DUPLICATE_"), c("duplicate_type")).alias("issue_type"),
        F.lit("UNIQUENESS").alias("issue_category"),
        F.when(c("duplicate_type") == "TRANSACTION_ID", "CRITICAL").otherwise("WARNING").alias("issue_severity"),
        text.alias("issue_description"), c("duplicate_key").alias("record_identifier"),
    )
    return _issue_log(rows, batch_id, as_of)


# ---- issue catalogue ------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One entry of the catalogue, as SQL over a staged table."""

    issue_type: str
    category: str
    severity: str
    predicate: str
    description: str
    field: str
    raw_field: str
    identifier: str = "transaction_id"
    expected: str | None = None
    target: str = "canonical.fact_transaction"


_NO_ID = "coalesce(order_id, 'UNKNOWN_' || cast(raw_record_id AS string))"
_LINE = "transaction_id || '-' || coalesce(sku, 'LINE_' || cast(line_number AS string))"
_ITEM_TABLE = "canonical.fact_transaction_item"


def _missing(field: str, severity: str, label: str, flag: str | None = None) -> Check:
    return Check(
        f"MISSING_{field.upper()}", "COMPLETENESS", severity,
        f"{flag or 'is_missing_' + field} AND NOT is_missing_transaction_id",
        f"'{label} is missing or empty'", field, f"{field}_raw",
    )


def _header_checks(expected: str | None) -> tuple[Check, Check]:
    missing_id = Check(
        "MISSING_TRANSACTION_ID", "COMPLETENESS", "CRITICAL", "is_missing_transaction_id",
        "'Transaction ID is missing or empty'", "transaction_id", "transaction_id_raw", _NO_ID,
    )
    negative = Check(
        "NEGATIVE_PAYMENT_AMOUNT", "VALIDITY", "HIGH", "is_negative_payment_amount",
        "'Payment amount is negative: ' || payment_amount_raw", "payment_amount", "payment_amount_raw",
        expected=expected,
    )
    return missing_id, negative


def _negative_quantity(expected: str | None) -> Check:
    return Check(
        "NEGATIVE_QUANTITY", "VALIDITY", "HIGH", "is_negative_quantity",
        "'Item quantity is negative: ' || quantity_raw", "quantity", "quantity_raw", _LINE, expected, _ITEM_TABLE,
    )


_missing_id_a, _negative_amount_a = _header_checks(">= 0")
HEADER_CHECKS_A = [
    _missing_id_a,
    _missing("customer_id", "HIGH", "Customer ID"),
    _missing("order_id", "HIGH", "Order ID"),
    _missing("order_date", "MEDIUM", "Order date"),
    Check(
        "INVALID_EMAIL_FORMAT", "FORMAT", "LOW", "email_validation_status = 'INVALID'", "'Email format is invalid'",
        "email", "email_raw", expected="user@domain.com", target="canonical.dim_customer",
    ),
    _missing("payment_method", "MEDIUM", "Payment method"),
    _negative_amount_a,
]
ITEM_CHECKS_A = [
    _negative_quantity(">= 0"),
    Check(
        "NEGATIVE_UNIT_PRICE", "VALIDITY", "HIGH", "is_negative_unit_price",
        "'Unit price is negative: ' || unit_price_raw", "unit_price", "unit_price_raw", _LINE, ">= 0", _ITEM_TABLE,
    ),
    Check(
        "MISSING_SKU", "COMPLETENESS", "MEDIUM", "is_missing_sku", "'Item SKU is missing or empty'", "sku", "sku_raw",
        "transaction_id || '-LINE_' || cast(line_number AS string)", None, _ITEM_TABLE,
    ),
]
HEADER_CHECKS_C = list(_header_checks(None))
ITEM_CHECKS_C = [_negative_quantity(None)]


def run_checks(staged: DataFrame, checks: list[Check], source_table: str) -> DataFrame:
    """All checks in one pass: each row yields the list of its issues, which is then unfolded."""
    found = []
    for check in checks:
        issue = F.struct(
            F.lit(check.target).alias("target_table"),
            F.lit(check.issue_type).alias("issue_type"),
            F.lit(check.category).alias("issue_category"),
            F.lit(check.severity).alias("issue_severity"),
            F.expr(check.description).alias("issue_description"),
            F.expr(check.identifier).alias("record_identifier"),
            F.lit(check.field).alias("field_name"),
            F.col(check.raw_field).alias("field_value_raw"),
            F.lit(check.expected).cast("string").alias("field_value_expected"),
        )
        found.append(F.when(F.expr(check.predicate), issue))
    per_row = staged.select("source_client", "source_file_name", F.explode(F.array(*found)).alias("i"))
    return per_row.filter("i IS NOT NULL").select(
        "source_client", "source_file_name", F.lit(source_table).alias("source_table"), "i.*"
    )


def _log(headers, items, header_checks, item_checks, client, batch_id, as_of) -> DataFrame:
    table = f"staging.stg_client_{client}_transaction"
    rows = run_checks(headers, header_checks, f"{table}s").unionByName(run_checks(items, item_checks, f"{table}_items"))
    return _issue_log(rows, batch_id, as_of)


def log_issues_client_a(headers: DataFrame, items: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    return _log(headers, items, HEADER_CHECKS_A, ITEM_CHECKS_A, "a", batch_id, as_of)


def log_issues_client_c(headers: DataFrame, items: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """The raw value is the primary field; for a payment under its other name that is NULL."""
    return _log(headers, items, HEADER_CHECKS_C, ITEM_CHECKS_C, "c", batch_id, as_of)


def amount_mismatch() -> Column:
    """More than a cent and more than 5 % of the payment apart; a payment of zero never counts.
    The share is compared as a product: a rounded quotient could cross the line."""
    paid, lines = F.col("payment_amount_abs"), F.col("total_line_amount_abs")
    gap = F.abs(paid - lines)
    cent, share = F.lit("0.01").cast("decimal(18,4)"), F.lit("0.05").cast("decimal(4,2)")
    return (gap > cent) & (paid != 0) & (gap > paid * share)


def detect_amount_mismatches(fact_transaction: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    c = F.col
    paid, lines = c("payment_amount_abs").cast("string"), c("total_line_amount_abs").cast("string")
    rows = fact_transaction.filter(amount_mismatch()).select(
        "source_client",
        F.lit("canonical.fact_transaction").alias("source_table"),
        F.lit("canonical.fact_transaction").alias("target_table"),
        F.lit("AMOUNT_MISMATCH").alias("issue_type"), F.lit("CONSISTENCY").alias("issue_category"),
        F.lit("WARNING").alias("issue_severity"),
        F.concat(F.lit("Payment amount ("), paid, F.lit(") does not match line total ("), lines, F.lit(")")).alias("issue_description"),
        c("transaction_id").alias("record_identifier"),
        F.lit("payment_amount vs total_line_amount").alias("field_name"),
        paid.alias("field_value_raw"), lines.alias("field_value_expected"),
    )
    return _issue_log(rows, batch_id, as_of)


# ---- metrics --------------------------------------------------------------


def percent(part: Column, whole: Column) -> Column:
    share = F.lit("100.0").cast("decimal(4,1)") * part.cast("decimal(18,0)") / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(share, 2).cast("decimal(9,2)")


def calculate_dq_metrics(
    client_a: DataFrame, client_c: DataFrame, fact_transaction: DataFrame, issues: DataFrame, tracker: DataFrame,
    batch_id: str, as_of: str, duration_ms: int | None = None,
) -> DataFrame:
    """One row per client: volumes, issue counts, rates and score of the batch."""
    c = F.col

    def staged_count(df: DataFrame, client: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total_records")).withColumn("source_client", F.lit(client))

    staged = staged_count(client_a, "ClientA").unionByName(staged_count(client_c, "ClientC"))
    loaded = fact_transaction.filter(c("batch_id") == batch_id).groupBy("source_client").agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(c("dq_status") == "INVALID").alias("rejected"),
        F.count_if(c("dq_status") == "WARNING").alias("warnings"),
    )
    issue_counts = issues.filter(c("batch_id") == batch_id).groupBy("source_client").agg(
        F.count_if(c("issue_category") == "COMPLETENESS").alias("missing"),
        F.count_if(c("issue_category") == "FORMAT").alias("format"),
        F.count_if(c("issue_category") == "VALIDITY").alias("validity"),
        F.count_if(c("issue_type").like("NEGATIVE%")).alias("negative"),
    )
    duplicates = tracker.filter(c("batch_id") == batch_id).groupBy("source_client").agg(
        F.count(F.lit(1)).alias("duplicates")
    )
    joined = staged
    for part in (loaded, issue_counts, duplicates):
        joined = joined.join(part, "source_client", "left")
    names = ["loaded", "rejected", "warnings", "missing", "format", "validity", "negative", "duplicates"]
    filled = joined.withColumns({n: F.coalesce(c(n), F.lit(0)) for n in names})
    total = c("total_records")
    hundred = F.lit("100.00").cast("decimal(9,2)")
    return filled.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(as_of).cast("timestamp").cast("date").alias("metric_date"),
        "source_client",
        total.alias("total_records_received"),
        c("loaded").alias("total_records_processed"),
        c("loaded").alias("total_records_loaded"),
        c("rejected").alias("total_records_rejected"),
        c("warnings").alias("total_records_warning"),
        c("missing").alias("missing_field_count"),
        c("format").alias("invalid_format_count"),
        c("validity").alias("invalid_value_count"),
        c("negative").alias("negative_value_count"),
        c("duplicates").alias("duplicate_count"),
        percent(c("rejected"), total).alias("rejection_rate"),
        percent(c("warnings"), total).alias("warning_rate"),
        (hundred - percent(c("missing") + c("validity"), total)).cast("decimal(9,2)").alias("data_quality_score"),
        F.lit(as_of).cast("timestamp").alias("calculated_at"),
        F.lit(duration_ms).cast("bigint").alias("calculation_duration_ms"),
    )


# ---- validation rules -----------------------------------------------------


def rule_violated(rule_type: str, column: str) -> Column:
    """The condition under which a rule fails for a row. UNIQUE is not a row condition."""
    c = F.col(column)
    if rule_type == "NOT_NULL":
        return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""
    if rule_type == "REGEX":
        return c.isNotNull() & ~c.rlike(EMAIL_PATTERN)
    if rule_type == "POSITIVE":
        return F.coalesce(c < 0, F.lit(False))
    raise ValueError(f"unknown rule type {rule_type}")


def apply_validation_rules(tables: dict[str, DataFrame], identifiers: dict[str, str], rules: list[tuple]) -> DataFrame:
    """Rows breaking a rule, one row per rule and record.

    ``rules`` are the entries of the rule catalogue, ``tables`` the rows to
    judge by table name and ``identifiers`` the expression naming a record.
    Row rules of a table are evaluated in one pass over it; a UNIQUE rule
    counts keys first and then picks the rows of repeated keys. ``customer_id``
    tells whose record it is, where the table does.
    """
    results = []
    for name, table in tables.items():
        own = [r for r in rules if r[3] == name]
        record = F.expr(identifiers[name]).cast("string")
        customer = F.col("customer_id") if "customer_id" in table.columns else F.lit(None)

        def entry(rule: tuple) -> Column:
            code, title, category, _, column, _, severity, action = rule
            return F.struct(
                F.lit(code).alias("rule_code"), F.lit(title).alias("rule_name"), F.lit(category).alias("rule_category"),
                F.lit(name).alias("target_table"), F.lit(column).alias("target_column"),
                F.lit(severity).alias("severity"), F.lit(action).alias("action_on_failure"),
                record.alias("record_identifier"), F.col(column).cast("string").alias("field_value"),
                customer.cast("string").alias("customer_id"),
            )

        by_row = [r for r in own if r[5] != "UNIQUE"]
        if by_row:
            broken = [F.when(rule_violated(r[5], r[4]), entry(r)) for r in by_row]
            results.append(table.select(F.explode(F.array(*broken)).alias("v")).filter("v IS NOT NULL").select("v.*"))
        for rule in (r for r in own if r[5] == "UNIQUE"):
            named = table.filter(F.coalesce(F.trim(F.col(rule[4])), F.lit("")) != "")
            keys = [k for k in ("source_client", rule[4]) if k in table.columns]
            repeated = check_unique(named, keys).select(*keys)
            results.append(named.join(repeated, keys, "left_semi").select(entry(rule).alias("v")).select("v.*"))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out


# ---- quarantine -----------------------------------------------------------


def quarantine_rejects(unified: DataFrame, batch_id: str, as_of: str, malformed: DataFrame | None = None) -> DataFrame:
    """Rows that cannot be loaded: no transaction id, a further copy of a loaded transaction, unreadable documents.

    Copies are what remains after taking away the first row per transaction;
    rows are told apart by their position in the source. They are found by position alone and
    kept at rest, so that their payloads are shuffled only where copies are too many to broadcast.
    ``malformed`` holds source_client, source_file_name, source_format, raw_record.
    """
    c = F.col
    position = ["source_client", "source_format", "raw_record_id", "transaction_index"]
    identified = unified.filter("transaction_id IS NOT NULL AND NOT is_missing_transaction_id")
    first = keep_first(
        identified.select(*position, "source_file_name", "ingestion_timestamp", "transaction_id"),
        ["source_client", "transaction_id"], [*FIRST_SEEN, "transaction_index"],
    )
    placed = c(position[0]).isNotNull()
    for name in position[1:]:
        placed = placed & c(name).isNotNull()
    further = identified.select(*position).filter(placed).join(first.select(*position), position, "left_anti")
    # a row without a position is no one's first row
    copies = identified.filter(placed).join(materialize(further, "copies"), position, "left_semi").unionByName(identified.filter(~placed))

    def reject(rows: DataFrame, reason: str, category: str, code: str) -> DataFrame:
        return rows.select(
            "source_client", "source_file_name", "source_format",
            F.coalesce("transaction_id", "order_id", F.concat(F.lit("UNKNOWN_"), c("raw_record_id").cast("string"))).alias("record_identifier"),
            "transaction_id", "order_id", "customer_id",
            F.lit(reason).alias("rejection_reason"), F.lit(category).alias("rejection_category"),
            F.array(F.lit(code)).alias("rejection_codes"), c("raw_payload").alias("raw_record"),
        )

    rows = reject(
        unified.filter("is_missing_transaction_id"), "Transaction ID must not be null or empty", "COMPLETENESS", "R001"
    ).unionByName(reject(copies, "Transaction ID should be unique", "UNIQUENESS", "R009"))
    if malformed is not None:
        rows = rows.unionByName(
            malformed.select(
                "source_client", "source_file_name", "source_format", c("source_file_name").alias("record_identifier"),
                F.lit("Document cannot be read").alias("rejection_reason"), F.lit("FORMAT").alias("rejection_category"),
                F.array(F.lit("UNREADABLE")).alias("rejection_codes"), "raw_record",
            ),
            allowMissingColumns=True,
        )
    return rows.withColumns({
        "batch_id": F.lit(batch_id), "rejection_severity": F.lit("CRITICAL"), "can_be_reprocessed": F.lit(True),
        "reprocessed": F.lit(False), "rejected_at": F.lit(as_of).cast("timestamp"),
    })


# ---- log upkeep -----------------------------------------------------------


def track_anomaly_patterns(issues: DataFrame) -> DataFrame:
    """Recurring issue types over all batches. Clients and fields are few fixed names."""
    return issues.groupBy(F.col("issue_type").alias("pattern_name"), F.col("issue_category").alias("pattern_category")).agg(
        F.array_sort(F.collect_set("source_client")).alias("affected_clients"),
        F.array_sort(F.collect_set("field_name")).alias("affected_fields"),
        F.min("detected_at").alias("first_detected_at"),
        F.max("detected_at").alias("last_detected_at"),
        F.count(F.lit(1)).alias("occurrence_count"),
        F.count_distinct("batch_id").alias("affected_batches"),
    ).withColumn("resolution_status", F.lit("OPEN"))


def merge_patterns(patterns: DataFrame) -> DataFrame:
    """Patterns of several logs that share no batch as those of one log, without reading the logs again."""
    names = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return patterns.groupBy("pattern_name", "pattern_category").agg(
        names("affected_clients").alias("affected_clients"), names("affected_fields").alias("affected_fields"),
        F.min("first_detected_at").alias("first_detected_at"), F.max("last_detected_at").alias("last_detected_at"),
        F.sum("occurrence_count").alias("occurrence_count"), F.sum("affected_batches").alias("affected_batches"),
    ).withColumn("resolution_status", F.lit("OPEN"))


def resolve_issues(issues: DataFrame, condition: Column, action: str, notes: str, by: str, as_of: str) -> DataFrame:
    """The log with matching open issues marked as resolved."""
    hit = F.coalesce(condition & ~F.col("is_resolved"), F.lit(False))
    changes = {
        "resolution_action": F.lit(action), "resolution_notes": F.lit(notes), "is_resolved": F.lit(True),
        "resolved_at": F.lit(as_of).cast("timestamp"), "resolved_by": F.lit(by),
    }
    return issues.withColumns({n: F.when(hit, v).otherwise(F.col(n)) for n, v in changes.items()})
