"""Staging tables of a batch, computed once and kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from ..operators import staging_csv, staging_json, staging_xml, unify
from ..session import run_together
from .store import TableStore

CLIENT_A, CLIENT_A_ITEMS = "staging.stg_client_a_transactions", "staging.stg_client_a_transaction_items"
CLIENT_C, CLIENT_C_ITEMS = "staging.stg_client_c_transactions", "staging.stg_client_c_transaction_items"
TRANSACTIONS, ITEMS = "staging.stg_transactions", "staging.stg_transaction_items"
CSV_TABLES = {
    "customers": ("staging.stg_customers", staging_csv.stage_customers),
    "orders": ("staging.stg_orders", staging_csv.stage_orders),
    "products": ("staging.stg_products", staging_csv.stage_products),
    "payments": ("staging.stg_payments", staging_csv.stage_payments),
}




def materialize_staging(store: TableStore, raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Parse and stage the given raw rows and write every staging table.

    The documents are parsed once: items are taken from the written header
    tables, which carry the item lists. ``raw`` has xml, txt, json, customers,
    orders, products and payments.
    """
    flat = staging_xml.flatten_xml_transactions(staging_xml.union_xml_sources(raw["xml"], raw["txt"]))
    if "xml_records" in raw:  # rows of ``read_xml_records``
        flat = flat.unionByName(staging_xml.parse_xml_records(raw["xml_records"]))

    def client_a() -> dict[str, DataFrame]:
        headers = store.overwrite(CLIENT_A, staging_xml.stage_flat_client_a(flat))
        return {CLIENT_A: headers, CLIENT_A_ITEMS: store.overwrite(CLIENT_A_ITEMS, staging_xml.stage_client_a_items(headers))}

    def client_c() -> dict[str, DataFrame]:
        headers = store.overwrite(CLIENT_C, staging_json.stage_client_c_transactions(raw["json"]))
        return {CLIENT_C: headers, CLIENT_C_ITEMS: store.overwrite(CLIENT_C_ITEMS, staging_json.stage_client_c_items(headers))}

    def reference(source: str, name: str, stage) -> dict[str, DataFrame]:
        return {name: store.overwrite(name, stage(raw[source]))}

    files = [partial(reference, source, name, stage) for source, (name, stage) in CSV_TABLES.items()]
    out: dict[str, DataFrame] = {}
    for part in run_together(client_a, client_c, *files):
        out.update(part)
    out[TRANSACTIONS], out[ITEMS] = run_together(
        lambda: store.overwrite(TRANSACTIONS, unify.unify_transactions(out[CLIENT_A], out[CLIENT_C])),
        lambda: store.overwrite(ITEMS, unify.unify_transaction_items(out[CLIENT_A_ITEMS], out[CLIENT_C_ITEMS])),
    )
    return out
