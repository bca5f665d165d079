"""Retail feeds with known defects, and the rule sets and steps of the sample pipeline."""

import csv
import datetime as dt
import json

from lakesieve import RuleSet, Source

# The sample pipeline's rules and steps.
KEY = {"primary_key": True}
RULES = {
    "products": RuleSet.of("product_catalog", [
        {"name": "required_columns_present", "type": "schema", "params": {"columns": {
            "product_id": "string", "product_name": "string", "category": "string",
            "unit_price": "float"}, "allow_extra": True}},
        {"name": "product_id_is_primary_key", "type": "primary_key", "columns": ["product_id"],
         "params": KEY},
        {"name": "product_name_complete", "type": "not_null", "columns": ["product_name"]},
        {"name": "category_complete", "type": "not_null", "columns": ["category"],
         "severity": "warning", "params": {"max_null_rate": 0.0}},
        {"name": "category_in_allowed_set", "type": "allowed_values", "columns": ["category"],
         "severity": "warning", "params": {"values": [
             "Electronics", "Grocery", "Apparel", "Home", "Beauty", "Toys"]}},
        {"name": "unit_price_non_negative", "type": "range", "columns": ["unit_price"],
         "params": {"min": 0, "max": 100000}},
        {"name": "unit_price_outliers", "type": "outliers", "columns": ["unit_price"],
         "severity": "warning", "params": {"method": "iqr", "factor": 3.0, "max_outlier_rate": 0.02}},
    ]),
    "customers": RuleSet.of("customers", [
        {"name": "required_columns_present", "type": "schema", "params": {"columns": {
            "customer_id": "string", "email": "string", "loyalty_tier": "string"}}},
        {"name": "customer_id_is_primary_key", "type": "primary_key", "columns": ["customer_id"],
         "params": KEY},
        {"name": "email_present", "type": "not_null", "columns": ["email"]},
        {"name": "loyalty_tier_valid", "type": "allowed_values", "columns": ["loyalty_tier"],
         "params": {"values": ["bronze", "silver", "gold", "platinum"]}},
        {"name": "lifetime_value_non_negative", "type": "range", "columns": ["lifetime_value"],
         "severity": "warning", "params": {"min": 0, "max": 1000000}},
    ]),
    "inventory": RuleSet.of("inventory", [
        {"name": "required_columns_present", "type": "schema", "params": {"columns": {
            "product_id": "string", "store_id": "string", "quantity_on_hand": "int"}}},
        {"name": "product_store_unique", "type": "unique", "columns": ["product_id", "store_id"]},
        {"name": "quantity_present", "type": "not_null", "columns": ["quantity_on_hand"]},
        {"name": "quantity_non_negative", "type": "range", "columns": ["quantity_on_hand"],
         "params": {"min": 0, "max": 1000000}},
        {"name": "reorder_level_reasonable", "type": "range", "columns": ["reorder_level"],
         "severity": "warning", "params": {"min": 0, "max": 10000}},
    ]),
    "transactions": RuleSet.of("pos_transactions", [
        {"name": "required_columns_present", "type": "schema", "params": {"columns": {
            "transaction_id": "string", "product_id": "string", "quantity": "int",
            "unit_price": "float", "total_amount": "float"}}},
        {"name": "transaction_id_unique", "type": "primary_key", "columns": ["transaction_id"],
         "params": KEY},
        {"name": "product_reference_present", "type": "not_null", "columns": ["product_id"]},
        {"name": "quantity_positive", "type": "range", "columns": ["quantity"],
         "params": {"min": 1, "max": 10000}},
        {"name": "payment_method_valid", "type": "allowed_values", "columns": ["payment_method"],
         "params": {"values": ["card", "cash", "mobile", "voucher"]}},
        {"name": "total_amount_consistent", "type": "business_rule", "severity": "warning",
         "params": {"expression": "abs(total_amount - (quantity * unit_price)) < 0.01",
                    "max_violation_rate": 0.0}},
        {"name": "transactions_are_fresh", "type": "freshness", "columns": ["transaction_ts"],
         "severity": "warning", "params": {"max_age_hours": 168}},
    ]),
}


def _cast(**columns):
    return {"type": "cast", "params": {"columns": columns}}


LOWER = {"type": "rename_lower"}
STEPS = {
    "products": [LOWER, _cast(unit_price="float"),
                 {"type": "drop_duplicates", "params": {"subset": ["product_id"], "keep": "first"}}],
    "customers": [LOWER, _cast(lifetime_value="float", signup_date="datetime")],
    "inventory": [LOWER, _cast(quantity_on_hand="int", reorder_level="int", last_counted="datetime")],
    "transactions": [
        LOWER,
        _cast(quantity="int", unit_price="float", total_amount="float", transaction_ts="datetime"),
        {"type": "derive", "params": {"column": "revenue", "expression": "quantity * unit_price"}},
    ],
}

CATEGORIES = ["Electronics", "Grocery", "Apparel", "Home", "Beauty", "Toys"]


def products() -> list[dict]:
    rows = [
        {"product_id": f"P{i:05d}", "product_name": f"Item {i}", "category": CATEGORIES[i % 6],
         "unit_price": round(5 + i * 3.17, 2), "supplier_id": f"SUP-{i % 25:03d}", "active": i % 20 > 0}
        for i in range(1, 121)
    ]
    rows.append({**rows[10], "product_name": "Item 11 (dup)"})
    for i in (3, 30, 60, 90):
        rows[i]["category"] = None
    rows[40]["category"] = "Unknown"
    for i, price in ((50, 999999.0), (70, -15.0), (80, None)):
        rows[i]["unit_price"] = price
    return rows


def inventory() -> list[dict]:
    rows = [
        {"product_id": p["product_id"], "store_id": store, "quantity_on_hand": (i * 7 + s) % 500,
         "reorder_level": 10 + i % 40, "last_counted": "2024-01-15"}
        for i, p in enumerate(products()) for s, store in enumerate(["S1", "S2", "S3", "S4"])
    ]
    for i in range(100, 106):
        rows[i]["quantity_on_hand"] = -i
    for i in range(200, 205):
        rows[i]["quantity_on_hand"] = None
    return rows


def transactions() -> list[dict]:
    now = dt.datetime.now(dt.timezone.utc)
    rows = []
    for i in range(1, 2001):
        quantity, price = 1 + i % 8, round(2 + i * 0.24, 2)
        rows.append({
            "transaction_id": f"T{i:08d}", "product_id": f"P{i % 120 + 1:05d}",
            "store_id": f"S{i % 4 + 1}", "quantity": quantity, "unit_price": price,
            "total_amount": round(quantity * price, 2),
            "payment_method": ["card", "cash", "mobile", "voucher"][i % 4],
            "transaction_ts": (now - dt.timedelta(minutes=i * 5)).isoformat(),
        })
    copies = [dict(rows[i]) for i in range(0, 800, 100)]
    for i in range(1000, 1010):
        rows[i]["product_id"] = None
    for i in range(1100, 1106):
        rows[i]["payment_method"] = "crypto"
    for i in range(1200, 1205):
        rows[i]["quantity"] = -2
    for i in range(1300, 1305):
        rows[i]["total_amount"] = 0.0
    return rows + copies


def customers() -> list[dict]:
    rows = [
        {"customer_id": f"C{i:06d}", "email": f"customer{i}@example.com", "full_name": f"Customer {i}",
         "loyalty_tier": ["bronze", "silver", "gold", "platinum"][i % 4],
         "lifetime_value": round(i * 37.5, 2), "signup_date": "2023-05-17", "country": "US"}
        for i in range(1, 401)
    ]
    rows.append(dict(rows[3]))
    for i in range(100, 112):
        rows[i]["email"] = None
    # One tier defect hits a row that lacks an email already, as in the sample run.
    for i in (111, 200, 201, 202, 203):
        rows[i]["loyalty_tier"] = "diamond"
    for i in range(300, 304):
        rows[i]["lifetime_value"] = -12.5
    return rows


def feeds(folder) -> dict[str, Source]:
    for name, rows in (("products", products()), ("inventory", inventory())):
        with open(folder / f"{name}.csv", "w", newline="") as handle:
            writer = csv.DictWriter(handle, rows[0].keys())
            writer.writeheader()
            writer.writerows(rows)
    for name, rows in (("transactions", transactions()), ("customers", customers())):
        document = {"data": rows, "meta": {"count": len(rows)}}
        (folder / f"{name}.json").write_text(json.dumps(document, indent=2))
    sources = {n: Source(n, "csv", {"path": str(folder / f"{n}.csv")}) for n in ("products", "inventory")}
    for name in ("transactions", "customers"):
        options = {"path": str(folder / f"{name}.json"), "records_path": "data"}
        sources[name] = Source(name, "json", options)
    return sources
