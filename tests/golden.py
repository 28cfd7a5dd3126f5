"""Small input files that carry every known defect of the sources."""

from __future__ import annotations

import json
from pathlib import Path

AS_OF = "2025-01-15 10:00:00"

# per transaction: what differs from a clean one
DEFECTS = {
    1001: {"qty": "-1", "extra": "<LoyaltyTier>Gold</LoyaltyTier>", "customer": "CUST-A-0001"},
    1002: {"txn": "", "date": "", "sku": "", "price": "0"},
    1003: {"qty": "-2", "extra": "<Metadata><Source>web</Source></Metadata>", "fees": "<Fees><Fee>1.50</Fee></Fees>"},
    1004: {"email": "", "extra": "<Tags><Tag>a</Tag></Tags>", "customer": "CUST-A-0001"},
    1005: {"amount": "-10.00"},
    1006: {"sku": "", "extra": "<Preferences><P>x</P></Preferences>"},
    1007: {"email": "invalid-email", "extra": "<Flags><F>y</F></Flags>"},
    1008: {"date": "", "qty": "-1"},
    1009: {},
    1010: {"first": "", "last": "", "extra": "<Attributes><A>1</A></Attributes>"},
    1011: {"price": "-5.00", "amount": "-10.00"},
    1012: {"method": ""},
    1013: {"order": "ORD-5013", "item_extra": "<Attributes><Color>red</Color></Attributes>"},
    1014: {"txn": ""},
    1015: {"order": "ORD-5013", "qty": "-3"},
    1016: {"email": "", "extra": "<Notes>call back</Notes>"},
    1017: {"sku": "", "amount": "-7.00"},
    1018: {"extra": "<Tags><Tag>b</Tag></Tags>"},
    1019: {"date": "", "qty": "-1"},
    1020: {"item_extra": "<Warranty><Months>12</Months></Warranty>"},
    1021: {},
    1022: {"customer": "", "extra": "<Preferences><P>z</P></Preferences>"},
    1023: {"price": "-5.00", "amount": "-10.00"},
    1024: {"description": ""},
    1025: {"item_extra": "<GiftOptions><Wrap>yes</Wrap></GiftOptions>"},
    1026: {"amount": ""},
    1027: {"qty": "-4"},
    1028: {"order": ""},
    1029: {},
}
FILES = {
    "ClientA_Transactions_1.xml": [1001, 1002, 1003, 1004, 1001],
    "ClientA_Transactions_2.xml": [1005, 1006, 1007, 1008, 1009, 1009],
    "ClientA_Transactions_3.xml": [1010, 1011, 1012, 1013, 1014, 1015],
    "ClientA_Transactions_4.txt": [1016, 1017, 1018, 1019, 1020, 1021, 1021],
    "ClientA_Transactions_5.xml": [1022, 1023, 1024, 1025, 1026, 1027, 1028, 1029],
}


def transaction_xml(n: int) -> str:
    d = {
        "txn": f"txn-{n}", "order": f"ord-{n}", "date": "2024-03-05", "customer": f"cust-a-{n}", "first": "mary-jane",
        "last": "o'brien", "email": f"User{n}@Example.com", "extra": "", "sku": f"sku-{n}", "description": "A thing",
        "qty": "2", "price": "5.00", "item_extra": "", "method": "Credit Card", "amount": "10.00", "fees": "", **DEFECTS[n],
    }
    return (
        f"<Transaction><TransactionID>{d['txn']}</TransactionID><Order><OrderID>{d['order']}</OrderID>"
        f"<OrderDate>{d['date']}</OrderDate><Customer><CustomerID>{d['customer']}</CustomerID><Name><FirstName>{d['first']}</FirstName>"
        f"<LastName>{d['last']}</LastName></Name><Email>{d['email']}</Email>{d['extra']}</Customer></Order><Items><Item>"
        f"<SKU>{d['sku']}</SKU><Description>{d['description']}</Description><Quantity>{d['qty']}</Quantity>"
        f"<UnitPrice currency=\"usd\">{d['price']}</UnitPrice>{d['item_extra']}</Item></Items><Payment><Method>{d['method']}</Method>"
        f"<Amount currency=\"\">{d['amount']}</Amount>{d['fees']}</Payment></Transaction>"
    )


def xml_document(body: str) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<SalesData client="ClientA">\n{body}\n</SalesData>\n'


CLIENT_C = [
    {"transaction_id": "c-1", "order": {"order_id": "o-1", "order_date": "03/05/2024", "status": "completed",
     "customer": {"customer_id": "CUST-C-1", "name": "Ada Lovelace King", "email": "ada@x.org", "loyalty_tier": None}},
     "payment": {"method": "wire", "amount": 20.50, "currency": "eur"},
     "items": [{"sku": "s-1", "description": "one", "quantity": 2, "unit_price": 10.25}, None, {"product_id": "s-2", "name": "two", "qty": "1", "price": "3"}]},
    {"txn_id": "c-2", "order": {"order_id": "o-2", "order_date": "nonsense", "customer": {"id": "CUST-C-2", "name": "Plato", "tier": "gold "}},
     "payment": {"payment_method": "PAYPAL", "total": "-4", "currency": ""}, "items": []},
    {"transaction_id": "", "txn_id": "hidden", "order": {"order_id": "o-3", "customer": {"first_name": "x"}}, "payment": {}},
]

CUSTOMER_CSV = """customer_id,first_name,last_name,email,loyalty_tier,signup_source,is_active
cust-a-0001,mary,"smith, jr.",M@X.org,gold,web,yes
N/A,null,-,NA,#N/A,na,n/a
cust-a-1003,short
cust-a-1005,a,b,c@d.org,silver,store,0,extra1,extra2,extra3,lost
"""
ORDERS_CSV = """order_id,customer_id,order_date,status,total_amount,currency
ord-1,cust-a-0001,2024-03-05,completed,10.00,usd
ord-2,,05-Mar-2024,weird,-3,
,cust-a-0001,2024-03-05,pending,1,usd
ord-1,cust-a-0001,2024-03-06,completed,11.00,usd
"""
PRODUCTS_CSV = """product_id,sku,product_name,description,category,price,currency
p-1,sku-1001,Thing,"A ""fine"" thing",home & garden,5.00,usd
p-2,,Nameless,,x,-1,
"""
PAYMENTS_CSV = """payment_id,order_id,transaction_id,payment_method,amount,currency,payment_date,status
pay-1,ord-1,txn-1001,dc,10.00,usd,2024-03-05,done
pay-2,ord-2,txn-1002,barter,-3,,bad,done
"""


def write_inbox(folder: Path) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    for name, numbers in FILES.items():
        body = "\n".join(transaction_xml(n) for n in numbers)
        if name.endswith(".txt"):
            text = f"Export of client A\n<!-- totals > 0, see <Transaction> docs -->\n{body}\n"
        else:
            text = xml_document(body)
        (folder / name).write_text(text)
    (folder / "ClientA_Transactions_bad.xml").write_text("<SalesData><Transaction><Order></SalesData>")
    (folder / "ClientA_Transactions_bad.txt").write_text("<Transaction><Order>")
    (folder / "OtherClient.xml").write_text(xml_document(transaction_xml(1001)))
    (folder / "transactions.json").write_text(json.dumps({"transactions": CLIENT_C}))
    (folder / "broken.json").write_text("{")
    (folder / "Customer.csv").write_text(CUSTOMER_CSV)
    (folder / "Customer.CSV").write_text(CUSTOMER_CSV.replace("M@X.org", "second@x.org"))
    (folder / "Orders.csv").write_text(ORDERS_CSV)
    (folder / "Products.csv").write_text(PRODUCTS_CSV)
    (folder / "Payments.csv").write_text(PAYMENTS_CSV)
    return folder
