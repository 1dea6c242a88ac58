"""A small landing tree with one of each known defect."""

from __future__ import annotations

import gzip
from pathlib import Path


def envelope(name: str, header: str, rows: list[str]) -> str:
    start = f"----- START OF FILE: {name} -----"
    return "\n".join([start, header, "", *rows, "", "----- END OF FILE -----"])


CUSTOMERS_A = envelope(
    "customers.csv",
    "customer_id,first_name,last_name,email,loyalty_tier,signup_source,is_active",
    [
        "CUST-1,Ada,Stone,ada@example.com,GOLD,Web,true",
        "CUST-2,,Noname,,BRONZE,Web,false",
        "CUST-3,Bo,Reed,bo@@mail..test,,Referral,true <-- invalid email",
        "CUST-1,Ada,Stone,ada@example.com,SILVER,Web,true   <-- duplicate",
        "CUST-9,,,,,false                 <-- null-heavy row",
    ],
)
CUSTOMERS_B = envelope(
    "customers_b.csv",
    "customer_id,customer_name,email,segment,is_active",
    [
        "C-CUST-1,Cal Fox,cal@example.com,VIP,true",
        "C-CUST-2,Dee Ray,dee@,RETAIL,true <-- invalid email",
        "C-CUST-3,,,,false <-- missing email",
        "C-CUST-4,Eve,e@example.com,VIP,false   <-- null-heavy row",
        "X-CUST-5,Not,a@b,c,true",
    ],
)
ORDERS_A = envelope(
    "orders.csv",
    "order_id,customer_id,order_date,order_status,channel",
    [
        "ORD-1,CUST-1,2025-01-01,COMPLETED,Web",
        "ORD-2,CUST-8,2025-01-02,COMPLETED,Web      <-- invalid customer  ",
        "ORD-3,CUST-2,,PENDING,Mobile",
        "ORD-4,CUST-3,2025-01-04,COMPLETED,Web",
        "ORD-4,CUST-3,2025-01-04,CANCELLED,Web <-- duplicate",
    ],
)
ORDERS_B = envelope(
    "orders_b.csv",
    "order_id,customer_id,order_date,order_status",
    [
        "C-ORD-1,C-CUST-1,2025-02-01,COMPLETED",
        "C-ORD-2,C-CUST-2,2025-02-02,PENDING",
        "C-ORD-3,C-CUST-7,2025-02-03,COMPLETED <-- invalid customer",
    ],
)
PRODUCTS_A = envelope(
    "products.csv",
    "sku,product_name,category,unit_price,currency,is_active",
    [
        "SKU-1,Mouse,Tech,25.50,USD,true",
        "SKU-2,Lamp,Home,abc,USD,true",
        "SKU-999,Bad,Odd,-1,USD,false  <-- anomaly",
    ],
)
PRODUCTS_B = envelope(
    "products_b.csv",
    "sku,product_name,category,unit_price,currency,is_active",
    ["C-SKU-1,Watch,Tech,100,USD,true", 'C-SKU-1,""Watch"",Tech,-5,USD,true <-- duplicate'],
)
PAYMENTS_B = envelope(
    "payments.csv",
    "payment_id,order_id,payment_method,amount,currency,status",
    [
        "PAY-1,C-ORD-1,Card,100,USD,PAID",
        "PAY-2,C-ORD-2,Card,-20.25,USD,REFUNDED  <-- negative",
        "PAY-3,C-ORD-2,Card,-1,USD,CHARGEBACK",
        "PAY-3,C-ORD-2,Card,-2,USD,CHARGEBACK",
    ],
)


def xml_transaction(
    tid, order, date, customer, first, last, email, items, method, amount, last_tag="LastName"
) -> str:
    body = "".join(
        f"""
            <Item>
                <SKU>{sku}</SKU>
                <Description>{text}</Description>
                <Quantity>{quantity}</Quantity>
                <UnitPrice currency="USD">{price}</UnitPrice>
            </Item>"""
        for sku, text, quantity, price in items
    )
    return f"""    <!-- {tid}: a comment -->
    <Transaction>
        <TransactionID>{tid}</TransactionID>
        <Order>
            <OrderID>{order}</OrderID>
            <OrderDate>{date}</OrderDate>
            <Customer>
                <CustomerID>{customer}</CustomerID>
                <Name>
                    <FirstName>{first}</FirstName>
                    <{last_tag}>{last}</{last_tag}>
                </Name>
                <Email>{email}</Email>
                <Metadata><Tag>x</Tag></Metadata>
            </Customer>
        </Order>
        <Items>{body}
        </Items>
        <Payment>
            <Method>{method}</Method>
            <Amount currency="USD">{amount}</Amount>
        </Payment>
        <Audit/>
    </Transaction>
"""


XML_1 = (
    '----- START OF FILE: t.xml -----\n<SalesData client="A" generatedAt="now">\n\n'
    + xml_transaction(
        "T-1", "ORD-1", "2025-01-01", "CUST-1", "Ada", "Stone", "ada@example.com",
        [("SKU-1", "Mouse", "-2", "25.50"), ("SKU-2", "Lamp", "1", "9")], "Card", "-60",
    )
    + xml_transaction(
        "T-1", "ORD-1", "2025-01-01", "CUST-1", "Ada", "Stone", "", [("SKU-1", "Mouse", "2", "1")],
        "Card", "60", last_tag="SurName",
    )
    + xml_transaction("", "ORD-5", "", "CUST-2", "", "Noname", "", [("", "Broken", "", "0")], "", "")
    + "</SalesData>\n"
)
XML_TXT = xml_transaction(
    "", "ORD-6", "2025-01-06", "CUST-4", "Fay", "Hill", "", [("SKU-3", "", "1", "1")], "Cash", "7"
) + xml_transaction(
    "T-2", "ORD-2", "2025-01-02", "", "Gus", "Lee", "g@example.com", [("SKU-4", "Pen", "3", "1")],
    "Cash", "3",
)
XML_3 = (
    xml_transaction(
        "T-3", "ORD-7", "2025-01-07", "CUST-5", "Hal", "Orr", "h@e", [("SKU-5", "Cup", "1", "1")],
        "Card", "5",
    )
    + xml_transaction(
        "T-4", "ORD-7", "2025-01-08", "CUST-6", "Ida", "Poe", "i@e", [("SKU-5", "Cup", "1", "1")],
        "Cash", "6",
    )
    + xml_transaction("T-5", "ORD-8", "2025-01-09", "CUST-6", "Ida", "Poe", "i@e", [], "Cash", "6")
    + "</SalesData>\n----- END OF FILE -----"
)
JSON_1 = """----- START OF FILE: t.json -----
{
  "client": "B",   // who
  /* "transactions": [
     none */
  "transactions": [
    {
      "id": "C-T-1",
      "order": { "id": "C-ORD-1", "date": "2025-02-01",
        "customer": { "id": "C-CUST-1", "name": " Cal Fox ", "email": "cal@example.com" } },
      "items": [
        { "sku": "C-SKU-1", "description": "Watch", "qty": -3,  // negative quantity
          "price": { "amount": 100, "currency": "USD" } }
      ],
      "payment": { "method": "Card", "total": 100.5 }
    },
    {
      "id": "C-T-1",  // duplicate
      "order": { "id": "C-ORD-1", "date": "2025-02-01",
        "customer": { "id": "C-CUST-1", "name": "Cal Fox", "email": null } },
      "items": [],
      "payment": { "method": "Card", "total": 1 }
    },
    {
      "id": "C-T-2",
      "order": { "id": null, "date": null,
        "customer": { "id": "C-CUST-9", "name": "", "email": "x@example.com" } },
      "items": [ { "sku": "C-SKU-9", "description": "Web {cam} [x]", "qty": "2",
          "price": { "amount": 5.5, "currency": "EUR" } } ],
      "payment": { "method": null, "total": 11 };
    }
  ],
  "refunds": [ { "id": "no" } ]
}
----- END OF FILE -----"""

# Worked out by hand from the rows above.
RAW_ROWS = {
    "csv": sum(
        t.count("\n") + 1
        for t in (CUSTOMERS_A, CUSTOMERS_B, ORDERS_A, ORDERS_B, PRODUCTS_A, PRODUCTS_B, PAYMENTS_B)
    ),
    "json": JSON_1.count("\n") + 1,
    "xml": XML_1.count("\n") + XML_TXT.count("\n") + XML_3.count("\n") + 1,
}


def write(root: Path) -> Path:
    b = root / "Client B"
    b.mkdir(parents=True)
    (root / "Customer.csv").write_text(CUSTOMERS_A)
    (root / "Orders.csv").write_text(ORDERS_A.replace("\n", "\r\n"))
    (root / "Products.csv").write_text(PRODUCTS_A)
    (root / "T_1.xml").write_text(XML_1)
    (root / "T_2.txt").write_text(XML_TXT)
    (root / "T_3.xml").write_text(XML_3)
    (root / "notes.md").write_text("not loaded")
    (b / "Customer.CSV").write_text(CUSTOMERS_B)
    (b / "Order.csv").write_text(ORDERS_B)
    (b / "Product.csv.gz").write_bytes(gzip.compress(PRODUCTS_B.encode()))
    (b / "Payments.csv").write_text(PAYMENTS_B)
    (b / "transactions.json").write_text(JSON_1)
    return root
