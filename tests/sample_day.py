"""One day of a small household-goods shop, in the files its sources would deliver."""

import json
from datetime import date, datetime

from cartwright.sources.entities import BY_KEY

DAY = "2026-05-18"
AS_OF = date(2026, 5, 20)
LOADED_AT = datetime(2026, 5, 20, 4)

# Tomas has two ids with one e-mail; Ola never ordered; Lin's only order is cancelled.
CUSTOMERS = """
31,noor@mail.example,Noor,Haddad,+4915550001,2025-02-14T10:30:00Z,DE,active,true
33,tomas@mail.example,Tomas,Vega,,2025-06-01T07:45:12Z,MX,active,false
35,lin@mail.example,Lin,Osei,+233200000,2025-08-19T19:05:40Z,GH,inactive,true
36,tomas@mail.example,Tomas,Vega,,2025-11-23T16:20:09Z,MX,active,false
38,ola@mail.example,Ola,Berg,+4670000000,2026-01-03T12:00:00Z,SE,active,false
40,ira@mail.example,Ira,Noam,+97250000,2026-04-27T06:10:55Z,IL,active,true
"""
# The tent's category has no reporting category.
PRODUCTS = """
501,LAMP-A,Desk Lamp,electronics,Lumo,20.00,50.00,true,2025-01-10T00:00:00Z
502,SCARF-B,Wool Scarf,accessories,Loom,6.00,24.00,true,2025-03-22T00:00:00Z
503,SANDAL-C,Beach Sandal,shoes,Dune,11.00,40.00,true,2025-04-30T00:00:00Z
504,PAN-D,Frying Pan,homewares,Forge,15.00,60.00,true,2025-07-07T00:00:00Z
505,TENT-E,Two Person Tent,camping,Forge,900.00,3600.00,false,2025-09-15T00:00:00Z
"""
# Two cancelled, one in pesos, one still pending.
ORDERS = """
201,31,2026-05-18T06:15:00Z,completed,USD,100.00,5.00,4.00,9.50,108.50,paid,41,41,2026-05-18T06:20:31Z
202,33,2026-05-18T07:20:30Z,completed,USD,24.00,0.00,3.00,2.40,29.40,paid,43,43,2026-05-18T07:31:00Z
203,36,2026-05-18T08:05:10Z,completed,USD,80.00,8.00,0.00,7.20,79.20,paid,43,44,2026-05-18T08:09:54Z
204,35,2026-05-18T09:40:00Z,cancelled,USD,60.00,0.00,6.00,6.00,72.00,voided,45,45,2026-05-18T11:02:16Z
205,40,2026-05-18T12:30:45Z,completed,PHP,3600.00,600.00,150.00,360.00,3510.00,paid,46,46,2026-05-18T12:41:07Z
206,31,2026-05-18T15:00:00Z,completed,USD,24.00,4.00,3.00,2.00,25.00,pending,41,41,2026-05-18T15:00:09Z
207,31,2026-05-18T18:45:20Z,cancelled,USD,50.00,0.00,5.00,5.00,60.00,voided,41,41,2026-05-18T19:15:28Z
"""
ITEMS = """
1,201,501,LAMP-A,Desk Lamp,2,50.00,5.00,95.00
2,202,502,SCARF-B,Wool Scarf,1,24.00,0.00,24.00
3,203,503,SANDAL-C,Beach Sandal,1,40.00,4.00,36.00
4,203,503,SANDAL-C,Beach Sandal,1,40.00,4.00,36.00
5,204,504,PAN-D,Frying Pan,1,60.00,0.00,60.00
6,205,505,TENT-E,Two Person Tent,1,3600.00,600.00,3000.00
7,206,502,SCARF-B,Wool Scarf,1,24.00,4.00,20.00
8,207,501,LAMP-A,Desk Lamp,1,50.00,0.00,50.00
"""
CAMPAIGNS = """
2026-05-18,delta,PAY-1,Spring,social,50000,2500,1000.00,40,5000.00,DE,mobile,ads.csv,2026-05-19T02:00:00Z
2026-05-18,omega,PAY-2,Summer,search,8000,640,480.00,16,1200.00,MX,desktop,ads.csv,2026-05-19T02:00:00Z
"""
# Ira's mail bounced; Lin unsubscribed.
SENDS = """
2026-05-18,MAIL-X,Weekly,noor@mail.example,31,delivered,true,true,false,mail.csv,2026-05-19T02:05:00Z
2026-05-18,MAIL-X,Weekly,tomas@mail.example,33,delivered,true,false,false,mail.csv,2026-05-19T02:05:00Z
2026-05-18,MAIL-X,Weekly,lin@mail.example,35,delivered,false,false,true,mail.csv,2026-05-19T02:05:00Z
2026-05-18,MAIL-X,Weekly,ola@mail.example,38,delivered,true,false,false,mail.csv,2026-05-19T02:05:00Z
2026-05-18,MAIL-X,Weekly,ira@mail.example,40,bounced,false,false,false,mail.csv,2026-05-19T02:05:00Z
"""
# The lamp is kept in two warehouses.
STOCK = """
2026-05-18,1,LAMP-A,501,30,5,25,10,20.00
2026-05-18,2,LAMP-A,501,10,4,6,10,20.00
2026-05-18,1,SCARF-B,502,80,20,60,15,6.00
2026-05-18,1,SANDAL-C,503,16,1,15,12,11.00
2026-05-18,3,PAN-D,504,55,5,50,20,15.00
2026-05-18,3,TENT-E,505,4,1,3,5,900.00
"""
PURCHASES = """
71,9,LAMP-A,50,50,20.00,received,2026-04-20T08:00:00Z,2026-05-05
72,9,LAMP-A,40,10,20.00,partial,2026-05-02T13:25:00Z,2026-05-15
73,8,TENT-E,6,0,900.00,open,2026-05-10T10:10:00Z,2026-06-01
74,8,SANDAL-C,100,0,11.00,open,2026-05-01T17:45:00Z,2026-05-19
"""
# id, order, customer, method, type, currency, gross, fee, net, brand
PAYMENTS = [
    ("pay-a", 201, 31, "card", "capture", "USD", 108.50, 3.50, 105.00, "amex"),
    ("pay-b", 202, 33, "wallet", "capture", "USD", 29.40, 0.40, 29.00, None),
    ("pay-c", 203, 36, "card", "capture", "USD", 79.20, 2.20, 77.00, "visa"),
    ("pay-d", 204, 35, "card", "void", "USD", 72.00, 0.0, 0.0, "visa"),
    ("pay-e", 205, 40, "wallet", "capture", "PHP", 3510.00, 60.00, 3450.00, None),
    ("pay-f", 206, 31, "card", "authorization", "USD", 25.00, 0.0, 25.00, "amex"),
    ("pay-g", 207, 31, "card", "void", "USD", 60.00, 0.0, 0.0, "amex"),
]
CSV = {
    "postgres/customers": CUSTOMERS,
    "postgres/products": PRODUCTS,
    "postgres/orders": ORDERS,
    "postgres/order_items": ITEMS,
    "marketing/campaign_performance": CAMPAIGNS,
    "marketing/email_sends": SENDS,
    "inventory/inventory_snapshot": STOCK,
    "inventory/purchase_orders": PURCHASES,
}


def write_files(folder) -> dict[str, str]:
    """Write the day's extracts and return their paths by entity."""
    files = {}
    for key, rows in CSV.items():
        path = folder / f"{key.split('/')[1]}.csv"
        header = ",".join(f.name for f in BY_KEY[key].schema)
        path.write_text(f"{header}\n{rows.strip()}\n")
        files[key] = str(path)
    names = (
        "transaction_id order_id customer_id payment_method transaction_type currency"
        " gross_amount fee_amount net_amount card_brand"
    ).split()
    documents = [
        {
            **dict(zip(names, row)),
            "status": "succeeded",
            "provider_created_at": f"{DAY}T{8 + place:02}:11:00Z",
            "card_country": "DE" if row[-1] else None,
            "failure_reason": None,
            "refund_flag": False,
        }
        for place, row in enumerate(PAYMENTS)
    ]
    path = folder / "transactions.json"
    path.write_text(json.dumps(documents, indent=2))
    files["payments/transactions"] = str(path)
    return files
