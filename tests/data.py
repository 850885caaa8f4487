"""The fixtures of FIXTURES.md."""

from __future__ import annotations

from pathlib import Path

CANONICAL_SCHEMA = (
    "order_id string, customer_id string, product_id string, order_ts timestamp_ntz, updated_at timestamp_ntz, "
    "category string, amount double, quantity bigint"
)

ORDERS_CSV = """order_id,customer_id,product_id,order_ts,updated_at,category,amount,quantity
A-10,kim,lamp,2025-03-06T07:15:00,2025-03-06T07:15:00,Lighting,80,2
A-11,ola,rug,2025-03-06T18:40:00,2025-03-06T18:40:00,Textile,35,1
A-12,kim,vase,2025-03-07T11:05:00,2025-03-07T11:35:00,Ceramics,12.5,4
A-13,,mug,2025-03-07T12:00:00,2025-03-07T12:00:00,Ceramics,6,2
A-11,ola,rug,2025-03-06T18:40:00,2025-03-07T06:40:00,Textile,31,1
A-14,ravi,lamp,2025-03-08T09:30:00,2025-03-08T09:30:00,Lighting,-80,1
A-15,ravi,desk,2025-03-09T20:20:00,2025-03-09T20:20:00,Furniture,240,1
A-16,tess,rug,2025-03-10T13:10:00,2025-03-10T13:10:00,Textile,33,3
A-17,kim,desk,2025-03-11T16:55:00,2025-03-11T16:55:00,Furniture,225,1
A-18,ola,cup,2025-03-12T10:00:00,2025-03-12T10:00:00,Ceramics,4,5
"""


def write_text(folder: str, name: str, text: str) -> str:
    path = Path(folder) / name
    path.write_text(text, encoding="utf-8")
    return str(path)
