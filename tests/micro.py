"""Six orders in raw CSV form that exercise each rule once."""

from pathlib import Path

PREFIX = "shop"

ORDERS = """\
order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-31 23:00:00,2018-02-01 00:30:00,2018-02-02 10:00:00,2018-02-08 22:59:59,2018-02-08 00:00:00
o2,c2,delivered,2018-03-01 08:00:00,2018-03-01 09:00:00,2018-03-02 09:00:00,2018-03-05 08:00:00,2018-03-20 00:00:00
o3,c3,delivered,2018-01-10 10:00:00,2018-01-10 11:00:00,2018-01-12 09:00:00,2018-01-20 10:00:00,2018-01-18 00:00:00
o4,c4,delivered,2018-02-10 12:00:00,2018-02-10 12:30:00,2018-02-11 09:00:00,,2018-02-20 00:00:00
o5,c5,shipped,2018-02-15 12:00:00,2018-02-15 13:00:00,,,2018-02-28 00:00:00
o6,c6,delivered,2018-02-20 10:00:00,,,2018-02-20 05:00:00,2018-03-01 00:00:00
"""
CUSTOMERS = """\
customer_id,customer_unique_id,customer_city,customer_state
c1,u1,santos,SP
c2,u1,santos,SP
c3,u2,niteroi,RJ
c4,u3,niteroi,RJ
c5,u3,niteroi,RJ
c6,u4,betim,MG
c6,u4,betim,MG
"""
ITEMS = """\
order_id,order_item_id,product_id,seller_id,price,freight_value
o1,1,p1,s1,100,10
o1,2,p2,s2,50,5
o2,1,p1,s1,100,10
o2,2,p1,s1,0,1
o2,3,p1,s1,,1
o2,4,p1,s1,9,-1
o2,5,p1,s1,NaN,1
o2,6,p1,s1,9,NaN
o3,1,p3,s1,20,0
o4,1,p9,s2,30,3
o5,1,p1,s1,1,1
o6,1,p1,s3,0.50,0.10
"""
PRODUCTS = """\
product_id,product_category_name,product_name_lenght,product_description_lenght,shelf
p1,beleza_saude,12.0,100,a
p2,,7,50.0,b
p3,brinquedos,,20,c
"""
TRANSLATION = """\
product_category_name,product_category_name_english
beleza_saude,health_beauty
"""
PAYMENTS = """\
order_id,payment_sequential,payment_type
o1,1,card
o1,2,voucher
o2,1,card
o3,1,card
"""
REVIEWS = '''\
review_id,order_id,review_score,review_comment_message
r1,o1,5,"good, ""really""
and fast"
r2,o1,2,n/a
r3,o2,4,
r4,o3,1,late
r4,o4,3,
'''


def write_raw(directory: Path) -> str:
    files = {
        f"{PREFIX}_orders_dataset.csv": ORDERS,
        f"{PREFIX}_order_items_dataset.csv": ITEMS,
        f"{PREFIX}_products_dataset.csv": PRODUCTS,
        "product_category_name_translation.csv": TRANSLATION,
        f"{PREFIX}_customers_dataset.csv": CUSTOMERS,
        f"{PREFIX}_order_payments_dataset.csv": PAYMENTS,
        f"{PREFIX}_order_reviews_dataset.csv": REVIEWS,
    }
    directory.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (directory / name).write_text(text)
    return str(directory)
