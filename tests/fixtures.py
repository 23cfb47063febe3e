"""A handful of hand-written orders that reach the cases the given tables do not."""

from __future__ import annotations

from pathlib import Path

# o1 delivered over midnight, two items of one seller, quoted comment
# o2 no children at all                     o3 only a payment
# o4 delivered, no estimate, on a Saturday  o5 status outside the accepted list
CSV = {
    "customers": """\
customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01037,sao paulo,sp
c2,u1,20000,rio de janeiro,rj
c3,u3,,recife,pe
""",
    "orders": """\
order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-12-31 23:00:00,2017-12-31 23:30:00,2018-01-01 00:10:00,2018-01-01 01:00:00,2018-01-05 00:00:00
o2,c2,canceled,2018-01-02 10:00:00,,,,
o3,c2,shipped,2018-01-04 10:00:00,"",,,2018-01-09 00:00:00
o4,c3,delivered,2018-01-06 09:00:00,2018-01-06 10:00:00,2018-01-07 10:00:00,2018-01-09 08:00:00,
o5,c9,lost,2018-01-07 09:00:00,,,,2018-01-09 08:00:00
""",
    "order_items": """\
order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-02 00:00:00,10.50,1.25
o1,2,p2,s1,,20.00,2.00
o4,1,p3,s2,2018-01-08 00:00:00,-5.00,1.00
o5,1,p1,s1,,7.00,0.50
ox,1,p1,s2,,99.00,9.00
""",
    "order_payments": """\
order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,30.00
o1,2,voucher,1,3.75
o3,1,boleto,1,55.00
oy,1,cash,2,1.00
""",
    "order_reviews": """\
review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,"great, really","line one
line ""two""

line four",2018-01-02 00:00:00,2018-01-03 12:30:00
r2,o1,4,"",,2018-01-02 00:00:00,
r3,o4,1, ,bad,,
r4,oz,6,,,,
""",
    "products": """\
product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,brinquedos,20,200,1,100,10,20,30
p2,sem_traducao,20,200,2,12.7,10,20,30
p3,,20,200,,,10,20,30
""",
    "sellers": """\
seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,00001,campinas,sp
s2,13000,olinda,pe
""",
    "product_category_name_translation": """\
product_category_name,product_category_name_english
brinquedos,toys
automotivo,auto
""",
}


def write_sources(folder: Path, **replaced: str) -> str:
    for name, text in {**CSV, **replaced}.items():
        (folder / f"{name}.csv").write_text(text, newline="")
    return str(folder)
