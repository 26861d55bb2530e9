"""Columns the metrics read, per source table, and where each table lives."""

from __future__ import annotations

# Logical database of each table.
DATABASE = {
    "tb_order": "business",
    "restaurant_order_detail2": "business",
    "td_restaurant_order": "business",
    "tb_order_parking": "business",
    "tb_order_cip": "business",
    "tb_order_cip_record": "business",
    "tb_order_vvip": "business",
    "tb_order_limousine": "business",
    "tblconsumerecord": "business",
    "tb_bindrecord": "business",
    "tb_order_loungeserv": "business",
    "tb_user_collect": "business",
    "customer_share": "business2",
    "tb_customer_share": "business",
    "tbd_url_element": "log",
    "tbd_visit_url": "log",
    "tbd_lettres_favor": "business",
    "tbd_belles_lettres": "business",
    "itd_restaurant": "business",
    "restaurant_class": "business",
    "tbd_app_opera_path": "log",
    "tb_user": "business",
}

# Column -> type it is read as; None keeps the type of the source (join keys, times, amounts).
COLUMNS = {
    "tb_order": {"order_no": None, "user_id": "string", "actual_amount": None, "cdate": None},
    "restaurant_order_detail2": {
        "fd_code": None, "fd_restaurant_code": "string", "xfprice": None, "ordertime": None, "fd_class": None,
    },
    "td_restaurant_order": {"fd_code": None, "fd_restaurant_code": "string", "fd_date": None},
    "tb_order_parking": {"order_no": None, "parking_code": "string", "create_date": None},
    "tb_order_cip": {"order_no": None, "pro_code": "string"},
    "tb_order_cip_record": {"order_no": None, "create_time": None},
    "tb_order_vvip": {"order_no": None},
    "tb_order_limousine": {"order_no": None},
    "tblconsumerecord": {
        "dragoncode": None, "loungecode": "string", "point": "bigint", "personcount": "bigint", "consumetime": None,
    },
    "tb_bindrecord": {"dragoncode": None, "user_id": "string"},
    "tb_order_loungeserv": {"dragoncode": None, "lounge_code": "string", "create_date": None},
    "tb_user_collect": {"user_id": "string", "code": "string", "create_time": None},
    "customer_share": {"user_id": "string", "code": "string", "create_time": None},
    "tb_customer_share": {"user_id": "string", "code": "string", "score": "double", "create_time": None},
    "tbd_url_element": {"url": "string", "param": "string", "create_time": None},
    "tbd_visit_url": {"user_id": "string", "url": "string", "create_time": None},
    "tbd_lettres_favor": {"user_id": "string", "lettres_id": "string", "create_time": None},
    "tbd_belles_lettres": {"id": "string", "person_labels": "string"},
    "itd_restaurant": {
        "fd_code": "string", "fd_lg": "string",
        "fd_iscoupon": "bigint", "fd_isflashsale": "bigint", "fd_settlementdiscount": "bigint",
    },
    "restaurant_class": {"fd_class": None, "fd_cls": "string"},
    "tbd_app_opera_path": {"id": None},
    "tb_user": {"id": None},
}

# Tables known by column position: name used here -> position in the source table.
# A table that already has the column by name is read by name.
POSITIONS = {
    "tb_user_collect": {"user_id": 1, "code": 3, "create_time": 4},
    "customer_share": {"user_id": 1, "create_time": 4, "code": 5},
    "tb_customer_share": {"create_time": 7},
}
