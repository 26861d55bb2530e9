"""Fixed values of the metric catalogue.

These must equal the values the source systems use, or results are wrong.
They are data, kept together here and used by name everywhere else.
"""

# Page-log URLs that count as a browse, per subject.
BROWSE_URLS = {
    "rest": [
        "/VirtualCard-en/restaurant/detail",
        "/VirtualCard-v5/restaurant/detail",
        "/VirtualCard-v6/restaurant/detail",
    ],
    "lounge": [
        "/VirtualCard-en/lounge/detail",
        "/VirtualCard-v5/lounge/detail",
        "/VirtualCard-v6/lounge/detail",
        "/VirtualCard-v6/lounge/buttonShow",
    ],
    "parking": ["/VirtualCard-v6/parking/items"],
    "shop": [
        "/VirtualCard-v5/shop/detail",
        "/VirtualCard-v5/shop/getNearbyShare",
    ],
    "cip": [
        "/VirtualCard-v6/orderCip/listCip",
        "/VirtualCard-v6/trafficsite/list/cip",
        "/VirtualCard-v5/orderCip/getCips",
    ],
    "vvip": [
        "/VirtualCard-v6/share/count/vvip",
        "/VirtualCard-v6/vvip/index",
        "/VirtualCard-v5/vvip/index",
        "/VirtualCard-v5/vvip/setTypes",
        "/VirtualCard-v5/share/getVvipShare",
    ],
    "car": [
        "/VirtualCard-v6/limousine/carTypeList",
        "/VirtualCard-v6/trafficsite/listHot/limousine",
        "/VirtualCard-v6/trafficsite/list/limousine",
    ],
}

# Article pages: URL prefix; the article id is path segment 4, cut at "?".
ARTICLE_URL_PREFIX = "https://m.dragonpass.com.cn/institute/"

# Banner pages: banner id -> URL prefix. No prefix extends another.
BANNER_URL_PREFIXES = {
    "51683051A64B2231E0530264A8C0D3BE": "https://activity.dragonpass.com.cn/highrail/equity/membershiplistnew",
    "51D11245FC325F6EE0530264A8C07548": "https://activity.dragonpass.com.cn/newestlounge",
    "597CFC5FA85839E7E0530264A8C0F0E6": "http://mp.weixin.qq.com/s/jFI9UNpQhhNrZgOIj15vSQ",
    "455AC8D410E86594E0530264A8C05B8E": "http://img.dragonpass.com.cn/activity/GD_bank",
    "59FAB1F5A2B059D2E0530264A8C080A5": "https://img.dragonpass.com.cn/activity/easternLounge",
    "56741F60A813112FE0530264A8C0E847": "http://activity.dragonpass.com.cn/shop/summer/membership/from",
    "5A5EC79C48D3224DE0530264A8C035D6": "http://img.dragonpass.com.cn/activity/nDay/",
    "59EFAD543BC50CC9E0530264A8C021D5": "http://mp.weixin.qq.com/s/KQSQgR6GBhxrOnJJDupYjQ",
    "5A72B21112676150E0530264A8C0293E": "https://activity.dragonpass.com.cn/aacar/index/v3",
    "4389DF2BEBB07C22E0530264A8C0E0A3": "https://activity.dragonpass.com.cn/lucky/airmealticket/index",
    "5766C676F7701850E0530164A8C09A5C": "http://img.dragonpass.com.cn/activity/HongKongActive/",
    "57690E6FA0C93694E0530264A8C03810": "https://activity.dragonpass.com.cn/wuhan/vvip/index",
}

# First letter of a product code -> subject.
CODE_CLASSES = {"R": "rest", "N": "lounge", "F": "shop", "M": "vvip"}

# Profile field -> text that an article's labels must contain.
ARTICLE_LABELS = {
    "business": "商旅出行",
    "student": "学生/背包客",
    "eleven": "十一",
    "home": "家庭出行",
    "crowd": "人群标签",
}

# Restaurant preference: mean class score at or above the threshold -> first label.
PREFERENCE_THRESHOLD = 0.5
PREFERENCE_LABELS = ("中餐", "西餐")

# Restaurant priority: first flag that equals 1 decides; none -> 0.
PRIORITY_FLAGS = [
    ("fd_isflashsale", 3),
    ("fd_iscoupon", 2),
    ("fd_settlementdiscount", 1),
]
RESTAURANT_LANGUAGE = "zh-cn"

# Lounge comments count above this score.
COMMENT_SCORE_ABOVE = 2

# A customer is a repeat customer above this many orders.
REPEAT_ABOVE = 1

# Zone whose midnight starts a day.
DAY_ZONE = "GMT+08:00"
