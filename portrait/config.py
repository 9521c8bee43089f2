"""Small fixed mapping tables (data, not code).  Each becomes a tiny DataFrame
that is broadcast - its size is fixed, independent of the input data."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Occupation answer -> class code (compared case-insensitively); codes not
# listed mean "unknown" and are dropped; labels are then shifted to 0-based.
OCCUPATION_CODES = [
    ("学生", 1), ("建筑", 8), ("法律", 6), ("艺术", 7), ("文化", 5),
    ("IT", 9), ("商业", 10), ("行政", 4), ("金融", 2), ("医疗", 3),
]
# Occupation classes after the shift that are used as override results.
OCCUPATION_STUDENT = 0
OCCUPATION_IT = 8
OCCUPATION_SILENT = 10
# Event -> rating score for user-item ratings.
EVENT_SCORES = [
    ("content_click", 1.0), ("content_comment", 2.0), ("content_like", 3.0),
    ("content_share", 5.0), ("content_danmku", 2.0), ("browse_progress", 0.0),
    ("video_play", 0.0),
]
# Marriage answer (single letter): A -> 0, B -> 1, C/D dropped.
MARRIAGE_ANSWERS = [("A", 0), ("B", 1)]
# Parent answer: A-F -> parent (1), H -> non-parent (0), anything else dropped.
PARENT_ANSWERS = [("A", 1), ("B", 1), ("C", 1), ("D", 1), ("E", 1), ("F", 1), ("H", 0)]
# Child stage answer: A-C -> 0, D-F -> 1.
CHILD_ANSWERS = [("A", 0), ("B", 0), ("C", 0), ("D", 1), ("E", 1), ("F", 1)]
# Consumption answer: A -> 0, any other non-empty answer -> 1.
CONSUMPTION_LOW = "A"
# Sex -> class.
SEXES = [("male", 1), ("female", 0)]
# Ages up to this one count as unmarried (0), above as married (1).
MARRIAGE_AGE = 35
# Source code -> source name.
SOURCE_NAMES = [(2, "UC"), (76, "Baidu")]
# Time-decay of daily label counts: factor = (DECAY_DAYS - d + 1) * DECAY_STEP.
DECAY_DAYS = 30
DECAY_STEP = 0.03333
# Web-page domain rules for content interest.
COMMERCE_DOMAINS = [
    "item.taobao.com", "s.click.taobao.com", "ai.m.taobao.com", "union.click.jd.com",
    "h5.m.taobao.com", "item.m.jd.com", "m.1688.com", "so.m.jd.com", "detail.m.tmall.com",
    "union-click.jd.com", "login.m.taobao.com", "m.taobao.com", "list.tmall.com", "m.vip.com",
    "s.m.taobao.com",
]
USELESS_DOMAINS = [
    "a.app.qq.com", "mp.weixin.qq.com", "wappass.baidu.com", "mobile.baidu.com", "map.baidu.com",
    "y.10086.cn", "accounts.google.com", "dx.10086.cn", "m.cr173.com", "m.yiwan.com",
    "hanyu.baidu.com",
]
KNOWN_DOMAIN_LABELS = [
    ("bbs.flyme.cn", "科技"), ("www.zybang.com", "教育"), ("detail.mall.meizu.com", "科技"),
    ("m.meizu.com", "科技"), ("m.120ask.com", "健康"), ("muzhi.baidu.com", "健康"),
    ("show.v.meizu.com", "科技"), ("baobao.baidu.com", "育儿"), ("m.ctrip.com", "旅游"),
    ("3g.club.xywy.com", "健康"), ("bbs.meizu.cn", "科技"), ("m.haodf.com", "健康"),
    ("www.flyme.cn", "科技"), ("h5.qichedaquan.com", "汽车"), ("m.babytree.com", "育儿"),
    ("i.flyme.cn", "科技"), ("m.flyme.cn", "科技"), ("mall.meizu.com", "科技"),
    ("a.9game.cn", "游戏"), ("car.h5.yiche.com", "汽车"), ("m.anjuke.com", "房产"),
    ("login.flyme.cn", "科技"), ("club.m.autohome.com.cn", "汽车"),
]
USELESS_TITLES = ["百度一下", "下载百度网盘", "赞评论"]
# Confidence given to a rule-decided label.
RULE_CONFIDENCE = 1.5
# ---------------------------------------------------------------------------
