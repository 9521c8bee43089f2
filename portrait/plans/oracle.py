"""DuckDB SQL twins of the query bindings (views named after the test tables)."""

from portrait.plans import params as P

_TOPK = f"""
  cat AS (SELECT l_partkey AS app_id, count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey),
  best AS (SELECT c.app_id, p.p_name AS app_name, max(c.n) AS install_num
           FROM cat c JOIN part p ON p.p_partkey = c.app_id GROUP BY c.app_id, p.p_name),
  ranked AS (SELECT *, row_number() OVER (ORDER BY install_num DESC, app_id DESC) - 1 AS idx FROM best),
  topk AS (SELECT * FROM ranked WHERE idx < {P.TOP_K}),
  pairs AS (SELECT o.o_custkey AS user_id, l.l_partkey AS app_id
            FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["topk_catalog"] = f"""WITH {_TOPK}
SELECT app_id, app_name, install_num, idx FROM topk"""

ORACLE_SQL["catalog_index"] = f"""WITH {_TOPK}
SELECT app_id, install_num, idx FROM ranked"""

ORACLE_SQL["install_features"] = f"""WITH {_TOPK},
  f AS (SELECT DISTINCT p.user_id, t.idx, t.app_name FROM pairs p JOIN topk t ON t.app_id = p.app_id)
SELECT user_id,
       string_agg(CAST(idx AS VARCHAR) || ':1', ' ' ORDER BY idx) AS feature,
       string_agg(app_name, ' ' ORDER BY idx) AS apps,
       CAST(count(*) AS BIGINT) AS n_apps
FROM f GROUP BY user_id"""

ORACLE_SQL["install_features_prefixed"] = ORACLE_SQL["install_features"]

ORACLE_SQL["install_stats"] = f"""WITH {_TOPK},
  pu AS (SELECT p.user_id, count(DISTINCT t.idx) AS n FROM pairs p LEFT JOIN topk t ON t.app_id = p.app_id
         GROUP BY p.user_id)
SELECT CAST(count(*) AS BIGINT) AS users_total,
       CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS users_empty,
       CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS users_kept,
       CAST(min(n) FILTER (WHERE n > 0) AS BIGINT) AS min_len,
       CAST(max(n) AS BIGINT) AS max_len
FROM pu"""

ORACLE_SQL["install_flag"] = f"""WITH {_TOPK}
SELECT user_id, CAST(max(CASE WHEN app_id IN {tuple(P.FLAG_APPS)} THEN 1 ELSE 0 END) AS BIGINT) AS flag
FROM pairs GROUP BY user_id"""

# ---------------------------------------------------------------- scans
from portrait.functions.dates import offset_date_py as _off  # noqa: E402

_D0 = P.AS_OF.isoformat()
_D1 = (P.AS_OF.fromordinal(P.AS_OF.toordinal() + 1)).isoformat()
_HLO = _off(P.AS_OF, -1, 0).isoformat()
_HHI = _off(P.AS_OF, 0, -1).isoformat()


def _lenient(d: str, months: int, days: int) -> str:
    """DuckDB form of the lenient calendar offset on a DATE expression."""
    return (f"(date_trunc('month', {d}) + INTERVAL ({months}) MONTH "
            f"+ INTERVAL (dayofmonth({d}) - 1 + {days}) DAY)")


ORACLE_SQL["scan_partition"] = f"""
SELECT event_id, user_id, event_type, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date
FROM events WHERE ts >= TIMESTAMP '{_D0}' AND ts < TIMESTAMP '{_D1}'"""

ORACLE_SQL["scan_date_range"] = f"""
SELECT event_id, user_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date,
       strftime({_lenient('CAST(ts AS DATE)', -1, 0)}, '%Y%m%d') AS prev_month_day
FROM events WHERE ts >= TIMESTAMP '{_HLO}' AND ts < TIMESTAMP '{_HHI}'"""

ORACLE_SQL["scan_hour_prefix"] = f"""
SELECT event_id, strftime(ts, '%Y%m%d%H') AS stat_hour FROM events
WHERE strftime(ts, '%Y%m%d%H') LIKE '{P.AS_OF.strftime('%Y%m%d')}%'"""

ORACLE_SQL["latest_partition"] = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS stat_date FROM orders)
SELECT * FROM o WHERE stat_date = (SELECT max(stat_date) FROM o)"""

ORACLE_SQL["latest_partition_table"] = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS stat_date FROM orders)
SELECT * FROM o WHERE stat_date = (SELECT max(stat_date) FROM o)"""

ORACLE_SQL["clean_rows"] = """
SELECT DISTINCT user_id, event_type, item_id FROM (
  SELECT user_id, nullif(nullif(event_type, 'error'), '') AS event_type, props->>'$.k' AS item_id, props
  FROM events) t
WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND item_id IS NOT NULL AND length(trim(props)) > 5"""

ORACLE_SQL["source_filter"] = """
SELECT doc_id, source, lang FROM documents
WHERE (source IN ('src1', 'src3', 'src5') AND lang NOT IN ('de'))
   OR ((source = 'src2' OR source = 'src7') AND (lang = 'en' OR lang = 'fr'))"""

_SEG = """seg AS (
  SELECT c_custkey AS user_id, CAST(m.code - 1 AS BIGINT) AS label
  FROM customer c JOIN (VALUES ('automobile', 1), ('building', 2), ('furniture', 3), ('machinery', 4),
                               ('household', 0)) m(key, code)
    ON lower(trim(c.c_mktsegment)) = m.key
  WHERE m.code <> 0),
seg_named AS (
  SELECT s.user_id, s.label, n.label_name FROM seg s
  LEFT JOIN (VALUES (0, 'automobile'), (1, 'building'), (2, 'furniture'), (3, 'machinery')) n(label, label_name)
    ON n.label = s.label)"""

ORACLE_SQL["label_map"] = f"WITH {_SEG} SELECT user_id, label, label_name FROM seg_named"

ORACLE_SQL["answer_labels"] = """
WITH a AS (SELECT o_custkey AS user_id, o_orderkey,
                  substr('ABCDE', TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER), 1) AS answer FROM orders),
     f AS (SELECT user_id, arg_min(answer, o_orderkey) AS answer FROM a WHERE length(answer) = 1 GROUP BY user_id)
SELECT f.user_id, f.answer, CAST(m.code AS BIGINT) AS label
FROM f JOIN (VALUES ('A', 0), ('B', 1)) m(key, code) ON m.key = f.answer"""

ORACLE_SQL["label_distribution"] = f"""WITH {_SEG}
SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
       round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM seg GROUP BY label"""

ORACLE_SQL["train_predict_sets"] = f"""WITH {_TOPK}, {_SEG},
  fu AS (SELECT DISTINCT p.user_id FROM pairs p JOIN topk t ON t.app_id = p.app_id)
SELECT fu.user_id, CAST(coalesce(seg.label, -1) AS BIGINT) AS label,
       CASE WHEN seg.label IS NULL THEN 'predict' ELSE 'train' END AS split
FROM fu LEFT JOIN seg ON seg.user_id = fu.user_id"""

ORACLE_SQL["priority_union"] = """
WITH u AS (
  SELECT doc_id, CAST(quality AS BIGINT) AS label, 'known' AS origin, 0 AS prio FROM labels
  UNION ALL SELECT doc_id, CAST(n_chars > 2000 AS BIGINT), 'predicted', 1 FROM documents
  UNION ALL SELECT doc_id, CAST(0 AS BIGINT), 'third', 2 FROM documents WHERE lang = 'en')
SELECT doc_id, arg_min(label, prio) AS label, arg_min(origin, prio) AS origin FROM u GROUP BY doc_id"""

ORACLE_SQL["silent_users"] = """
SELECT o_custkey AS user_id, o_orderkey FROM orders a
WHERE o_orderstatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderstatus = 'F' AND b.o_custkey = a.o_custkey)"""

ORACLE_SQL["occupation_overrides"] = f"""WITH {_SEG},
  pairs AS (SELECT o.o_custkey AS user_id, l.l_partkey AS app_id
            FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
  boots AS (SELECT o.o_custkey AS user_id, l.l_partkey AS app_id
            FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_linestatus = 'F'),
  silent AS (SELECT DISTINCT user_id FROM pairs WHERE user_id NOT IN (SELECT user_id FROM boots)),
  both_ AS (SELECT * FROM pairs UNION ALL SELECT * FROM boots),
  student AS (SELECT DISTINCT user_id FROM both_ WHERE app_id IN {tuple(P.STUDENT_APPS)}),
  it AS (SELECT DISTINCT user_id FROM both_ WHERE app_id IN ({P.IT_APPS[0]})),
  u AS (SELECT user_id, label AS v, 0 AS st, 0 AS it FROM seg
        UNION ALL SELECT user_id, 10, 0, 0 FROM silent
        UNION ALL SELECT user_id, NULL, 1, 0 FROM student
        UNION ALL SELECT user_id, NULL, 0, 1 FROM it),
  per AS (SELECT user_id, CASE WHEN max(it) = 1 THEN 8 WHEN max(st) = 1 THEN 0 ELSE max(v) END AS b
          FROM u GROUP BY user_id),
  age AS (SELECT c_custkey AS user_id,
                 CAST(CASE WHEN c_acctbal < 0 THEN NULL ELSE least(floor(c_acctbal / 2000), 4) END AS BIGINT) AS age
          FROM customer),
  s1 AS (SELECT per.user_id, age.age, CASE WHEN age.age IN (0, 1) THEN 0 ELSE per.b END AS o
         FROM per JOIN age ON age.user_id = per.user_id WHERE age.age IS NOT NULL)
SELECT user_id, CAST(CASE WHEN o = 0 AND age IN (3, 4) THEN 10 ELSE o END AS BIGINT) AS occupation FROM s1"""

ORACLE_SQL["consistency_merge"] = """
WITH m AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 4000 THEN 'married' ELSE 'unmarried' END AS marriage
           FROM customer WHERE c_acctbal >= 0),
     p AS (SELECT c_custkey AS user_id, CASE WHEN c_nationkey < 12 THEN 'parent' ELSE 'non_parent' END AS parent
           FROM customer WHERE c_nationkey <> 3),
     c AS (SELECT c_custkey AS user_id, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'baby'
                                            WHEN c_mktsegment = 'BUILDING' THEN 'pregnancy' ELSE 'teen' END AS child_stage
           FROM customer)
SELECT m.user_id, marriage,
       CASE WHEN marriage = 'unmarried' AND parent = 'parent' THEN 'non_parent' ELSE parent END AS parent,
       CASE WHEN (marriage = 'unmarried' AND parent = 'parent') OR parent = 'non_parent' THEN 'null'
            ELSE child_stage END AS child_stage
FROM m JOIN p ON p.user_id = m.user_id JOIN c ON c.user_id = m.user_id"""

ORACLE_SQL["label_audit"] = """
SELECT CAST(count(*) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE l.quality = CAST(d.n_chars > 2000 AS INTEGER)) AS BIGINT) AS agree,
       CAST(count(*) FILTER (WHERE l.quality <> CAST(d.n_chars > 2000 AS INTEGER)) AS BIGINT) AS conflict
FROM labels l JOIN documents d ON d.doc_id = l.doc_id"""

ORACLE_SQL["coverage_report"] = """
SELECT (SELECT count(DISTINCT user_id) FROM events) AS event_users,
       (SELECT count(DISTINCT user_id) FROM events WHERE user_id IN (SELECT c_custkey FROM customer)) AS overlap_users,
       (SELECT count(*) FROM events WHERE user_id IN (SELECT c_custkey FROM customer)) AS events_of_known,
       (SELECT count(*) FROM customer) AS customers"""

ORACLE_SQL["dedupe_first"] = """
SELECT user_id, ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id, event_type) AS rn FROM events) t
WHERE rn = 1"""

ORACLE_SQL["id_translate"] = """
WITH s AS (SELECT user_id, count(*) AS n_signups FROM events WHERE event_type = 'signup' GROUP BY user_id),
     c AS (SELECT c_custkey, c_name FROM customer WHERE length(c_name) > 0),
     dm AS (SELECT upper(md5(CAST(c_custkey AS VARCHAR))) AS imeimd5, CAST(c_nationkey AS BIGINT) AS device FROM customer)
SELECT s.user_id, c.c_custkey, c.c_name, s.n_signups, dm.device
FROM s JOIN c ON s.user_id = c.c_custkey
LEFT JOIN dm ON lower(md5(CAST(s.user_id AS VARCHAR))) = lower(dm.imeimd5)
WHERE dm.imeimd5 IS NOT NULL"""

# ---------------------------------------------------------------- ads
import datetime as _dt  # noqa: E402

_Y = (P.AS_OF - _dt.timedelta(days=1)).strftime("%Y%m%d")
_HIST_LO = _off(P.AS_OF, -1, 0).strftime("%Y%m%d")
_HIST_HI = _off(P.AS_OF, 0, -1).strftime("%Y%m%d")

_CTR_COLUMNS = ["unit_id", "location", "week", "hour", "date", "seg", "nation", "bal", "brand", "ptype", "psize",
                "history_click_1m"]
# one token for each blank-separated element of a value
_BAG = "concat_ws(' ', " + ", ".join(
    f"""nullif(array_to_string(list_transform(list_filter(string_split(replace(coalesce(CAST({c} AS VARCHAR), ''), '_', ''), ' '),
        lambda e: e <> ''), lambda e: '{c}_' || e), ' '), '')""" for c in _CTR_COLUMNS) + ")"
_ADS = f"""
  log AS (SELECT md5(CAST(user_id AS VARCHAR)) AS imei, props->>'$.k' AS unit_id,
                 'L' || CAST(CAST(floor(value / 25) AS BIGINT) AS VARCHAR) AS location, ts,
                 CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clk,
                 strftime(ts, '%Y%m%d%H') AS stat_hour, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date
          FROM events WHERE event_type IN ('view', 'click')),
  lab AS (SELECT imei, unit_id, location, CAST(isodow(ts) AS BIGINT) AS week, CAST(hour(ts) AS BIGINT) AS hour,
                 strftime(ts, '%m%d') AS date, CAST(max(clk) AS BIGINT) AS label
          FROM log WHERE stat_hour >= '{_Y}00' AND stat_hour < '{(P.AS_OF).strftime('%Y%m%d')}00'
          GROUP BY ALL),
  hist AS (SELECT imei, string_agg(DISTINCT unit_id, ' ' ORDER BY unit_id) AS history_click_1m
           FROM log WHERE clk = 1 AND stat_date >= {_HIST_LO} AND stat_date < {_HIST_HI} GROUP BY imei),
  users AS (SELECT md5(CAST(c_custkey AS VARCHAR)) AS imei, c_mktsegment AS seg,
                   CAST(c_nationkey AS VARCHAR) AS nation, CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS bal
            FROM customer),
  units AS (SELECT CAST(p_partkey AS VARCHAR) AS unit_id, p_brand AS brand, p_type AS ptype,
                   CAST(p_size AS VARCHAR) AS psize FROM part),
  wide AS (SELECT lab.*, users.seg, users.nation, users.bal, units.brand, units.ptype, units.psize,
                  coalesce(hist.history_click_1m, 'null') AS history_click_1m
           FROM lab JOIN users USING (imei) JOIN units USING (unit_id) LEFT JOIN hist USING (imei)),
  rows_ AS (SELECT {_BAG} AS features, label
           FROM wide),
  ctr AS (SELECT features, max(label) AS label FROM rows_ GROUP BY features)
"""

ORACLE_SQL["ad_click_label"] = f"WITH {_ADS} SELECT * FROM lab"
ORACLE_SQL["ad_click_history"] = f"WITH {_ADS} SELECT * FROM hist"
ORACLE_SQL["ad_click_hourly"] = f"""WITH {_ADS}
SELECT imei, unit_id, location, strftime(ts, '%Y-%m-%dT%H') AS time, CAST(max(clk) AS BIGINT) AS label
FROM log WHERE stat_hour >= '{_Y}00' AND stat_hour < '{(P.AS_OF).strftime('%Y%m%d')}00' GROUP BY ALL"""
ORACLE_SQL["ctr_feature_lines"] = f"WITH {_ADS} SELECT features || '##yf##' || CAST(label AS VARCHAR) AS value FROM ctr"
ORACLE_SQL["ad_training_wide"] = f"""WITH {_ADS}
SELECT imei, unit_id, location, week, hour, date, seg, nation, bal, brand, ptype, psize, history_click_1m, label
FROM wide"""
ORACLE_SQL["ctr_feature_rows"] = f"WITH {_ADS} SELECT * FROM ctr"
ORACLE_SQL["feature_vocab"] = f"""WITH {_ADS},
  toks AS (SELECT DISTINCT unnest(string_split(features, ' ')) AS feature FROM ctr)
SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM toks WHERE feature <> ''"""

# month window of daily wide rows (job days [d - 1 month, d))
_MLO = _off(P.AS_OF, -1, 0)
_EV_LO = (_MLO - _dt.timedelta(days=1)).isoformat()
_EV_HI = (P.AS_OF - _dt.timedelta(days=1)).isoformat()
_H_LO = _off(_MLO, -1, 0).isoformat()
_MONTH = f"""
  mlog AS (SELECT md5(CAST(user_id AS VARCHAR)) AS imei, props->>'$.k' AS unit_id,
                  'L' || CAST(CAST(floor(value / 25) AS BIGINT) AS VARCHAR) AS location, ts,
                  CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clk, CAST(ts AS DATE) AS day
           FROM events WHERE event_type IN ('view', 'click')),
  mlab AS (SELECT imei, unit_id, location, day + 1 AS job_day, CAST(isodow(ts) AS BIGINT) AS week,
                  CAST(hour(ts) AS BIGINT) AS hour, strftime(ts, '%m%d') AS date, CAST(max(clk) AS BIGINT) AS label
           FROM mlog WHERE ts >= TIMESTAMP '{_EV_LO}' AND ts < TIMESTAMP '{_EV_HI}' GROUP BY ALL),
  mclk AS (SELECT imei, unit_id, day AS click_day FROM mlog
           WHERE clk = 1 AND ts >= TIMESTAMP '{_H_LO}' AND ts < TIMESTAMP '{_EV_HI}'),
  mcand AS (SELECT imei, unit_id, click_day,
                   CAST(unnest(generate_series(CAST(click_day AS TIMESTAMP) + INTERVAL 2 DAY,
                                               CAST(click_day AS TIMESTAMP) + INTERVAL 32 DAY, INTERVAL 1 DAY)) AS DATE)
                   AS job_day FROM mclk),
  mhist AS (SELECT imei, job_day, string_agg(DISTINCT unit_id, ' ' ORDER BY unit_id) AS history_click_1m
            FROM mcand WHERE {_lenient('job_day', -1, 0)} <= click_day AND click_day < job_day - 1
            GROUP BY imei, job_day),
  mwide AS (SELECT mlab.*, users.seg, users.nation, users.bal, units.brand, units.ptype, units.psize,
                   coalesce(mhist.history_click_1m, 'null') AS history_click_1m
            FROM mlab JOIN users USING (imei) JOIN units USING (unit_id) LEFT JOIN mhist USING (imei, job_day))
"""

ORACLE_SQL["ad_training_month"] = f"""WITH {_ADS}, {_MONTH}
SELECT CAST(strftime(job_day, '%Y%m%d') AS BIGINT) AS stat_date, imei, unit_id, location, week, hour, date, seg,
       nation, bal, brand, ptype, psize, history_click_1m, label FROM mwide"""

_MROWS = f"""{_MONTH},
  mrows AS (SELECT features, max(label) AS label FROM (SELECT {_BAG} AS features, label FROM mwide) GROUP BY features)"""
ORACLE_SQL["ctr_month_rows"] = f"""WITH {_ADS}, {_MROWS}
SELECT features, label FROM mrows"""


def _ctr_training() -> str:
    """The rounds of the long-form logistic regression, one after the other."""
    from portrait.operators.longform import ROUNDS, momentum
    out = f"""{_MROWS},
  ex AS MATERIALIZED (SELECT row_number() OVER (ORDER BY features) AS row, features, label::DOUBLE AS label,
             substring(md5(features), 1, 8) < 'cccccccc' AS train FROM mrows),
  long AS MATERIALIZED (SELECT DISTINCT row, label, train, unnest(string_split(features, ' ')) AS feature FROM ex),
  tr AS MATERIALIZED (SELECT * FROM long WHERE train),
  most AS (SELECT max(m) AS m FROM (SELECT count(*) AS m FROM tr GROUP BY row)),
  steps AS (SELECT feature, 4.0::DOUBLE / (count(*) * any_value(most.m)) AS step FROM tr, most GROUP BY feature),
  w0 AS MATERIALIZED (SELECT feature, step, 0.0::DOUBLE AS weight, 0.0::DOUBLE AS ahead
         FROM (SELECT DISTINCT feature FROM long WHERE feature <> '') LEFT JOIN steps USING (feature))"""
    for k, look in enumerate(momentum(ROUNDS)):
        out += f""",
  m{k} AS MATERIALIZED (SELECT row, any_value(label) AS label, sum(ahead) AS margin FROM tr JOIN w{k} USING (feature) GROUP BY row),
  g{k} AS (SELECT feature, sum(1 / (1 + exp(-margin)) - m{k}.label) AS g FROM tr JOIN m{k} USING (row) GROUP BY feature),
  n{k} AS (SELECT feature, step, weight AS old, ahead - coalesce(step * g, 0) AS weight FROM w{k} LEFT JOIN g{k} USING (feature)),
  w{k + 1} AS MATERIALIZED (SELECT feature, step, weight, weight + {look!r}::DOUBLE * (weight - old) AS ahead FROM n{k})"""
    return out + f""",
  trained AS MATERIALIZED (SELECT feature, weight FROM w{ROUNDS})"""


_TRAINED = _ctr_training()
ORACLE_SQL["ctr_weights"] = f"""WITH {_ADS}, {_TRAINED},
  shown AS (SELECT feature, CASE WHEN round(weight, 5) = 0 THEN 0.0::DOUBLE ELSE round(weight, 5) END AS weight FROM trained
            WHERE split_part(feature, '_', 1) <> 'date')
SELECT feature, weight, feature || ' ' || printf('%.5f', weight) AS line FROM shown"""
ORACLE_SQL["ctr_threshold"] = f"""WITH {_ADS}, {_TRAINED},
  scored AS (SELECT round(1 / (1 + exp(-sum(weight))), 9) AS score, any_value(label) AS label
             FROM long JOIN trained USING (feature) WHERE NOT train GROUP BY row),
  per AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score),
  cum AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS total FROM per
          WINDOW w AS (ORDER BY score DESC)),
  pr AS (SELECT score, tp / (tp + fp) AS p, CASE WHEN total > 0 THEN tp / total END AS r FROM cum),
  f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)
SELECT score AS threshold, round(f, 6) AS f_measure, round(p, 6) AS precision, round(r, 6) AS recall
FROM f ORDER BY round(f, 12) DESC, score DESC LIMIT 1"""
ORACLE_SQL["publish_marker"] = f"""WITH {_ADS}, {_MROWS},
  toks AS (SELECT DISTINCT unnest(string_split(features, ' ')) AS feature FROM mrows)
SELECT '{P.AS_OF.strftime('%Y%m%d')}' AS marker, count(*) AS rows FROM toks
WHERE feature <> '' AND split_part(feature, '_', 1) <> 'date'"""

# ---------------------------------------------------------------- ratings
_ACTS = """
  scores AS (SELECT * FROM (VALUES ('content_click', 1.0), ('content_comment', 2.0), ('content_like', 3.0),
                                   ('content_share', 5.0), ('content_danmku', 2.0), ('browse_progress', 0.0),
                                   ('video_play', 0.0)) s(action, score)),
  alog AS (SELECT md5(CAST(user_id AS VARCHAR)) AS imei, props->>'$.k' AS item_id,
                  CASE event_type WHEN 'click' THEN 'content_click' WHEN 'view' THEN 'video_play'
                                  WHEN 'purchase' THEN 'content_share' WHEN 'signup' THEN 'content_comment' END AS action,
                  CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date FROM events),
  daily AS (SELECT imei, item_id, action, stat_date, CAST(count(*) AS DOUBLE) AS frequency
            FROM alog WHERE action IN (SELECT action FROM scores) AND imei IS NOT NULL AND item_id IS NOT NULL
            GROUP BY ALL),
  rng AS (SELECT imei, item_id, action, sum(frequency) AS frequency FROM daily
          WHERE stat_date > 20240101 AND stat_date < 20240116 GROUP BY ALL HAVING length(imei) > 5)
"""
ORACLE_SQL["user_actions_daily"] = f"""WITH {_ACTS}
SELECT imei, item_id, action, frequency FROM daily WHERE stat_date = {P.AS_OF.strftime('%Y%m%d')}"""
ORACLE_SQL["user_actions_range"] = f"WITH {_ACTS} SELECT * FROM rng"
ORACLE_SQL["item_rating"] = f"""WITH {_ACTS}
SELECT imei, item_id, sum(score * frequency) AS rating FROM rng JOIN scores USING (action) GROUP BY imei, item_id"""

_LABELS = """
  base AS (SELECT md5(CAST(e.user_id AS VARCHAR)) AS imei, p.p_brand AS pred, p.p_type AS label, e.event_type,
                  CAST(strftime(e.ts, '%Y%m%d') AS BIGINT) AS stat_date
           FROM events e JOIN part p ON p.p_partkey = CAST(e.props->>'$.k' AS BIGINT)
           WHERE e.event_type IN ('click', 'view', 'purchase', 'signup')),
  ld AS (SELECT imei, pred || '@' || label AS labels, count(*) AS times, stat_date FROM base
         WHERE imei IS NOT NULL AND pred IS NOT NULL AND label IS NOT NULL GROUP BY imei, pred, label, stat_date)
"""
ORACLE_SQL["label_daily"] = f"WITH {_LABELS} SELECT * FROM ld"
_PSINCE = _off(P.PROFILE_AS_OF, -1, 0).strftime("%Y%m%d")
ORACLE_SQL["label_profile"] = f"""WITH {_LABELS},
  sc AS (SELECT imei, labels, round(sum(CAST(times AS DECIMAL(20,0)) *
                  ((31 - datediff('day', strptime(CAST(stat_date AS VARCHAR), '%Y%m%d')::DATE, DATE '{P.PROFILE_AS_OF.isoformat()}'))
                   * CAST(0.03333 AS DECIMAL(6,5)))), 3) AS s
         FROM ld WHERE stat_date > {_PSINCE} GROUP BY imei, labels)
SELECT imei, string_agg(labels || ':' || CAST(CAST(s AS DECIMAL(38,3)) AS VARCHAR), '###' ORDER BY s DESC, labels ASC) AS labels
FROM sc GROUP BY imei"""

ORACLE_SQL["label_profile_entries"] = f"""WITH {_LABELS},
  sc AS (SELECT imei, labels, stat_date, round(CAST(times AS DECIMAL(20,0)) *
                  ((31 - datediff('day', strptime(CAST(stat_date AS VARCHAR), '%Y%m%d')::DATE, DATE '{P.PROFILE_AS_OF.isoformat()}'))
                   * CAST(0.03333 AS DECIMAL(6,5))), 3) AS s
         FROM ld WHERE stat_date > {_PSINCE})
SELECT imei, string_agg(labels || ':' || CAST(CAST(s AS DECIMAL(38,3)) AS VARCHAR), '###'
                        ORDER BY s DESC, labels ASC, stat_date DESC) AS labels
FROM sc GROUP BY imei"""

ORACLE_SQL["event_counts"] = """
SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date, event_type, count(*) AS n
FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL"""

ORACLE_SQL["event_counts_sets"] = """
SELECT source, event_type, count(*) AS n, CAST(grouping_id(source, event_type) AS BIGINT) AS gid
FROM (SELECT 'b' || CAST(CAST(floor(user_id / 25) AS BIGINT) AS VARCHAR) AS source, event_type FROM events) t
GROUP BY GROUPING SETS ((source), (event_type), (source, event_type))"""

ORACLE_SQL["run_metrics"] = """
SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT props->>'$.k') AS items,
       count(DISTINCT (user_id, props->>'$.k')) AS user_items FROM events"""

ORACLE_SQL["questionnaire_best"] = f"""
WITH q AS (SELECT o_custkey AS user_id, o_orderstatus AS a0,
                  CASE WHEN o_totalprice < {P.POOR_SHEET} THEN '' ELSE substr(o_orderpriority, 1, 1) END AS a1,
                  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(year(o_orderdate) % 3 AS VARCHAR) END AS a10 FROM orders),
     s AS (SELECT DISTINCT user_id, concat_ws(';', '0=' || a0, '1=' || a1, '10=' || a10) AS answers,
                  CAST((coalesce(a0, '') <> '')::INT + (coalesce(a1, '') <> '')::INT + (coalesce(a10, '') <> '')::INT AS BIGINT) AS answered
           FROM q),
     b AS (SELECT user_id, max(answered) AS m FROM s GROUP BY user_id)
SELECT s.user_id, s.answers, s.answered, c.c_custkey, c.c_name
FROM s JOIN b ON b.user_id = s.user_id AND s.answered = b.m JOIN customer c ON c.c_custkey = s.user_id"""

# ---------------------------------------------------------------- text / content
from portrait.functions.text import HTML_STEPS  # noqa: E402


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _html(expr: str) -> str:
    out = f"coalesce({expr}, '')"
    for pat, rep in HTML_STEPS:
        out = f"regexp_replace({out}, {_q(pat)}, {_q(rep)}, 'g')"
    return out


def _norm_cat(expr: str) -> str:
    return f"regexp_replace(replace(lower(trim({expr})), '其它', '其他'), '[ _-]+', ',', 'g')"


def _tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _keep(expr: str, cls: str) -> str:
    return f"replace(regexp_replace({expr}, '[^{cls}]+', ' ', 'g'), chr(10), ' ')"


def _host(expr: str) -> str:
    parts = f"string_split(rtrim({expr}, '/'), '/')"
    return f"(CASE WHEN len({parts}) > 3 THEN {parts}[3] ELSE '' END)"


ORACLE_SQL["html_to_text"] = f"SELECT page_id, {_html('html')} AS text FROM pages"
ORACLE_SQL["keep_script"] = f"SELECT doc_id, {_keep('text', 'a-z')} AS kept FROM documents"
ORACLE_SQL["decode_content"] = """
SELECT doc_id, md5(decode(from_base64(to_base64(encode(text))))) AS digest,
       CAST(length(decode(from_base64(to_base64(encode(text))))) AS BIGINT) AS n FROM documents"""
ORACLE_SQL["tokenize_text"] = f"""
SELECT doc_id, CAST(len({_tokens('text')}) AS BIGINT) AS n_tokens, array_to_string({_tokens('text')}, ' ') AS tokens
FROM documents"""

_USED_PART = f"""
  used AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS category_id FROM (
             SELECT DISTINCT {_norm_cat('p_type')} AS name FROM part
             UNION SELECT DISTINCT {_norm_cat("p_type || '_' || p_brand")} FROM part WHERE p_size <= 25) t)"""

ORACLE_SQL["category_normalize"] = f"""WITH {_USED_PART},
  c AS (SELECT p_partkey, {_norm_cat("p_type || '_' || p_brand")} AS cat FROM part)
SELECT p_partkey, CASE WHEN u.name IS NULL THEN 'UNK' ELSE replace(c.cat, ',', '-') END AS category,
       CAST(coalesce(u.category_id, -1) AS BIGINT) AS category_id,
       CAST(CASE WHEN u.name IS NULL THEN -1 WHEN len(string_split(c.cat, ',')) = 2 THEN 2 ELSE 1 END AS BIGINT) AS level
FROM c LEFT JOIN used u ON u.name = c.cat"""

_GOODS = """
  g0 AS (SELECT p_partkey AS fid, CASE WHEN p_size >= 5 THEN p_type || '|' || p_brand || '|' || p_name
                                       ELSE p_type || '|' || p_brand END AS fcategory FROM part),
  g AS (SELECT fid, string_split(trim(fcategory), '|') AS p FROM g0 WHERE len(string_split(trim(fcategory), '|')) = 3),
  lv AS (SELECT fid, p[1] AS category_1, p[1] || '-' || p[2] AS category_2, p[1] || '-' || p[2] || '-' || p[3] AS category_3
         FROM g),
  d1 AS (SELECT category_1 AS name, count(*) AS count FROM lv GROUP BY 1),
  d2 AS (SELECT category_2 AS name, count(*) AS count FROM lv GROUP BY 1),
  d3 AS (SELECT category_3 AS name, count(*) AS count FROM lv GROUP BY 1),
  i1 AS (SELECT *, row_number() OVER (ORDER BY count DESC, name) - 1 AS id FROM d1),
  i2 AS (SELECT *, row_number() OVER (ORDER BY count DESC, name) - 1 AS id FROM d2),
  i3 AS (SELECT *, row_number() OVER (ORDER BY count DESC, name) - 1 AS id FROM d3)"""

ORACLE_SQL["category_path"] = f"""WITH {_GOODS}
SELECT lv.fid, lv.category_1, i1.count || '-' || i1.id AS label_1, lv.category_2, i2.count || '-' || i2.id AS label_2,
       lv.category_3, i3.count || '-' || i3.id AS label_3
FROM lv LEFT JOIN i1 ON i1.name = lv.category_1 LEFT JOIN i2 ON i2.name = lv.category_2
LEFT JOIN i3 ON i3.name = lv.category_3"""

ORACLE_SQL["label_dictionary"] = f"""WITH {_GOODS}
SELECT CAST(1 AS BIGINT) AS level, name, count, id FROM i1
UNION ALL SELECT 2, name, count, id FROM i2
UNION ALL SELECT 3, name, count, id FROM i3"""

ORACLE_SQL["load_alias_map"] = """
SELECT lower(p_type) AS alias, arg_max(lower(p_brand), p_partkey) AS canonical FROM part GROUP BY lower(p_type)"""

_TEST_DENY = ["spam-farm.example.org", "www.cheap-pills.example.com"]
_TEST_KNOWN = [("thther.example.org", "news"), ("blog.ththan.example.net", "blog")]


def _pages_cte():
    from portrait import config as C
    deny = ", ".join(_q(x) for x in C.COMMERCE_DOMAINS + C.USELESS_DOMAINS + _TEST_DENY)
    titles = ", ".join(_q(x) for x in C.USELESS_TITLES)
    known = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in C.KNOWN_DOMAIN_LABELS + _TEST_KNOWN)
    return f"""
  known AS (SELECT * FROM (VALUES {known}) k(domain, label)),
  pr AS (SELECT page_id, url, trim({_keep("regexp_extract(html, '<title>(.*?)</title>', 1)", '\\p{L}')}) AS title, html
         FROM pages),
  pr2 AS (SELECT *, {_host('url')} AS domain FROM pr WHERE length(title) > 1),
  lp AS (SELECT pr2.*, coalesce(known.label, 'unk') AS label FROM pr2 LEFT JOIN known USING (domain)
         WHERE domain NOT IN ({deny}) AND title NOT IN ({titles}))"""


ORACLE_SQL["url_domain_label"] = f"""WITH {_pages_cte()}
SELECT page_id, domain, label, array_to_string({_tokens('title')}, ' ') AS title_tokens,
       CAST(len({_tokens(_keep(_html('html'), chr(92) + 'p{L}'))}) AS BIGINT) AS n_content_tokens
FROM lp"""

ORACLE_SQL["notice_extract"] = """
SELECT conv_id, turn, text FROM conversations
WHERE trim(role) IN ('user') AND turn IS NOT NULL AND length(trim(text)) > 20"""

ORACLE_SQL["notice_group"] = """
SELECT d.doc_id, g.group_id, g.group_size FROM documents d
JOIN (SELECT lang, text, min(doc_id) AS group_id, count(*) AS group_size FROM documents GROUP BY lang, text) g
  ON g.lang = d.lang AND g.text = d.text"""

ORACLE_SQL["article_labels"] = f"""
WITH a AS (SELECT doc_id, trim(split_part(text, chr(10), 1)) AS title, trim(text) AS content, source FROM documents),
     a2 AS (SELECT * FROM a WHERE length(title) > 1 AND length(content) > 1),
     used AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS category_id
              FROM (SELECT DISTINCT {_norm_cat('source')} AS name FROM a2) t)
SELECT a2.doc_id, CASE WHEN u.name IS NULL THEN 'UNK' ELSE replace(u.name, ',', '-') END AS category,
       CAST(coalesce(u.category_id, -1) AS BIGINT) AS category_id,
       CAST(CASE WHEN u.name IS NULL THEN -1 WHEN len(string_split(u.name, ',')) = 2 THEN 2 ELSE 1 END AS BIGINT) AS level,
       CASE TRY_CAST(substr(source, 4, 10) AS INTEGER) WHEN 2 THEN 'UC' WHEN 76 THEN 'Baidu' ELSE 'other' END AS source_name,
       array_to_string({_tokens(_keep('title', chr(92) + 'p{L}'))}, ' ') AS title_tokens,
       CAST(len({_tokens('content')}) AS BIGINT) AS n_content_tokens
FROM a2 LEFT JOIN used u ON u.name = {_norm_cat('a2.source')}"""

ORACLE_SQL["parse_scored_lines"] = """
SELECT DISTINCT 'd' || CAST(l.doc_id AS VARCHAR) AS id, d.lang AS label_1,
       CAST(CASE WHEN l.quality = 1 THEN 0.75 ELSE 0.25 END AS DOUBLE) AS prob_1,
       d.lang || '-' || d.source AS label_2, CAST(CASE WHEN l.toxic = 1 THEN 0.8 ELSE 0.4 END AS DOUBLE) AS prob_2
FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE d.n_chars >= 100"""

_SCORED = f"""{_GOODS},
  lines AS (SELECT k.level, md5(CAST(p_partkey AS VARCHAR)) AS id,
                   CASE WHEN p_partkey % 23 = 0 THEN replace(p_name, ' ', '|') WHEN p_partkey % 29 = 0 THEN '' ELSE p_name END AS text,
                   CASE WHEN (p_partkey + k.level) % 31 = 0 THEN '' WHEN (p_partkey + k.level) % 37 = 0 THEN '__label__99999'
                        ELSE '__label__' || CAST((p_partkey * (2 * k.level + 1)) % (5 * k.level * k.level) AS VARCHAR) END AS pred
            FROM part, (VALUES (1::BIGINT), (2), (3)) k(level)),
  parsed AS (SELECT *, len(string_split(text, '|')) = 1 AND length(text) > 1 AND length(pred) > 1 AS kept FROM lines)"""
ORACLE_SQL["result_line_counts"] = f"""WITH {_SCORED}
SELECT level, count(*) AS lines, count(*) FILTER (NOT kept) AS rejected FROM parsed GROUP BY level"""
ORACLE_SQL["multi_level_results"] = f"""WITH {_SCORED},
  dict AS (SELECT 1 AS level, name, id FROM i1 UNION ALL SELECT 2, name, id FROM i2 UNION ALL SELECT 3, name, id FROM i3),
  named AS (SELECT DISTINCT p.level, p.id, p.text, p.pred, coalesce(d.name, '') AS label
            FROM parsed p LEFT JOIN dict d ON d.level = p.level AND p.pred = '__label__' || CAST(d.id AS VARCHAR) WHERE p.kept)
SELECT a.id, a.text, a.pred AS pred_1, a.label AS label_1, b.pred AS pred_2, b.label AS label_2, c.pred AS pred_3, c.label AS label_3
FROM named a JOIN named b ON b.id = a.id AND b.text = a.text AND b.level = 2
JOIN named c ON c.id = a.id AND c.text = a.text AND c.level = 3 WHERE a.level = 1"""


def _hexf(h, start, n):
    return f"round(CAST(('0x' || substr({h}, {start}, {n}))::BIGINT AS DOUBLE) / 255.0, 4)"


def _hexi(h, start):
    return f"CAST(('0x' || substr({h}, {start}, 1))::BIGINT AS VARCHAR)"


_H = "md5(CAST(doc_id AS VARCHAR))"
_RECON = """
  r1 AS (SELECT *, split_part(label_1, '_', 1) AS n1, split_part(label_1, '_', 2) AS id1,
                string_split(trim(label_2), '-') AS p2 FROM j),
  r2 AS (SELECT *, (len(p2) = 2 AND n1 <> p2[1]) AS conflict FROM r1),
  r3 AS (SELECT *, coalesce(conflict AND prob_2 > prob_1 AND prob_2 >= 0.7, false) AS lift,
                coalesce(conflict AND NOT (prob_2 > prob_1 AND prob_2 >= 0.7), false) AS fall FROM r2)"""

ORACLE_SQL["hier_reconcile"] = f"""
WITH pred AS (SELECT doc_id, 'c' || substr({_H}, 1, 1) || '_' || {_hexi(_H, 1)} AS label_1, {_hexf(_H, 2, 2)} AS prob_1,
                     'c' || substr({_H}, 3, 1) || '-d' || substr({_H}, 4, 1) || '_' || {_hexi(_H, 4)} AS label_2,
                     {_hexf(_H, 5, 2)} AS prob_2
              FROM documents WHERE n_chars > 100),
  j AS (SELECT d.doc_id, d.source AS known_label, p.label_1, p.prob_1, p.label_2, p.prob_2
        FROM documents d LEFT JOIN pred p ON p.doc_id = d.doc_id),
  {_RECON}
SELECT doc_id,
       CASE WHEN lift THEN p2[1] || '_' || CAST(('0x' || substr(p2[1], 2, 1))::BIGINT AS VARCHAR) ELSE label_1 END AS label_1,
       CASE WHEN lift THEN 1.5 ELSE prob_1 END AS prob_1,
       CASE WHEN fall THEN n1 || '-其它_' || id1 ELSE label_2 END AS label_2,
       CASE WHEN fall THEN 1.5 ELSE prob_2 END AS prob_2, known_label
FROM r3"""

ORACLE_SQL["hier_reconcile_refined"] = f"""
WITH j AS (SELECT doc_id, 'c' || substr({_H}, 1, 1) || '_' || {_hexi(_H, 1)} AS label_1, {_hexf(_H, 2, 2)} AS prob_1,
                  'c' || substr({_H}, 3, 1) || '-d' || substr({_H}, 4, 1) || '_' || {_hexi(_H, 4)} AS label_2,
                  {_hexf(_H, 5, 2)} AS prob_2
           FROM documents WHERE n_chars > 100),
  {_RECON}
SELECT doc_id,
       CASE WHEN lift THEN p2[1] || '_' || CAST(('0x' || substr(p2[1], 2, 1))::BIGINT AS VARCHAR) ELSE label_1 END AS label_1,
       CASE WHEN lift THEN 1.5 ELSE prob_1 END AS prob_1,
       CASE WHEN fall THEN n1 || '-其它_' || id1 ELSE label_2 END AS label_2,
       CASE WHEN fall THEN 1.5 ELSE prob_2 END AS prob_2
FROM r3 WHERE NOT coalesce(conflict AND prob_1 <= 0.5 AND prob_2 <= 0.5, false)"""

_HP = "md5(CAST(page_id AS VARCHAR))"
ORACLE_SQL["manual_override"] = f"""WITH {_pages_cte()},
  used AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS category_id
           FROM (SELECT DISTINCT label AS name FROM known) t),
  pred AS (SELECT page_id, 'c' || substr({_HP}, 1, 1) || '_' || {_hexi(_HP, 1)} AS label_1, {_hexf(_HP, 2, 2)} AS prob_1,
                  'c' || substr({_HP}, 3, 1) || '-d' || substr({_HP}, 4, 1) AS label_2, {_hexf(_HP, 5, 2)} AS prob_2
           FROM pages WHERE length(html) > 5000),
  j AS (SELECT lp.page_id, lp.label, pred.label_1, pred.prob_1, pred.label_2, pred.prob_2
        FROM lp LEFT JOIN pred USING (page_id))
SELECT page_id,
       CASE WHEN coalesce(label, 'unk') <> 'unk' THEN label || '_' || CAST(u.category_id AS VARCHAR) ELSE label_1 END AS label_1,
       CASE WHEN coalesce(label, 'unk') <> 'unk' THEN 1.5 ELSE prob_1 END AS prob_1,
       CASE WHEN coalesce(label, 'unk') <> 'unk' THEN 'null' ELSE label_2 END AS label_2,
       CASE WHEN coalesce(label, 'unk') <> 'unk' THEN -1.0 ELSE prob_2 END AS prob_2,
       CASE WHEN coalesce(label, 'unk') <> 'unk' THEN 'Manual' ELSE 'Pred' END AS label_source
FROM j LEFT JOIN used u ON u.name = j.label"""

ORACLE_SQL["url_to_user"] = f"""
WITH pg AS (SELECT page_id, md5(url) AS url_md5, {_host('url')} AS domain FROM pages),
     uu AS (SELECT DISTINCT pg.url_md5, e.user_id FROM events e
            JOIN pg ON pg.page_id = CAST(e.props->>'$.k' AS BIGINT))
SELECT uu.user_id, pg.page_id, pg.domain FROM pg JOIN uu USING (url_md5)"""

# ---------------------------------------------------------------- sampling
ORACLE_SQL["badcase_sample"] = f"""
WITH pred AS (SELECT doc_id, 'c' || substr({_H}, 1, 1) || '_' || {_hexi(_H, 1)} AS label_1, {_hexf(_H, 2, 2)} AS prob_1
              FROM documents WHERE n_chars > 100),
     s AS (SELECT *, row_number() OVER (PARTITION BY label_1 ORDER BY md5(CAST(doc_id AS VARCHAR))) AS rn
           FROM pred WHERE prob_1 < 0.5),
     a AS (SELECT doc_id, trim(split_part(text, chr(10), 1)) AS title, trim(text) AS content FROM documents)
SELECT s.doc_id, s.label_1, s.prob_1, a.title FROM s JOIN a ON a.doc_id = s.doc_id
WHERE s.rn <= {P.BADCASE_PER_LABEL} AND length(a.title) > 1 AND length(a.content) > 1"""

ORACLE_SQL["hash_split"] = f"""
SELECT doc_id, CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) < '{P.SPLIT_HEX}' THEN 'train' ELSE 'valid' END AS split
FROM documents"""

ORACLE_SQL["balance_classes"] = """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
     f AS (SELECT quality, (SELECT min(n) FROM c) / n AS frac FROM c)
SELECT l.doc_id, CAST(l.quality AS BIGINT) AS label FROM labels l JOIN f USING (quality)
WHERE CAST(('0x' || substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 < f.frac"""

ORACLE_SQL["min_support_classes"] = f"""
SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) >= {P.MIN_SUPPORT}"""

# ---------------------------------------------------------------- sinks
ORACLE_SQL["export_infer_lines"] = f"""
WITH a AS (SELECT doc_id, trim(split_part(text, chr(10), 1)) AS title, trim(text) AS content FROM documents)
SELECT CAST(doc_id AS VARCHAR) || '##yf##' || array_to_string({_tokens(_keep('title', chr(92) + 'p{L}'))}, ' ') AS value
FROM a WHERE length(title) > 1 AND length(content) > 1"""

_RAW_CATEGORY = "CASE WHEN doc_id % 3 = 0 THEN lang ELSE lang || '_' || source END"
ORACLE_SQL["content_train_lines"] = f"""
WITH a AS (SELECT doc_id, trim(split_part(text, chr(10), 1)) AS title, trim(text) AS content, source, lang FROM documents),
     a2 AS (SELECT *, {_norm_cat(_RAW_CATEGORY)} AS name FROM a WHERE length(title) > 1 AND length(content) > 1),
     used AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS id FROM (SELECT DISTINCT name FROM a2) t),
     r AS (SELECT '__label__' || replace(name, ',', '-') || '_' || CAST(id AS VARCHAR) || ', ' AS head,
                  array_to_string({_tokens('title')}, ' ') AS title, array_to_string({_tokens('content')}, ' ') AS content,
                  CAST(CASE WHEN len(string_split(name, ',')) = 2 THEN 2 ELSE 1 END AS BIGINT) AS level
           FROM a2 JOIN used USING (name)
           WHERE source = '{P.TRAIN_SOURCE}'
             AND DATE '{P.AS_OF.isoformat()}' - CAST(doc_id % 900 AS INTEGER) >= DATE '{_off(P.AS_OF, P.TRAIN_MONTHS, 0).isoformat()}')
SELECT 'title' AS field, level, head || title AS value FROM r
UNION ALL SELECT 'content', level, head || content FROM r"""

ORACLE_SQL["export_train_lines"] = f"""WITH {_GOODS},
  g2 AS (SELECT g0.fid, p.p_name AS ftitle FROM g0 JOIN part p ON p.p_partkey = g0.fid),
  lv2 AS (SELECT lv.*, g2.ftitle FROM lv JOIN g2 USING (fid))
SELECT CAST(1 AS BIGINT) AS level, '__label__' || i1.id || ', ' || ftitle AS value FROM lv2 JOIN i1 ON i1.name = category_1
  WHERE i1.count >= {P.TRAIN_MIN_SUPPORT}
UNION ALL SELECT 2, '__label__' || i2.id || ', ' || ftitle FROM lv2 JOIN i2 ON i2.name = category_2
  WHERE i2.count >= {P.TRAIN_MIN_SUPPORT}
UNION ALL SELECT 3, '__label__' || i3.id || ', ' || ftitle FROM lv2 JOIN i3 ON i3.name = category_3
  WHERE i3.count >= {P.TRAIN_MIN_SUPPORT}"""

_DAY = P.AS_OF.strftime("%Y%m%d")
ORACLE_SQL["partition_overwrite"] = f"""
WITH e AS (SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date, event_type FROM events)
SELECT stat_date, event_type, count(*) AS n FROM e WHERE stat_date <> {_DAY} GROUP BY ALL
UNION ALL
SELECT stat_date, event_type, count(*) FROM e WHERE stat_date = {_DAY} AND event_type = 'click' GROUP BY ALL"""

ORACLE_SQL["guarded_write"] = f"""WITH {_SEG}
SELECT user_id, label, label_name FROM seg_named WHERE (SELECT count(*) FROM seg_named) > {P.GUARD_MIN_ROWS}"""

# ---------------------------------------------------------------- evaluation
_SCORES = """
  s AS (SELECT CAST(d.n_chars AS DOUBLE) / 1000.0 AS score, l.quality AS label
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
  g AS (SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
               CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg FROM s GROUP BY score)"""

ORACLE_SQL["eval_auc"] = f"""WITH {_SCORES},
  c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM g)
SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
       (SELECT round(avg(CASE WHEN (score >= 2.0) = (label = 1) THEN 1.0 ELSE 0.0 END), 6) FROM s) AS accuracy
FROM c"""

ORACLE_SQL["best_threshold"] = f"""WITH {_SCORES},
  c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM g),
  f AS (SELECT score AS threshold, tp / (tp + fp) AS precision, tp / (SELECT sum(pos) FROM g) AS recall FROM c),
  f2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END
                   AS f_measure FROM f)
SELECT threshold, round(f_measure, 6) AS f_measure, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM f2 ORDER BY round(f_measure, 12) DESC, threshold DESC LIMIT 1"""

ORACLE_SQL["eval_confusion"] = """
WITH d AS (SELECT lang AS label,
                  CASE WHEN text LIKE '% the %' THEN 'en' WHEN text LIKE '% le %' OR text LIKE '% la %' THEN 'fr'
                       WHEN text LIKE '% der %' OR text LIKE '% die %' THEN 'de' ELSE 'es' END AS prediction
           FROM documents),
  cls AS (SELECT label AS c FROM d UNION SELECT prediction FROM d),
  m AS (SELECT c, (SELECT count(*) FROM d WHERE label = c AND prediction = c) AS tp,
               (SELECT count(*) FROM d WHERE prediction = c) AS predicted,
               (SELECT count(*) FROM d WHERE label = c) AS support FROM cls)
SELECT c AS class, CAST(tp AS BIGINT) AS tp, CAST(predicted - tp AS BIGINT) AS fp, CAST(support - tp AS BIGINT) AS fn,
       round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END, 6) AS precision,
       round(CASE WHEN support > 0 THEN tp / support ELSE 0 END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2 * (tp / predicted) * (tp / support) / ((tp / predicted) + (tp / support)) ELSE 0 END, 6) AS f1,
       round((SELECT count(*) FROM d WHERE label = prediction) / (SELECT count(*) FROM d), 6) AS accuracy
FROM m"""

ORACLE_SQL["sparse_features"] = f"""WITH {_TOPK},
  f AS (SELECT DISTINCT p.user_id, t.idx FROM pairs p JOIN topk t ON t.app_id = p.app_id)
SELECT user_id, CAST(count(*) AS BIGINT) AS nnz, string_agg(CAST(idx AS VARCHAR), ' ' ORDER BY idx) AS indices
FROM f GROUP BY user_id"""

# ---------------------------------------------------------------- further forms
def _pairs_sql(rows) -> str:
    return ", ".join(f"('{k}', {c})" for k, c in rows)


from portrait import config as _C  # noqa: E402

_CODES = ", ".join(f"'{k}'" for k, _ in _C.OCCUPATION_CODES) + ", 'it', '?'"
_LETTER = "substr('ABCDEFGH', CAST(c_custkey * {} % 8 + 1 AS BIGINT), 1)"
ORACLE_SQL["profile_label_maps"] = f"""
WITH c AS (SELECT c_custkey AS user_id, ([{_CODES}])[c_custkey % {len(_C.OCCUPATION_CODES) + 2} + 1] AS occupation,
                  {_LETTER.format(3)} AS marriage, {_LETTER.format(1)} AS parent, {_LETTER.format(5)} AS child,
                  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE {_LETTER.format(7)} END AS consumption, c_custkey % 60 + 10 AS age,
                  CASE WHEN c_custkey % 5 = 4 THEN NULL WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex FROM customer),
  oc(k, v) AS (VALUES {_pairs_sql([(k.lower(), c - 1) for k, c in _C.OCCUPATION_CODES])}),
  ma(k, v) AS (VALUES {_pairs_sql(_C.MARRIAGE_ANSWERS)}), pa(k, v) AS (VALUES {_pairs_sql(_C.PARENT_ANSWERS)}),
  ch(k, v) AS (VALUES {_pairs_sql(_C.CHILD_ANSWERS)})
SELECT 'occupation' AS kind, user_id, CAST(v AS BIGINT) AS label FROM c JOIN oc ON lower(c.occupation) = oc.k
UNION ALL SELECT 'marriage', user_id, v FROM c JOIN ma ON ma.k = marriage
UNION ALL SELECT 'parent', user_id, v FROM c JOIN pa ON pa.k = parent
UNION ALL SELECT 'child_stage', user_id, v FROM c JOIN ch ON ch.k = child
UNION ALL SELECT 'consumption', user_id, CASE WHEN consumption = 'A' THEN 0 ELSE 1 END FROM c WHERE consumption <> ''
UNION ALL SELECT 'marriage_by_age', user_id, CASE WHEN age <= 35 THEN 0 ELSE 1 END FROM c
UNION ALL SELECT 'sex', user_id, CASE sex WHEN 'male' THEN 1 ELSE 0 END FROM c WHERE sex IS NOT NULL"""

ORACLE_SQL["downsample_negatives"] = f"""
SELECT doc_id, CAST(quality AS BIGINT) AS label FROM labels
WHERE quality = 1 OR (quality = 0 AND CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0
                      < {P.NEGATIVE_FRACTION})"""

ORACLE_SQL["hive_text_table"] = f"""
SELECT user_id, parent, nullif(child_stage, 'null') AS child_stage, marriage, CAST({P.AS_OF.strftime('%Y%m%d')} AS BIGINT) AS stat_date
FROM ({ORACLE_SQL["consistency_merge"]}) m"""

_VALID = "SELECT count(*) FROM embeddings WHERE NOT substring(md5(CAST(vec_id AS VARCHAR)), 1, 8) < 'cccccccc'"
ORACLE_SQL["model_score_check"] = f"""
SELECT 'lr_binary' AS model, ({_VALID}) AS scored, CAST(0 AS BIGINT) AS wrong
UNION ALL SELECT 'svm_binary', ({_VALID}), 0
UNION ALL SELECT 'lr_multiclass', ({_VALID}), 0
UNION ALL SELECT 'batch_score', (SELECT 11 * count(*) FROM embeddings), 0
UNION ALL SELECT 'text_classify', (SELECT count(*) FROM documents), 0"""
