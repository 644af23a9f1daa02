"""DuckDB twins of the registered queries (ANSI SQL over the driver's views).

The payment-shaped stand-ins are derived from ``events`` with the SQL of
FIXTURES.md part B; every oracle starts from them, so the Spark side (built
with the DataFrame API in ``paylabel.sources.fixtures``) is checked end to
end.  Doubles are compared after ``ROUND(x, 6) + 0.0``.
"""

from __future__ import annotations

from paylabel.functions.rules import KEYWORD_RULES, TYPE_RULES
from paylabel.functions.text import duckdb_keyword_regex

TXN = """
SELECT concat('TXN_', lpad(CAST(event_id AS VARCHAR(20)), 8, '0'))            AS txn_id,
       concat('CUST_', lpad(CAST(user_id AS VARCHAR(20)), 6, '0'))            AS sender_id,
       ts                                                                     AS txn_time_utc,
       value * 1000                                                           AS amount,
       'VND'                                                                  AS currency,
       CASE event_type WHEN 'purchase' THEN 'qrcode_payment' WHEN 'signup' THEN 'opensaving'
                       WHEN 'click' THEN 'bill_payment' WHEN 'view' THEN 'transfer_in' END AS tranx_type,
       CASE WHEN event_id % 5 < 3 THEN 'MOBILE' ELSE 'WEB' END                AS channel,
       CASE k % 11 WHEN 0 THEN 'BIL' WHEN 1 THEN 'FOO' WHEN 2 THEN 'TRN' WHEN 3 THEN 'HLT'
                   WHEN 4 THEN 'INS' WHEN 5 THEN 'SHP' WHEN 6 THEN 'ENT' WHEN 7 THEN 'EDU'
                   WHEN 8 THEN 'FIN' WHEN 9 THEN 'OTH' ELSE 'ZZZ' END         AS category,
       CASE WHEN event_id % 50 = 0 THEN NULL
            ELSE CASE k % 11 WHEN 0 THEN 'Tien nước thang 3' WHEN 1 THEN 'Nhà hàng Cafe' WHEN 2 THEN 'Grab'
                 WHEN 3 THEN 'Khám bệnh' WHEN 4 THEN 'Bảo hiểm' WHEN 5 THEN 'Mua sắm tại sieu thi'
                 WHEN 6 THEN 'Ve phim' WHEN 7 THEN 'Học phí' WHEN 8 THEN 'Điện thoại đan' ELSE 'Chuyen tien' END
       END                                                                    AS msg_content,
       CASE WHEN k < 68 THEN concat('ENT_rcv_', lpad(CAST(k AS VARCHAR(20)), 5, '0')) END        AS recipient_entity_id,
       concat('Payee ', CAST(k AS VARCHAR(20)))                               AS recipient_alias_raw,
       concat('h:acc_', substr(md5(CAST(k AS VARCHAR(20))), 1, 16))           AS to_account_number_hash,
       CASE k % 4 WHEN 0 THEN 'VCB' WHEN 1 THEN 'TCB' WHEN 2 THEN 'ACB' END   AS to_bank_code,
       CASE WHEN k >= 68 AND k < 96 THEN concat('MER_', lpad(CAST(k AS VARCHAR(20)), 5, '0')) END AS merchant_id,
       CASE WHEN event_id % 10 < 7 THEN concat('882a100d', CAST(event_id % 10 AS VARCHAR(20)), 'bfffff') END AS geo_cell_h3_8
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
"""

ENTITY = """
SELECT concat('ENT_rcv_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))               AS recipient_entity_id,
       CASE WHEN k % 2 = 0 THEN 'MERCHANT' ELSE 'PERSON' END                  AS entity_type,
       concat('Payee ', CAST(k AS VARCHAR(20)))                               AS primary_display_name
FROM (SELECT DISTINCT CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
WHERE k < 96
"""

MERCHANT = """
SELECT concat('MER_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))                   AS merchant_id,
       concat('ENT_rcv_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))               AS recipient_entity_id,
       CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 2 THEN '4900' ELSE '5812' END AS mcc,
       concat('Payee ', CAST(k AS VARCHAR(20)))                               AS brand_name
FROM (SELECT DISTINCT CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
WHERE k < 96 AND k % 2 = 0
"""

PERSON = """
SELECT concat('PERS_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))                  AS person_id,
       concat('ENT_rcv_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))               AS recipient_entity_id,
       CASE k % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' ELSE 'unk' END      AS age_band,
       CASE k % 5 WHEN 0 THEN 'HCM' WHEN 1 THEN 'HN' WHEN 2 THEN 'DN' END     AS province_code,
       CASE k % 7 WHEN 0 THEN 'student' WHEN 1 THEN 'retired' ELSE 'salaried' END AS occupation_band
FROM (SELECT DISTINCT CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
WHERE k < 96 AND k % 2 = 1
"""

CUSTOMER = """
SELECT concat('CUST_', lpad(CAST(u AS VARCHAR(20)), 6, '0'))                  AS sender_id,
       CASE u % 4 WHEN 0 THEN 'L0' WHEN 1 THEN 'L1' WHEN 2 THEN 'L2' ELSE 'L3' END AS kyc_tier,
       CASE u % 3 WHEN 0 THEN 'student' WHEN 1 THEN 'salaried' ELSE 'other' END AS segment,
       CASE u % 3 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' ELSE '55+' END      AS age_band,
       CASE u % 2 WHEN 0 THEN 'HCM' ELSE 'HN' END                             AS home_province_code,
       CASE u % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'mid' WHEN 2 THEN 'high' ELSE 'unk' END AS income_band
FROM (SELECT DISTINCT user_id AS u FROM events) e
"""

ALIAS = """
SELECT concat('ENT_rcv_', lpad(CAST(k AS VARCHAR(20)), 5, '0'))               AS recipient_entity_id,
       CASE a WHEN 'handle' THEN concat('@payee_', CAST(k AS VARCHAR(20)))
              ELSE concat('Payee ', CAST(k AS VARCHAR(20))) END               AS alias_text,
       a                                                                      AS alias_type
FROM (SELECT DISTINCT CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e
CROSS JOIN (SELECT 'account_name' AS a UNION ALL SELECT 'handle' AS a) x
WHERE k < 96
"""

REPLY = """
SELECT concat('TXN_', lpad(CAST(event_id AS VARCHAR(20)), 8, '0'))            AS txn_id,
       CASE event_id % 6
         WHEN 0 THEN '{"label": "FOO", "confidence": 0.95}'
         WHEN 1 THEN 'Sure: {"label": "SHP", "confidence": 0.80} done'
         WHEN 2 THEN '{"label": "EDU", "confidence": 0.5}'
         WHEN 3 THEN 'no idea'
         WHEN 4 THEN '{"label": null, "confidence": 0.9}'
         ELSE '{"label": "unknown", "confidence": 0.1}' END                   AS reply_text
FROM events
"""

LABEL_MAP = """
SELECT 'BIL' AS code, 0 AS idx, 'Bills & Utilities' AS name
UNION ALL SELECT 'FOO', 1, 'Food & Drink'
UNION ALL SELECT 'TRN', 2, 'Transport & Mobility'
UNION ALL SELECT 'HLT', 3, 'Health & Wellness'
UNION ALL SELECT 'INS', 4, 'Insurance & Taxes'
UNION ALL SELECT 'SHP', 5, 'Shopping & Retail'
UNION ALL SELECT 'ENT', 6, 'Entertainment & Leisure'
UNION ALL SELECT 'EDU', 7, 'Education & Learning'
UNION ALL SELECT 'FIN', 8, 'Financial Services'
UNION ALL SELECT 'OTH', 9, 'Other'
"""

# per-transaction derived columns shared by many oracles
FEAT = """
SELECT *, CAST(txn_time_utc AS DATE) AS txn_date,
       ln(1 + amount) AS amount_log,
       hour(txn_time_utc) AS hr,
       sin(2 * pi() * hour(txn_time_utc) / 24.0) AS hour_sin,
       cos(2 * pi() * hour(txn_time_utc) / 24.0) AS hour_cos,
       hour(txn_time_utc) * 3600 + minute(txn_time_utc) * 60 + second(txn_time_utc) AS sod,
       coalesce(tranx_type, 'UNKNOWN') AS tt,
       coalesce(channel, 'UNKNOWN') AS ch,
       CASE WHEN coalesce(recipient_entity_id, '') <> '' THEN recipient_entity_id
            WHEN coalesce(merchant_id, '') <> '' THEN 'MER_' || merchant_id
            ELSE 'UNK_' || coalesce(to_bank_code, '') || '_' || coalesce(to_account_number_hash, '') END AS recipient_canon_id
FROM txn
"""

VOCAB = """
vt AS (SELECT tt, CAST(row_number() OVER (ORDER BY tt) AS INT) AS tt_r FROM (SELECT DISTINCT tt FROM feat) x),
vc AS (SELECT ch, CAST(row_number() OVER (ORDER BY ch) AS INT) AS ch_r FROM (SELECT DISTINCT ch FROM feat) x),
nv AS (SELECT (SELECT count(*) FROM vt) AS nt, (SELECT count(*) FROM vc) AS nc),
fv AS (SELECT f.*, vt.tt_r, vc.ch_r FROM feat f JOIN vt USING (tt) JOIN vc USING (ch))
"""

# scaler statistics and the scaled numerics
SCALED = """
st AS (SELECT avg(amount_log) AS m0, avg(hour_sin) AS m1, avg(hour_cos) AS m2,
              CASE WHEN stddev_pop(amount_log) = 0 THEN 1.0 ELSE stddev_pop(amount_log) END AS s0,
              CASE WHEN stddev_pop(hour_sin) = 0 THEN 1.0 ELSE stddev_pop(hour_sin) END AS s1,
              CASE WHEN stddev_pop(hour_cos) = 0 THEN 1.0 ELSE stddev_pop(hour_cos) END AS s2 FROM feat),
sc AS (SELECT fv.*, (amount_log - m0) / s0 AS z0, (hour_sin - m1) / s1 AS z1, (hour_cos - m2) / s2 AS z2 FROM fv, st)
"""

# ctx numeric + one-hot vector in long form: (txn_id, dim, v), dims 0-based
CTXLONG = """
ctxl AS (
  SELECT txn_id, 0 AS dim, z0 AS v FROM sc
  UNION ALL SELECT txn_id, 1, z1 FROM sc
  UNION ALL SELECT txn_id, 2, z2 FROM sc
  UNION ALL SELECT txn_id, 2 + tt_r, 1.0 FROM sc
  UNION ALL SELECT txn_id, 2 + (SELECT nt FROM nv) + ch_r, 1.0 FROM sc)
"""

# hashed text vectors (16 dims) in long form: (txn_id, dim, v), dim 0..15
TEXTLONG = """
tok AS (SELECT txn_id, unnest(list_filter(string_split_regex(coalesce(msg_content, ''), '\\s+'), lambda x: x <> '')) AS w FROM txn),
ntok AS (SELECT txn_id, greatest(len(list_filter(string_split_regex(coalesce(msg_content, ''), '\\s+'), lambda x: x <> '')), 1) AS n FROM txn),
d16 AS (SELECT CAST(range AS INT) AS d FROM range(0, 16)),
tv AS (SELECT t.txn_id, d.d, sum(CAST(('0x' || substr(sha256(t.w || '#' || CAST(d.d // 16 AS VARCHAR)), 4 * (d.d % 16) + 1, 4)) AS BIGINT) / 65535.0 * 2.0 - 1.0) AS sv
       FROM tok t, d16 d GROUP BY t.txn_id, d.d),
textl AS (SELECT n.txn_id, d.d AS dim, coalesce(tv.sv, 0.0) / n.n AS v FROM ntok n CROSS JOIN d16 d LEFT JOIN tv ON tv.txn_id = n.txn_id AND tv.d = d.d)
"""

# sender snapshot state (time-decayed, half-life 2 days, lookback 10), long form normalised
SND = """
ap AS (SELECT DISTINCT sender_id, txn_date AS snapshot_date FROM feat),
win AS (SELECT ap.sender_id, ap.snapshot_date, e.txn_id, e.amount_log, e.hour_sin, e.hour_cos, e.tt_r, e.ch_r,
               exp(-(ln(2.0) / 2.0) * (date_diff('day', e.txn_date, ap.snapshot_date) + (86400 - e.sod) / 86400.0)) AS w
        FROM ap JOIN fv e ON e.sender_id = ap.sender_id AND e.txn_date >= ap.snapshot_date - 10 AND e.txn_date <= ap.snapshot_date),
comp AS (
  SELECT sender_id, snapshot_date, 0 AS dim, sum(w) AS v FROM win GROUP BY ALL
  UNION ALL SELECT sender_id, snapshot_date, 1, sum(w * amount_log) FROM win GROUP BY ALL
  UNION ALL SELECT sender_id, snapshot_date, 2, sum(w * hour_sin) FROM win GROUP BY ALL
  UNION ALL SELECT sender_id, snapshot_date, 3, sum(w * hour_cos) FROM win GROUP BY ALL
  UNION ALL SELECT sender_id, snapshot_date, 3 + tt_r, sum(w) FROM win GROUP BY ALL
  UNION ALL SELECT sender_id, snapshot_date, 3 + (SELECT nt FROM nv) + ch_r, sum(w) FROM win GROUP BY ALL),
dims AS (SELECT CAST(range AS INT) AS dim FROM range(0, 4 + (SELECT nt + nc FROM nv))),
dense AS (SELECT ap.sender_id, ap.snapshot_date, dims.dim, coalesce(comp.v, 0.0) AS v
          FROM ap CROSS JOIN dims LEFT JOIN comp USING (sender_id, snapshot_date, dim)),
snd AS (SELECT sender_id, snapshot_date, dim,
               v / greatest(sqrt(sum(v * v) OVER (PARTITION BY sender_id, snapshot_date)), 1e-9) AS value FROM dense),
sndn AS (SELECT sender_id, snapshot_date, count(*) AS n_window_txns FROM win GROUP BY ALL),
sndck AS (SELECT sender_id, snapshot_date, sum((dim + 1) * value) AS ck FROM snd GROUP BY ALL)
"""

STUB = """
cls AS (SELECT CAST(range AS INT) AS c FROM range(0, 10)),
lg AS (SELECT f.txn_id, cls.c,
              sin((cls.c + 1) * 1.0) * (f.amount_log / 10.0) + sin((cls.c + 1) * 2.0) * f.hour_sin + sin((cls.c + 1) * 3.0) * f.hour_cos AS logit
       FROM feat f CROSS JOIN cls),
lgm AS (SELECT lg.*, max(logit) OVER (PARTITION BY txn_id) AS mx FROM lg),
pr AS (SELECT txn_id, c, logit, mx, exp(logit - mx) / sum(exp(logit - mx)) OVER (PARTITION BY txn_id) AS p,
              ln(sum(exp(logit - mx)) OVER (PARTITION BY txn_id)) + mx AS lse FROM lgm),
am AS (SELECT txn_id, c AS pred, p AS conf FROM (
         SELECT pr.*, row_number() OVER (PARTITION BY txn_id ORDER BY p DESC, c) AS rn FROM pr) x WHERE rn = 1)
"""


def r6(x: str) -> str:
    return f"(ROUND({x}, 6) + 0.0)"


def with_(*ctes: str) -> str:
    parts = []
    named = {"txn": TXN, "ent": ENTITY, "mer": MERCHANT, "per": PERSON, "cust": CUSTOMER, "alias": ALIAS, "reply": REPLY, "lm": LABEL_MAP, "feat": FEAT}
    for c in ctes:
        if c in named:
            parts.append(f"{c} AS ({named[c]})")
        else:
            parts.append(c.strip())
    return "WITH " + ",\n".join(parts) + "\n"


def _type_rule_case(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in TYPE_RULES.items()) + " END"


def _keyword_hits() -> str:
    """Ordered list of matching (label, keyword) per row; constant patterns compile once."""
    cases = []
    for label, kws in KEYWORD_RULES:
        for kw in kws:
            rx = duckdb_keyword_regex(kw)
            cases.append(f"CASE WHEN regexp_matches(cleaned, '{rx}') THEN {{'label': '{label}', 'keyword': '{kw}'}} END")
    return "list_filter([" + ", ".join(cases) + "], lambda x: x IS NOT NULL)"


CLEAN = "clean AS (SELECT txn_id, tranx_type, strip_accents(lower(coalesce(msg_content, ''))) AS cleaned FROM txn)"
KWHITS = CLEAN + ",\nkwh AS (SELECT txn_id, tranx_type, " + _keyword_hits() + " AS hits FROM clean)"

_TR = _type_rule_case("tranx_type")
_Q = "'"
# rule layer result per txn: rl(txn_id, success, label, reason)
RULE = (
    KWHITS
    + ",\nrl AS (SELECT txn_id,\n"
    + f"  ({_TR}) IS NOT NULL OR len(hits) > 0 AS success,\n"
    + f"  coalesce({_TR}, hits[1].label) AS label,\n"
    + f"  CASE WHEN ({_TR}) IS NOT NULL THEN 'Matched tranx_type=' || tranx_type\n"
    + "       WHEN len(hits) > 0 THEN 'Keyword match " + _Q * 2 + "' || hits[1].keyword || '" + _Q * 2 + "'\n"
    + "       ELSE 'No rule matched' END AS reason\n"
    + "  FROM kwh)\n"
)

# parsed replies: rp(txn_id, parsed, has_label, label, confidence)
REPLIES = """
rj AS (SELECT txn_id, reply_text,
              CASE WHEN json_valid(reply_text) THEN reply_text
                   WHEN json_valid(regexp_extract(reply_text, '(?s)\\{.*\\}', 0)) THEN regexp_extract(reply_text, '(?s)\\{.*\\}', 0) END AS js
       FROM reply),
rp AS (SELECT txn_id, reply_text, js IS NOT NULL AS parsed,
              coalesce(json_exists(js, '$.label'), FALSE) AS has_label,
              json_extract_string(js, '$.label') AS label,
              coalesce(TRY_CAST(json_extract(js, '$.confidence') AS DOUBLE), 0.0) AS confidence
       FROM rj)
"""
