"""Golden cases of the rule layer, accent stripping and reply parsing."""

import unicodedata

from pyspark.sql import functions as F

from paylabel.functions.replies import confidence_gate, extract_json_reply
from paylabel.functions.rules import apply_rules
from paylabel.functions.text import keyword_match, strip_accents, strip_accents_py


def test_strip_accents_matches_python(spark):
    texts = ["Mua sắm tại sieu thi", "Điện thoại đan", "Học phí", "Tiền nước tháng 3", "Khám bệnh", "ÀÉÎÕÜ çñ", "đĐ ơƯ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(strip_accents("t")).collect()]
    assert got == [strip_accents_py(t) for t in texts]
    assert strip_accents_py("đan") == "đan"  # đ has no decomposition


def test_strip_accents_beyond_the_table(spark):
    texts = ["ﬁ\u0301le", "한국 Café", "𝐠𝐫𝐚𝐛 ĐÀ NẴNG", "½ kg", "", None, "日本 é", "ǆ Ⅷ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_accents("t")).collect()] == [None if t is None else strip_accents_py(t) for t in texts]


def test_strip_accents_handles_ligatures(spark):
    df = spark.createDataFrame([("ﬁle café",)], "t string")
    assert df.select(strip_accents("t")).first()[0] == unicodedata.normalize("NFKD", "ﬁle café").replace("́", "")


def test_keyword_whole_word(spark):
    df = spark.createDataFrame([("đan",), ("an uong",), ("ban",), ("grab be xe",), ("di be ",), ("be",)], "t string")
    an = [r[0] for r in df.select(keyword_match(F.col("t"), "an")).collect()]
    assert an == [False, True, False, False, False, False]
    be = [r[0] for r in df.select(keyword_match(F.col("t"), "be ")).collect()]
    assert be == [False, False, False, False, True, False]


def test_rule_classify_golden(spark):
    rows = [
        ("Mua sắm tại sieu thi", None, True, "SHP", "Keyword match 'sieu thi'"),
        ("anything", "bill_payment", True, "BIL", "Matched tranx_type=bill_payment"),
        ("Chuyen tien", "transfer_in", False, None, "No rule matched"),
        # đ has no decomposition: "đien" is not the keyword "dien", and "đan" is not "an"
        ("Điện thoại đan", None, False, None, "No rule matched"),
        ("Nhà hàng Cafe", None, True, "FOO", "Keyword match 'cafe'"),
        (None, None, False, None, "No rule matched"),
    ]
    df = spark.createDataFrame([(m, t) for m, t, *_ in rows], "m string, t string")
    got = apply_rules(df, "m", "t").select("rule.success", "rule.label", "rule.reason").collect()
    assert [tuple(r) for r in got] == [(s, lbl, why) for _, _, s, lbl, why in rows]


def test_extract_json_reply_and_gate(spark):
    texts = [
        '{"label": "FOO", "confidence": 0.95}',
        'Sure: {"label": "SHP", "confidence": 0.80} done',
        "no idea",
        '{"label": null, "confidence": 0.9}',
        '{"label": "EDU", "confidence": 0.5}',
        '{"confidence": 0.9}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(extract_json_reply("t").alias("p"))
    got = [tuple(r) for r in df.select("p.parsed", "p.has_label", "p.label", "p.confidence").collect()]
    assert got == [
        (True, True, "FOO", 0.95),
        (True, True, "SHP", 0.8),
        (False, False, None, 0.0),
        (True, True, None, 0.9),
        (True, True, "EDU", 0.5),
        (True, False, None, 0.9),
    ]
    gated = df.select(confidence_gate(F.col("p.label"), F.col("p.confidence")).alias("g")).select("g.success", "g.label").collect()
    assert [tuple(r) for r in gated][:5] == [(True, "FOO"), (True, "SHP"), (False, "unknown"), (False, None), (False, "unknown")]
