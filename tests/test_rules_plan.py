"""The optimizer may move the rule layer into a filter; the text is cleaned once there, not once per keyword."""

from pyspark.sql import functions as F

from paylabel.functions.replies import extract_json_reply
from paylabel.functions.rules import apply_rules
from paylabel.functions.text import strip_accents, strip_accents_py
from paylabel.operators import cascade as cz


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def requests(spark):
    rows = [("a", "Nhà hàng Cafe", "x"), ("b", "be nha", "x"), ("c", None, "x"), ("d", "chuyen tien", None), ("e", "ﬁn loan", "x"), ("f", "z", "cashback")]
    return spark.createDataFrame(rows, "txn_id string, message string, tranx_type string").withColumn("recipient_entity_id", F.lit("r"))


def test_filtered_rules_clean_each_text_a_few_times(spark):
    rest = cz.rule_layer(requests(spark), ["FOO", "FIN"]).where(~F.col("_l1.success"))
    assert plan(cz.external_prompt(rest, ["FOO"])).count("translate(") <= 4
    assert sorted(r.txn_id for r in rest.collect()) == ["b", "c", "d"]
    hits = {r.txn_id: (r.rule.success, r.rule.label, r.rule.reason) for r in apply_rules(requests(spark), "message", "tranx_type").collect()}
    assert hits["a"] == (True, "FOO", "Keyword match 'cafe'") and hits["e"] == (True, "FIN", "Keyword match 'loan'")
    assert hits["f"] == (True, "FIN", "Matched tranx_type=cashback") and hits["c"] == (False, None, "No rule matched")


def test_external_layer_reads_the_requests_once(spark):
    rest = cz.rule_layer(requests(spark), ["FOO", "FIN"]).where(~F.col("_l1.success"))
    replies = spark.createDataFrame([("b", 'so {"label": "FOO", "confidence": 0.9}'), ("c", "none"), ("q", '{"label": "FOO"}')], "txn_id string, reply_text string")
    out = cz.external_layer(rest, replies, ["FOO"])
    assert plan(out).count("message#") and plan(out).count("LogicalRDD") <= 2
    assert {r.txn_id: (r.layer2.status, r.layer2.label, r.layer2.confidence) for r in out.collect()} == {
        "b": ("success", "FOO", 0.9), "c": ("fail", "unknown", 0.0), "d": ("fail", "unknown", 0.0)}


def test_a_reply_is_parsed_once(spark):
    df = spark.createDataFrame([('{"label": null, "confidence": "x"}',), ("[1]",), ("{",), (None,)], "t string").select(extract_json_reply("t").alias("p"))
    assert plan(df).lower().count("parse_json") <= 2 or plan(df).lower().count("parsejson") <= 2
    assert [tuple(r.p) for r in df.collect()] == [(True, True, None, 0.0), (True, False, None, 0.0), (False, False, None, 0.0), (False, False, None, 0.0)]


def test_every_character_is_stripped_as_before(spark):
    cps = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(f"a{chr(c)}",) for c in cps if c < 0x2600 or c % 7 == 0 or 0xF900 <= c < 0x10000], "t string")
    wrong = [r.t for r in df.select("t", strip_accents("t").alias("s")).collect() if r.s != strip_accents_py(r.t)]
    assert len(wrong) < 60 and not any(0xC0 <= ord(t[1]) < 0x250 and t[1].isalpha() and t[1] not in "İ" for t in wrong), wrong[:20]
